import math

from hypothesis import given, settings as hsettings, strategies as st

from conftest import D0, D0_DAY, readings
from loadlens.operators import activity as A
from loadlens.operators import latenight as L
from loadlens.operators import profile as P
from loadlens.operators import utilization as UT
from loadlens.settings import Thresholds, special_users_df

U = "12_ab1"


def _sess_daily(spark, day_hours):
    """Sessions starting at the given JST hour on the given day offsets, and matching daily rows."""
    s = [(U, "25", D0_DAY + d, D0 + d * 86400 + h * 3600, D0 + d * 86400 + h * 3600 + 900)
         for d, h in day_hours]
    sess = spark.createDataFrame(s, "user_id string, app_type_id string, day_no long, st long, et long")
    days = sorted({d for d, _ in day_hours})
    daily = spark.createDataFrame([(U, "25", D0_DAY + d, 1, 900) for d in days],
                                  "user_id string, app_type_id string, day_no long, cnt long, dur long")
    grid = spark.createDataFrame([(U, "25"), ("other", "25")], "user_id string, app_type_id string")
    return sess, daily, grid


def _hours(row, prefix):
    return [row[f"{prefix}{h:02d}"] for h in range(24)]


def test_long_short_fraction(spark):
    sess, daily, grid = _sess_daily(spark, [(0, 7), (1, 7), (2, 20)])
    as_of = D0_DAY + 3
    lo = {r.user_id: r for r in UT.utilization_long(sess, grid, as_of).collect()}
    sh = {r.user_id: r for r in UT.utilization_short(sess, grid, as_of).collect()}
    fr = {r.user_id: r for r in UT.utilization_long_fraction(sess, grid, as_of).collect()}
    h = _hours(lo[U], "l")
    assert h[7] == h[20] == 1 / 3 and sum(h) == 2 / 3
    assert _hours(sh[U], "s")[7] == 1 / 3
    f = _hours(fr[U], "l")
    assert f[7] == 2 / 3 and f[20] == 1 / 3
    assert _hours(lo["other"], "l") == [0.0] * 24
    assert all(math.isnan(x) for x in _hours(sh["other"], "s"))


def test_weekday_profile(spark):
    sess, daily, grid = _sess_daily(spark, [(0, 7), (7, 7), (14, 20), (15, 3)])
    as_of = D0_DAY + 14
    wd = {r.user_id: r for r in UT.utilization_weekday(sess, grid, as_of).collect()}
    h = _hours(wd[U], "")
    assert h[7] == h[20] == 0.125 and h[3] == 0.0
    assert _hours(wd["other"], "") == [0.0] * 24


def test_profile_minmax_and_rolling(spark):
    r = readings(spark, [(U, "25", D0 + 100, 5.0), (U, "25", D0 + 86400 * 13 + 5, 50.0),
                         (U, "25", D0 - 10, 999.0), (U, "25", D0 + 200, None)])
    r = P.profile_readings(r, Thresholds().to_df(spark))
    m = P.profile_minmax(r, D0_DAY + 13).collect()[0]
    assert (m.min_power, m.max_power) == (5.0, 50.0)
    roll = {x.day_no: (x.min_power, x.max_power) for x in P.profile_rolling(r).collect()}
    assert roll[D0_DAY + 13] == (5.0, 50.0)
    assert roll[D0_DAY - 1] == (999.0, 999.0) and roll[D0_DAY + 12] == (5.0, 999.0)


def test_latenight(spark):
    M = D0 + 86400
    th = Thresholds({"25": [10, 300, 3600]}).to_df(spark)
    sp = special_users_df(spark, {"sp": (-7200, 18000)})
    rows = []
    for u in (U, "sp"):
        rows += [(u, "25", M - 3600, 20.0), (u, "25", M + 100, 20.0), (u, "25", M + 1000, 20.0)]
    rows += [("short", "25", M + 100, 20.0), ("short", "25", M + 200, 20.0)]
    lr = L.latenight_readings(readings(spark, rows), sp)
    kept = {(x.user_id, x.t - M) for x in lr.collect()}
    assert (U, -3600) not in kept and ("sp", -3600) in kept
    ls = L.latenight_sessions(lr, th, sp)
    got = sorted((x.user_id, x.st - M, x.et - M) for x in ls.filter("kept").collect())
    assert got == [("12_ab1", 100, 19000), ("sp", -7100, 19000)]
    tags = {x.user_id: x.tags for x in L.latenight_tags(ls).collect()}
    assert tags["short"] == [] and len(tags[U]) == 1


def test_last_activity_carry(spark):
    th = Thresholds({"25": [10, 0, 600]}).to_df(spark)
    rows = [("a", "25", D0 + 100, 20.0), ("a", "25", D0 + 300, 20.0), ("a", "25", D0 + 400, 5.0),
            ("b", "25", D0 + 80, 20.0), ("b", "25", D0 + 86400 + 50, 5.0),
            ("c", "25", D0 + 50, 5.0),
            ("d", "25", D0 + 80, 20.0), ("d", "25", D0 + 3 * 86400, 5.0)]
    la = A.last_activity(readings(spark, rows), th)
    c = {(x.user_id, x.day_no - D0_DAY): x.la for x in A.last_activity_carry(la).collect()}
    assert c[("a", 0)] == D0 + 300
    assert c[("b", 1)] == D0 + 80
    assert c[("c", 0)] == 0
    assert c[("d", 3)] == 0       # no reading on the days between: nothing to carry


def test_last_activity_compat_idle_last_slot(spark):
    th = Thresholds({"25": [10, 0, 600]}).to_df(spark)
    U0 = D0 + 32400                      # 00:00 UTC, so UTC and JST-shifted days line up for the check
    rows = [("a", "25", U0 - 86400 + 80, 20.0),                  # yesterday: 80
            ("a", "25", U0 + 300, 20.0), ("a", "25", U0 + 7200, 5.0)]   # today: 300, then an idle slot
    build = {(x.day_no, x.la) for x in A.last_activity_carry(A.last_activity(readings(spark, rows), th)).collect()}
    lit = {(x.day_no, x.la) for x in
           A.last_activity_carry(A.last_activity(readings(spark, rows), th, compat=True)).collect()}
    today = (U0 + 300) // 86400
    assert (today, U0 - 86400 + 80) in lit                        # literal regresses to yesterday
    assert max(v for _, v in build) == U0 + 300                   # build keeps today's 300


def test_weekly_wow_compat_is_zero(spark):
    from loadlens.operators import weekly as W
    wk = spark.createDataFrame([(U, "25", D0_DAY, 9, 9), (U, "25", D0_DAY - 7, 3, 3)],
                               "user_id string, app_type_id string, day_no long, w_cnt long, w_dur long")
    r = W.weekly_trends(wk, compat=True).filter(f"day_no = {D0_DAY}").collect()[0]
    assert (r.wow_cnt, r.wow_dur) == (0, 0)



@hsettings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 12 * 86400 - 1),
                          st.sampled_from([None, 3.0, 11.0, 50.0])), min_size=1, max_size=80))
def test_last_activity_carry_equals_brute_force(spark, pts):
    th = Thresholds({"25": [10, 0, 600]}).to_df(spark)
    r = readings(spark, [(u, "25", D0 + t, p) for u, t, p in pts])
    got = {(x.user_id, x.day_no - D0_DAY): x.la for x in A.last_activity_carry(A.last_activity(r, th)).collect()}
    days = {}
    for u, t, p in pts:
        d = t // 86400
        best = days.setdefault((u, d), None)
        if p is not None and p > 10:
            days[(u, d)] = max(best or 0, D0 + t)
    want = {}
    for (u, d) in sorted(days, key=lambda k: k[1]):
        v = days[(u, d)]
        if v is None:
            v = want.get((u, d - 1), 0) if (u, d - 1) in days else 0
        want[(u, d)] = v
    assert got == want


@hsettings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40), st.integers(0, 23)),
                min_size=0, max_size=40))
def test_utilization_equals_brute_force(spark, starts):
    rows = [(u, "25", D0_DAY + d, D0 + d * 86400 + h * 3600 + 17, D0 + d * 86400 + h * 3600 + 999)
            for u, d, h in starts]
    sess = spark.createDataFrame(rows, "user_id string, app_type_id string, day_no long, st long, et long")
    grid = spark.createDataFrame([("a", "25"), ("b", "25"), ("c", "25")], "user_id string, app_type_id string")
    as_of = D0_DAY + 40
    lo = {r.user_id: _hours(r, "l") for r in UT.utilization_long(sess, grid, as_of).collect()}
    fr = {r.user_id: _hours(r, "l") for r in UT.utilization_long_fraction(sess, grid, as_of).collect()}
    wd = {r.user_id: _hours(r, "") for r in UT.utilization_weekday(sess, grid, as_of).collect()}
    for u in ("a", "b", "c"):
        mine = [(d, h) for uu, d, h in starts if uu == u]
        in28 = [(d, h) for d, h in mine if 40 - 27 <= d <= 40]
        n = len({d for d, _ in in28})
        assert lo[u] == [(1.0 / n if any(h == x for _, h in in28) else 0.0) if n else 0.0 for x in range(24)]
        assert fr[u] == [len({d for d, h in in28 if h == x}) / n if n else 0.0 for x in range(24)]
        same = [(d, h) for d, h in mine if (40 - d) % 7 == 0 and 0 <= 40 - d < 56]
        assert wd[u] == [(1.0 if any(h == x for _, h in same) else 0.0) / 8 for x in range(24)]


@hsettings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["sp", "r"]), st.integers(0, 4 * 86400 - 1),
                          st.sampled_from([5.0, 20.0])), min_size=1, max_size=80),
       st.sampled_from([60, 600, 3600]), st.sampled_from([0, 100]))
def test_latenight_equals_brute_force(spark, pts, gap, min_dur):
    th = Thresholds({"25": [10, min_dur, gap]}).to_df(spark)
    sp = special_users_df(spark, {"sp": (-7200, 18000)})
    lr = L.latenight_readings(readings(spark, [(u, "25", D0 + t, p) for u, t, p in pts]), sp)
    ls = L.latenight_sessions(lr, th, sp)
    got_s = sorted((x.user_id, x.ymd, x.st, x.et) for x in ls.filter("kept").collect())
    got_n = {(x.user_id, x.ymd): len(x.tags) for x in L.latenight_tags(ls).collect()}
    groups = {}
    for u, t, p in pts:
        t = D0 + t
        m = ((t + 32400 + 7200) // 86400) * 86400 - 32400
        lo = -7200 if u == "sp" else 0
        if lo <= t - m < 18000 and p > 10:
            groups.setdefault((u, m), []).append(t)
    want_s, want_n = [], {}
    for (u, m), ts in groups.items():
        ts.sort()
        runs, start, prev = [], ts[0], ts[0]
        for t in ts[1:]:
            if t - prev > gap:
                runs.append((start, prev))
                start = t
            prev = t
        runs.append((start, prev))
        kept = [(s, e) for s, e in runs if e - s > min_dur]
        want_n[(u, m)] = len(kept)
        want_s += [(u, m, s - 7200 if u == "sp" else s, e + 18000) for s, e in kept]
    assert got_s == sorted(want_s)
    assert got_n == want_n
