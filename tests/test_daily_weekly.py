import pytest
from hypothesis import given, settings as hsettings, strategies as st

from conftest import D0_DAY
from loadlens.operators import daily as D
from loadlens.operators import weekly as W

U = "12_ab1"


def _daily(spark, days):
    return spark.createDataFrame(
        [(U, "25", d, c, c * 100) for d, c in days],
        "user_id string, app_type_id string, day_no long, cnt long, dur long")


@pytest.mark.parametrize("hist,today,high,low", [
    ([2, 2, 2, 2], 3, True, False),
    ([10, 10], 9, False, True),
    ([1, 3], 5, False, False),
    ([1, 3], 6, True, False),
    ([], 4, False, False),
])
def test_outlier_flags(spark, hist, today, high, low):
    T = D0_DAY + 100
    days = [(T - 1 - i * 2, c) for i, c in enumerate(hist)] + [(T, today)]
    u = D.daily_unusual(D.daily_baseline(_daily(spark, days))).filter(f"day_no = {T}").collect()[0]
    assert (u.u_h_cnt, u.u_l_cnt) == (high, low)
    assert (u.u_h_dur, u.u_l_dur) == (high, low)


def test_history_window_edges(spark):
    T = D0_DAY + 100
    u = D.daily_baseline(_daily(spark, [(T - 57, 50), (T - 56, 1), (T - 1, 3), (T, 3)]))
    r = u.filter(f"day_no = {T}").collect()[0]
    assert r.n_hist == 2 and r.avg_cnt == 2.0 and r.sd_cnt == 1.0


@pytest.mark.parametrize("back,expect", [(1, 1), (28, 28), (29, -1), (56, -1), (57, -1)])
def test_interval_days(spark, back, expect):
    T = D0_DAY + 100
    df = spark.createDataFrame([(1, T - back), (1, T)], "user_id long, day_no long")
    r = D.interval_days(df).filter(f"day_no = {T}").collect()[0]
    assert r.i_day == expect


def test_weekly_totals_integer_average(spark):
    Y = D0_DAY + 50
    w = W.weekly_totals(_daily(spark, [(Y - 6, 1), (Y - 3, 2), (Y, 2), (Y - 7, 40)]))
    r = w.filter(f"day_no = {Y}").collect()[0]
    assert (r.w_cnt, r.a_cnt, r.w_dur, r.a_dur) == (5, 1, 500, 166)


@pytest.mark.parametrize("weeks,ma4,high,low,wow", [
    ((4, 6, 8, 10), 7.0, False, False, 2),
    ((2, 2, 2, 14), 5.0, True, False, 12),
    ((10, 10, 10, 2), 8.0, False, True, -8),
    ((None, 6, 8, 10), 0.0, False, False, 2),
])
def test_weekly_trends(spark, weeks, ma4, high, low, wow):
    Y = D0_DAY + 50
    rows = [(U, "25", Y - 21 + 7 * i, c, c) for i, c in enumerate(weeks) if c is not None]
    wk = spark.createDataFrame(rows, "user_id string, app_type_id string, day_no long, w_cnt long, w_dur long")
    r = W.weekly_unusual(W.weekly_trends(wk)).filter(f"day_no = {Y}").collect()[0]
    assert (r.ma4_cnt, r.u_h_cnt, r.u_l_cnt, r.wow_cnt) == (ma4, high, low, wow)


def test_weekly_wow_absent_previous_week(spark):
    Y = D0_DAY + 50
    wk = spark.createDataFrame([(U, "25", Y, 9, 9), (U, "25", Y - 8, 3, 3)],
                               "user_id string, app_type_id string, day_no long, w_cnt long, w_dur long")
    r = W.weekly_trends(wk).filter(f"day_no = {Y}").collect()[0]
    assert r.wow_cnt == 0


def _brute_weekly(days):
    """Direct definition over {(user, day): (cnt, dur)}."""
    out = {}
    labels = {(u, d + k) for (u, d) in days for k in range(7)}
    for u, L in labels:
        rows = [days[(u, d)] for d in range(L - 6, L + 1) if (u, d) in days]
        wc, wd = sum(r[0] for r in rows), sum(r[1] for r in rows)
        out[(u, L)] = (wc, wd, wc // len(rows), wd // len(rows))
    res = {}
    for (u, L), (wc, wd, ac, ad) in out.items():
        prev = out.get((u, L - 7))
        wow = (wc - prev[0], wd - prev[1]) if prev else (0, 0)
        weeks = [out.get((u, L - k)) for k in (0, 7, 14, 21)]
        ma = (sum(w[0] for w in weeks) / 4.0, sum(w[1] for w in weeks) / 4.0) if all(weeks) else (0.0, 0.0)
        res[(u, L)] = (wc, ac, wd, ad) + wow + ma
    return res



@hsettings(max_examples=10, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60)),
                       st.tuples(st.integers(1, 5), st.integers(1, 5000)), min_size=1, max_size=60))
def test_weekly_equals_brute_force(spark, days):
    df = spark.createDataFrame([(u, "25", D0_DAY + d, c, du) for (u, d), (c, du) in days.items()],
                               "user_id string, app_type_id string, day_no long, cnt long, dur long")
    got = {(r.user_id, r.day_no - D0_DAY): (r.w_cnt, r.a_cnt, r.w_dur, r.a_dur, r.wow_cnt, r.wow_dur,
                                            r.ma4_cnt, r.ma4_dur)
           for r in W.weekly_trends(W.weekly_totals(df)).collect()}
    assert got == _brute_weekly(days)


def _brute_flags(days, u, d):
    from fractions import Fraction
    hist = [days[(u, x)] for x in range(d - 56, d) if (u, x) in days]
    prev = [x for x in range(d - 56, d) if (u, x) in days]
    iday = -1 if not prev or d - max(prev) > 28 else d - max(prev)
    if not hist:
        return (False, False, False, False, iday)
    flags = []
    for k in (0, 1):
        xs = [Fraction(h[k]) for h in hist]
        mean = sum(xs) / len(xs)
        var = sum((x - mean) ** 2 for x in xs) / len(xs)
        dev = Fraction(days[(u, d)][k]) - mean
        high = dev > 0 and dev * dev > 9 * var
        low = (not high) and dev < 0 and dev * dev > 9 * var
        flags += [high, low]
    return (flags[0], flags[1], flags[2], flags[3], iday)


@hsettings(max_examples=10, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 90)),
                       st.tuples(st.integers(1, 6), st.integers(1, 3000)), min_size=1, max_size=70))
def test_daily_flags_equal_brute_force(spark, days):
    df = spark.createDataFrame([(u, "25", D0_DAY + d, c, du) for (u, d), (c, du) in days.items()],
                               "user_id string, app_type_id string, day_no long, cnt long, dur long")
    b = D.daily_unusual(D.daily_baseline(df))
    got = {(r.user_id, r.day_no - D0_DAY): (r.u_h_cnt, r.u_l_cnt, r.u_h_dur, r.u_l_dur,
                                            -1 if r.last_active is None or r.day_no - r.last_active > 28
                                            else r.day_no - r.last_active)
           for r in b.collect()}
    assert got == {(u, d): _brute_flags(days, u, d) for (u, d) in days}
