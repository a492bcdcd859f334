import pytest
from hypothesis import given, settings as hsettings, strategies as st

from conftest import readings
from loadlens.functions.time import data_day, day_to_label, weekday_no, yyyymm
from loadlens.operators import ingest as I
from loadlens.operators import pairing as PR
from loadlens.operators import payload as PL
from loadlens.operators import watermark as WM
from loadlens.sources.schemas import ESTIMATE_PAYLOAD

ST = 1_700_000_000


@pytest.mark.parametrize("span,expect", [
    (0, []),
    (86339, [(0, 86339)]),
    (86340, [(0, 86339)]),
    (86341, [(0, 86339), (86340, 86341)]),
    (172680, [(0, 86339), (86340, 172679)]),
    (259200, [(0, 86339), (86340, 172679), (172680, 259019), (259020, 259200)]),
])
def test_chunks(spark, span, expect):
    df = spark.createDataFrame([("u", "1", ST, ST + span)], "user_id string, ser_id string, st long, et long")
    got = sorted((r.st - ST, r.et - ST) for r in I.chunk_windows(df).collect())
    assert got == expect


def test_short_span_passes_whole(spark):
    users = spark.createDataFrame([("a", "1"), ("b", "1")], "user_id string, ser_id string")
    wm = spark.createDataFrame([("a", ST - 86340)], "user_id string, commited_at long")
    got = sorted((r.user_id, r.st, r.et) for r in I.ingest_windows(users, wm, ST).collect())
    assert got[0] == ("a", ST - 86340, ST)
    assert [g for g in got if g[0] == "b"][-1] == ("b", ST - 259200 + 3 * 86340, ST)


def test_watermark_merge(spark):
    new = spark.createDataFrame([("a", 100), ("a", 120), ("b", 90)], "user_id string, commited_at long")
    old = spark.createDataFrame([("b", 50), ("c", 40)], "user_id string, commited_at long")
    assert sorted(map(tuple, WM.merge_watermarks(new, old).collect())) == [("a", 120), ("b", 90), ("c", 40)]
    empty = new.limit(0)
    assert sorted(map(tuple, WM.merge_watermarks(empty, old).collect())) == [("b", 50), ("c", 40)]


def test_latest_snapshot(spark):
    h = spark.createDataFrame([("a", 1, 2024010100), ("a", 5, 2024010200), ("b", 7, 2024010200),
                               ("b", 7, 2024010200)], "user_id string, commited_at long, et_hr int")
    assert sorted(map(tuple, WM.latest_snapshot(h).collect())) == [("a", 5), ("b", 7)]


def test_null_safe_pair(spark):
    r = readings(spark, [("u1", "300", 1, 3.0), ("u1", "300", 2, None),
                         ("u1", "301", 1, 4.0), ("u2", "301", 1, 9.0), ("u1", "301", 3, 5.0)])
    got = sorted((x.user_id, x.t, x.power) for x in PR.pair_fusion(r).collect())
    assert got == [("u1", 1, 7.0), ("u1", 2, 0.0), ("u1", 3, 5.0), ("u2", 1, 9.0)]


def _payload(spark, commited_at):
    row = {"customer": "u", "commited_at": commited_at, "st": 1000,
           "data": [{"timestamps": [1000, 2000, 3000], "main_pwrs": [9.0],
                     "app_type": [{"app_id": 1, "apps": [{"id": 71, "pwrs": [5.0, None, 7.0]}]},
                                  {"app_id": 2, "apps": [{"id": 72, "pwrs": [5.0, 0.0, 7.0]}]}]}]}
    return spark.createDataFrame([row], ESTIMATE_PAYLOAD)


def test_payload_flatten(spark):
    p = _payload(spark, 2500)
    est = PL.flatten_estimates(p)
    assert [tuple(x) for x in est.collect()] == [("u", 1, 71, 2000, None, 2500)]
    assert PL.flatten_main(p).count() == 0
    rec = PL.payload_records(p).collect()
    assert len(rec) == 1 and rec[0].est_json is not None and rec[0].main_json is None
    assert PL.flatten_estimates(_payload(spark, None)).count() == 0


def test_nest_unnest_roundtrip(spark):
    pts = spark.createDataFrame([("u", 1, 71, 100, 1.0), ("u", 2, 72, 100, None), ("u", 1, 71, 200, 3.0)],
                                "user_id string, app_type_id int, app_id int, t long, power double")
    back = PL.unnest_estimates(PL.nest_estimates(pts.union(pts)))     # landed twice
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, pts.collect()), key=str)


def test_labels(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(19723,)], "d long")
    r = df.select(day_to_label("d").alias("ymd"), yyyymm(day_to_label("d")).alias("m"),
                  weekday_no(F.date_from_unix_date(F.col("d").cast("int"))).alias("w"),
                  data_day(day_to_label("d") - 1).alias("dd")).collect()[0]
    assert (r.ymd, r.m, r.w, str(r.dd)) == (1704121200, 202401, 0, "2024-01-01")


def test_null_safe_sum_text(spark):
    from loadlens.functions.power import null_safe_sum
    df = spark.createDataFrame([("null", None), (" 3 ", None), ("3", "4"), (None, "null")], "a string, b string")
    assert [r[0] for r in df.select(null_safe_sum("a", "b")).collect()] == [0.0, 3.0, 7.0, 0.0]


def test_main_nest_unnest_roundtrip(spark):
    from pyspark.sql import functions as F
    from loadlens.sources.schemas import NESTED_MAIN
    est = spark.createDataFrame([("u", 1, 100, 1.0), ("u", 1, 200, None)],
                                "user_id string, app_id int, t long, power double")
    main = spark.createDataFrame([("u", 100, 9.0), ("u", 200, None), ("u", 300, 4.0)],
                                 "user_id string, t long, main double")
    nested = PL.nest_main(main, est)
    back = nested.select(F.from_json(F.to_json(F.struct("user_id", "data")), NESTED_MAIN).alias("r")).select("r.*")
    assert sorted(map(tuple, PL.unnest_main(back).collect()), key=str) == [("u", 100, 9.0), ("u", 200, None)]


def test_read_provider_tables(spark, capsys):
    from loadlens.session import fresh_path
    from loadlens.sources.readings import read_provider_tables
    base = fresh_path(spark, "providers")
    for p, n in (("1", 3), ("2", 2), ("5", 1)):
        spark.range(n).selectExpr("id AS user_id").write.parquet(f"{base}/ser_id={p}")
    df = read_provider_tables(spark, base, providers=["1", "5"])
    assert sorted((r.ser_id, r.user_id) for r in df.collect()) == [("1", 0), ("1", 1), ("1", 2), ("5", 0)]
    capsys.readouterr()
    df.explain("formatted")
    assert "PartitionFilters: [" in capsys.readouterr().out


def test_main_requires_kept_estimate_in_row(spark):
    row = {"customer": "u", "commited_at": 3500, "st": 1000,
           "data": [{"timestamps": [1000, 2000, 3000, 3400], "main_pwrs": [9.0, 8.0, 7.0, 6.0],
                     "app_type": [{"app_id": 1, "apps": [{"id": 1, "pwrs": [5.0, 0.0, None, 0.0]}]},
                                  {"app_id": 2, "apps": [{"id": 2, "pwrs": [5.0, 0.0, 0.0, 4.0]}]}]}]}
    p = spark.createDataFrame([row], ESTIMATE_PAYLOAD)
    got = sorted(tuple(r) for r in PL.flatten_main(p).collect())
    assert got == [("u", 3000, 7.0), ("u", 3400, 6.0)]          # 2000: no type kept; 1000: not after st
    via_join = PL.nest_main(PL.flatten_main(p, require_estimate=False), PL.flatten_estimates(p))
    assert sorted((x.timestamp, x.w_hp) for x in via_join.collect()[0].data) == [(3000, 7.0), (3400, 6.0)]


def test_payload_with_empty_arrays(spark):
    rows = [{"customer": "u", "commited_at": 10, "st": 0, "data": []},
            {"customer": "v", "commited_at": 10, "st": 0,
             "data": [{"timestamps": [5], "main_pwrs": [1.0], "app_type": [{"app_id": 1, "apps": []}]}]}]
    p = spark.createDataFrame(rows, ESTIMATE_PAYLOAD)
    assert PL.flatten_estimates(p).count() == 0
    assert PL.flatten_main(p).count() == 0


def _loop_chunks(st, et, step=86340):
    out = []
    while et - st > 0:
        if et - st >= step:
            out.append((st, st + step - 1))
            st += step
        else:
            out.append((st, et))
            break
    return out



@hsettings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-1000, 400_000), min_size=1, max_size=25))
def test_chunks_equal_loop(spark, spans):
    df = spark.createDataFrame([(f"u{i}", "1", ST, ST + s) for i, s in enumerate(spans)],
                               "user_id string, ser_id string, st long, et long")
    got = sorted((r.user_id, r.st, r.et) for r in I.chunk_windows(df).collect())
    want = sorted((f"u{i}", a, b) for i, s in enumerate(spans) for a, b in _loop_chunks(ST, ST + s))
    assert got == want
    wm = spark.createDataFrame([(f"u{i}", ST + s) for i, s in enumerate(spans)], "user_id string, commited_at long")
    now = ST + 400_000
    users = df.select("user_id", "ser_id")
    got_w = sorted((r.user_id, r.st, r.et) for r in I.ingest_windows(users, wm, now).collect())
    want_w = sorted((f"u{i}", a, b) for i, s in enumerate(spans)
                    for a, b in (_loop_chunks(ST + s, now) if now - (ST + s) >= 86400 else [(ST + s, now)]))
    assert got_w == want_w


@hsettings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u", "v"]), st.sampled_from(["cnt", "dur"]),
                          st.integers(0, 50), st.integers(0, 999)), min_size=1, max_size=40, unique_by=lambda x: x[2]))
def test_upsert_equals_newest(spark, cells):
    from loadlens.operators import store as STO
    schema = "user_id string, app_type_id string, ymd long, family string, col string, value string, version long"
    rows = [(u, "1", 1704121200, "Daily", c, str(v), ver) for u, c, ver, v in cells]
    half = len(rows) // 2
    a = spark.createDataFrame(rows[:half], schema)
    b = spark.createDataFrame(rows[half:], schema)
    got = sorted((r.user_id, r.col, r.value, r.version) for r in STO.upsert(a, b).collect())
    newest = {}
    for u, c, ver, v in cells:
        if (u, c) not in newest or ver > newest[(u, c)][1]:
            newest[(u, c)] = (str(v), ver)
    assert got == sorted((u, c, v, ver) for (u, c), (v, ver) in newest.items())


def test_short_power_array_invents_no_gap(spark):
    row = {"customer": "u", "commited_at": 3500, "st": 0,
           "data": [{"timestamps": [1000, 2000], "main_pwrs": [9.0, 8.0],
                     "app_type": [{"app_id": 1, "apps": [{"id": 71, "pwrs": [5.0]}]}]}]}
    p = spark.createDataFrame([row], ESTIMATE_PAYLOAD)
    assert [(r.t, r.power) for r in PL.flatten_estimates(p).collect()] == [(1000, 5.0)]
    rec = PL.payload_records(p).collect()
    assert rec[0].main_json == '{"user_id":"u","data":[{"timestamp":1000,"w_hp":9.0}]}'


def test_records_equal_the_two_nested_series(spark):
    from pyspark.sql import functions as F
    rows = [{"customer": u, "commited_at": 300_000, "st": 0,
             "data": [{"timestamps": list(range(s, s + 5000, 700)), "main_pwrs": [float(k % 3) for k in range(6)],
                       "app_type": [{"app_id": a, "apps": [{"id": 10 * a, "pwrs": [float((k * a) % 4) if k % 5 else None for k in range(8)]}]}
                                    for a in (1, 2)]}]} for u, s in (("u", 50_000), ("v", 52_000), ("v", 140_000))]
    p = spark.createDataFrame(rows + rows[:1], ESTIMATE_PAYLOAD)
    e = PL.nest_estimates(PL.flatten_estimates(p)).select("user_id", "partition", F.to_json(F.struct("user_id", "data")).alias("j"))
    m = PL.nest_main(PL.flatten_main(p)).select("user_id", "partition", F.to_json(F.struct("user_id", "data")).alias("j"))
    got = PL.payload_records(p).collect()
    assert sorted((r.user_id, r.partition, r.est_json) for r in got if r.est_json) == sorted(map(tuple, e.collect()))
    assert sorted((r.user_id, r.partition, r.main_json) for r in got if r.main_json) == sorted(map(tuple, m.collect()))


def test_pair_keeps_least_and_greatest(spark):
    from loadlens.operators.pairing import pair_fusion
    rows = [("u", "300", 1, 5.0), ("u", "300", 1, 50.0), ("u", "301", 1, 7.0), ("u", "300", 2, None), ("v", "301", 1, 3.0)]
    df = spark.createDataFrame(rows, "user_id string, app_type_id string, t long, power double")
    got = sorted((r.user_id, r.t, r.power_a, r.power_b, r.power) for r in pair_fusion(df).collect())
    assert got == [("u", 1, 5.0, 7.0, 12.0), ("u", 1, 50.0, 7.0, 57.0), ("u", 2, None, None, 0.0), ("v", 1, None, 3.0, 3.0)]


def test_alignment_is_linear_in_the_window(spark):
    import time
    from pyspark.sql import functions as F
    from loadlens.plans.payload_input import estimate_payloads

    def seconds(n):
        pts = spark.range(n).select(F.lit("u").alias("user_id"), (F.col("id") % 5 + 1).cast("int").alias("app_type_id"),
                                    F.col("id").alias("t"), F.lit(1.0).alias("power"))
        t0 = time.time()
        assert estimate_payloads(pts, 10**6, 0).count() == 1
        estimate_payloads(pts, 10**6, 0).write.format("noop").mode("overwrite").save()
        return time.time() - t0

    seconds(500)
    assert seconds(32_000) < 10 * max(seconds(4_000), 0.5)
