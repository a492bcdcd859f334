import os

from pyspark.sql import functions as F

from loadlens import jobs as J
from loadlens.functions.time import epoch_seconds
from loadlens.session import fresh_path
from loadlens.settings import Thresholds

SF = "/root/testdata/sf0.001"


def _readings(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    return e.select(F.col("user_id").cast("string").alias("user_id"), F.lit("2").alias("app_type_id"),
                    epoch_seconds(e, "ts").alias("t"), F.col("value").alias("power"))


def test_run_date():
    assert J.run_date_to_day("01302024") == 19751     # data day 2024-01-29


def test_daily_job_as_of_equals_backfill(spark):
    r = _readings(spark)
    th = Thresholds({"2": [10, 300, 21600]}).to_df(spark)
    day = J.run_date_to_day("01292024")      # data day 2024-01-28 has sessions at sf0.001
    full = J.daily_job(r, th).filter(F.col("day_no") == day).drop("tags").collect()
    one = J.daily_job(r, th, day).drop("tags").collect()
    assert sorted(map(tuple, full)) == sorted(map(tuple, one)) and len(one) > 0


def test_to_cells_and_weekly(spark):
    r = _readings(spark)
    th = Thresholds({"2": [10, 300, 21600]}).to_df(spark)
    d = J.daily_job(r, th)
    cells = J.to_cells(d, J.FAMILY_DAILY, J.DAILY_COLS, 7)
    assert cells.count() == d.count() * len(J.DAILY_COLS)
    assert set(cells.columns) == {"user_id", "app_type_id", "ymd", "family", "col", "value", "version"}
    w = J.weekly_job(d)
    assert w.count() >= d.select("user_id", "day_no").distinct().count()


def test_cli_daily_and_activity(spark):
    src = fresh_path(spark, "cli-readings")
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.select("user_id", F.lit("2").alias("app_type_id"), "ts", F.col("value").alias("power")).write.parquet(src)
    store = fresh_path(spark, "cli-store")
    J.main(["daily", "--readings", src, "--store", store, "--run-date", "01292024", "--version", "1"])
    J.main(["activity", "--readings", src, "--store", store, "--version", "2"])
    J.main(["util-long", "--readings", src, "--store", store, "--run-date", "01292024", "--version", "3"])
    J.main(["weekly", "--readings", src, "--store", store, "--run-date", "01292024", "--version", "4"])
    from pyspark.sql import SparkSession
    s = SparkSession.builder.getOrCreate()
    got = {r.col for r in s.read.parquet(store).select("col").distinct().collect()}
    assert {"cnt", "dur", "Otag", "iDay", "la", "l00", "l23", "wCnt", "ma4Cnt"} <= got
    assert os.path.isdir(store.removeprefix("file:"))


def test_cli_windows_and_ingest(spark):
    import json
    reg = fresh_path(spark, "cli-reg")
    spark.createDataFrame([("1_a", 1), ("2_b", 1), ("3_c", 0)], "user string, is_active int").write.parquet(reg)
    wm, out = fresh_path(spark, "cli-wm"), fresh_path(spark, "cli-win")
    now = 1_706_659_200
    J.main(["windows", "--registry", reg, "--allowed", "1,2", "--watermark", wm, "--out", out, "--now", str(now)])
    w = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert {r[0] for r in w} == {"1_a", "2_b"} and len(w) == 8        # 3 days -> 3 full chunks + remainder each
    pay = fresh_path(spark, "cli-pay").removeprefix("file:")
    os.makedirs(pay)
    with open(os.path.join(pay, "p.json"), "w") as f:
        f.write(json.dumps({"customer": "1_a", "commited_at": now - 100, "st": now - 1000,
                            "data": [{"timestamps": [now - 500, now - 50], "main_pwrs": [1.0, 1.0],
                                      "app_type": [{"app_id": 2, "apps": [{"id": 77, "pwrs": [20.0, 30.0]}]}]}]}) + "\n")
    pts = fresh_path(spark, "cli-pts")
    rec = fresh_path(spark, "cli-rec")
    J.main(["ingest", "--payloads", pay, "--points", pts, "--watermark", wm, "--run-hour", "2024013000", "--records", rec])
    assert [tuple(r) for r in spark.read.parquet(pts).select("user_id", "t", "power").collect()] == [("1_a", now - 500, 20.0)]
    from loadlens.operators.payload import unnest_estimates, unnest_main
    from loadlens.operators.sinks import load_with_schema
    from loadlens.sources.schemas import NESTED_ESTIMATE, NESTED_MAIN
    from pyspark.sql import types as T
    parts = {"batch": T.StringType(), "ser_id": T.StringType(), "partition": T.IntegerType()}
    e = load_with_schema(spark, f"{rec}/est", NESTED_ESTIMATE, parts)
    assert [(r.user_id, r.ser_id, r.t, r.power) for r in
            unnest_estimates(e).join(e.select("user_id", "ser_id"), "user_id").collect()] == [("1_a", "1", now - 500, 20.0)]
    m = load_with_schema(spark, f"{rec}/main", NESTED_MAIN, parts)
    assert [tuple(r) for r in unnest_main(m).collect()] == [("1_a", now - 500, 1.0)]
    J.main(["windows", "--registry", reg, "--allowed", "1,2", "--watermark", wm, "--out", out, "--now", str(now)])
    w2 = {(r.user_id, r.st, r.et) for r in spark.read.parquet(out).collect()}
    assert ("1_a", now - 100, now) in w2                              # resumes from its watermark


def test_cli_prunes_day_partitioned_readings(spark):
    from loadlens.functions.time import day_no
    src = fresh_path(spark, "cli-part-readings")
    e = spark.read.parquet(f"{SF}/events.parquet")
    r = e.select("user_id", F.lit("2").alias("app_type_id"), "ts", F.col("value").alias("power"),
                 epoch_seconds(e, "ts").alias("t"))
    r = r.withColumn("partition", F.date_format(F.date_from_unix_date(day_no("t").cast("int")), "yyyyMMdd").cast("int"))
    r.drop("t").write.partitionBy("partition").parquet(src)
    day = J.run_date_to_day("01292024")
    got = J._readings_from_parquet(spark, src, day - 13, day)
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    assert "PartitionFilters: [" in buf.getvalue() and "20240114" in buf.getvalue()
    full = J._readings_from_parquet(spark, src)
    want = full.filter((F.col("t") >= (day - 13) * 86400 - 32400) & (F.col("t") < (day + 1) * 86400 - 32400))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_incremental_daily_equals_recompute(spark):
    r = _readings(spark)
    th = Thresholds({"2": [10, 300, 21600]}).to_df(spark)
    store = fresh_path(spark, "inc-store")
    from loadlens.operators import store as STO
    full = J.daily_job(r, th)
    STO.upsert_table(spark, store, J.to_cells(full, J.FAMILY_DAILY, J.DAILY_COLS, 1))
    day = J.run_date_to_day("01292024")
    hist = J.store_daily_history(spark.read.parquet(store), day - 56, day - 1)
    inc = J.daily_job_incremental(r, th, hist, day)
    rec = J.daily_job(r, th, day)
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, rec.collect())) and inc.count() > 0


def test_months_between():
    assert J.months_between(19723 - 2, 19723 + 31) == [202312, 202401, 202402]


def test_weekly_from_store_equals_recompute(spark):
    r = _readings(spark)
    th = Thresholds({"2": [10, 300, 21600]}).to_df(spark)
    store = fresh_path(spark, "wk-store")
    from loadlens.operators import store as STO
    full = J.daily_job(r, th)
    STO.upsert_table(spark, store, J.to_cells(full, J.FAMILY_DAILY, J.DAILY_COLS, 1))
    day = J.run_date_to_day("01292024")
    from_store = J.weekly_job(J.store_daily_history(spark.read.parquet(store), day - 27, day), day)
    rec = J.weekly_job(full, day)
    assert sorted(map(tuple, from_store.collect())) == sorted(map(tuple, rec.collect())) and rec.count() > 0


def test_utilization_from_stored_sessions_equals_recompute(spark):
    r = _readings(spark)
    th = Thresholds({"2": [10, 300, 21600]}).to_df(spark)
    store = fresh_path(spark, "util-store")
    from loadlens.operators import store as STO
    full = J.daily_job(r, th)
    STO.upsert_table(spark, store, J.tag_cells(full, "Otag", 1))
    day = J.run_date_to_day("01292024")
    grid = r.select("user_id").distinct().withColumn("app_type_id", F.lit("2"))
    for kind, span in (("long", 28), ("short", 7), ("weekday", 56)):
        a = J.utilization_from_sessions(J.store_sessions(spark.read.parquet(store), day - span, day), grid, day, kind)
        b = J.utilization_job(r, th, grid, day, kind)
        key = lambda row: tuple("nan" if isinstance(v, float) and v != v else v for v in row)
        assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_cli_latenight_run_date_equals_full(spark):
    src = fresh_path(spark, "ln-readings")
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.select(F.col("user_id").cast("string").alias("user_id"), F.lit("2").alias("app_type_id"), "ts",
             F.col("value").alias("power")).write.parquet(src)
    full_store, one_store = fresh_path(spark, "ln-full"), fresh_path(spark, "ln-one")
    J.main(["latenight", "--readings", src, "--store", full_store, "--version", "1", "--special-user", "7"])
    J.main(["latenight", "--readings", src, "--store", one_store, "--version", "1", "--special-user", "7",
            "--run-date", "01202024"])
    m = (J.run_date_to_day("01202024") + 1) * 86400 - 32400
    one = sorted(map(tuple, spark.read.parquet(one_store).drop("yyyymm", "run").collect()))
    full = sorted(map(tuple, spark.read.parquet(full_store).filter(F.col("ymd") == m).drop("yyyymm", "run").collect()))
    assert one == full and len(one) > 0


def test_activity_incremental_equals_full(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    r = e.select(F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("app_type_id"),
                 epoch_seconds(e, "ts").alias("t"), F.col("value").alias("power"))
    th = Thresholds({k: [10, 0, 600] for k in ("click", "view", "error", "purchase", "signup")}).to_df(spark)
    full = J.activity_job(r, th)
    store = fresh_path(spark, "act-store")
    from loadlens.operators import store as STO
    STO.upsert_table(spark, store, J.to_cells(full, J.FAMILY_DAILY, {"la": "la"}, 1))
    for run in ("01152024", "01292024"):
        day = J.run_date_to_day(run)
        inc = J.activity_job_incremental(r, th, spark.read.parquet(store), day)
        want = full.filter(F.col("day_no") == day).select(*J.KEYS, "day_no", "la", "ymd")
        assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, want.collect())) and inc.count() > 0


def test_cli_from_payloads_to_metrics(spark):
    """Landed payload JSON -> ingest points -> daily, utilisation and activity cells, idle users included."""
    import json
    day = 19723                                  # 2024-01-01
    t0 = day * 86400 - 32400 + 9 * 3600          # 09:00 JST
    pay, pts, wm, store, reg = (fresh_path(spark, n).removeprefix("file:") for n in ("e2e-pay", "e2e-pts", "e2e-wm", "e2e-store", "e2e-reg"))
    os.makedirs(pay)
    times = [t0 + 60 * k for k in range(30)]
    with open(os.path.join(pay, "p.json"), "w") as f:
        f.write(json.dumps({"customer": "1_a", "commited_at": t0 + 86400, "st": t0 - 1,
                            "data": [{"timestamps": times, "main_pwrs": [50.0] * 30,
                                      "app_type": [{"app_id": 2, "apps": [{"id": 77, "pwrs": [40.0] * 30}]}]}]}) + "\n")
    spark.createDataFrame([("1_a", 1), ("2_idle", 1), ("3_left", 0)], "user string, is_active int").write.parquet(reg)
    J.main(["ingest", "--payloads", pay, "--points", pts, "--watermark", wm, "--run-hour", "2024010200"])
    for job in (["daily"], ["util-long", "--registry", reg], ["util-short", "--registry", reg], ["activity"]):
        J.main([job[0], "--readings", pts, "--store", store, "--run-date", "01022024", *job[1:]])
    cells = {(r.user_id, r.app_type_id, r.col): r.value for r in spark.read.parquet(store).collect()}
    assert cells["1_a", "2", "cnt"] == "1" and cells["1_a", "2", "dur"] == str(29 * 60)
    assert cells["1_a", "2", "l09"] == "1.0" and cells["1_a", "2", "la"] == str(times[-1])
    assert cells["2_idle", "2", "l09"] == "0.0" and cells["2_idle", "2", "s09"] == "NaN"
    assert not any(user == "3_left" for user, _, _ in cells)
    act = fresh_path(spark, "e2e-act").removeprefix("file:")
    os.makedirs(act)
    with open(os.path.join(act, "a.json"), "w") as f:
        f.write(json.dumps({"customer": "1_a", "fixed_at": t0 + 900, "st": t0,
                            "data": [{"timestamps": times, "appliance_types": [
                                {"appliance_type_id": 2, "appliances": [{"appliance_id": 77, "powers": [40.0] * 30}]}]}]}) + "\n")
    other = fresh_path(spark, "e2e-store2")
    J.main(["activity", "--payloads", act, "--store", other, "--run-date", "01022024"])
    assert [r.value for r in spark.read.parquet(other).collect()] == [str(t0 + 900)]


def test_cli_reads_nested_records(spark):
    from loadlens.operators.payload import nest_estimates
    from loadlens.operators.sinks import load_into_table
    t0 = 19723 * 86400 - 32400 + 3600
    pts = spark.createDataFrame([("1_a", 2, 77, t0 + 60 * k, 40.0) for k in range(20)],
                                "user_id string, app_type_id int, app_id int, t long, power double")
    base, store = fresh_path(spark, "nested-src"), fresh_path(spark, "nested-store")
    for ser in ("1", "2"):      # a folder per provider
        load_into_table(nest_estimates(pts if ser == "1" else pts.limit(0)), f"{base}/ser_id={ser}")
    J.main(["daily", "--readings", base, "--store", store, "--run-date", "01022024"])
    assert {r.col: r.value for r in spark.read.parquet(store).collect()}["dur"] == str(19 * 60)


def test_unreadable_tables_fail_the_jobs(spark):
    import pytest
    reg, bad = fresh_path(spark, "reg"), fresh_path(spark, "bad").removeprefix("file:")
    spark.createDataFrame([("1_a", 1)], "user string, is_active int").write.parquet(reg)
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        J.main(["windows", "--registry", reg, "--watermark", bad, "--out", fresh_path(spark, "out"), "--now", "1706659200"])
    with pytest.raises(Exception):
        J.main(["daily", "--readings", reg, "--store", bad, "--run-date", "01022024"])


def test_registry_over_jdbc_is_a_partitioned_read(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(J, "read_registry_jdbc", lambda spark, *a: seen.setdefault("args", a) and spark.createDataFrame([("1_a", 1)], "user string, is_active int"))
    out = fresh_path(spark, "jdbc-win")
    J.main(["windows", "--registry-jdbc", "jdbc:postgresql://h/db?a=1,users,id,0,1000", "--watermark", fresh_path(spark, "no-wm"), "--out", out, "--now", "1706659200"])
    assert seen["args"] == ("jdbc:postgresql://h/db?a=1", "users", "id", 0, 1000)
    assert {r.user_id for r in spark.read.parquet(out).collect()} == {"1_a"}
