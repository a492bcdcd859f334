"""Loads with a quarantine, provider tables that differ, and baselines from running moments."""

import json
import random

import pytest
from conftest import D0_DAY
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens import jobs as J
from loadlens.operators import daily as D
from loadlens.operators import sinks as SK
from loadlens.operators import store as ST
from loadlens.session import fresh_path
from loadlens.sources.readings import read_differing_providers
from loadlens.sources.schemas import NESTED_ESTIMATE

SF = "/root/testdata/sf0.001"
GOOD = {"user_id": "u", "data": [{"timestamp": 1, "app_types": [{"app_type_id": 2, "apps": [{"app_id": 3, "pwr": None}]}]}]}
BAD = {
    "malformed record": ['{"user_id": "u", "data": [', "nothing", '{"user_id": "u", "data": "oops"}', '{"user_id": "u", "data": [{"timestamp": "x"}]}'],
    "required field is missing: user_id": [json.dumps({"data": GOOD["data"]})],
    "required field is missing: data[].timestamp": [json.dumps({"user_id": "u", "data": [{"app_types": []}]})],
    "required field is missing: data[].app_types[].app_type_id": [json.dumps({"user_id": "u", "data": [{"timestamp": 1, "app_types": [{"apps": []}]}]})],
    "required field is missing: data[].app_types[].apps[].app_id": [
        json.dumps({"user_id": "u", "data": [{"timestamp": 1, "app_types": [{"app_type_id": 2, "apps": [{"app_id": 1}, {"pwr": 1.0}]}]}]})],
}


def landed(spark, lines):
    path = fresh_path(spark, "q-src")
    spark.createDataFrame([(x, 20240101) for x in lines], "v string, partition int").write.partitionBy("partition").text(path)
    return path


def test_quarantine_keeps_the_good_records(spark):
    bad = [(x, why) for why, xs in BAD.items() for x in xs]
    src = landed(spark, [json.dumps(GOOD), json.dumps({"user_id": "v"}), "", "   ", *[x for x, _ in bad]])
    table, rest = fresh_path(spark, "q-table"), fresh_path(spark, "q-rest")
    cols = {"partition": T.IntegerType()}
    assert SK.load_with_quarantine(spark, src, NESTED_ESTIMATE, table, rest, cols, most_share=0.9) == (2, len(bad))
    loaded = spark.read.parquet(table)
    assert sorted(r.user_id for r in loaded.collect()) == ["u", "v"] and loaded.columns == ["user_id", "data", "partition"]
    got = spark.read.parquet(rest).collect()
    assert sorted((r._text, r._reason) for r in got) == sorted(bad) and all(r.partition == 20240101 and "part-" in r._file for r in got)


def test_too_many_rejected_records_leave_the_table_alone(spark):
    src = landed(spark, [json.dumps(GOOD)] * 3 + ["nothing"])
    table, rest = fresh_path(spark, "q-table"), fresh_path(spark, "q-rest")
    with pytest.raises(SK.TooManyRejected, match="1 of 4 records rejected"):
        SK.load_with_quarantine(spark, src, NESTED_ESTIMATE, table, rest, {"partition": T.IntegerType()}, most_share=0.2)
    assert [r._reason for r in spark.read.parquet(rest).collect()] == ["malformed record"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(table)
    good = landed(spark, [json.dumps(GOOD)])
    assert SK.load_with_quarantine(spark, good, NESTED_ESTIMATE, table, rest, {"partition": T.IntegerType()}, most_share=0.0) == (1, 0)
    with pytest.raises(Exception):      # the strict load still fails on the same records
        SK.load_with_schema(spark, src, NESTED_ESTIMATE, {"partition": T.IntegerType()}).collect()


SCHEMA = T.StructType([T.StructField("user_id", T.LongType(), False), T.StructField("kind", T.StringType()), T.StructField("power", T.DoubleType())])


def test_differing_providers_are_scanned_once_for_declared_columns(spark, capsys):
    a, b = fresh_path(spark, "prov-a"), fresh_path(spark, "prov-b")
    spark.createDataFrame([(1, "x", 2.0, "more")], "user_id long, kind string, power double, note string").write.parquet(a)
    spark.createDataFrame([("3.5", 7)], "watts string, USER_ID int").write.parquet(b)
    u = read_differing_providers(spark, {"1": a, "2": b}, SCHEMA, {"2": {"power": "watts"}})
    assert sorted(tuple(r) for r in u.collect()) == [(1, "x", 2.0, "1"), (7, None, 3.5, "2")]
    assert [f.dataType for f in u.schema.fields][:3] == [f.dataType for f in SCHEMA.fields]
    u.select("user_id", "power").explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("ReadSchema") == 2 and "note" not in plan.split("ReadSchema", 1)[1].split("\n")[0]
    with pytest.raises(ValueError, match="provider '2' has no column 'customer'"):
        read_differing_providers(spark, {"1": a, "2": b}, SCHEMA, {"2": {"user_id": "customer"}})
    c = fresh_path(spark, "prov-c")
    spark.createDataFrame([("no number", 7)], "power string, user_id int").write.parquet(c)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_differing_providers(spark, {"3": c}, SCHEMA).collect()


def test_moments_rolled_day_by_day_and_over_gaps(spark):
    r = random.Random(8)
    rows = [(u, "2", d, r.randint(1, 40), r.randint(1, 90_000)) for u in "abc" for d in range(100, 170) if r.random() < 0.6 or (u == "c" and d > 160)]
    rows = [x for x in rows if not (x[0] == "b" and 110 < x[2] < 140)]
    daily = spark.createDataFrame(rows, "user_id string, app_type_id string, day_no long, cnt long, dur long").withColumn("ymd", F.col("day_no") * 86400 + 54000).cache()
    flags = ["u_h_cnt", "u_l_cnt", "u_h_dur", "u_l_dur", "last_active", "n_hist"]
    keys = ["user_id", "app_type_id", "day_no"]
    for days in (5, 56):
        want = {tuple(x)[:3]: tuple(x)[3:] for x in D.daily_unusual(D.daily_baseline(daily, days=days)).select(*keys, *flags).collect()}
        state, at = D.moments_of(daily, 130, days=days), 130
        for day in (131, 132, 133, 140, 169):       # single days and gaps
            state = D.roll_moments(state, daily.filter(F.col("day_no").between(at, day - 1)),
                                   daily.filter(F.col("day_no").between(at - days, day - 1 - days)), day, days=days)
            state = spark.createDataFrame(state.collect(), state.schema)     # as if stored by one run and read by the next
            at = day
            got = {tuple(x)[:3]: tuple(x)[3:] for x in D.daily_from_moments(daily.filter(F.col("day_no") == day), state).select(*keys, *flags).collect()}
            assert got == {k: v for k, v in want.items() if k[2] == day}
            assert sorted(map(tuple, state.collect())) == sorted(map(tuple, D.moments_of(daily, day, days=days).collect()))
    daily.unpersist()


def test_cli_daily_from_moments_equals_history(spark):
    src = fresh_path(spark, "m-readings")
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.select(F.col("user_id").cast("string").alias("user_id"), F.lit("2").alias("app_type_id"), "ts", (F.col("value") + 100).alias("power")).write.parquet(src)
    by_history, by_moments, moments = fresh_path(spark, "m-store"), fresh_path(spark, "m-store2"), fresh_path(spark, "m-moments")
    backfill = fresh_path(spark, "m-first")
    J.main(["daily", "--readings", src, "--store", backfill, "--version", "1"])
    first = ST.stored_cells(spark, backfill).filter(F.col("ymd") < (D0_DAY + 20) * 86400 + 54000)
    for store in (by_history, by_moments):
        ST.append_cells(spark, store, first)
        ST.mark_covered(spark, store, "daily", 0, D0_DAY + 19)
    for run in ("01222024", "01232024", "01262024"):      # two days without a run: the last is computed from readings
        J.main(["daily", "--readings", src, "--store", by_history, "--run-date", run, "--version", "2"])
        J.main(["daily", "--readings", src, "--store", by_moments, "--run-date", run, "--version", "2", "--moments", moments])
    a, b = (sorted(map(tuple, ST.stored_cells(spark, s).collect())) for s in (by_history, by_moments))
    assert a == b and any(x[6] == 2 and x[4] == "cnt" for x in a)
    assert spark.read.parquet(moments).select("day_no").distinct().count() == 2
    for day in (20, 21, 24):
        label = (D0_DAY + day) * 86400 + 54000
        whole = sorted((r.user_id, r["col"], r.value) for r in ST.stored_cells(spark, backfill).filter(F.col("ymd") == label).collect())
        assert whole == sorted((x[0], x[4], x[5]) for x in b if x[2] == label)


def test_stores_with_other_cells_are_no_history(spark):
    path = fresh_path(spark, "cover")
    ST.append_cells(spark, path, spark.createDataFrame([("u", "2", 1704121200, "Daily", "la", "5", 1)],
                                                       "user_id string, app_type_id string, ymd long, family string, col string, value string, version long"))
    assert not ST.is_covered(spark, path, "daily", 10, 12)
    for lo, hi in ((11, 11), (0, 9), (10, 10)):
        ST.mark_covered(spark, path, "daily", lo, hi)
    ST.mark_covered(spark, path, "activity", 12, 12)
    assert ST.is_covered(spark, path, "daily", 3, 11) and not ST.is_covered(spark, path, "daily", 3, 12) and ST.is_covered(spark, path, "activity", 12, 12)
    assert ST.stored_cells(spark, path).count() == 1
