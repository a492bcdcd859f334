"""Plan shape guards: shuffles stay where the design puts them, scans stay pruned."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name, capsys):
    capsys.readouterr()
    E.queries()[name](spark, SF).explain("formatted")
    return capsys.readouterr().out


def _shuffles(plan):
    return len(re.findall(r"^\(\d+\) Exchange$", plan, flags=re.M))


@pytest.mark.parametrize("name,expected", [
    ("daily_metrics", 2),      # bucket partial aggregates, then bucket summaries by key and day
    ("daily_unusual", 3),      # day rows by key for the history windows
    ("weekly_unusual", 3),     # day rows by label, then by key for the trend frames
    ("profile_rolling", 2),    # daily min/max, then one shuffle of day rows before the fan-out
    ("last_activity_carry", 2),
    ("daily_job", 3),          # the full daily job row, session lists included
])
def test_shuffle_count(spark, capsys, name, expected):
    assert _shuffles(_plan(spark, name, capsys)) == expected


def test_scan_is_pruned(spark, capsys):
    plan = _plan(spark, "daily_metrics", capsys)
    schemas = re.findall(r"ReadSchema: (struct<.*>)", plan)
    assert schemas == ["struct<ts:timestamp_ntz,user_id:bigint,value:double>"]


def test_nested_range_prunes_partitions(spark, capsys):
    plan = _plan(spark, "readings_range_nested", capsys)
    assert re.search(r"PartitionFilters: \[.*partition#\d+ >= 20240108.*partition#\d+ <= 20240115", plan)


@pytest.mark.parametrize("name", ["util_long", "util_short", "util_long_fraction", "util_weekday", "profile_minmax"])
def test_time_range_reaches_the_scan(spark, capsys, name):
    plan = _plan(spark, name, capsys)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,.*LessThan\(ts,", plan)


def test_job_range_reaches_every_scan(spark, capsys):
    from pyspark.sql import functions as F
    from loadlens import jobs as J
    from loadlens.plans import fixtures as X
    from loadlens.session import fresh_path
    path = fresh_path(spark, "job-readings")
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.select("user_id", F.element_at(F.array(F.lit("300"), F.lit("301")), (F.col("event_id") % 2 + 1).cast("int")).alias("app_type_id"),
             F.col("ts"), F.col("value").alias("power")).write.parquet(path)
    r = J._readings_from_parquet(spark, path, X.AS_OF_DAY - 56, X.AS_OF_DAY)
    for df in (J.daily_job(r, X.PAIR_THRESHOLDS.to_df(spark), X.AS_OF_DAY),
               J.profile_job(r, X.PAIR_THRESHOLDS.to_df(spark), X.AS_OF_DAY)):
        capsys.readouterr()
        df.explain("formatted")
        pushed = re.findall(r"PushedFilters: \[(.*)\]", capsys.readouterr().out)
        assert len(pushed) == 2 and all("GreaterThanOrEqual(ts," in p for p in pushed)


@pytest.mark.parametrize("name, scans", [("payload_records", 1), ("null_safe_sum", 2), ("readings_union_providers", 1)])
def test_scan_count(spark, capsys, name, scans):
    assert len(re.findall(r"^\(\d+\) Scan parquet", _plan(spark, name, capsys), flags=re.M)) == scans
