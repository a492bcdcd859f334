"""Landed payload files, read with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadlens.sources.schemas import ACTIVITY_PAYLOAD, ESTIMATE_PAYLOAD, NESTED_ESTIMATE


def read_estimate_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ESTIMATE_PAYLOAD).option("mode", "FAILFAST").json(path)


def read_activity_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ACTIVITY_PAYLOAD).option("mode", "FAILFAST").json(path)


def read_nested_estimates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NESTED_ESTIMATE).option("mode", "FAILFAST").json(path)


def read_nested_range(spark: SparkSession, path: str, start_t: int, end_t: int) -> DataFrame:
    """Readings with ``start_t <= t <= end_t`` from a day-partitioned nested table.

    The table is parquet partitioned by ``partition`` (yyyymmdd of the JST
    day).  The day bounds derived from the time range prune partitions at
    planning time; the exact time predicate is applied after the unnest.
    """
    from pyspark.sql import functions as F

    from loadlens.operators.payload import unnest_estimates

    def day_of(t: int) -> int:
        import datetime as dt
        d = dt.datetime.fromtimestamp(t + 32400, dt.timezone.utc)
        return d.year * 10000 + d.month * 100 + d.day

    t = spark.read.parquet(path)
    t = t.filter((F.col("partition") >= day_of(start_t)) & (F.col("partition") <= day_of(end_t)))
    flat = unnest_estimates(t)
    return flat.filter((F.col("t") >= start_t) & (F.col("t") <= end_t))
