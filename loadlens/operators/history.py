"""Daily history as a catalog table bucketed by (user, type).

The store keeps cells by month, family and label day, so each job that reads
weeks of them deals them by key again.  ``publish`` turns the newest Daily and
OneTag cells into one row per key and day, bucketed by key within its month,
one file a bucket.  What groups, windows or joins by (user, type) over
``history`` then needs no exchange on that side, whatever the number of days.

The table names the data days that it is complete for in a table property.
One publisher at a time; a publication replaces the months it is given, and
jobs that read those months then read the old or the new files, or fail.
The catalog has to outlive the session (a metastore) for other jobs to use it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.time import months_between
from loadlens.operators.store import covered_spans, spans_cover, stored_cells

KEYS = ["user_id", "app_type_id"]
COLUMNS = [*KEYS, "day_no", "cnt", "dur", "tags", "yyyymm"]
SPANS = "loadlens.covered"
TAGS = "array<struct<st:bigint,et:bigint>>"


def day_rows(cells: DataFrame) -> DataFrame:
    """Newest store cells -> one row per key and label day: cnt, dur and the day's session list."""
    def value(family: str, col: str):
        return F.max(F.when((F.col("family") == family) & (F.col("col") == col), F.col("value")))

    wide = (cells.filter(((F.col("family") == "Daily") & F.col("col").isin("cnt", "dur"))
                         | ((F.col("family") == "OneTag") & (F.col("col") == "Otag")))
            .groupBy(*KEYS, "ymd", "yyyymm")
            .agg(value("Daily", "cnt").cast("long").alias("cnt"), value("Daily", "dur").cast("long").alias("dur"),
                 F.from_json(value("OneTag", "Otag"), TAGS).alias("tags")))
    return wide.select(*KEYS, ((F.col("ymd") - 54000) / 86400).cast("long").alias("day_no"), "cnt", "dur", "tags",
                       F.col("yyyymm").cast("int").alias("yyyymm"))


def publish(spark: SparkSession, store_path: str, table: str, buckets: int, months: list[int] | None = None,
            location: str | None = None) -> None:
    """Write the store's daily rows of ``months`` (None: all) to ``table``, which is made when there is none.

    Rows are dealt once, to ``buckets`` partitions by key, for the reduction to
    the newest cells and for the write alike.
    """
    spans = covered_spans(spark, store_path, "daily")       # before the cells are read: these hold at least as much
    cells = stored_cells(spark, store_path, parts=buckets)
    if cells is None:
        raise ValueError(f"{store_path} does not exist")
    rows = day_rows(cells).select(*COLUMNS)
    if not spark.catalog.tableExists(table):
        if months is not None:
            rows = rows.filter(F.col("yyyymm").isin([int(m) for m in months]))
        w = rows.write.format("parquet").partitionBy("yyyymm").bucketBy(buckets, *KEYS).sortBy(*KEYS, "day_no")
        (w if location is None else w.option("path", location)).saveAsTable(table)
    elif bucket_count(spark, table) != buckets:
        raise ValueError(f"{table} has {bucket_count(spark, table)} buckets, not {buckets}")
    elif months is None:
        rows.write.insertInto(table, overwrite=True)
    else:
        for m in map(int, months):      # named one by one: other months stay, whatever the session's overwrite mode
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (yyyymm = {m}) SELECT * FROM {{rows}}",
                      rows=rows.filter(F.col("yyyymm") == m).drop("yyyymm"))
    kept = [] if months is None else covered(spark, table)
    fresh = spans if months is None else [s for m in months for s in clipped(spans, int(m))]
    text = ",".join(f"{a}:{b}" for a, b in sorted(set(kept + fresh)))
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SPANS}' = '{text}')")


def clipped(spans: list[tuple[int, int]], month: int) -> list[tuple[int, int]]:
    """The parts of ``spans`` (data days) that lie in a month."""
    first = (date(month // 100, month % 100, 1) - date(1970, 1, 1)).days
    last = (date(month // 100 + month % 100 // 12, month % 100 % 12 + 1, 1) - date(1970, 1, 1)).days - 1
    return [(max(a, first), min(b, last)) for a, b in spans if max(a, first) <= min(b, last)]


def covered(spark: SparkSession, table: str) -> list[tuple[int, int]]:
    """Spans of data days that the table is complete for."""
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return [tuple(map(int, s.split(":"))) for s in properties.get(SPANS, "").split(",") if s]


def bucket_count(spark: SparkSession, table: str) -> int:
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return int(described.get("Num Buckets", 0))


def complete_history(spark: SparkSession, table: str, lo_day: int, hi_day: int) -> DataFrame | None:
    """Daily rows of the data days lo..hi, or None when the table lacks some of these days.

    Only the folders of their months are read, and rows arrive by (user, type).
    """
    if not spark.catalog.tableExists(table) or not spans_cover(covered(spark, table), lo_day, hi_day):
        return None
    return history(spark, table, lo_day, hi_day)


def history(spark: SparkSession, table: str, lo_day: int, hi_day: int) -> DataFrame:
    return (spark.table(table)
            .filter(F.col("yyyymm").isin(months_between(lo_day, hi_day)) & F.col("day_no").between(lo_day, hi_day))
            .select(*COLUMNS[:-1]))


def active_days(rows: DataFrame) -> DataFrame:
    """Rows with sessions, without their lists: the history of the daily and weekly jobs."""
    return rows.filter((F.col("cnt") > 0) & (F.col("dur") > 0)).select(*KEYS, "day_no", "cnt", "dur")


def sessions(rows: DataFrame) -> DataFrame:
    """(user_id, app_type_id, day_no, st, et): the history of the utilisation jobs."""
    return rows.select(*KEYS, "day_no", F.inline("tags"))
