"""Readings: (user_id, app_type_id, t, power) with ``t`` in epoch seconds."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.time import epoch_seconds
from loadlens.settings import DAY, JST_OFFSET


def readings_from_events(events: DataFrame, app: str | None = None,
                         power_col: str = "value") -> DataFrame:
    """Map an event table to readings.

    ``app=None`` keeps ``event_type`` as the appliance type, otherwise all
    rows get the constant type ``app``.  Timestamps are truncated to seconds.
    """
    app_col = F.col("event_type") if app is None else F.lit(app)
    return events.select(
        F.col("user_id"),
        app_col.alias("app_type_id"),
        epoch_seconds(events, "ts").alias("t"),
        F.col(power_col).cast("double").alias("power"),
    )


def readings_in_range(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= ts < end``; a plain predicate so it reaches the scan."""
    c = F.col(ts_col)
    dtype = df.schema[ts_col].dataType.simpleString()
    lo = F.lit(start).cast(dtype)
    hi = F.lit(end).cast(dtype)
    return df.filter((c >= lo) & (c < hi))


def readings_of_days(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Rows of JST days lo..hi, as a plain range on the source's own time column.

    ``ts`` (a timestamp, zone-free or not) is compared with constants, so the
    predicate reaches the scan; otherwise the range is on ``t``.
    """
    start, end = lo * DAY - JST_OFFSET, (hi + 1) * DAY - JST_OFFSET
    if "ts" not in df.columns:
        return df.filter((F.col("t") >= start) & (F.col("t") < end))
    text = [dt.datetime.fromtimestamp(x, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S") for x in (start, end)]
    if isinstance(df.schema["ts"].dataType, T.TimestampNTZType):
        return readings_in_range(df, "ts", *text)
    return readings_in_range(df, "ts", *[f"{x}+00:00" for x in text])


def union_providers(parts: dict) -> DataFrame:
    """UNION ALL of one table per provider, tagging each with ``ser_id``."""
    tagged = [df.withColumn("ser_id", F.lit(str(k))) for k, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def read_provider_tables(spark, base: str, providers=None) -> DataFrame:
    """One scan over ``base/ser_id=<p>/`` folders; ``ser_id`` comes from partition discovery.

    ``providers`` limits the folders read (a partition filter, so other
    providers are never listed or opened).
    """
    df = spark.read.option("basePath", base).parquet(base)
    if providers is not None:
        df = df.filter(F.col("ser_id").cast("string").isin([str(p) for p in providers]))
    return df.withColumn("ser_id", F.col("ser_id").cast("string"))


def reconciled(df: DataFrame, schema: T.StructType, aliases: dict[str, str] | None = None, provider: str = "") -> DataFrame:
    """The table's columns under the declared schema: by name, in its order and types.

    ``aliases`` names this provider's column for a declared one.  A column that
    is not there is null, or fails when the schema does not allow nulls; other
    columns are left out; a value that its declared type can't hold fails the
    job.  Names are compared without case, as Spark does.
    """
    aliases = aliases or {}
    there = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        own = there.get(aliases.get(f.name, f.name).lower())
        if own is None and not f.nullable:
            raise ValueError(f"provider {provider!r} has no column {aliases.get(f.name, f.name)!r}")
        out.append((F.lit(None) if own is None else F.col(f"`{own}`")).cast(f.dataType).alias(f.name))
    return df.select(*out)


def read_differing_providers(spark, folders: dict[str, str], schema: T.StructType, aliases: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """UNION ALL of provider tables that differ in columns, types and order, tagged with ``ser_id``.

    ``folders`` names each provider's table.  Each is scanned once, for the declared columns alone.
    """
    aliases = aliases or {}
    return union_providers({p: reconciled(spark.read.parquet(path), schema, aliases.get(p), p) for p, path in folders.items()})
