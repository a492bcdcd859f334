"""Last activity per (user, type, day) with carry-over of the previous day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.time import day_no


def last_activity(readings: DataFrame, thresholds: DataFrame,
                  keys=("user_id", "app_type_id"), compat: bool = False,
                  slot_seconds: int = 600) -> DataFrame:
    """la = latest eligible t of the day (null when the day has readings but none eligible).

    ``compat=True`` reproduces the original 600 s slot job: the day is the
    UTC date, and the value left at the end of the day is the one written by
    the day's last slot, so an idle last slot leaves null (which the carry
    step then fills with the previous day's value).
    """
    r = readings.join(thresholds, "app_type_id", "inner")
    eligible = F.when(F.col("power") > F.col("min_power"), F.col("t"))
    if not compat:
        r = r.withColumn("day_no", day_no("t"))
        return r.groupBy(*keys, "day_no").agg(F.max(eligible).alias("la"))
    r = r.withColumn("day_no", F.floor(F.col("t") / F.lit(86400)).cast("long"))
    slots = (r.groupBy(*keys, "day_no", F.floor(F.col("t") / F.lit(slot_seconds)).alias("slot"))
             .agg(F.max(eligible).alias("la")))
    last = slots.groupBy(*keys, "day_no").agg(F.max(F.struct("slot", "la")).alias("s"))
    return last.select(*keys, "day_no", F.col("s.la").alias("la"))


def last_activity_carry(la: DataFrame, keys=("user_id", "app_type_id")) -> DataFrame:
    """la, else the previous day's carried value, else 0.

    A day without any reading writes nothing, so carrying stops there: the
    carry runs inside islands of consecutive days.  Windows are per key over
    day rows (one row per calendar day).
    """
    w = Window.partitionBy(*keys).orderBy("day_no")
    isl = la.withColumn("island", F.col("day_no") - F.row_number().over(w))
    w2 = (Window.partitionBy(*keys, "island").orderBy("day_no")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return isl.select(*keys, "day_no",
                      F.coalesce(F.last("la", ignorenulls=True).over(w2), F.lit(0)).cast("long").alias("la"))
