"""Two-week minimum / maximum power profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.time import day_no
from loadlens.operators.weekly import fan_out_labels
from loadlens.sources.readings import readings_of_days


def profile_readings(readings: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Configured types only, non-null power."""
    keep = thresholds.select("app_type_id")
    return readings.join(keep, "app_type_id", "left_semi").filter(F.col("power").isNotNull())


def profile_minmax(readings: DataFrame, as_of_day: int, days: int = 14,
                   keys=("user_id", "app_type_id")) -> DataFrame:
    """min/max power over data days as_of-days+1 .. as_of (one label); a plain range on the time column."""
    r = readings_of_days(readings, as_of_day - days + 1, as_of_day)
    return r.groupBy(*keys).agg(F.min("power").alias("min_power"), F.max("power").alias("max_power"))


def profile_rolling(readings: DataFrame, days: int = 14,
                    keys=("user_id", "app_type_id"), last_day: int | None = None) -> DataFrame:
    """The same profile for every label day up to ``last_day`` that has data in its window.

    Daily min/max first (map-side combined), then the day rows are shuffled
    once by key and each is fanned out to the ``days`` labels whose window
    contains it; the label aggregation reuses that partitioning, so the
    fan-out never crosses the network.
    """
    daily = (readings.withColumn("day_no", day_no("t")).groupBy(*keys, "day_no")
             .agg(F.min("power").alias("mn"), F.max("power").alias("mx"))
             .repartition(*keys))
    return (fan_out_labels(daily, days, last_day).groupBy(*keys, "label_day")
            .agg(F.min("mn").alias("min_power"), F.max("mx").alias("max_power"))
            .withColumnRenamed("label_day", "day_no"))
