"""Fusion of two appliance types into a virtual one (null-safe power sum)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.power import null_safe_sum
from loadlens.settings import PAIR_APP_ID, PAIR_APPS


def pair_fusion(readings: DataFrame, apps=PAIR_APPS, new_app: str = PAIR_APP_ID,
                time_col: str = "t") -> DataFrame:
    """Readings of types ``apps[0]`` and ``apps[1]`` of one user and time, added.

    Returns (user_id, app_type_id = new_app, time, power_a, power_b, power)
    with power = a + b, a missing side (or power) counting as 0.  A full outer
    join would pair every reading of one type with every reading of the other
    at that time; sessions and power ranges need only the least and the
    greatest of those sums, so one aggregation of a single scan keeps both:
    one row where they are equal, two where they differ.
    """
    def side(app, how, name):
        here = F.col("app_type_id") == app
        return how(F.when(here, F.coalesce("power", F.lit(0.0)))).alias(name), F.max(F.when(here, F.col("power"))).alias(f"{name}_known")

    pair = readings.filter(F.col("app_type_id").isin(*apps))
    g = pair.groupBy("user_id", time_col).agg(
        *side(apps[0], F.min, "a0"), *side(apps[0], F.max, "a1"), *side(apps[1], F.min, "b0"), *side(apps[1], F.max, "b1"))

    def row(k):
        a, b = (F.when(F.col(f"{s}{k}_known").isNotNull(), F.col(f"{s}{k}")) for s in "ab")
        return F.struct(a.alias("power_a"), b.alias("power_b"), null_safe_sum(f"a{k}", f"b{k}").alias("power"))

    rows = F.array_distinct(F.array(row(0), row(1)))
    return g.select("user_id", F.lit(new_app).alias("app_type_id"), time_col, F.inline(rows))


def with_pair(readings: DataFrame, apps=PAIR_APPS, new_app: str = PAIR_APP_ID) -> DataFrame:
    """Readings plus the fused virtual type (UNION ALL)."""
    fused = pair_fusion(readings, apps, new_app).select("user_id", "app_type_id", "t", "power")
    return readings.select("user_id", "app_type_id", "t", "power").unionByName(fused)
