"""Hour-of-day utilisation profiles (long 28 d, short 7 d, weekday 8 weeks).

A day is active when it has at least one kept session, so hour flags, the
per-hour day counts and the active-day count all come from two aggregations
over the sessions of the window (start hours folded into a 24-bit mask).  Both group by a superset of the entity
key, so they reuse the sessions' partitioning; only the (small) user grid is
shuffled for the final left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.time import jst_hour
from loadlens.settings import N_WEEKS

HOURS = range(24)


def session_start_hour(sess: DataFrame) -> DataFrame:
    return sess.withColumn("h", jst_hour("st"))


def hour_stats(sess: DataFrame, keys, per_hour_days: bool = False) -> DataFrame:
    """Per key: f_hh (any start in hour), n_days, and with ``per_hour_days`` c_hh (days per hour).

    A day's start hours are folded into a 24-bit mask (``bit_or``), so each
    aggregation carries one or two columns instead of one per hour.
    """
    starts = session_start_hour(sess)
    per_day = starts.groupBy(*keys, "day_no").agg(
        F.bit_or(F.expr("shiftleft(1, h)")).alias("mask"))
    aggs = [F.bit_or("mask").alias("any_mask"), F.count(F.lit(1)).alias("n_days")]
    if per_hour_days:
        aggs += [F.sum(F.shiftright("mask", h).bitwiseAND(F.lit(1))).alias(f"c{h:02d}") for h in HOURS]
    out = per_day.groupBy(*keys).agg(*aggs)
    return out.select("*", *[F.shiftright("any_mask", h).bitwiseAND(F.lit(1)).alias(f"f{h:02d}")
                             for h in HOURS])


def _profile(grid, stats, keys, prefix, empty_value, source="f", divisor=None):
    j = grid.join(stats, list(keys), "left")
    n = F.coalesce(F.col("n_days"), F.lit(0)) if divisor is None else F.lit(divisor)
    cols = []
    for h in HOURS:
        v = F.coalesce(F.col(f"{source}{h:02d}"), F.lit(0)).cast("double")
        cols.append(F.when(n > 0, v / n).otherwise(F.lit(empty_value)).alias(f"{prefix}{h:02d}"))
    return j.select(*keys, *cols)


def _in_range(df, as_of_day: int, days: int):
    return df.filter((F.col("day_no") > as_of_day - days) & (F.col("day_no") <= as_of_day))


def utilization(sess: DataFrame, grid: DataFrame, as_of_day: int, days: int, prefix: str,
                empty_value: float, keys=("user_id", "app_type_id"), fraction: bool = False) -> DataFrame:
    """Per key of ``grid``: hour flag (or day count) / active days in the window.

    ``days=28`` is the long profile (zeros when idle), ``days=7`` the short one
    (NaN when idle); ``fraction=True`` counts days per hour instead of a flag.
    """
    stats = hour_stats(_in_range(sess, as_of_day, days), keys, per_hour_days=fraction)
    return _profile(grid, stats, keys, prefix, empty_value, "c" if fraction else "f")


def utilization_long(sess, grid, as_of_day, keys=("user_id", "app_type_id")):
    return utilization(sess, grid, as_of_day, 28, "l", 0.0, keys)


def utilization_short(sess, grid, as_of_day, keys=("user_id", "app_type_id")):
    return utilization(sess, grid, as_of_day, 7, "s", float("nan"), keys)


def utilization_long_fraction(sess, grid, as_of_day, keys=("user_id", "app_type_id")):
    return utilization(sess, grid, as_of_day, 28, "l", 0.0, keys, fraction=True)


def utilization_weekday(sess: DataFrame, grid: DataFrame, as_of_day: int,
                        keys=("user_id", "app_type_id"), n_weeks: int = N_WEEKS) -> DataFrame:
    """Same weekday as ``as_of_day`` over the last ``n_weeks`` weeks, divided by n_weeks."""
    back = F.lit(as_of_day) - F.col("day_no")
    same = sess.filter((back >= 0) & (back < 7 * n_weeks) & (F.pmod(back, F.lit(7)) == 0))
    return _profile(grid, hour_stats(same, keys), keys, "", 0.0, divisor=n_weeks)
