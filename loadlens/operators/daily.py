"""Daily usage metrics: count, duration, 56-day baseline, flags, interval days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.time import day_to_label
from loadlens.settings import HISTORY_DAYS, INTERVAL_MAX_DAYS, STD_MULTIPLE


def daily_metrics(sess: DataFrame, keys=("user_id", "app_type_id"), with_tags: bool = False) -> DataFrame:
    """cnt and dur per key and day; only days with cnt > 0 and dur > 0.

    ``with_tags`` also collects the day's sorted session list (bounded: a day
    holds at most 43,200 sessions) in the same aggregation.
    """
    aggs = [F.count(F.lit(1)).alias("cnt"), F.sum(F.col("et") - F.col("st")).alias("dur")]
    if with_tags:
        aggs.append(F.sort_array(F.collect_list(F.struct("st", "et"))).alias("tags"))
    out = sess.groupBy(*keys, "day_no").agg(*aggs)
    return (out.filter((F.col("cnt") > 0) & (F.col("dur") > 0))
            .withColumn("ymd", day_to_label("day_no")))


def _history_window(keys, lo: int, hi: int):
    return Window.partitionBy(*keys).orderBy("day_no").rangeBetween(lo, hi)


def daily_baseline(daily: DataFrame, keys=("user_id", "app_type_id"),
                   days: int = HISTORY_DAYS) -> DataFrame:
    """History stats over labels ymd-days .. ymd-1 (active days only).

    Adds n_hist, s_cnt, q_cnt, s_dur, q_dur (sums and sums of squares, exact
    longs) and avg/population-std of cnt and dur.  Windows run per key over
    day rows, so a key holds at most one row per calendar day.
    """
    w = _history_window(keys, -days, -1)
    out = daily.select(
        "*",
        F.count("cnt").over(w).alias("n_hist"),
        F.sum("cnt").over(w).alias("s_cnt"),
        F.sum(F.col("cnt") * F.col("cnt")).over(w).alias("q_cnt"),
        F.sum("dur").over(w).alias("s_dur"),
        F.sum(F.col("dur") * F.col("dur")).over(w).alias("q_dur"),
        F.avg("cnt").over(w).alias("avg_cnt"),
        F.stddev_pop("cnt").over(w).alias("sd_cnt"),
        F.avg("dur").over(w).alias("avg_dur"),
        F.stddev_pop("dur").over(w).alias("sd_dur"),
        F.max("day_no").over(w).alias("last_active"),
    )
    return out


def _outlier(x: str, s: str, q: str, high: bool, k: int = STD_MULTIPLE):
    """x > mean + k*sd (or < mean - k*sd) in exact integer arithmetic.

    With n history values, S = sum, Q = sum of squares:
    x > mean + k*sd  <=>  n*x - S > 0 and (n*x - S)^2 > k^2 * (n*Q - S^2).
    """
    n = F.col("n_hist")
    d = n * F.col(x) - F.col(s)
    if not high:
        d = -d
    var_n2 = n * F.col(q) - F.col(s) * F.col(s)
    return (n > 0) & (d > 0) & ((d * d) > F.lit(k * k) * var_n2)


def daily_unusual(baseline: DataFrame) -> DataFrame:
    """uHcnt/uLcnt/uHdur/uLdur flags; no history -> all false."""
    h_cnt = _outlier("cnt", "s_cnt", "q_cnt", True)
    l_cnt = ~h_cnt & _outlier("cnt", "s_cnt", "q_cnt", False)
    h_dur = _outlier("dur", "s_dur", "q_dur", True)
    l_dur = ~h_dur & _outlier("dur", "s_dur", "q_dur", False)
    return baseline.select(
        "*",
        F.coalesce(h_cnt, F.lit(False)).alias("u_h_cnt"),
        F.coalesce(l_cnt, F.lit(False)).alias("u_l_cnt"),
        F.coalesce(h_dur, F.lit(False)).alias("u_h_dur"),
        F.coalesce(l_dur, F.lit(False)).alias("u_l_dur"),
    )


def interval_days(active_days: DataFrame, keys=("user_id",), days: int = HISTORY_DAYS,
                  max_days: int = INTERVAL_MAX_DAYS) -> DataFrame:
    """Days since the previous active day within ``days``; none or > max_days -> -1.

    ``active_days`` holds one row per key and active ``day_no``.
    """
    w = _history_window(keys, -days, -1)
    last = F.max("day_no").over(w)
    gap = F.col("day_no") - last
    return active_days.select(
        *keys, "day_no",
        F.when(last.isNull() | (gap > max_days), F.lit(-1)).otherwise(gap).cast("long").alias("i_day"))


MOMENTS = ["n_hist", "s_cnt", "q_cnt", "s_dur", "q_dur"]


def _as_moments(daily: DataFrame, keys, sign: int) -> DataFrame:
    one = [F.lit(1), F.col("cnt"), F.col("cnt") * F.col("cnt"), F.col("dur"), F.col("dur") * F.col("dur")]
    last = F.col("day_no") if sign > 0 else F.lit(None)
    return daily.select(*keys, *[(sign * c).cast("long").alias(m) for m, c in zip(MOMENTS, one)], last.cast("long").alias("last_active"))


def moments_of(daily: DataFrame, day: int, keys=("user_id", "app_type_id"), days: int = HISTORY_DAYS) -> DataFrame:
    """Count, sums and sums of squares per key over labels day-days .. day-1, from all their rows: a first state."""
    return roll_moments(None, daily.filter((F.col("day_no") >= day - days) & (F.col("day_no") < day)), None, day, keys, days)


def roll_moments(state: DataFrame | None, entering: DataFrame, leaving: DataFrame | None, day: int,
                 keys=("user_id", "app_type_id"), days: int = HISTORY_DAYS) -> DataFrame:
    """The moments before label ``day`` from those before an earlier label: one row per key with active days.

    ``entering`` holds the daily rows from the earlier label to day-1, ``leaving``
    those of the labels that were in its frame and are no more, so a run
    that follows the day before reads a row per key and two days' rows instead of
    ``days`` days.  Sums are exact longs: taking a day out leaves no residue.
    """
    parts = [_as_moments(entering, keys, 1)]
    if state is not None:
        parts.append(state.select(*keys, *MOMENTS, "last_active"))
    if leaving is not None:
        parts.append(_as_moments(leaving, keys, -1))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    out = rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MOMENTS], F.max("last_active").alias("last_active"))
    return out.filter((F.col("n_hist") > 0) & (F.col("last_active") >= day - days))


def daily_from_moments(today: DataFrame, moments: DataFrame, keys=("user_id", "app_type_id")) -> DataFrame:
    """One label's rows with their baseline and flags (``daily_unusual``) from the moments before it."""
    m = moments.select(*keys, *MOMENTS, "last_active")
    return daily_unusual(today.join(m, list(keys), "left").withColumn("n_hist", F.coalesce("n_hist", F.lit(0))))
