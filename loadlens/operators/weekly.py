"""Weekly totals, week-over-week change, 4-week moving average, flags.

A weekly label L covers data days L-6 .. L.  Instead of a grid of labels,
each daily row is fanned out to the 7 labels it contributes to and summed
with a partially-aggregated groupBy; labels without data never appear
(keys with no data in the 7 days are skipped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.time import day_to_label
from loadlens.settings import (COUNT_BUFFER, DURATION_BUFFER, PARAM_TH_BOTTOM,
                               PARAM_TH_TOP, WINDOW_SIZE)


def fan_out_labels(df: DataFrame, span_days: int, last_day: int | None, day_col: str = "day_no") -> DataFrame:
    """Each row repeated for labels day .. day + span_days - 1 (column ``label_day``), none after ``last_day``.

    ``last_day`` is the newest data day: a label is a day of the data, so
    windows that end later are not results yet.  None sets no end.
    """
    end = F.col(day_col) + F.lit(span_days - 1)
    if last_day is not None:
        df, end = df.filter(F.col(day_col) <= last_day), F.least(end, F.lit(last_day).cast("long"))
    return df.withColumn("label_day", F.explode(F.sequence(F.col(day_col), end)))


def weekly_totals(daily: DataFrame, keys=("user_id", "app_type_id"), last_day: int | None = None, dealt: bool = False) -> DataFrame:
    """w_cnt, w_dur, a_cnt, a_dur per key and label day (integer averages), up to label ``last_day``.

    ``dealt``: the rows lie by key already, as a bucketed table's do.
    """
    # one exchange of day rows by user; the label sums and the trend frames reuse it
    w = (fan_out_labels(daily if dealt else daily.repartition(keys[0]), 7, last_day)
         .groupBy(*keys, "label_day")
         .agg(F.sum("cnt").alias("w_cnt"), F.sum("dur").alias("w_dur"),
              F.count(F.when(F.col("cnt") > 0, 1)).alias("n_days")))
    return w.select(
        *keys, F.col("label_day").alias("day_no"),
        day_to_label("label_day").alias("ymd"),
        "w_cnt", "w_dur",
        F.when(F.col("w_cnt") == 0, F.lit(0)).otherwise(F.expr("w_cnt div n_days")).cast("long").alias("a_cnt"),
        F.when(F.col("w_dur") == 0, F.lit(0)).otherwise(F.expr("w_dur div n_days")).cast("long").alias("a_dur"),
    )


def weekly_trends(weekly: DataFrame, keys=("user_id", "app_type_id"), compat: bool = False) -> DataFrame:
    """wow_* (minus the week ending 7 days earlier, 0 if absent) and ma4_*.

    ``compat=True`` gives the original change, which subtracts the week just
    written from itself and is therefore always 0.

    Values at exact 7-day steps are read through single-point range frames,
    so a missing week is seen as missing instead of being skipped.  One key
    holds at most one row per calendar day.
    """
    w = Window.partitionBy(*keys).orderBy("day_no")
    cols = {}
    for k in (7, 14, 21):
        fr = w.rangeBetween(-k, -k)
        cols[f"c{k}"] = F.first("w_cnt").over(fr)
        cols[f"d{k}"] = F.first("w_dur").over(fr)
    out = weekly.select("*", *[v.alias(k) for k, v in cols.items()])
    full = F.col("c7").isNotNull() & F.col("c14").isNotNull() & F.col("c21").isNotNull()
    n = float(WINDOW_SIZE)
    if compat:
        out = out.withColumn("c7", F.col("w_cnt")).withColumn("d7", F.col("w_dur"))
    return out.select(
        *weekly.columns,
        F.when(F.col("c7").isNull(), F.lit(0)).otherwise(F.col("w_cnt") - F.col("c7")).cast("long").alias("wow_cnt"),
        F.when(F.col("d7").isNull(), F.lit(0)).otherwise(F.col("w_dur") - F.col("d7")).cast("long").alias("wow_dur"),
        F.when(full, (F.col("w_cnt") + F.col("c7") + F.col("c14") + F.col("c21")) / F.lit(n))
         .otherwise(F.lit(0.0)).alias("ma4_cnt"),
        F.when(full, (F.col("w_dur") + F.col("d7") + F.col("d14") + F.col("d21")) / F.lit(n))
         .otherwise(F.lit(0.0)).alias("ma4_dur"),
    )


def weekly_unusual(trends: DataFrame, count_buffer: float = COUNT_BUFFER,
                   duration_buffer: float = DURATION_BUFFER) -> DataFrame:
    """High if w > (ma4 + buf) * 1.5, else low if w < (ma4 - buf) * 0.5; skipped when ma4_cnt = 0."""
    on = F.col("ma4_cnt") != 0
    hc = on & (F.col("w_cnt") > (F.col("ma4_cnt") + count_buffer) * PARAM_TH_TOP)
    lc = on & ~hc & (F.col("w_cnt") < (F.col("ma4_cnt") - count_buffer) * PARAM_TH_BOTTOM)
    hd = on & (F.col("w_dur") > (F.col("ma4_dur") + duration_buffer) * PARAM_TH_TOP)
    ld = on & ~hd & (F.col("w_dur") < (F.col("ma4_dur") - duration_buffer) * PARAM_TH_BOTTOM)
    return trends.select("*", hc.alias("u_h_cnt"), lc.alias("u_l_cnt"),
                         hd.alias("u_h_dur"), ld.alias("u_l_dur"))
