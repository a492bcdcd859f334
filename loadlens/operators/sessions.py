"""Sessionisation ("one tags").

A session is a maximal run of eligible readings (power > min_power) of one
(user, appliance type, group) whose consecutive gaps are <= max_gap; it is
kept when ``et - st > min_duration``.  The group is the JST data day (so
sessions split at midnight) or any other label such as the late-night
midnight.

Plan: readings are first collapsed into buckets of width ``max_gap + 1``
seconds.  Two readings inside one bucket are at most ``max_gap`` apart, so a
bucket never contains a split and can be reduced to (first, last) by an
ordinary partially-aggregated ``groupBy``.  Only the bucket summaries (at
most 86,400 per key and day, whatever the row volume) go through the
ordered window that finds splits; that window is keyed by (user, type, day),
so a user's history never meets in one task and a day filter passes below it.
A hot key therefore costs map-side combining, not one oversized sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.time import day_no


def eligible_readings(readings: DataFrame, thresholds: DataFrame,
                      compat: bool = False) -> DataFrame:
    """Readings of configured types joined with their thresholds.

    ``compat=False`` keeps ``power > min_power``; ``compat=True`` keeps every
    non-null power (the original text-vs-number comparison).
    """
    r = readings.join(thresholds, "app_type_id", "inner")
    cond = F.col("power").isNotNull() if compat else F.col("power") > F.col("min_power")
    return r.filter(cond)


def gap_buckets(df: DataFrame, group_cols: list[str]) -> DataFrame:
    """First and last eligible time per bucket of ``max_gap + 1`` seconds, which holds no split."""
    width = F.col("max_gap") + F.lit(1)
    # max_gap / min_duration depend on the type only, so grouping on them is free
    return (df.withColumn("b", F.floor(F.col("t") / width))
            .groupBy(*group_cols, "b", "max_gap", "min_duration")
            .agg(F.min("t").alias("f"), F.max("t").alias("l")))


def sessions_from_eligible(df: DataFrame, group_cols: list[str],
                           keep_short: bool = False) -> DataFrame:
    """Sessions of already-eligible rows carrying ``max_gap``/``min_duration``.

    ``group_cols`` is (entity..., group): sessions never span two groups (the
    last column, a day or late-night label).  The ordered window runs per
    entity and group, and the sums per day reuse its partitioning; a window
    partition holds at most 86,400 bucket summaries.

    Output: group_cols + [st, et, min_duration].  ``keep_short`` keeps the
    sessions failing the duration rule (used for empty late-night lists).
    """
    buckets = gap_buckets(df, group_cols)
    w = Window.partitionBy(*group_cols).orderBy("b")
    prev_l = F.lag("l").over(w)
    split = prev_l.isNull() | ((F.col("f") - prev_l) > F.col("max_gap"))
    starts = buckets.withColumn("new", F.when(split, 1).otherwise(0))
    starts = starts.withColumn(
        "sid", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sessions = (
        starts.groupBy(*group_cols, "sid", "min_duration")
        .agg(F.min("f").alias("st"), F.max("l").alias("et"))
        .drop("sid")
    )
    if keep_short:
        return sessions
    return sessions.filter((F.col("et") - F.col("st")) > F.col("min_duration"))


def sessions(readings: DataFrame, thresholds: DataFrame, compat: bool = False) -> DataFrame:
    """Daily sessions: (user_id, app_type_id, day_no, st, et)."""
    el = eligible_readings(readings, thresholds, compat).withColumn("day_no", day_no("t"))
    return (sessions_from_eligible(el, ["user_id", "app_type_id", "day_no"])
            .select("user_id", "app_type_id", "day_no", "st", "et"))


def sessions_native(readings: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Same sessions through Spark's ``session_window`` with a per-row gap.

    ``session_window`` merges points whose distance is <= gap.  It is fed the
    bucket summaries: a bucket starts at its first reading and reaches
    ``max_gap`` seconds beyond its last, so only the summaries of a (user,
    type, day) are sorted in one task.  This is the cross-check of
    ``sessions`` and the shape the streaming job uses.
    """
    el = eligible_readings(readings, thresholds).withColumn("day_no", day_no("t"))
    b = gap_buckets(el, ["user_id", "app_type_id", "day_no"]).withColumn("ts", F.timestamp_seconds("f"))
    gap = F.concat((F.col("l") - F.col("f") + F.col("max_gap")).cast("string"), F.lit(" seconds"))
    out = (
        b.groupBy("user_id", "app_type_id", "day_no", "min_duration",
                  F.session_window("ts", gap).alias("sw"))
        .agg(F.min("f").alias("st"), F.max("l").alias("et"))
    )
    return (out.filter((F.col("et") - F.col("st")) > F.col("min_duration"))
            .select("user_id", "app_type_id", "day_no", "st", "et"))


def one_tags(sess: DataFrame, keys=("user_id", "app_type_id", "day_no")) -> DataFrame:
    """Sessions as a sorted array<struct<st, et>> per key.

    Sessions of one key are disjoint, each lasting >= 1 s and separated by
    > max_gap, so a day holds at most 43,200 of them: the array is bounded.
    """
    return sess.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("st", "et"))).alias("tags"))


def pack_readings(readings: DataFrame, keys: list[str], chunk_seconds: int = 3600, most: int = 7200) -> DataFrame:
    """Pack readings into sorted arrays of struct<t, power, n> per key and time chunk.

    Equal (t, power) readings are folded into one entry with multiplicity
    ``n`` by a partially-aggregated groupBy first.  A chunk with more than
    ``most`` entries (there is no bound on the powers of one second) becomes
    several packs, numbered by ``part`` in time order, so no array is longer.
    ``sum(n)`` over a chunk's packs is its row count.

    No task sorts a chunk: entries are counted per second, the seconds of a
    chunk (``chunk_seconds`` rows at most) are summed up in time order, and an
    entry's place is its second's start plus its place within the second.  A
    second's start joins its entries as one more row of their group, so that
    null keys need no join of their own.
    """
    chunk = F.floor(F.col("t") / F.lit(chunk_seconds)).alias("chunk")
    folded = readings.groupBy(*keys, chunk, "t", "power").agg(F.count(F.lit(1)).alias("n"))
    # counted by n, so that both uses of the folded readings read one exchange
    seconds = folded.groupBy(*keys, "chunk", "t").agg(F.count_if(F.col("n") > 0).alias("entries"))
    before = Window.partitionBy(*keys, "chunk").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    starts = seconds.select(*keys, "chunk", "t", F.coalesce(F.sum("entries").over(before), F.lit(0)).alias("start"))
    second = Window.partitionBy(*keys, "chunk", "t").orderBy(F.col("start").isNull(), "power")
    # a second's first row holds its start, so its first entry has row number 2
    placed = (folded.unionByName(starts, allowMissingColumns=True)
              .withColumns({"place": F.first("start").over(second) + F.row_number().over(second) - 2})
              .filter(F.col("start").isNull()))
    return (placed.withColumn("part", F.floor(F.col("place") / F.lit(most)).cast("int"))
            .groupBy(*keys, "chunk", "part")
            .agg(F.sort_array(F.collect_list(F.struct("t", "power", "n"))).alias("ts_power")))
