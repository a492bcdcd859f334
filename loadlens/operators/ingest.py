"""Fetch windows for the ingest: new/old users, 3-day look-back, chunking.

A window [st, et] longer than a day is cut into sub-windows
[s, s + 86339] stepping by 86340 s, plus the remainder [s, et] when it is
non-empty.  The cut is a ``sequence`` + ``explode`` (at most span/86340
elements per user), not a Python loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.settings import CHUNK_MIN_SPAN, CHUNK_STEP, DAYS_3_SECS


def chunk_array(st, et, step: int = CHUNK_STEP):
    """array<struct<st, et>> of the chunks of [st, et] (empty when et <= st)."""
    seq = F.sequence(st, et - 1, F.lit(step).cast("long"))
    chunks = F.transform(seq, lambda s: F.struct(
        s.alias("st"), F.when(et - s >= step, s + (step - 1)).otherwise(et).alias("et")))
    return F.when(et > st, chunks).otherwise(F.array().cast("array<struct<st:bigint,et:bigint>>"))


def chunk_windows(df: DataFrame, step: int = CHUNK_STEP) -> DataFrame:
    """Replace (st, et) by its chunks; rows with et <= st vanish."""
    others = [c for c in df.columns if c not in ("st", "et")]
    c = F.explode(chunk_array(F.col("st"), F.col("et"), step)).alias("c")
    return df.select(*others, c).select(*others, "c.st", "c.et")


def first_run_windows(users: DataFrame, now: int, lookback: int = DAYS_3_SECS) -> DataFrame:
    """First run: every user from now - 3 days, chunked."""
    return chunk_windows(users.select("user_id", "ser_id",
                                      F.lit(now - lookback).cast("long").alias("st"),
                                      F.lit(now).cast("long").alias("et")))


def ingest_windows(users: DataFrame, watermark: DataFrame, now: int,
                   lookback: int = DAYS_3_SECS, min_span: int = CHUNK_MIN_SPAN) -> DataFrame:
    """Users left-joined with their watermark; st = watermark or now - 3 days.

    Spans of at least ``min_span`` are chunked, shorter ones pass whole as
    [st, now]; both cases come out of one conditional explode, so the join
    runs once.  ``watermark`` has (user_id, commited_at).
    """
    # a snapshot may hold several rows per user (one per fetched chunk): keep the newest
    wm = watermark.groupBy("user_id").agg(F.max("commited_at").alias("wm"))
    j = users.join(wm, "user_id", "left")
    st = F.coalesce(F.col("wm"), F.lit(now - lookback)).cast("long")
    et = F.lit(now).cast("long")
    whole = F.array(F.struct(st.alias("st"), et.alias("et")))
    win = F.when(et - st >= min_span, chunk_array(st, et)).otherwise(whole)
    return j.select("user_id", "ser_id", F.explode(win).alias("c")).select("user_id", "ser_id", "c.st", "c.et")
