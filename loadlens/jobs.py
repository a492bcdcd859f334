"""Metric jobs: readings -> metric DataFrames -> cells in the month store.

Each job computes every label day in one plan (backfill); ``as_of_day``
restricts the output to one label and narrows the scan to the days that
label needs (the time predicate reaches the parquet scan).  ``to_cells``
turns a wide result into store cells, and ``python -m loadlens.jobs`` runs a
job against parquet readings and upserts the cells.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.time import day_no, day_to_label, epoch_seconds, months_between, weekday_no
from loadlens.operators import activity as A
from loadlens.operators import daily as D
from loadlens.operators import history as H
from loadlens.operators import latenight as L
from loadlens.operators import pairing as PR
from loadlens.operators import profile as P
from loadlens.operators import registry as G
from loadlens.operators import sessions as S
from loadlens.operators import store as ST
from loadlens.operators import utilization as U
from loadlens.operators import weekly as W
from loadlens.operators.commits import read_committed
from loadlens.settings import (HISTORY_DAYS, SPECIAL_USER_OFFSETS, Thresholds, literal_table,
                               special_users_df)
from loadlens.operators.payload import flatten_activity, unnest_estimates
from loadlens.sources.files import Folder
from loadlens.sources.payloads import read_activity_payloads
from loadlens.sources.readings import readings_of_days
from loadlens.sources.registry import read_registry_jdbc

KEYS = ["user_id", "app_type_id"]

# ---------------------------------------------------------------------------
# Store column families and column names of each job.
DAILY_COLS = {"cnt": "cnt", "dur": "dur", "uHcnt": "u_h_cnt", "uLcnt": "u_l_cnt",
              "uHdur": "u_h_dur", "uLdur": "u_l_dur", "iDay": "i_day"}
WEEKLY_COLS = {"wCnt": "w_cnt", "aCnt": "a_cnt", "wDur": "w_dur", "aDur": "a_dur",
               "wowCnt": "wow_cnt", "wowDur": "wow_dur", "ma4Cnt": "ma4_cnt", "ma4Dur": "ma4_dur",
               "uHcnt": "u_h_cnt", "uLcnt": "u_l_cnt", "uHdur": "u_h_dur", "uLdur": "u_l_dur"}
PROFILE_COLS = {"2wMxpwr": "max_power", "2wMnpwr": "min_power"}
FAMILY_DAILY, FAMILY_WEEKLY, FAMILY_ONETAG = "Daily", "Weekly", "OneTag"
# ---------------------------------------------------------------------------


def run_date_to_day(text: str, fmt: str = "%m%d%Y") -> int:
    """Day number of the data day processed by a run on ``text`` (the day before)."""
    d = dt.datetime.strptime(text, fmt).date() - dt.timedelta(days=1)
    return (d - dt.date(1970, 1, 1)).days


def _only(df: DataFrame, as_of_day: int | None) -> DataFrame:
    return df if as_of_day is None else df.filter(F.col("day_no") == as_of_day)


def prepared_readings(readings: DataFrame, pair: bool = True, days: tuple[int, int] | None = None) -> DataFrame:
    """Readings of the JST days, plus the fused 300+301 type when ``pair`` (UNION ALL).

    The range comes first, so it reaches the scans of both branches.
    """
    r = readings if days is None else readings_of_days(readings, *days)
    return PR.with_pair(r) if pair else r


def daily_job(readings: DataFrame, thresholds: DataFrame, as_of_day: int | None = None,
              pair: bool = True) -> DataFrame:
    """cnt, dur, flags, interval days and the session list per key and day.

    Duplicate readings are not removed: they never change a session.
    """
    days = None if as_of_day is None else (as_of_day - HISTORY_DAYS, as_of_day)
    sess = S.sessions(prepared_readings(readings, pair, days), thresholds)
    # one pipeline: session lists ride along with cnt/dur, no join back to the sessions
    base = D.daily_unusual(D.daily_baseline(D.daily_metrics(sess, with_tags=True)))
    gap = F.col("day_no") - F.col("last_active")
    out = base.withColumn("i_day", F.when(F.col("last_active").isNull() | (gap > 28), F.lit(-1))
                          .otherwise(gap).cast("long"))
    return _only(out, as_of_day).select(*KEYS, "day_no", "ymd", *DAILY_COLS.values(), "tags")


def store_daily_history(store: DataFrame, lo_day: int, hi_day: int) -> DataFrame:
    """Stored Daily cnt/dur of label days lo..hi as (user_id, app_type_id, day_no, cnt, dur).

    The month partitions are pruned with a literal filter; ``stored_cells`` has
    reduced them to their newest version and dealt them by (user, type), so
    this grouping and the history window need no exchange of their own.
    """
    lo_lbl, hi_lbl = lo_day * 86400 + 54000, hi_day * 86400 + 54000
    c = store.filter(F.col("yyyymm").isin(months_between(lo_day, hi_day))
                     & (F.col("family") == FAMILY_DAILY) & F.col("col").isin("cnt", "dur")
                     & F.col("ymd").between(lo_lbl, hi_lbl))
    w = c.groupBy("user_id", "app_type_id", "ymd").agg(
        F.max(F.when(F.col("col") == "cnt", F.col("value"))).cast("long").alias("cnt"),
        F.max(F.when(F.col("col") == "dur", F.col("value"))).cast("long").alias("dur"))
    return w.select("user_id", "app_type_id", ((F.col("ymd") - 54000) / 86400).cast("long").alias("day_no"),
                    "cnt", "dur").filter((F.col("cnt") > 0) & (F.col("dur") > 0))


def store_sessions(store: DataFrame, lo_day: int, hi_day: int) -> DataFrame:
    """Stored OneTag session lists of label days lo..hi as session rows.

    (user_id, app_type_id, day_no, st, et); month partitions pruned by literal filter.
    """
    lo_lbl, hi_lbl = lo_day * 86400 + 54000, hi_day * 86400 + 54000
    c = store.filter(F.col("yyyymm").isin(months_between(lo_day, hi_day))
                     & (F.col("family") == FAMILY_ONETAG) & (F.col("col") == "Otag")
                     & F.col("ymd").between(lo_lbl, hi_lbl))
    tags = F.from_json("value", "array<struct<st:bigint,et:bigint>>")
    return c.select("user_id", "app_type_id", ((F.col("ymd") - 54000) / 86400).cast("long").alias("day_no"),
                    F.inline(tags))


def daily_job_incremental(readings: DataFrame, thresholds: DataFrame, history: DataFrame,
                          as_of_day: int, pair: bool = True) -> DataFrame:
    """The daily job for one label, sessionizing only that day's readings.

    ``history`` holds the previous days' (user_id, app_type_id, day_no, cnt,
    dur), e.g. from ``store_daily_history``; the 56-day flags and interval
    days are computed over it plus today, so a day's work no longer grows
    with the history length.
    """
    r = prepared_readings(readings, pair, (as_of_day, as_of_day))
    today = D.daily_metrics(S.sessions(r, thresholds), with_tags=True)
    tags_type = today.schema["tags"].dataType
    hist = (history.filter((F.col("day_no") >= as_of_day - HISTORY_DAYS) & (F.col("day_no") < as_of_day))
            .select(F.col("user_id").cast("string").alias("user_id"), "app_type_id", "day_no", "cnt", "dur",
                    F.lit(None).cast(tags_type).alias("tags"))
            .withColumn("ymd", day_to_label("day_no")))
    allx = today.select(F.col("user_id").cast("string").alias("user_id"), "app_type_id", "day_no",
                        "cnt", "dur", "tags", "ymd").unionByName(hist)
    base = D.daily_unusual(D.daily_baseline(allx))
    gap = F.col("day_no") - F.col("last_active")
    out = base.withColumn("i_day", F.when(F.col("last_active").isNull() | (gap > 28), F.lit(-1))
                          .otherwise(gap).cast("long"))
    return _only(out, as_of_day).select(*KEYS, "day_no", "ymd", *DAILY_COLS.values(), "tags")


def read_moments(spark: SparkSession, path: str, before: int) -> tuple[DataFrame, int] | None:
    """The newest stored moments of a label up to ``before``, and that label; found by folder names."""
    days = [int(v) for v in Folder(spark, path).partition_values("day_no") if int(v) <= before]
    if not days:
        return None
    return spark.read.parquet(f"{path.rstrip('/')}/day_no={max(days)}"), max(days)


def daily_job_from_moments(spark: SparkSession, readings: DataFrame, thresholds: DataFrame, store: DataFrame, moments_path: str,
                           as_of_day: int, pair: bool = True) -> DataFrame:
    """The daily job for one label from running moments instead of 56 days of history.

    The moments before the label are rolled on from the newest stored ones by
    the stored Daily rows of the days that entered and left since, and written
    for the next run; without any they are summed up from 56 days once.
    """
    newest = read_moments(spark, moments_path, as_of_day)
    if newest is not None and newest[1] < as_of_day - HISTORY_DAYS:
        newest = None                       # nothing of that frame is left
    if newest is None:
        moments = D.moments_of(store_daily_history(store, as_of_day - HISTORY_DAYS, as_of_day - 1), as_of_day)
    else:
        state, day = newest
        moments = state if day == as_of_day else D.roll_moments(
            state, store_daily_history(store, day, as_of_day - 1),
            store_daily_history(store, day - HISTORY_DAYS, as_of_day - 1 - HISTORY_DAYS), as_of_day)
    if newest is None or newest[1] != as_of_day:
        path = f"{moments_path.rstrip('/')}/day_no={as_of_day}"
        moments.hint("rebalance").write.mode("overwrite").parquet(path)
        moments = spark.read.parquet(path)
    return _with_moments(_metrics_of_day(readings, thresholds, as_of_day, pair), moments, as_of_day)


def _metrics_of_day(readings: DataFrame, thresholds: DataFrame, day: int, pair: bool) -> DataFrame:
    m = D.daily_metrics(S.sessions(prepared_readings(readings, pair, (day, day)), thresholds), with_tags=True)
    return m.withColumn("user_id", F.col("user_id").cast("string"))


def _with_moments(today: DataFrame, moments: DataFrame, as_of_day: int) -> DataFrame:
    """The daily job's columns for one label from its metrics and the moments before it."""
    gap = F.col("day_no") - F.col("last_active")
    out = D.daily_from_moments(today, moments).withColumn(
        "i_day", F.when(F.col("last_active").isNull() | (gap > 28), F.lit(-1)).otherwise(gap).cast("long"))
    return _only(out, as_of_day).select(*KEYS, "day_no", "ymd", *DAILY_COLS.values(), "tags")


def daily_job_from_history(readings: DataFrame, thresholds: DataFrame, rows: DataFrame, buckets: int,
                           as_of_day: int, pair: bool = True) -> DataFrame:
    """The daily job for one label, with its 56 days read from a bucketed history table.

    ``rows`` are summed up where they lie; only the label day's rows are dealt, into the table's buckets.
    """
    moments = D.moments_of(H.active_days(rows), as_of_day)
    return _with_moments(_metrics_of_day(readings, thresholds, as_of_day, pair).repartition(buckets, *KEYS), moments, as_of_day)


def weekly_job(daily: DataFrame, as_of_day: int | None = None, last_day: int | None = None, dealt: bool = False) -> DataFrame:
    """One label (``as_of_day``), or all labels up to the newest data day ``last_day``; ``dealt``: rows lie by key already."""
    last = as_of_day if as_of_day is not None else last_day
    w = W.weekly_unusual(W.weekly_trends(W.weekly_totals(daily.select(*KEYS, "day_no", "cnt", "dur"), last_day=last, dealt=dealt)))
    return _only(w, as_of_day).select(*KEYS, "day_no", "ymd", *WEEKLY_COLS.values())


def utilization_job(readings: DataFrame, thresholds: DataFrame, grid: DataFrame,
                    as_of_day: int, kind: str = "long", pair: bool = True) -> DataFrame:
    """kind: 'long' (l00..l23), 'short' (s00..s23) or 'weekday' (00..23 + wDay)."""
    span = {"long": 28, "short": 7, "weekday": 56}[kind]
    r = prepared_readings(readings, pair, (as_of_day - span, as_of_day))
    return utilization_from_sessions(S.sessions(r, thresholds), grid, as_of_day, kind)


def utilization_from_sessions(sess: DataFrame, grid: DataFrame, as_of_day: int, kind: str) -> DataFrame:
    if kind == "long":
        out = U.utilization_long(sess, grid, as_of_day)
    elif kind == "short":
        out = U.utilization_short(sess, grid, as_of_day)
    else:
        out = U.utilization_weekday(sess, grid, as_of_day).withColumn(
            "wDay", weekday_no(F.date_from_unix_date(F.lit(as_of_day))))
    return out.withColumn("day_no", F.lit(as_of_day).cast("long")).withColumn("ymd", day_to_label("day_no"))


def profile_job(readings: DataFrame, thresholds: DataFrame, as_of_day: int, pair: bool = True) -> DataFrame:
    r = prepared_readings(readings, pair, (as_of_day - 13, as_of_day))
    p = P.profile_minmax(P.profile_readings(r, thresholds), as_of_day)
    return p.withColumn("day_no", F.lit(as_of_day).cast("long")).withColumn("ymd", day_to_label("day_no"))


def latenight_job(readings: DataFrame, thresholds: DataFrame, special: DataFrame,
                  pair: bool = True) -> DataFrame:
    """Late-night session lists per key and midnight label (empty lists kept)."""
    lr = L.latenight_readings(prepared_readings(readings, pair), special)
    return L.latenight_tags(L.latenight_sessions(lr, thresholds, special))


def activity_job(readings: DataFrame, thresholds: DataFrame) -> DataFrame:
    c = A.last_activity_carry(A.last_activity(readings, thresholds))
    return c.withColumn("ymd", day_to_label("day_no"))


def activity_job_incremental(readings: DataFrame, thresholds: DataFrame, store: DataFrame,
                             as_of_day: int) -> DataFrame:
    """Last activity of one day: today's latest eligible time, else the stored previous-day value, else 0.

    A previous-day cell exists exactly when that day had readings, which is
    when the full computation carries too.
    """
    today = A.last_activity(readings_of_days(readings, as_of_day, as_of_day), thresholds)
    prev_lbl = (as_of_day - 1) * 86400 + 54000
    prev = (store.filter(F.col("yyyymm").isin(months_between(as_of_day - 1, as_of_day - 1))
                         & (F.col("family") == FAMILY_DAILY) & (F.col("col") == "la")
                         & (F.col("ymd") == prev_lbl))
            .select(F.col("user_id").cast("string").alias("user_id"), "app_type_id",
                    F.col("value").cast("long").alias("la_prev")))
    j = today.withColumn("user_id", F.col("user_id").cast("string")).join(prev, KEYS, "left")
    return j.select(*KEYS, "day_no", F.coalesce("la", "la_prev", F.lit(0)).cast("long").alias("la"),
                    day_to_label("day_no").alias("ymd"))


def to_cells(df: DataFrame, family: str, columns: dict, version) -> DataFrame:
    """Wide metric rows -> (user_id, app_type_id, ymd, family, col, value, version)."""
    pairs = F.array(*[F.struct(F.lit(name).alias("col"), F.col(src).cast("string").alias("value"))
                      for name, src in columns.items()])
    return df.select(F.col("user_id").cast("string").alias("user_id"), "app_type_id",
                     F.col("ymd").cast("long").alias("ymd"), F.lit(family).alias("family"),
                     F.inline(pairs), F.lit(version).cast("long").alias("version"))


def tag_cells(df: DataFrame, col: str, version) -> DataFrame:
    """Session lists as JSON text in the OneTag family."""
    return to_cells(df.withColumn("tags_json", F.to_json("tags")), FAMILY_ONETAG, {col: "tags_json"}, version)


# days of readings each job needs before its label day (None: all days)
LOOKBACK = {"daily": HISTORY_DAYS, "weekly": 27, "util-long": 28, "util-short": 7,
            "util-weekday": 56, "profile": 13}
# first and last day, from its label day, of the daily rows that each job reads
HISTORY_OF = {"daily": (-HISTORY_DAYS, -1), "weekly": (-27, 0), "util-long": (-28, 0), "util-short": (-7, 0), "util-weekday": (-56, 0)}


def _yyyymmdd(day: int) -> int:
    d = dt.date(1970, 1, 1) + dt.timedelta(days=day)
    return d.year * 10000 + d.month * 100 + d.day


def _readings_from_parquet(spark: SparkSession, path: str, lo_day: int | None = None,
                           hi_day: int | None = None) -> DataFrame:
    """Readings (user_id, app_type_id, t, power), restricted to JST days lo..hi when given.

    ``path`` may hold flat readings, the points that ``ingest`` writes (committed runs only), nested
    per-day records, or ``ser_id=`` folders of any of them.  A ``partition``
    (yyyymmdd) column of a day-partitioned table is pruned with literal bounds
    (one day of slack on each side, since the folder day may be UTC); the exact
    time range is applied as well.
    """
    df = read_committed(spark, path)   # also a ser_id= folder per provider
    if lo_day is not None and "partition" in df.columns:
        df = df.filter(F.col("partition").between(_yyyymmdd(lo_day - 1), _yyyymmdd(hi_day + 1)))
    if "data" in df.columns:        # nested per-day records
        df = unnest_estimates(df)
    if lo_day is not None:
        df = readings_of_days(df, lo_day, hi_day)
    t = epoch_seconds(df, "ts") if "ts" in df.columns else F.col("t").cast("long")
    return df.select(F.col("user_id").cast("string").alias("user_id"),
                     F.col("app_type_id").cast("string").alias("app_type_id"),
                     t.alias("t"), F.col("power").cast("double").alias("power"))


def read_registry(spark: SparkSession, path: str | None, jdbc: str | None) -> DataFrame | None:
    """The (user, is_active) registry from parquet, or by a partitioned JDBC scan.

    ``jdbc`` is ``url,table,id_column,lower,upper``.
    """
    if jdbc:
        url, table, column, lower, upper = jdbc.rsplit(",", 4)
        return read_registry_jdbc(spark, url, table, column, int(lower), int(upper))
    return spark.read.parquet(path) if path else None


def _session(job: str) -> SparkSession:
    """A session of its own lets Spark remove checkpoints that nothing refers to any more."""
    return (SparkSession.builder.appName(f"loadlens-{job}")
            .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())


def ingest_main(argv) -> None:
    """``windows``: fetch windows per active user; ``ingest``: landed payloads -> points + watermark."""
    from loadlens.operators import ingest as I
    from loadlens.operators import watermark as WM
    from loadlens.sources.payloads import read_estimate_payloads
    from loadlens.streaming.jobs import ingest_batch, run_hour

    ap = argparse.ArgumentParser(prog="loadlens.jobs")
    ap.add_argument("job", choices=["windows", "ingest"])
    ap.add_argument("--registry", help="windows: parquet with user, is_active")
    ap.add_argument("--registry-jdbc", help="windows: url,table,id_column,lower,upper instead of --registry")
    ap.add_argument("--allowed", help="windows: comma-separated provider ids (default: all)")
    ap.add_argument("--watermark", required=True, help="watermark snapshot table (partitioned by et_hr)")
    ap.add_argument("--out", help="windows: output parquet of (user_id, ser_id, st, et)")
    ap.add_argument("--now", type=int, help="windows: end of the fetch span, epoch s (default: clock)")
    ap.add_argument("--first-run", action="store_true", help="windows: ignore watermarks")
    ap.add_argument("--payloads", help="ingest: landed estimate payload JSON files")
    ap.add_argument("--points", help="ingest: output points table (partitioned by batch)")
    ap.add_argument("--records", help="ingest: also write nested est/main JSON records here")
    ap.add_argument("--batch-id", help="ingest: names the run; the same name replaces its points (default: a fresh name)")
    ap.add_argument("--run-hour", type=int, help="ingest: snapshot id yyyymmddHH (default: clock)")
    a = ap.parse_args(argv)
    spark = _session(a.job)
    if a.job == "windows":
        reg = read_registry(spark, a.registry, a.registry_jdbc)
        if reg is None or not a.out:
            ap.error("windows needs --registry or --registry-jdbc, and --out")
        now = a.now if a.now is not None else int(time.time())
        if a.allowed:
            allowed = literal_table(spark, [(x,) for x in a.allowed.split(",")],
                                    T.StructType([T.StructField("ser_id", T.StringType())]))
            users = G.users_with_provider(reg, allowed)
        else:
            from loadlens.functions.keys import provider_id
            users = G.active_users(reg).select("user", provider_id("user").alias("ser_id"))
        users = users.select(F.col("user").alias("user_id"), "ser_id")
        # only a missing path is a first run; a table that can't be read fails the job
        wm = None if a.first_run else WM.read_latest_snapshot(spark, a.watermark)
        win = I.first_run_windows(users, now) if wm is None else I.ingest_windows(users, wm[0], now)
        win.write.mode("overwrite").parquet(a.out)
    else:
        if not (a.payloads and a.points):
            ap.error("ingest needs --payloads and --points")
        hour = a.run_hour if a.run_hour is not None else run_hour()
        run = a.batch_id or f"run-{hour}-{uuid.uuid4().hex}"
        ingest_batch(spark, read_estimate_payloads(spark, a.payloads), run, hour,
                     a.points, a.watermark, a.records, replace=a.batch_id is not None)


#: What streamed readings look like in their landing folder.
READING_SCHEMA = "user_id string, app_type_id string, t long, power double"


def stream_main(argv) -> None:
    """``stream-ingest``, ``stream-activity``, ``stream-sessions``: the streaming jobs, until stopped or over what has landed."""
    from loadlens.streaming import jobs as SJ

    ap = argparse.ArgumentParser(prog="loadlens.jobs")
    ap.add_argument("job", choices=["stream-ingest", "stream-activity", "stream-sessions"])
    ap.add_argument("--checkpoint", required=True, help="the query's own folder")
    ap.add_argument("--available-now", action="store_true", help="process what has landed, then stop")
    ap.add_argument("--payloads", help="stream-ingest: folder where payload JSON lands")
    ap.add_argument("--points", help="stream-ingest: output points table")
    ap.add_argument("--watermark", help="stream-ingest: watermark snapshot table")
    ap.add_argument("--records", help="stream-ingest: also write nested est/main JSON records here")
    ap.add_argument("--readings", help="stream-activity, stream-sessions: folder where parquet readings land (%s)" % READING_SCHEMA)
    ap.add_argument("--store", help="stream-activity: cell table")
    ap.add_argument("--out", help="stream-sessions: output parquet table")
    ap.add_argument("--delay", help="how long late readings are waited for (default: 4 hours, sessions 1 day)")
    ap.add_argument("--max-files", type=int, help="files of a folder that a trigger takes on (default: all)")
    a = ap.parse_args(argv)
    needed = {"stream-ingest": ("payloads", "points", "watermark"), "stream-activity": ("readings", "store"), "stream-sessions": ("readings", "out")}[a.job]
    if any(getattr(a, n) is None for n in needed):
        ap.error(f"{a.job} needs " + ", ".join(f"--{n}" for n in needed))
    spark = _session(a.job)
    if a.job == "stream-ingest":
        query = SJ.ingest_stream(spark, a.payloads, a.points, a.watermark, a.checkpoint, a.available_now, a.records)
    else:
        source = spark.readStream.schema(READING_SCHEMA)
        readings = (source.option("maxFilesPerTrigger", a.max_files) if a.max_files else source).parquet(a.readings)
        th = Thresholds().to_df(spark)
        if a.job == "stream-activity":
            query = SJ.activity_store_stream(readings, th, a.store, a.checkpoint, a.available_now, delay=a.delay or "4 hours")
        else:
            query = SJ.sessions_store_stream(readings, th, a.out, a.checkpoint, a.available_now, delay=a.delay or "1 day")
    query.awaitTermination()


def compact_main(argv) -> None:
    """``compact``: merge the store's runs; may run beside any job."""
    ap = argparse.ArgumentParser(prog="loadlens.jobs")
    ap.add_argument("job", choices=["compact"])
    ap.add_argument("--store", required=True, help="cell table")
    ap.add_argument("--month", type=int, action="append", help="yyyymm to compact; repeatable (default: all)")
    ap.add_argument("--grace", type=float, default=3600.0, help="seconds that replaced files stay for readers that began before")
    a = ap.parse_args(argv)
    days = ST.compact_store(_session(a.job), a.store, a.month, a.grace)
    print(f"{days} label days merged")


def history_main(argv) -> None:
    """``history``: the store's daily rows as a table bucketed by key, for ``--history-table``."""
    ap = argparse.ArgumentParser(prog="loadlens.jobs")
    ap.add_argument("job", choices=["history"])
    ap.add_argument("--store", required=True, help="cell table")
    ap.add_argument("--table", required=True, help="catalog table, made when there is none")
    ap.add_argument("--buckets", type=int, required=True, help="files a month: rows of a month / some millions")
    ap.add_argument("--month", type=int, action="append", help="yyyymm to publish; repeatable (default: all)")
    a = ap.parse_args(argv)
    H.publish(_session(a.job), a.store, a.table, a.buckets, a.month)


def needed_history(spark: SparkSession, a, as_of: int) -> list[tuple[str, int, int]]:
    """(job, first, last data day) of the stored cells that a job for one label reads."""
    if a.job == "daily":
        newest = read_moments(spark, a.moments, as_of) if a.moments else None
        if newest is None or newest[1] < as_of - HISTORY_DAYS:
            return [("daily", as_of - HISTORY_DAYS, as_of - 1)]
        return [("daily", newest[1], as_of - 1), ("daily", newest[1] - HISTORY_DAYS, as_of - 1 - HISTORY_DAYS)]
    if a.job == "weekly":
        return [("daily", as_of - 27, as_of)]
    if a.job.startswith("util-"):
        return [("daily", as_of - {"util-long": 28, "util-short": 7, "util-weekday": 56}[a.job], as_of)]
    return [("activity", as_of - 1, as_of - 1)] if a.job == "activity" else []


def main(argv=None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] in ("windows", "ingest"):
        return ingest_main(argv)
    if argv and argv[0].startswith("stream-"):
        return stream_main(argv)
    if argv and argv[0] == "compact":
        return compact_main(argv)
    if argv and argv[0] == "history":
        return history_main(argv)
    ap = argparse.ArgumentParser(prog="loadlens.jobs")
    ap.add_argument("job", choices=["daily", "weekly", "util-long", "util-short", "util-weekday",
                                    "profile", "latenight", "activity"])
    ap.add_argument("--readings", help="parquet: user_id, app_type_id, ts|t, power; ingest points; nested records; ser_id= folders")
    ap.add_argument("--payloads", help="activity: landed activity payload JSON instead of --readings")
    ap.add_argument("--registry", help="util: parquet with user, is_active; idle users get rows too")
    ap.add_argument("--registry-jdbc", help="util: url,table,id_column,lower,upper instead of --registry")
    ap.add_argument("--special-users", help="late-night: parquet with user_id, start_offset, end_offset")
    ap.add_argument("--store", required=True, help="month-partitioned cell table")
    ap.add_argument("--run-date", help="MMDDYYYY; the data day is the day before (default: all days)")
    ap.add_argument("--version", type=int, help="cell version (default: run time in ms)")
    ap.add_argument("--recompute-history", action="store_true",
                    help="daily/weekly/util: rebuild the history from readings instead of the store")
    ap.add_argument("--moments", help="daily with --run-date: folder of running baseline moments, so a run reads no 56 days of history")
    ap.add_argument("--history-table", help="daily/weekly/util with --run-date: bucketed table of the history job, used when complete")
    ap.add_argument("--special-user", action="append", default=[],
                    help="late-night special user id (offsets %s); repeatable" % (SPECIAL_USER_OFFSETS,))
    a = ap.parse_args(argv)
    if bool(a.readings) == bool(a.payloads) or (a.payloads and a.job != "activity"):
        ap.error("give --readings, or for activity --payloads")
    spark = _session(a.job)
    version = a.version if a.version is not None else int(time.time() * 1000)
    as_of = run_date_to_day(a.run_date) if a.run_date else None
    back = LOOKBACK.get(a.job) if as_of is not None else None
    if a.payloads:
        r = flatten_activity(read_activity_payloads(spark, a.payloads)).select(
            F.col("user_id").cast("string").alias("user_id"), F.col("app_type_id").cast("string").alias("app_type_id"), "t", "power")
    else:
        r = (_readings_from_parquet(spark, a.readings) if back is None
             else _readings_from_parquet(spark, a.readings, as_of - back, as_of))
    th = Thresholds().to_df(spark)
    rows = None
    if a.history_table and as_of is not None and not a.recompute_history and a.job in HISTORY_OF:
        lo, hi = (as_of + d for d in HISTORY_OF[a.job])
        rows = H.complete_history(spark, a.history_table, lo, hi)
        if rows is None:
            print(f"{a.history_table}: data days {lo}..{hi} are not complete; not used", file=sys.stderr)
    # the stored history is used when it is complete for the days that the label needs; only a missing path means there is no store
    store = None if as_of is None or a.recompute_history or rows is not None else ST.stored_cells(spark, a.store)
    if store is not None:
        lacking = [(kind, lo, hi) for kind, lo, hi in needed_history(spark, a, as_of) if not ST.is_covered(spark, a.store, kind, lo, hi)]
        if lacking:
            print(f"{a.store}: cells of {', '.join(f'{k} for data days {lo}..{hi}' for k, lo, hi in lacking)} are not complete; "
                  "computing from readings", file=sys.stderr)
            store = None
    if a.job == "daily" and rows is not None:
        d = daily_job_from_history(_readings_from_parquet(spark, a.readings, as_of, as_of), th, rows,
                                   H.bucket_count(spark, a.history_table), as_of)
        cells = to_cells(d, FAMILY_DAILY, DAILY_COLS, version).unionByName(tag_cells(d, "Otag", version))
    elif a.job == "daily" and store is not None and a.moments:
        d = daily_job_from_moments(spark, _readings_from_parquet(spark, a.readings, as_of, as_of), th, store, a.moments, as_of)
        cells = to_cells(d, FAMILY_DAILY, DAILY_COLS, version).unionByName(tag_cells(d, "Otag", version))
    elif a.job == "daily" and store is not None:
        r1 = _readings_from_parquet(spark, a.readings, as_of, as_of)
        hist = store_daily_history(store, as_of - HISTORY_DAYS, as_of - 1)
        d = daily_job_incremental(r1, th, hist, as_of)
        cells = to_cells(d, FAMILY_DAILY, DAILY_COLS, version).unionByName(tag_cells(d, "Otag", version))
    elif a.job == "daily":
        d = daily_job(r, th, as_of)
        cells = to_cells(d, FAMILY_DAILY, DAILY_COLS, version).unionByName(tag_cells(d, "Otag", version))
    elif a.job == "weekly":
        # stored Daily cells of the 28 days the label needs, or a recomputation from readings
        d = (H.active_days(rows) if rows is not None
             else store_daily_history(store, as_of - 27, as_of) if store is not None
             else daily_job(r, th, None))
        last = None if as_of is not None else r.agg(F.max(day_no("t"))).first()[0]
        cells = to_cells(weekly_job(d, as_of, last, dealt=rows is not None), FAMILY_WEEKLY, WEEKLY_COLS, version)
    elif a.job.startswith("util-"):
        if as_of is None:
            ap.error("utilisation jobs need --run-date")
        kind = a.job.split("-", 1)[1]
        reg = read_registry(spark, a.registry, a.registry_jdbc)
        # every active user and type: idle ones get zeros; without a registry, the users of the readings
        users = G.active_users(reg) if reg is not None else r.select(F.col("user_id").alias("user")).distinct()
        grid = G.user_app_grid(users, Thresholds().app_types)
        span = {"long": 28, "short": 7, "weekday": 56}[kind]
        if rows is not None:
            u = utilization_from_sessions(H.sessions(rows), grid, as_of, kind)
        elif store is not None:
            # the daily job's stored session lists replace re-sessionizing `span` days of readings
            u = utilization_from_sessions(store_sessions(store, as_of - span, as_of), grid, as_of, kind)
        else:
            u = utilization_job(r, th, grid, as_of, kind)
        prefix, fam = {"long": ("l", FAMILY_WEEKLY), "short": ("s", FAMILY_WEEKLY),
                       "weekday": ("", FAMILY_DAILY)}[kind]
        cols = {f"{prefix}{h:02d}": f"{prefix}{h:02d}" for h in range(24)}
        if kind == "weekday":
            cols["wDay"] = "wDay"
        cells = to_cells(u, fam, cols, version)
    elif a.job == "profile":
        if as_of is None:
            ap.error("profile needs --run-date")
        cells = to_cells(profile_job(r, th, as_of), FAMILY_WEEKLY, PROFILE_COLS, version)
    elif a.job == "latenight":
        sp = special_users_df(spark, {u: SPECIAL_USER_OFFSETS for u in a.special_user})
        if a.special_users:
            sp = sp.unionByName(spark.read.parquet(a.special_users).select(F.col("user_id").cast("string").alias("user_id"), "start_offset", "end_offset"))
        if as_of is not None:
            # the run date's night: label = JST midnight starting the run date (15:00 UTC of the data day)
            m = (as_of + 1) * 86400 - 32400
            rl = _readings_from_parquet(spark, a.readings, as_of, as_of + 1)
            rl = rl.filter((F.col("t") >= m - 7200) & (F.col("t") < m + 18000))
            t = latenight_job(rl, th, sp).filter(F.col("ymd") == m)
        else:
            t = latenight_job(r, th, sp)
        cells = tag_cells(t, "LOtag", version)
    else:
        if store is not None:
            act = activity_job_incremental(r if a.payloads else _readings_from_parquet(spark, a.readings, as_of, as_of), th, store, as_of)
        else:
            act = activity_job(r, th)
            act = act if as_of is None else act.filter(F.col("day_no") == as_of)
        cells = to_cells(act, FAMILY_DAILY, {"la": "la"}, version)
    months = None
    if as_of is not None:
        d = dt.date(1970, 1, 1) + dt.timedelta(days=as_of)   # the label's UTC date is the data day
        months = [d.year * 100 + d.month]
    ST.append_cells(spark, a.store, cells, months)   # other jobs may write the same day at once
    if a.job in ("daily", "activity"):
        newest = as_of if as_of is not None else r.agg(F.max(day_no("t"))).first()[0]
        if newest is not None:
            ST.mark_covered(spark, a.store, a.job, as_of if as_of is not None else 0, newest)


if __name__ == "__main__":
    main()
    SparkSession.builder.getOrCreate().stop()
