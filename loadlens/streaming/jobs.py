"""Streaming jobs.

* ``ingest_stream`` (X1): landed payload JSON files -> finalised points,
  appended per micro-batch, and the per-user watermark merged into a new
  snapshot.  Both become visible by one commit marker per batch, which carries
  the query's identity and the batch's number: a replayed batch that was
  committed writes nothing, one that was not is written anew, and a new run
  overwrites nothing.
* ``last_activity_carry_stream`` (X2): readings -> each day's last activity
  with the previous day's carried over, by keyed state with timers, in update
  mode; ``last_activity_stream`` gives closed 600 s windows instead.
* ``sessions_stream`` (X3): readings -> daily sessions in two chained steps, a
  windowed aggregate per second and ``session_window`` with the per-type gap;
  state is bounded by the event-time watermark.
"""

from __future__ import annotations

import time

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from loadlens.functions.time import day_no, day_to_label
from loadlens.functions.keys import provider_id
from loadlens.operators.commits import IngestLog, batch_name
from loadlens.operators.payload import flatten_estimates, payload_records, with_partition
from loadlens.operators.watermark import merge_watermarks, plain_newest, read_snapshot, stage_snapshot
from loadlens.operators.store import append_cells
from loadlens.session import shared_dir
from loadlens.sources.schemas import ESTIMATE_PAYLOAD


def ingest_batch(spark: SparkSession, df: DataFrame, run: str, run_hr: int, points_dir: str,
                 watermark_dir: str, records_dir: str | None = None, replace: bool = False) -> bool:
    """One ingest run; its points, records and watermark become visible together, or not at all.

    ``run`` names the run for good (an identity and a number, never a number
    that starts anew).  A run that is committed already is left as it is
    (False), unless ``replace`` asks for its batch to be written anew; no run
    touches another's batch, whatever the hour.  ``run_hr`` (yyyymmddHH) is the
    watermark snapshot's id; a snapshot never gets an id below the newest one,
    and holds each user's greatest watermark.  Only users with finalised points
    advance.  ``records_dir`` additionally writes the nested per-(user, day)
    JSON records, ``est`` and ``main`` text datasets under
    ``batch=/ser_id=/partition=``.
    """
    shared_dir(spark)
    log = IngestLog(spark, watermark_dir)
    outputs = [points_dir, *([f"{records_dir.rstrip('/')}/{k}" for k in ("est", "main")] if records_dir else [])]
    log.start(outputs, None if log.begun() else plain_newest(spark, watermark_dir))
    if not replace and log.committed(run):
        return False
    batch = batch_name(run)
    df = df.persist()   # feeds several writes; parse the batch once
    try:
        est = flatten_estimates(df)
        pts = with_partition(est.drop("commited_at")).withColumn("batch", F.lit(batch))
        (pts.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(points_dir))
        if records_dir is not None:
            rec = payload_records(df)
            rec = rec.withColumn("ser_id", provider_id("user_id")).withColumn("batch", F.lit(batch))
            for kind, out in zip(("est", "main"), outputs[1:]):
                (rec.filter(F.col(f"{kind}_json").isNotNull())
                 .select(f"{kind}_json", "batch", "ser_id", "partition")
                 .hint("rebalance", "ser_id", "partition")
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch", "ser_id", "partition").text(out))
        new = est.groupBy("user_id").agg(F.max("commited_at").alias("commited_at")).checkpoint(eager=True)
        while True:
            last = log.newest()     # read before the snapshot, so a run that ends meanwhile takes the next number
            stored = read_snapshot(spark, watermark_dir, last)
            et_hr = max(run_hr, last.et_hr or run_hr)
            snapshot = stage_snapshot(new if stored is None else merge_watermarks(new, stored), watermark_dir, et_hr)
            if log.commit(run, batch, outputs, snapshot, et_hr, after=last.number):
                return True
    finally:
        df.unpersist()


def run_hour(now: float | None = None) -> int:
    """yyyymmddHH (UTC) of a run."""
    return int(time.strftime("%Y%m%d%H", time.gmtime(now)))


def ingest_stream(spark: SparkSession, payload_dir: str, points_dir: str, watermark_dir: str,
                  checkpoint: str, available_now: bool = True,
                  records_dir: str | None = None) -> StreamingQuery:
    shared_dir(spark)
    src = spark.readStream.schema(ESTIMATE_PAYLOAD).json(payload_dir)

    def batch(df: DataFrame, batch_id: int) -> None:
        # the query's own id is written once into its checkpoint folder: it outlives restarts, and
        # a new checkpoint folder, whose batches count from 0 again, has another one
        run = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        ingest_batch(spark, df, f"{run}-{batch_id}", run_hour(), points_dir, watermark_dir, records_dir)

    w = src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="3600 seconds")
    return w.start()


def _with_event_time(readings: DataFrame) -> DataFrame:
    return readings.withColumn("ts", F.timestamp_seconds("t"))


def last_activity_stream(readings: DataFrame, thresholds: DataFrame,
                         delay: str = "4 hours", slot: str = "600 seconds") -> DataFrame:
    """Streaming A1: max eligible t per (user, type, 600 s slot); append mode.

    Finalising takes up to 3 hours, so readings are waited for 4 hours.
    """
    r = _with_event_time(readings).join(thresholds, "app_type_id").withWatermark("ts", delay)
    return (r.groupBy("user_id", "app_type_id", F.window("ts", slot).alias("slot"))
            .agg(F.max(F.when(F.col("power") > F.col("min_power"), F.col("t"))).alias("la"))
            .select("user_id", "app_type_id", F.unix_seconds(F.col("slot.start")).alias("slot_st"), "la"))


def sessions_stream(readings: DataFrame, thresholds: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming N1+N2: sessions per (user, type, day); emitted once closed by the watermark.

    Two chained stateful steps.  Eligible readings are first reduced to one row
    per key and second, a windowed aggregate that is combined map-side, so a
    hot key's raw rows never meet; only these rows (86,400 a key and day at
    most) reach the session window.  Its event time is the second's, which
    shifts all rows alike and so changes no gap.
    """
    r = (_with_event_time(readings).join(thresholds, "app_type_id")
         .filter(F.col("power") > F.col("min_power"))
         .withColumn("day_no", day_no("t")).withWatermark("ts", delay))
    keys = ["user_id", "app_type_id", "day_no"]
    seconds = (r.groupBy(*keys, "max_gap", "min_duration", F.window("ts", "1 second").alias("second"))
               .agg(F.min("t").alias("t")).withColumn("at", F.window_time("second")))
    gap = F.concat(F.col("max_gap").cast("string"), F.lit(" seconds"))
    s = (seconds.groupBy(*keys, "min_duration", F.session_window("at", gap).alias("sw"))
         .agg(F.min("t").alias("st"), F.max("t").alias("et")))
    return s.filter((F.col("et") - F.col("st")) > F.col("min_duration")).select(*keys, "st", "et")


class CarryProcessor(StatefulProcessor):
    """Per (user, type): each recent day's own latest eligible time, and its value with the previous day's carried over.

    A day stays until the watermark is past the day after it, when no row can
    change it or be filled from it any more; a timer then drops it.
    """

    def init(self, handle) -> None:
        self.handle = handle
        # own: -1 while the day has readings but none eligible
        self.days = handle.getMapState("days", "day_no long", "own long, la long")

    def handleInputRows(self, key, rows, timerValues):
        fresh: dict[int, int] = {}
        for part in rows:       # Arrow chunks of the key's rows
            for d, own in part.groupby("day_no")["own"].max().items():
                fresh[int(d)] = max(int(own), fresh.get(int(d), -1))
        state = {int(k[0]): (int(v[0]), int(v[1])) for k, v in self.days.iterator()}
        changed = []
        for d in sorted(fresh):
            own = max(fresh[d], state[d][0] if d in state else -1)
            if d not in state:
                self.handle.registerTimer((d + 2) * 86_400_000 - 32_400_000)   # the end of the day after
            # the day, and the days after it in a row, which may be filled from it
            while True:
                la = own if own >= 0 else state.get(d - 1, (-1, 0))[1]
                old = state.get(d)
                if old == (own, la):
                    break
                state[d] = (own, la)
                self.days.updateValue((d,), state[d])
                if old is None or old[1] != la:
                    changed.append(d)
                d += 1
                if d not in state:
                    break
                own = state[d][0]
        if changed:
            changed = sorted(set(changed))
            yield pd.DataFrame({"user_id": [key[0]] * len(changed), "app_type_id": [key[1]] * len(changed), "day_no": changed,
                                "la": [state[d][1] for d in changed]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last = (expiredTimerInfo.getExpiryTimeInMs() + 32_400_000) // 86_400_000 - 2
        for d in [int(k[0]) for k in self.days.keys()]:
            if d <= last:
                self.days.removeKey((d,))
        yield from ()

    def close(self) -> None:
        pass


def last_activity_carry_stream(readings: DataFrame, thresholds: DataFrame, delay: str = "4 hours") -> DataFrame:
    """Streaming A2: (user, type, day, la), the day's latest eligible time, else the previous day's value, else 0.

    For update mode: every trigger gives the days whose value it changed, so a
    slot's value is out within the slot, and a late row corrects its day and
    the days filled from it.  Days without a reading give nothing, as in
    ``last_activity_carry``.  Needs the RocksDB state store (``use_keyed_state``).
    """
    r = _with_event_time(readings).join(thresholds, "app_type_id").withWatermark("ts", delay)
    own = F.when(F.col("power") > F.col("min_power"), F.col("t")).otherwise(F.lit(-1)).cast("long")
    few = r.select("user_id", "app_type_id", day_no("t").alias("day_no"), own.alias("own"), "ts")
    types = {f.name: f.dataType.simpleString() for f in few.schema.fields}
    out = f"user_id {types['user_id']}, app_type_id {types['app_type_id']}, day_no long, la long"
    return few.groupBy("user_id", "app_type_id").transformWithStateInPandas(CarryProcessor(), out, "Update", "EventTime")


def use_keyed_state(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def activity_store_stream(readings: DataFrame, thresholds: DataFrame, store: str, checkpoint: str, available_now: bool = False,
                          slot_seconds: int = 600, delay: str = "4 hours") -> StreamingQuery:
    """Write the changed ``la`` cells of every slot to the store; a replayed batch writes the same values again."""
    from loadlens.jobs import FAMILY_DAILY, to_cells

    spark = readings.sparkSession
    use_keyed_state(spark)

    def batch(df: DataFrame, batch_id: int) -> None:
        cells = to_cells(df.withColumn("ymd", day_to_label("day_no")), FAMILY_DAILY, {"la": "la"}, int(time.time() * 1000))
        append_cells(spark, store, cells)

    w = (last_activity_carry_stream(readings, thresholds, delay).writeStream.foreachBatch(batch).outputMode("update")
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{slot_seconds} seconds")).start()


def sessions_store_stream(readings: DataFrame, thresholds: DataFrame, out: str, checkpoint: str, available_now: bool = False,
                          delay: str = "1 day") -> StreamingQuery:
    """Append closed sessions to a parquet table (exactly once, by the file sink's log)."""
    w = (sessions_stream(readings, thresholds, delay).writeStream.format("parquet").option("path", out).outputMode("append")
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="600 seconds")).start()
