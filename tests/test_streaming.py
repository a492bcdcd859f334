"""Streaming jobs give the batch results (X1-X3)."""

import json
import os

from pyspark.sql import functions as F

from conftest import D0, readings
from loadlens.operators import activity as A  # noqa: F401
from loadlens.operators import sessions as S
from loadlens.session import fresh_path
from loadlens.settings import Thresholds
from loadlens.streaming import ingest_stream, last_activity_stream, sessions_stream

SCHEMA = "user_id string, app_type_id string, t long, power double"


def _rows():
    rows = []
    for u in ("a", "b"):
        t = D0
        for i in range(200):
            t += 4000 if i % 30 == 29 else 40
            rows.append((u, "25", t, 20.0 if i % 5 else 3.0))
    return rows


def _stream_of(spark, rows, sentinel, parts=3):
    """Rows split over time-ordered files, then the watermark sentinel as the last file."""
    path = fresh_path(spark, "stream-src")
    df = readings(spark, rows)
    ts = sorted(r[2] for r in rows)
    cuts = [ts[0]] + [ts[len(ts) * (i + 1) // parts - 1] + 1 for i in range(parts)]
    for lo, hi in zip(cuts, cuts[1:]):
        df.filter((F.col("t") >= lo) & (F.col("t") < hi)).coalesce(1).write.mode("append").parquet(path)
    readings(spark, sentinel).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def _run(df, name, mode="append"):
    spark = df.sparkSession
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_sessions_stream_equals_batch(spark):
    rows = _rows()
    sentinel = [("zz", "25", D0 + 40 * 86400, 20.0)]   # advances the watermark past every session
    th = Thresholds().to_df(spark)
    out = _run(sessions_stream(_stream_of(spark, rows, sentinel), th), "x3")
    got = sorted(tuple(r) for r in out.filter("user_id <> 'zz'").collect())
    want = sorted(tuple(r) for r in S.sessions(readings(spark, rows), th).collect())
    assert got == want and len(got) > 5


def test_last_activity_stream_equals_batch(spark):
    rows = _rows()
    sentinel = [("zz", "25", D0 + 40 * 86400, 20.0)]
    th = Thresholds().to_df(spark)
    out = _run(last_activity_stream(_stream_of(spark, rows, sentinel), th), "x2")
    got = sorted(tuple(r) for r in out.filter("user_id <> 'zz'").collect())
    r = readings(spark, rows).join(th, "app_type_id")
    want = (r.groupBy("user_id", "app_type_id", (F.floor(F.col("t") / 600) * 600).alias("slot_st"))
            .agg(F.max(F.when(F.col("power") > F.col("min_power"), F.col("t"))).alias("la")))
    assert got == sorted(tuple(x) for x in want.collect())


def test_ingest_stream_equals_batch(spark):
    from loadlens.operators.payload import flatten_estimates
    from loadlens.sources.payloads import read_estimate_payloads
    src = fresh_path(spark, "payload-src").removeprefix("file:")
    os.makedirs(src, exist_ok=True)
    payloads = []
    for k, (user, commit) in enumerate([("a", 2500), ("b", 3500), ("a", 9000)]):
        p = {"customer": user, "commited_at": commit, "st": 1000 * k,
             "data": [{"timestamps": [1000 + k, 2000 + k, 3000 + k], "main_pwrs": [1.0, 2.0, 3.0],
                       "app_type": [{"app_id": 1, "apps": [{"id": 1, "pwrs": [5.0, None, 7.0]}]}]}]}
        payloads.append(p)
        with open(os.path.join(src, f"p{k}.json"), "w") as f:
            f.write(json.dumps(p) + "\n")
    pts, wm, ck, rec = (fresh_path(spark, n) for n in ("pts", "wm", "ck", "rec"))
    q = ingest_stream(spark, src, pts, wm, ck, records_dir=rec)
    q.awaitTermination()
    cols = ["user_id", "app_type_id", "app_id", "t", "power"]
    got = sorted(tuple(r) for r in spark.read.parquet(pts).select(*cols).collect())
    want = sorted(tuple(r) for r in flatten_estimates(read_estimate_payloads(spark, src)).select(*cols).collect())
    assert got == want
    hist = spark.read.parquet(wm)
    last = hist.filter(F.col("et_hr") == hist.agg(F.max("et_hr")).collect()[0][0])
    assert sorted((r.user_id, r.commited_at) for r in last.collect()) == [("a", 9000), ("b", 3500)]
    assert spark.read.text(f"{rec}/est").count() > 0


def test_ingest_batch_replay_is_idempotent(spark):
    from loadlens.sources.schemas import ESTIMATE_PAYLOAD
    from loadlens.streaming import ingest_batch
    rows = [{"customer": u, "commited_at": c, "st": 0,
             "data": [{"timestamps": [10, 20], "main_pwrs": [1.0, 2.0],
                       "app_type": [{"app_id": 1, "apps": [{"id": 1, "pwrs": [5.0, 6.0]}]}]}]}
            for u, c in (("a", 15), ("b", 30))]
    df = spark.createDataFrame(rows, ESTIMATE_PAYLOAD)
    pts, wm = fresh_path(spark, "replay-pts"), fresh_path(spark, "replay-wm")
    ingest_batch(spark, df, "run-0", 2024011500, pts, wm)
    ingest_batch(spark, df.filter("customer = 'a'"), "run-1", 2024011501, pts, wm)
    first = sorted(tuple(r) for r in spark.read.parquet(pts).collect())
    ingest_batch(spark, df.filter("customer = 'a'"), "run-1", 2024011501, pts, wm)     # replay after a failure
    assert sorted(tuple(r) for r in spark.read.parquet(pts).collect()) == first
    snap = spark.read.parquet(wm).filter("et_hr = 2024011501")
    assert sorted((r.user_id, r.commited_at) for r in snap.collect()) == [("a", 15), ("b", 30)]


def _payload(user, commit, st, times, powers=(20.0, 30.0)):
    return {"customer": user, "commited_at": commit, "st": st,
            "data": [{"timestamps": times, "main_pwrs": [1.0] * len(times),
                      "app_type": [{"app_id": 1, "apps": [{"id": 77, "pwrs": list(powers)}]}]}]}


def test_new_checkpoint_overwrites_no_points(spark):
    src = fresh_path(spark, "src").removeprefix("file:")
    os.makedirs(src, exist_ok=True)
    pts, wm = fresh_path(spark, "pts"), fresh_path(spark, "wm")
    for k in range(2):     # the second run has a checkpoint folder of its own, so its batches start at 0 again
        with open(os.path.join(src, f"p{k}.json"), "w") as f:
            f.write(json.dumps(_payload(f"u{k}", 100, 0, [10, 20])) + "\n")
        ingest_stream(spark, src, pts, wm, fresh_path(spark, "ck")).awaitTermination()
    users = {r[0]: r[1] for r in spark.read.parquet(pts).groupBy("user_id").count().collect()}
    assert users == {"u0": 4, "u1": 2}      # u0's file is read by both runs; neither lost a point
    assert spark.read.parquet(pts).select("batch").distinct().count() == 2


def test_watermark_never_goes_back(spark):
    from loadlens.operators.watermark import read_latest_snapshot
    from loadlens.sources.schemas import ESTIMATE_PAYLOAD
    from loadlens.streaming import ingest_batch
    pts, wm = fresh_path(spark, "pts"), fresh_path(spark, "wm")
    frame = lambda *rows: spark.createDataFrame(list(rows), ESTIMATE_PAYLOAD)
    ingest_batch(spark, frame(_payload("a", 5000, 0, [10, 20]), _payload("b", 70, 0, [10, 20])), "x-0", 2024011505, pts, wm)
    late = frame(_payload("a", 4000, 5000, [10, 20]), _payload("b", 60, 0, [30, 40]), _payload("c", 9, 9, [1, 2]))
    ingest_batch(spark, late, "x-1", 2024011501, pts, wm)     # older hour, older values, and a user without a kept point
    snap, newest = read_latest_snapshot(spark, wm)
    assert newest == 2024011505
    assert sorted(tuple(r) for r in snap.collect()) == [("a", 5000), ("b", 70)]
    assert read_latest_snapshot(spark, fresh_path(spark, "none")) is None


def test_failed_ingest_releases_its_cache(spark):
    import pytest
    from loadlens.sources.schemas import ESTIMATE_PAYLOAD
    from loadlens.streaming import ingest_batch
    df = spark.createDataFrame([_payload("a", 50, 0, [10, 20])], ESTIMATE_PAYLOAD)
    blocked = fresh_path(spark, "blocked")
    spark.range(3).write.parquet(blocked)      # a table that is no snapshot table
    with pytest.raises(Exception):
        ingest_batch(spark, df, "x", 2024011500, fresh_path(spark, "pts"), blocked)
    assert not df.is_cached
