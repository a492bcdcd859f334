"""Ingest commits and stores with several writers: nothing is lost, doubled or seen half done."""

import json
import threading
import time

import pytest
from conftest import D0

from loadlens import jobs as J
from loadlens.operators import commits as C
from loadlens.operators import store as ST
from loadlens.operators import watermark as WM
from loadlens.session import fresh_path
from loadlens.sources.files import Folder
from loadlens.sources.schemas import ESTIMATE_PAYLOAD
from loadlens.streaming import ingest_batch
from loadlens.streaming import jobs as SJ

HOUR = 2024011500
CELLS = "user_id string, app_type_id string, ymd long, family string, col string, value string, version long"


def payload(user, commit, times, st=0):
    return {"customer": user, "commited_at": commit, "st": st,
            "data": [{"timestamps": times, "main_pwrs": [1.0] * len(times),
                      "app_type": [{"app_id": 1, "apps": [{"id": 77, "pwrs": [20.0] * len(times)}]}]}]}


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ESTIMATE_PAYLOAD)


def points(spark, path):
    return sorted((r.user_id, r.t) for r in C.read_committed(spark, path).select("user_id", "t").collect())


def marks(spark, path):
    got = WM.read_latest_snapshot(spark, path)
    return None if got is None else sorted(tuple(r) for r in got[0].collect())


@pytest.fixture
def paths(spark):
    return fresh_path(spark, "c-pts"), fresh_path(spark, "c-wm"), fresh_path(spark, "c-rec")


def test_two_runs_within_an_hour(spark, paths, tmp_path):
    """Two payload folders landed within an hour: both users' points stay, under fresh run names."""
    pts, wm, _ = paths
    for user in ("a", "b"):
        folder = tmp_path / user
        folder.mkdir()
        (folder / "p.json").write_text(json.dumps(payload(user, 500, [100, 200])) + "\n")
        J.main(["ingest", "--payloads", str(folder), "--points", pts, "--watermark", wm, "--run-hour", str(HOUR)])
    assert points(spark, pts) == [("a", 100), ("a", 200), ("b", 100), ("b", 200)]
    assert marks(spark, wm) == [("a", 500), ("b", 500)]


@pytest.mark.parametrize("stop_at", ["stage_snapshot", "commit"])
def test_run_that_stops_between_its_writes(spark, paths, monkeypatch, stop_at):
    pts, wm, rec = paths
    ingest_batch(spark, frame(spark, payload("a", 500, [100])), "r0", HOUR, pts, wm, rec)

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(SJ, "stage_snapshot", stop) if stop_at == "stage_snapshot" else m.setattr(C.IngestLog, "commit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            ingest_batch(spark, frame(spark, payload("a", 900, [600]), payload("b", 50, [10])), "r1", HOUR, pts, wm, rec)
    # its points and records lie there, and no reader takes them
    assert spark.read.parquet(pts).count() == 3
    assert points(spark, pts) == [("a", 100)] and marks(spark, wm) == [("a", 500)]
    assert C.committed(spark.read.text(f"{rec}/est"), f"{rec}/est").count() == 1
    # run again, whatever its name: everything once
    assert ingest_batch(spark, frame(spark, payload("a", 900, [600]), payload("b", 50, [10])), "r2", HOUR, pts, wm, rec)
    assert points(spark, pts) == [("a", 100), ("a", 600), ("b", 10)]
    assert marks(spark, wm) == [("a", 900), ("b", 50)]
    assert C.remove_abandoned(spark, pts, time.time() - 3600) == []     # too young: its run might be at work
    assert len(C.remove_abandoned(spark, pts, time.time() + 60)) == 1
    assert spark.read.parquet(pts).count() == 3 == len(points(spark, pts))


def test_replayed_and_replaced_runs(spark, paths):
    pts, wm, _ = paths
    assert ingest_batch(spark, frame(spark, payload("a", 500, [100, 200])), "r", HOUR, pts, wm)
    assert not ingest_batch(spark, frame(spark, payload("a", 500, [100, 200])), "r", HOUR, pts, wm)      # a replay
    assert points(spark, pts) == [("a", 100), ("a", 200)]
    assert ingest_batch(spark, frame(spark, payload("a", 400, [100]), payload("b", 9, [5])), "r", HOUR, pts, wm, replace=True)
    assert points(spark, pts) == [("a", 100), ("b", 5)]
    assert marks(spark, wm) == [("a", 500), ("b", 9)]       # a watermark never goes back


def test_runs_that_end_at_once(spark, paths, monkeypatch):
    """Another run commits between this one's reading of the watermark and its commit."""
    pts, wm, _ = paths
    ingest_batch(spark, frame(spark, payload("a", 10, [5])), "r0", HOUR, pts, wm)
    real, calls = SJ.stage_snapshot, []

    def other_first(*args):
        calls.append(1)
        if len(calls) == 1:
            ingest_batch(spark, frame(spark, payload("b", 70, [6])), "other", HOUR + 1, pts, wm)
        return real(*args)

    monkeypatch.setattr(SJ, "stage_snapshot", other_first)
    assert ingest_batch(spark, frame(spark, payload("c", 80, [7])), "mine", HOUR, pts, wm)
    assert len(calls) == 3       # mine, the other's, mine again
    assert marks(spark, wm) == [("a", 10), ("b", 70), ("c", 80)]
    assert points(spark, pts) == [("a", 5), ("b", 6), ("c", 7)]
    log = C.IngestLog(spark, wm)
    assert [c.run for c in log.commits()] == [None, "r0", "other", "mine"] and log.newest().et_hr == HOUR + 1


def test_tables_from_before_the_log(spark, paths):
    """Batches and snapshots that lay there count on; what is staged later counts by commits."""
    pts, wm, _ = paths
    old = spark.createDataFrame([("z", 1, 77, 3, 20.0, 19700101, "2024011423")], "user_id string, app_type_id int, app_id int, t long, power double, partition int, batch string")
    old.write.partitionBy("batch").parquet(pts)
    WM.write_snapshot(spark.createDataFrame([("z", 3)], "user_id string, commited_at long"), wm, HOUR - 77)
    assert points(spark, pts) == [("z", 3)]
    ingest_batch(spark, frame(spark, payload("a", 10, [5])), "r0", HOUR, pts, wm)
    assert points(spark, pts) == [("a", 5), ("z", 3)] and marks(spark, wm) == [("a", 10), ("z", 3)]
    with pytest.raises(ValueError, match="committed with the watermark"):
        ingest_batch(spark, frame(spark, payload("a", 10, [5])), "r1", HOUR, pts, fresh_path(spark, "other-wm"))


def test_points_below_provider_folders(spark, paths):
    base, wm, _ = paths
    for ser in ("1", "2"):
        ingest_batch(spark, frame(spark, payload(f"{ser}_a", 10, [5])), f"r{ser}", HOUR, f"{base}/ser_id={ser}", wm)
    stray = C.read_committed(spark, f"{base}/ser_id=1").withColumn("batch", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x~1"))
    stray.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{base}/ser_id=2")
    got = sorted((r.user_id, r.ser_id) for r in C.read_committed(spark, base).collect())
    assert got == [("1_a", 1), ("2_a", 2)]


def test_marker_is_created_once(spark):
    folder = Folder(spark, fresh_path(spark, "once"))
    assert folder.names() == [] and not folder.exists()
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append((folder.write_new("m/1.json", str(k)), k))) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert folder.read_text("m/1.json") in {str(k) for ok, k in won if ok}
    assert not folder.write_new("m/1.json", "late") and folder.read_text("m/1.json") != "late"


def test_newest_snapshot_opens_no_older_file(spark, tmp_path):
    """Older snapshots are not listed, let alone read: theirs are no parquet files here."""
    for hr in (HOUR - 2, HOUR - 1):
        (tmp_path / f"et_hr={hr}").mkdir()
        (tmp_path / f"et_hr={hr}" / "part-0.parquet").write_text("no parquet")
    WM.write_snapshot(spark.createDataFrame([("z", 3)], "user_id string, commited_at long"), str(tmp_path), HOUR)
    snap, newest = WM.read_latest_snapshot(spark, str(tmp_path))
    assert newest == HOUR and [tuple(r) for r in snap.collect()] == [("z", 3)]
    assert all(f"et_hr={HOUR}" in f for f in snap.inputFiles())


# --- stores

def cells(spark, user, n, version, family="Daily", col="cnt", ymd=1704121200):
    return spark.range(n).selectExpr(f"concat('{user}', id) AS user_id", "'1' AS app_type_id", f"{ymd}L AS ymd", f"'{family}' AS family",
                                     f"'{col}' AS col", f"'{version}' AS value", f"{version}L AS version")


def test_writers_at_once_keep_all_cells(spark):
    """Daily, weekday utilisation and activity own one family: three jobs write one day at the same time."""
    path, failed = fresh_path(spark, "at-once"), []

    def job(col):
        try:
            ST.append_cells(spark, path, cells(spark, "u", 1000, 1, col=col), months=[202401])
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=job, args=(c,)) for c in ("cnt", "00", "la")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    assert {r["col"]: r["count"] for r in ST.stored_cells(spark, path).groupBy("col").count().collect()} == {"cnt": 1000, "00": 1000, "la": 1000}


def test_newest_cell_of_all_runs_and_compaction(spark):
    path = fresh_path(spark, "compact")
    ST.append_cells(spark, path, cells(spark, "u", 5, 3))
    ST.append_cells(spark, path, cells(spark, "u", 9, 2))
    ST.append_cells(spark, path, cells(spark, "u", 9, 2, ymd=1706799600))
    want = sorted(map(tuple, ST.stored_cells(spark, path).collect()))
    assert [r[5] for r in want if r[2] == 1704121200] == ["3"] * 5 + ["2"] * 4
    assert ST.compact_store(spark, path, grace=3600) == 1
    assert sorted(map(tuple, ST.stored_cells(spark, path).collect())) == want      # old and merged runs side by side
    assert spark.read.parquet(path).count() == 5 + 9 + 9 + 9
    ST.append_cells(spark, path, cells(spark, "u", 1, 9))                           # lands while old files wait
    assert ST.compact_store(spark, path, grace=0) == 1
    got = sorted(map(tuple, ST.stored_cells(spark, path).collect()))
    assert got == sorted([r if r[0] != "u0" or r[2] != 1704121200 else (*r[:5], "9", 9, r[7]) for r in want])
    assert spark.read.parquet(path).count() == 18 and not ST.named_superseded(spark, path)
    assert ST.compact_store(spark, path, grace=0) == 0


def test_compaction_that_stops_changes_nothing(spark, monkeypatch):
    path = fresh_path(spark, "stopped")
    ST.append_cells(spark, path, cells(spark, "u", 3, 1))
    ST.append_cells(spark, path, cells(spark, "u", 3, 2))
    want = sorted(map(tuple, ST.stored_cells(spark, path).collect()))
    with monkeypatch.context() as m:
        m.setattr(Folder, "write_new", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            ST.compact_store(spark, path, grace=0)
    assert sorted(map(tuple, ST.stored_cells(spark, path).collect())) == want
    ST.compact_store(spark, path, grace=0)
    assert sorted(map(tuple, ST.stored_cells(spark, path).collect())) == want and spark.read.parquet(path).count() == 3


def test_stores_without_run_folders(spark):
    old, new = fresh_path(spark, "old-store"), fresh_path(spark, "new-store")
    ST.with_month(cells(spark, "u", 3, 1)).write.partitionBy("yyyymm", "family", "ymd").parquet(old)
    with pytest.raises(ValueError, match="convert_store"):
        ST.stored_cells(spark, old)
    ST.convert_store(spark, old, new)
    assert ST.stored_cells(spark, new).count() == 3


def test_history_takes_one_exchange(spark, capsys):
    path, day = fresh_path(spark, "history"), (D0 + 32400) // 86400
    ST.append_cells(spark, path, cells(spark, "u", 3, 1).unionByName(cells(spark, "u", 3, 1, col="dur")))
    h = J.store_daily_history(ST.stored_cells(spark, path), day - 56, day)
    h.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1
    assert "isnotnull(ymd" in plan.split("PartitionFilters")[1] and "yyyymm" in plan.split("PartitionFilters")[1]
    assert sorted(map(tuple, h.collect())) == [(f"u{k}", "1", day, 1, 1) for k in range(3)]
