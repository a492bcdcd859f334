"""Keyed state and chained steps give the batch results, late rows included; the streaming jobs have command-line entries."""

import random

from conftest import D0, D0_DAY, readings
from pyspark.sql import functions as F

from loadlens import jobs as J
from loadlens.operators import activity as A
from loadlens.operators import sessions as S
from loadlens.operators import store as ST
from loadlens.session import fresh_path
from loadlens.settings import Thresholds
from loadlens.streaming import jobs as SJ

SCHEMA = "user_id string, app_type_id string, t long, power double"
DAY = 86400


def stream_of(spark, parts):
    """A file per part, taken one by one in this order."""
    path = fresh_path(spark, "state-src")
    for rows in parts:
        readings(spark, rows).coalesce(1).write.mode("append").parquet(path)
    return path, spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_carry_equals_batch_with_late_rows(spark):
    r = random.Random(4)
    rows = []
    for user in "abcd":
        for d in sorted(r.sample(range(9), 6)):
            for _ in range(r.randint(1, 4)):
                rows.append((user, r.choice(["25", "30"]), D0 + d * DAY + r.randrange(DAY), r.choice([0.5, 2000.0])))
    rows.sort(key=lambda x: x[2])
    late = rows[5::7]           # lands after later days did: within the delay
    on_time = [x for x in rows if x not in late]
    third = len(on_time) // 3
    parts = [on_time[:third], on_time[third:2 * third] + late[:2], on_time[2 * third:], late[2:]]
    th = Thresholds().to_df(spark)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        path, source = stream_of(spark, parts)
        store = fresh_path(spark, "carry-store")
        SJ.activity_store_stream(source, th, store, fresh_path(spark, "ck"), available_now=True, delay="20 days").awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = sorted((x.user_id, x.app_type_id, (x.ymd - 54000) // DAY, int(x.value)) for x in ST.stored_cells(spark, store).collect())
    want = sorted(tuple(x) for x in A.last_activity_carry(A.last_activity(readings(spark, rows), th)).select("user_id", "app_type_id", "day_no", "la").collect())
    assert got == want and any(x[3] == 0 for x in got) and any(0 < x[3] < (x[2] * DAY - 32400) for x in got)


class Days(dict):
    """A map state in memory."""

    def iterator(self):
        return iter(list(self.items()))

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    def __init__(self):
        self.timers = []

    def getMapState(self, *args):
        return Days()

    def registerTimer(self, at):
        self.timers.append(at)


def step(p, *rows):
    import pandas as pd
    out = list(p.handleInputRows(("u", "25"), iter([pd.DataFrame(rows, columns=["day_no", "own"])]), None))
    return [tuple(x) for f in out for x in f[["day_no", "la"]].itertuples(index=False)]


def test_carry_state_step_by_step():
    p = SJ.CarryProcessor()
    handle = Handle()
    p.init(handle)
    assert step(p, (10, -1)) == [(10, 0)]                        # a reading, none eligible, no day before
    assert step(p, (11, 500), (11, 400)) == [(11, 500)]
    assert step(p, (12, -1), (13, -1)) == [(12, 500), (13, 500)]      # filled from the day before
    assert step(p, (13, -1)) == []                               # nothing changed, nothing given
    assert step(p, (10, 90)) == [(10, 90)]                       # late: day 11 has its own value
    assert step(p, (11, 700)) == [(11, 700), (12, 700), (13, 700)]    # late: days filled from it follow
    assert step(p, (15, -1)) == [(15, 0)]                        # a day without readings ends the carry
    assert step(p, (14, -1)) == [(14, 700), (15, 700)]           # until a late reading joins the days
    assert sorted(handle.timers) == [(d + 2) * DAY * 1000 - 32_400_000 for d in (10, 11, 12, 13, 14, 15)]

    class Info:
        def getExpiryTimeInMs(self):
            return (12 + 2) * DAY * 1000 - 32_400_000

    assert list(p.handleExpiredTimer(("u", "25"), None, Info())) == [] and sorted(k[0] for k in p.days) == [13, 14, 15]


def test_sessions_in_two_steps(spark, capsys):
    """Raw rows of a key are combined before they are exchanged; only rows per second reach the session window."""
    rows = [("hot", "25", D0 + k % 900, 2000.0 + k) for k in range(4000)] + [("hot", "25", D0 + 40_000 + 30 * k, 2000.0) for k in range(40)]
    th = Thresholds().to_df(spark)
    path, source = stream_of(spark, [rows[::2], rows[1::2], [("zz", "25", D0 + 40 * DAY, 2000.0)]])
    out = fresh_path(spark, "sessions-out")
    q = SJ.sessions_store_stream(source, th, out, fresh_path(spark, "ck"), available_now=True)
    q.awaitTermination()
    q.explain()
    plan = capsys.readouterr().out
    assert plan.count("StateStoreSave") >= 1 and "SessionWindowStateStoreSave" in plan
    at = plan.rfind("Scan parquet") if "Scan parquet" in plan else plan.rfind("FileScan")
    first = plan[:at].rfind("Exchange hashpartitioning")
    assert "partial_min(t" in plan[first:at]           # map-side, below the first exchange
    got = sorted(tuple(x) for x in spark.read.parquet(out).filter("user_id <> 'zz'").collect())
    want = sorted(tuple(x) for x in S.sessions(readings(spark, rows), th).collect())
    assert got == want and len(got) > 0


def test_streams_from_the_command_line(spark):
    rows = [("a", "25", D0 + 60 * k, 2000.0) for k in range(50)] + [("zz", "25", D0 + 40 * DAY, 2000.0)]
    src, store, out = fresh_path(spark, "cli-src"), fresh_path(spark, "cli-store"), fresh_path(spark, "cli-out")
    readings(spark, rows).write.parquet(src)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        J.main(["stream-activity", "--readings", src, "--store", store, "--checkpoint", fresh_path(spark, "ck"), "--available-now"])
        J.main(["stream-sessions", "--readings", src, "--out", out, "--checkpoint", fresh_path(spark, "ck"), "--available-now"])
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    assert {(r.user_id, int(r.value)) for r in ST.stored_cells(spark, store).collect()} == {("a", D0 + 60 * 49), ("zz", D0 + 40 * DAY)}
    assert [(r.user_id, r.day_no, r.st, r.et) for r in spark.read.parquet(out).collect()] == [("a", D0_DAY, D0, D0 + 60 * 49)]
