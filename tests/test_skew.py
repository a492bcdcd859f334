"""A third of all readings on one user: results still equal an independent SQL computation."""

import duckdb
from pyspark.sql import functions as F

from loadlens.functions.time import epoch_seconds
from loadlens.operators import daily as D
from loadlens.operators import sessions as S
from loadlens.operators import weekly as W
from loadlens.settings import Thresholds

SF = "/root/testdata/sf0.01"
HOT = """
WITH r AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id,
         epoch_us(ts) // 1000000 AS t, value AS power
  FROM read_parquet('/root/testdata/sf0.01/events.parquet')
), e AS (SELECT *, (t + 32400) // 86400 AS d FROM r WHERE power > 10
), g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id, d ORDER BY t) <= 600
                        THEN 0 ELSE 1 END AS nw FROM e
), s AS (SELECT *, sum(nw) OVER (PARTITION BY user_id, d ORDER BY t
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g
)
SELECT user_id, d, min(t) AS st, max(t) AS et FROM s GROUP BY user_id, d, sid HAVING max(t) - min(t) > 60
"""


def _hot_readings(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    uid = F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit(-1)).otherwise(F.col("user_id"))
    return e.select(uid.alias("user_id"), F.lit("k").alias("app_type_id"),
                    epoch_seconds(e, "ts").alias("t"), F.col("value").alias("power"))


def test_hot_user_sessions_and_daily(spark):
    th = Thresholds({"k": [10, 60, 600]}).to_df(spark)
    sess = S.sessions(_hot_readings(spark), th)
    got = sorted((r.user_id, r.day_no, r.st, r.et) for r in sess.collect())
    want = sorted(duckdb.sql(HOT).fetchall())
    assert got == want
    assert sum(1 for g in got if g[0] == -1) > len(got) // 10     # the hot user really is hot
    daily = D.daily_metrics(sess)
    by = {}
    for u, d, st, et in want:
        c, du = by.get((u, d), (0, 0))
        by[(u, d)] = (c + 1, du + et - st)
    assert sorted((r.user_id, r.day_no, r.cnt, r.dur) for r in daily.collect()) == \
        sorted((u, d, c, du) for (u, d), (c, du) in by.items())
    wk = {(r.user_id, r.day_no): r.w_cnt for r in W.weekly_totals(daily).collect()}
    for (u, d), _ in list(by.items())[:200]:
        assert wk[(u, d)] == sum(c for (u2, d2), (c, _) in by.items() if u2 == u and d - 6 <= d2 <= d)
