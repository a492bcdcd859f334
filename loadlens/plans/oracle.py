"""Independent DuckDB SQL for every registered query.

Written from the metric definitions (lag-based sessions, correlated range
joins for history) rather than from the Spark plans.  Dates are rendered as
'YYYY-MM-DD' text and doubles rounded to 6 places on both sides.
"""

from __future__ import annotations

import datetime as _dt

from loadlens.plans import fixtures as X

# Readings with epoch seconds and JST day number.
R_ALL = """r AS (
  SELECT user_id, epoch_us(ts) // 1000000 AS t, value AS power FROM events
)"""


def _sessions_cte(src: str, min_power: float, gap: int, min_dur: int, part: str = "user_id, d") -> str:
    return f"""e AS (
  SELECT *, (t + 32400) // 86400 AS d FROM {src} WHERE power > {min_power}
), g AS (
  SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY {part} ORDER BY t) <= {gap}
                 THEN 0 ELSE 1 END AS nw FROM e
), s AS (
  SELECT *, sum(nw) OVER (PARTITION BY {part} ORDER BY t
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g
), sess AS (
  SELECT {part}, min(t) AS st, max(t) AS et FROM s GROUP BY {part}, sid
  HAVING max(t) - min(t) > {min_dur}
)"""


def DAY(col: str = "d") -> str:
    return f"strftime(DATE '1970-01-01' + CAST({col} AS INTEGER), '%Y-%m-%d')"


SESS = "WITH " + R_ALL + ",\n" + _sessions_cte("r", 10, 21600, 300)
DAILY = SESS + """, daily AS (
  SELECT user_id, d, d * 86400 + 54000 AS ymd, count(*) AS cnt, CAST(sum(et - st) AS BIGINT) AS dur
  FROM sess GROUP BY user_id, d
)"""

HIST = DAILY + """, hist AS (
  SELECT a.user_id, a.d, a.cnt, a.dur,
         count(b.cnt) AS n_hist, sum(b.cnt) AS s_cnt, sum(b.cnt * b.cnt) AS q_cnt,
         sum(b.dur) AS s_dur, sum(b.dur * b.dur) AS q_dur,
         avg(b.cnt) AS avg_cnt, stddev_pop(b.cnt) AS sd_cnt,
         avg(b.dur) AS avg_dur, stddev_pop(b.dur) AS sd_dur
  FROM daily a LEFT JOIN daily b
    ON a.user_id = b.user_id AND b.d BETWEEN a.d - 56 AND a.d - 1
  GROUP BY a.user_id, a.d, a.cnt, a.dur
)"""


def _flag(x, s, q, sign):
    d = f"({sign}(n_hist * {x} - {s}))"
    return f"(n_hist > 0 AND {d} > 0 AND {d} * {d} > 9 * (n_hist * {q} - {s} * {s}))"


ORACLE = {
    "daily_metrics": DAILY + f"""
SELECT user_id, {DAY()} AS data_day, ymd, cnt, dur FROM daily""",
    "sessions": SESS + f"""
SELECT user_id, {DAY()} AS data_day, st, et FROM sess""",
    "sessions_native": SESS + f"""
SELECT user_id, {DAY()} AS data_day, st, et FROM sess""",
    "one_tags": SESS + f"""
SELECT user_id, {DAY()} AS data_day, count(*) AS n_tags, min(st) AS first_st, max(et) AS last_et
FROM sess GROUP BY user_id, d""",
    "readings_packed": "WITH " + R_ALL + f"""
SELECT user_id, {DAY('(t + 32400) // 86400')} AS data_day, count(*) AS n,
       min(t) AS first_t, max(t) AS last_t
FROM r WHERE power IS NOT NULL GROUP BY user_id, (t + 32400) // 86400""",
    "daily_baseline": HIST + f"""
SELECT user_id, {DAY()} AS data_day, n_hist,
       round(avg_cnt, 6) AS avg_cnt, round(sd_cnt, 6) AS sd_cnt,
       round(avg_dur, 6) AS avg_dur, round(sd_dur, 6) AS sd_dur FROM hist""",
    "daily_unusual": HIST + f"""
SELECT user_id, {DAY()} AS data_day,
       coalesce({_flag('cnt', 's_cnt', 'q_cnt', '')}, false) AS u_h_cnt,
       coalesce(NOT {_flag('cnt', 's_cnt', 'q_cnt', '')} AND {_flag('cnt', 's_cnt', 'q_cnt', '-')}, false) AS u_l_cnt,
       coalesce({_flag('dur', 's_dur', 'q_dur', '')}, false) AS u_h_dur,
       coalesce(NOT {_flag('dur', 's_dur', 'q_dur', '')} AND {_flag('dur', 's_dur', 'q_dur', '-')}, false) AS u_l_dur
FROM hist""",
    "interval_days": f"""
WITH od AS (
  SELECT DISTINCT o_custkey AS user_id, (epoch_us(o_orderdate) // 1000000 + 32400) // 86400 AS d FROM orders
), lastd AS (
  SELECT a.user_id, a.d, (SELECT max(b.d) FROM od b WHERE b.user_id = a.user_id
                          AND b.d BETWEEN a.d - 56 AND a.d - 1) AS prev
  FROM od a
)
SELECT user_id, {DAY()} AS data_day,
       CAST(CASE WHEN prev IS NULL OR d - prev > 28 THEN -1 ELSE d - prev END AS BIGINT) AS i_day
FROM lastd""",
}


# --- weekly -----------------------------------------------------------------
WEEKLY = DAILY + """, labels AS (
  SELECT DISTINCT user_id, d + k AS L FROM daily, range(7) AS rg(k)
  WHERE d + k <= (SELECT max((t + 32400) // 86400) FROM r)
), wk AS (
  SELECT l.user_id, l.L, CAST(sum(x.cnt) AS BIGINT) AS w_cnt, CAST(sum(x.dur) AS BIGINT) AS w_dur,
         count(*) AS n
  FROM labels l JOIN daily x ON x.user_id = l.user_id AND x.d BETWEEN l.L - 6 AND l.L
  GROUP BY l.user_id, l.L
), tr AS (
  SELECT a.*, b.w_cnt AS c7, b.w_dur AS d7, c.w_cnt AS c14, c.w_dur AS d14,
         e.w_cnt AS c21, e.w_dur AS d21
  FROM wk a
  LEFT JOIN wk b ON b.user_id = a.user_id AND b.L = a.L - 7
  LEFT JOIN wk c ON c.user_id = a.user_id AND c.L = a.L - 14
  LEFT JOIN wk e ON e.user_id = a.user_id AND e.L = a.L - 21
), ma AS (
  SELECT *, CASE WHEN c7 IS NOT NULL AND c14 IS NOT NULL AND c21 IS NOT NULL
                 THEN (w_cnt + c7 + c14 + c21) / 4.0 ELSE 0.0 END AS ma4_cnt,
            CASE WHEN c7 IS NOT NULL AND c14 IS NOT NULL AND c21 IS NOT NULL
                 THEN (w_dur + d7 + d14 + d21) / 4.0 ELSE 0.0 END AS ma4_dur
  FROM tr
)"""

ORACLE.update({
    "weekly_totals": WEEKLY + """
SELECT user_id, L * 86400 + 54000 AS ymd, w_cnt, w_cnt // n AS a_cnt, w_dur, w_dur // n AS a_dur FROM wk""",
    "weekly_wow": WEEKLY + """
SELECT user_id, L * 86400 + 54000 AS ymd,
       CASE WHEN c7 IS NULL THEN 0 ELSE w_cnt - c7 END AS wow_cnt,
       CASE WHEN d7 IS NULL THEN 0 ELSE w_dur - d7 END AS wow_dur FROM tr""",
    "weekly_ma4": WEEKLY + """
SELECT user_id, L * 86400 + 54000 AS ymd, round(ma4_cnt, 6) AS ma4_cnt, round(ma4_dur, 6) AS ma4_dur FROM ma""",
    "weekly_unusual": WEEKLY + """
SELECT user_id, L * 86400 + 54000 AS ymd,
  (ma4_cnt <> 0 AND w_cnt > (ma4_cnt + 1.0) * 1.5) AS u_h_cnt,
  (ma4_cnt <> 0 AND NOT (w_cnt > (ma4_cnt + 1.0) * 1.5) AND w_cnt < (ma4_cnt - 1.0) * 0.5) AS u_l_cnt,
  (ma4_cnt <> 0 AND w_dur > (ma4_dur + 210.0) * 1.5) AS u_h_dur,
  (ma4_cnt <> 0 AND NOT (w_dur > (ma4_dur + 210.0) * 1.5) AND w_dur < (ma4_dur - 210.0) * 0.5) AS u_l_dur
FROM ma""",
})


# --- utilisation ------------------------------------------------------------
def _util_sql(lo_days: int, mode: str) -> str:
    a = X.AS_OF_DAY
    if mode == "weekday":
        rng = f"({a} - d) BETWEEN 0 AND 55 AND ({a} - d) % 7 = 0"
    else:
        rng = f"d > {a - lo_days} AND d <= {a}"
    hours = ",\n  ".join(
        f"round(CASE WHEN {{n}} > 0 THEN {{v{h}}} / {{n}} ELSE {{e}} END, 6) AS h{h:02d}" for h in range(24))
    # one row per user: active days, and per hour the days (or whether any) with a session that starts in it
    per_hour = "count(DISTINCT CASE WHEN h = {h} THEN d END)" if mode == "fraction" else "max(CASE WHEN h = {h} THEN 1 ELSE 0 END)"
    per_user = ", ".join(per_hour.replace("{h}", str(h)) + f" AS v{h}" for h in range(24))
    body = hours.replace("{n}", "8" if mode == "weekday" else "coalesce(n, 0)").replace("{e}", "-1.0" if mode == "short" else "0.0")
    for h in range(24):
        body = body.replace("{v%d}" % h, f"CAST(coalesce(v{h}, 0) AS DOUBLE)")
    return DAILY + f""", st AS (
  SELECT user_id, d, CAST(((st + 32400) // 3600) % 24 AS INTEGER) AS h FROM sess WHERE {rng}
), nn AS (SELECT user_id, count(DISTINCT d) AS n FROM daily WHERE cnt > 0 AND {rng} GROUP BY user_id
), hh AS (SELECT user_id, {per_user} FROM st GROUP BY user_id
), ug AS (SELECT DISTINCT user_id FROM events)
SELECT user_id,
  {body}
FROM ug LEFT JOIN nn USING (user_id) LEFT JOIN hh USING (user_id)"""


ORACLE.update({
    "session_start_hour": SESS + f"""
SELECT user_id, {DAY()} AS data_day, st, CAST(((st + 32400) // 3600) % 24 AS BIGINT) AS h FROM sess""",
    "util_long": _util_sql(28, "long"),
    "util_short": _util_sql(7, "short"),
    "util_long_fraction": _util_sql(28, "fraction"),
    "util_weekday": _util_sql(0, "weekday"),
    "weekday_no": "WITH " + R_ALL + f""", dd AS (SELECT DISTINCT (t + 32400) // 86400 AS d FROM r)
SELECT {DAY()} AS data_day, CAST(isodow(DATE '1970-01-01' + CAST(d AS INTEGER)) - 1 AS BIGINT) AS w_day FROM dd""",
})


# --- profile ----------------------------------------------------------------
R_TYPED = """rt AS (
  SELECT user_id, event_type AS app, epoch_us(ts) // 1000000 AS t, value AS power FROM events
  WHERE event_type IN ('click', 'error', 'purchase', 'signup', 'view') AND value IS NOT NULL
)"""

ORACLE.update({
    "profile_minmax": "WITH " + R_TYPED + f"""
SELECT user_id, app, min(power) AS min_power, max(power) AS max_power FROM rt
WHERE (t + 32400) // 86400 BETWEEN {X.AS_OF_DAY - 13} AND {X.AS_OF_DAY}
GROUP BY user_id, app""",
    "profile_rolling": "WITH " + R_TYPED + f""", rd AS (
  SELECT DISTINCT user_id, app, (t + 32400) // 86400 + k AS d FROM rt, range(14) AS rg(k)
  WHERE (t + 32400) // 86400 + k <= (SELECT max((epoch_us(ts) // 1000000 + 32400) // 86400) FROM events)
)
SELECT rd.user_id, rd.app, {DAY('rd.d')} AS data_day, min(rt.power) AS min_power, max(rt.power) AS max_power
FROM rd JOIN rt ON rt.user_id = rd.user_id AND rt.app = rd.app
  AND (rt.t + 32400) // 86400 BETWEEN rd.d - 13 AND rd.d
GROUP BY rd.user_id, rd.app, rd.d""",
})


# --- late night -------------------------------------------------------------
LN = "WITH " + R_ALL + """, rd AS (SELECT DISTINCT user_id, t, power FROM r),
ln AS (
  SELECT user_id, t, power, ((t + 32400 + 7200) // 86400) * 86400 - 32400 AS ymd FROM rd
), lnr AS (
  SELECT * FROM ln WHERE (user_id = 7 AND t - ymd >= -7200 AND t - ymd < 18000)
                      OR (user_id <> 7 AND t - ymd >= 0 AND t - ymd < 18000)
), le AS (SELECT * FROM lnr WHERE power > 10
), lg AS (
  SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id, ymd ORDER BY t) <= 21600
                 THEN 0 ELSE 1 END AS nw FROM le
), ls AS (
  SELECT *, sum(nw) OVER (PARTITION BY user_id, ymd ORDER BY t
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM lg
), lsess AS (
  SELECT user_id, ymd, min(t) AS st, max(t) AS et FROM ls GROUP BY user_id, ymd, sid
)"""

ORACLE.update({
    "latenight_readings": LN + """
SELECT user_id, ymd, t, power FROM lnr""",
    "latenight_sessions": LN + """
SELECT user_id, ymd, CASE WHEN user_id = 7 THEN st - 7200 ELSE st END AS st, et + 18000 AS et
FROM lsess WHERE et - st > 300""",
    "latenight_tags": LN + """
SELECT user_id, ymd, CAST(count(*) FILTER (WHERE et - st > 300) AS BIGINT) AS n_tags
FROM lsess GROUP BY user_id, ymd""",
})


# --- last activity ----------------------------------------------------------
LA = "WITH " + R_TYPED + """, la AS (
  SELECT user_id, app, (t + 32400) // 86400 AS d, max(CASE WHEN power > 10 THEN t END) AS la
  FROM rt GROUP BY user_id, app, (t + 32400) // 86400
)"""

ORACLE.update({
    "last_activity": LA + f"""
SELECT user_id, app, {DAY()} AS data_day, la FROM la""",
    "last_activity_carry": LA + f"""
SELECT a.user_id, a.app, {DAY('a.d')} AS data_day,
  coalesce((SELECT max(b.la) FROM la b
            WHERE b.user_id = a.user_id AND b.app = a.app AND b.d <= a.d AND b.la IS NOT NULL
              AND (SELECT count(*) FROM la c WHERE c.user_id = a.user_id AND c.app = a.app
                   AND c.d BETWEEN b.d AND a.d) = a.d - b.d + 1), 0) AS la
FROM la a""",
})


# --- registry, readings, pairing ---------------------------------------------
REG = """reg AS (
  SELECT CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR) AS "user",
         CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS is_active FROM customer
), prov AS (
  SELECT "user", regexp_extract("user", '(\\d+)_([a-zA-Z0-9]+)', 1) AS ser_id FROM reg WHERE is_active = 1
), allowed AS (
  SELECT "user", ser_id FROM prov
  WHERE ser_id IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_regionkey = 1)
)"""

GAPPED = """gp AS (
  SELECT user_id, event_type AS app, epoch_us(ts) // 1000000 AS t,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS power FROM events
), g2 AS (SELECT * FROM gp UNION ALL SELECT * FROM gp)"""

PAIR = "WITH " + GAPPED + """, hp AS (
  SELECT user_id, CASE WHEN app = 'click' THEN '300' ELSE '301' END AS app, (t // 3600) * 3600 AS h,
         sum(power) AS power
  FROM (SELECT DISTINCT * FROM gp WHERE app IN ('click', 'view'))
  GROUP BY 1, 2, 3
), a AS (SELECT user_id, h, power FROM hp WHERE app = '300'
), b AS (SELECT user_id, h, power FROM hp WHERE app = '301'
), fused AS (
  SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.h, b.h) AS h,
         a.power AS power_a, b.power AS power_b,
         (CASE WHEN a.power IS NULL THEN 0.0 ELSE a.power END)
         + (CASE WHEN b.power IS NULL THEN 0.0 ELSE b.power END) AS power
  FROM a FULL OUTER JOIN b ON a.user_id = b.user_id AND a.h = b.h
)"""

ORACLE.update({
    "registry_active": "WITH " + REG + """
SELECT "user" FROM reg WHERE is_active = 1""",
    "registry_provider": "WITH " + REG + """
SELECT "user", ser_id FROM allowed""",
    "user_app_grid": "WITH " + REG + """
SELECT "user" AS user_id, app FROM allowed,
  (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) AS v(app)""",
    "readings_range": """
SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000000 AS t FROM events
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'""",
    "readings_union_providers": """
SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000000 AS t,
       CAST(user_id % 3 AS VARCHAR) AS ser_id FROM events""",
    "readings_eligible": "WITH " + GAPPED + """
SELECT user_id, app, t, power FROM g2
WHERE (app IN ('click', 'purchase', 'view')) AND power > 10""",
    "readings_distinct": "WITH " + GAPPED + """
SELECT DISTINCT user_id, app, t, power FROM g2""",
    "readings_nonnull": "WITH " + GAPPED + """
SELECT user_id, app, t, power FROM g2 WHERE power IS NOT NULL""",
    "null_safe_sum": PAIR + """
SELECT user_id, h, round(power_a, 6) AS power_a, round(power_b, 6) AS power_b, round(power, 6) AS power
FROM fused""",
    "pair_fusion": PAIR + """
SELECT user_id, app, h, round(power, 6) AS power FROM hp
UNION ALL
SELECT user_id, '300301' AS app, h, round(power, 6) AS power FROM fused""",
})


# --- ingest windows and watermarks -------------------------------------------
EU = """eu AS (SELECT DISTINCT user_id, CAST(user_id % 3 AS VARCHAR) AS ser_id FROM events
), ep AS (SELECT user_id, epoch_us(ts) // 1000000 AS t, ts FROM events
), old AS (
  SELECT user_id, max(t) + CASE WHEN user_id % 5 = 0 THEN 3456000 ELSE 0 END AS commited_at FROM ep
  WHERE user_id % 3 <> 0 AND ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY user_id
), new AS (
  SELECT user_id, t AS commited_at FROM ep WHERE user_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-16 00:00:00'
)"""


def _chunks(src: str) -> str:
    return f"""RECURSIVE {EU}, w AS ({src}
), c AS (
  SELECT user_id, ser_id, st AS s, et FROM w WHERE et > st
  UNION ALL
  SELECT user_id, ser_id, s + 86340, et FROM c WHERE et - s >= 86340 AND et - (s + 86340) > 0
)"""


CHUNK_OUT = """
SELECT user_id, ser_id, s AS st, CASE WHEN et - s >= 86340 THEN s + 86339 ELSE et END AS et FROM c"""

NOW = X.NOW

ORACLE.update({
    "ingest_chunks": "WITH " + _chunks(
        f"SELECT eu.user_id, eu.ser_id, min(ep.t) AS st, CAST({NOW} AS BIGINT) AS et "
        "FROM eu JOIN ep ON eu.user_id = ep.user_id GROUP BY eu.user_id, eu.ser_id") + CHUNK_OUT,
    "ingest_first_run": "WITH " + _chunks(
        f"SELECT user_id, ser_id, CAST({NOW - 259200} AS BIGINT) AS st, CAST({NOW} AS BIGINT) AS et FROM eu")
    + CHUNK_OUT,
    "ingest_windows": "WITH " + _chunks(
        f"SELECT eu.user_id, eu.ser_id, coalesce(old.commited_at, {NOW - 259200}) AS st, "
        f"CAST({NOW} AS BIGINT) AS et FROM eu LEFT JOIN old ON eu.user_id = old.user_id") + f"""
SELECT user_id, ser_id, s AS st, CASE WHEN et - s >= 86340 THEN s + 86339 ELSE et END AS et FROM c
WHERE et - (SELECT st FROM w WHERE w.user_id = c.user_id) >= 86400
UNION ALL
SELECT user_id, ser_id, st, et FROM w WHERE et - st < 86400""",
    "watermark_latest": "WITH " + EU + """, hist AS (
  SELECT user_id, max(t) AS commited_at,
         CAST(strftime(DATE '1970-01-01' + CAST((t + 32400) // 86400 AS INTEGER), '%Y%m%d') AS INTEGER) * 100 + 23 AS et_hr
  FROM ep GROUP BY user_id, (t + 32400) // 86400
)
SELECT DISTINCT user_id, commited_at FROM hist WHERE et_hr = (SELECT max(et_hr) FROM hist)""",
    "watermark_join": "WITH " + EU + """
SELECT eu.user_id, old.commited_at AS st FROM eu LEFT JOIN old ON eu.user_id = old.user_id""",
    "watermark_merge": "WITH " + EU + """, al AS (SELECT * FROM new UNION ALL SELECT * FROM old)
SELECT user_id, commited_at FROM al a
WHERE commited_at = (SELECT max(b.commited_at) FROM al b WHERE b.user_id = a.user_id)
GROUP BY user_id, commited_at""",
    "watermark_carry": "WITH " + EU + """
SELECT user_id, commited_at FROM old""",
})


# --- payloads ----------------------------------------------------------------
PTS = """pts AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                              WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS BIGINT) AS app_id,
         epoch_us(ts) // 1000000 AS t,
         max(CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 0.0 ELSE value END) AS power
  FROM events GROUP BY 1, 2, 3
)"""


def _dense(window: int) -> str:
    # every (timestamp of the window) x (type present in the window), value or null
    return PTS + f""", pw AS (SELECT *, t // {window} AS w FROM pts
), dense AS (
  SELECT tt.user_id, tt.w, aa.app_id, tt.t, pw.power
  FROM (SELECT DISTINCT user_id, w, t FROM pw) tt
  JOIN (SELECT DISTINCT user_id, w, app_id FROM pw) aa ON aa.user_id = tt.user_id AND aa.w = tt.w
  LEFT JOIN pw ON pw.user_id = tt.user_id AND pw.app_id = aa.app_id AND pw.t = tt.t
)"""


PC, PS = X.PAYLOAD_COMMIT, X.PAYLOAD_ST
EST = "WITH " + _dense(86340) + f""", est AS (
  SELECT user_id, app_id, t, power FROM dense
  WHERE t > {PS} AND t <= {PC} AND (power > 0 OR power IS NULL)
), mainv AS (
  SELECT user_id, t, sum(power) AS main FROM pw GROUP BY user_id, t
), mk AS (
  SELECT m.user_id, m.t FROM mainv m
  WHERE m.t > {PS} AND m.t <= {PC} AND (m.main > 0 OR m.main IS NULL)
    AND EXISTS (SELECT 1 FROM est e WHERE e.user_id = m.user_id AND e.t = m.t)
), ed AS (
  SELECT user_id, CAST(strftime(DATE '1970-01-01' + CAST((t + 32400) // 86400 AS INTEGER), '%Y%m%d') AS BIGINT) AS day,
         count(DISTINCT t) AS n_est FROM est GROUP BY 1, 2
), md AS (
  SELECT user_id, CAST(strftime(DATE '1970-01-01' + CAST((t + 32400) // 86400 AS INTEGER), '%Y%m%d') AS BIGINT) AS day,
         count(*) AS n_main FROM mk GROUP BY 1, 2
)"""

ORACLE.update({
    "payload_flatten": "WITH " + _dense(86340) + f"""
SELECT user_id, app_id AS app_type_id, app_id * 100 + 7 AS app_id, t, round(power, 6) AS power FROM dense
WHERE t > 0 AND t <= {X.NOW} AND (power > 0 OR power IS NULL)""",
    "payload_committed": "WITH " + _dense(86340) + f"""
SELECT user_id, app_id AS app_type_id, app_id * 100 + 7 AS app_id, t, round(power, 6) AS power FROM dense
WHERE t > {PS} AND t <= {PC} AND (power > 0 OR power IS NULL)""",
    "activity_committed": "WITH " + _dense(600) + f"""
SELECT user_id, app_id AS app_type_id, app_id * 100 + 7 AS app_id, t, round(power, 6) AS power FROM dense
WHERE {PC} >= w * 600 AND t <= {PC} AND power > 0""",
    "payload_nest": EST + """
SELECT user_id, app_id AS app_type_id, app_id * 100 + 7 AS app_id, t, round(power, 6) AS power FROM est""",
    "payload_unnest": "WITH " + PTS + """
SELECT user_id, app_id AS app_type_id, app_id * 100 + 7 AS app_id, t, round(power, 6) AS power FROM pts""",
    "payload_by_day": "WITH " + PTS + """
SELECT user_id, CAST(strftime(DATE '1970-01-01' + CAST((t + 32400) // 86400 AS INTEGER), '%Y%m%d') AS BIGINT) AS day,
       count(DISTINCT t) AS n_ts
FROM pts GROUP BY 1, 2""",
    "payload_main": EST + """
SELECT user_id, day, n_main FROM md""",
    "payload_records": EST + """
SELECT coalesce(ed.user_id, md.user_id) AS user_id, coalesce(ed.day, md.day) AS day,
       coalesce(ed.n_est, 0) AS n_est, coalesce(md.n_main, 0) AS n_main
FROM ed FULL OUTER JOIN md ON ed.user_id = md.user_id AND ed.day = md.day""",
})


# --- store, labels, sinks ----------------------------------------------------
CELLS = """cells AS (
  SELECT user_id, event_type AS app, ((epoch_us(ts) // 1000000 + 32400) // 86400) * 86400 + 54000 AS ymd,
         value, event_id AS version FROM events
), newest AS (
  SELECT c.* FROM cells c
  WHERE c.version = (SELECT max(d.version) FROM cells d
                     WHERE d.user_id = c.user_id AND d.app = c.app AND d.ymd = c.ymd)
)"""

ORACLE.update({
    "store_upsert": "WITH " + CELLS + """
SELECT user_id, app, ymd, round(value, 6) AS value, version FROM newest""",
    "store_latest_cell": "WITH " + CELLS + """
SELECT n.user_id, n.app, n.ymd, round(n.value, 6) AS value, n.version FROM newest n
WHERE EXISTS (SELECT 1 FROM cells k WHERE k.value > 100 AND k.user_id = n.user_id
              AND k.app = n.app AND k.ymd = n.ymd)""",
    "store_month_shard": "WITH " + CELLS + """
SELECT user_id, app, ymd, round(value, 6) AS value, version,
       CAST(strftime(make_timestamp(ymd * 1000000), '%Y%m') AS BIGINT) AS yyyymm FROM newest""",
    "row_key": DAILY + """
SELECT user_id, ymd, md5(trim(CAST(user_id AS VARCHAR)) || trim(CAST(ymd AS VARCHAR))) || 'all' AS row_key
FROM daily""",
    "time_labels": """
WITH l AS (SELECT event_id, ((epoch_us(ts) // 1000000 + 32400) // 86400) * 86400 + 54000 AS ymd FROM events)
SELECT event_id, ymd, CAST(strftime(make_timestamp(ymd * 1000000), '%Y%m') AS BIGINT) AS yyyymm,
       CAST(strftime(make_timestamp(ymd * 1000000), '%Y%m%d') AS BIGINT) AS yyyymmdd FROM l""",
    "sink_partition_counts": """
SELECT CAST(user_id % 3 AS VARCHAR) AS ser_id,
       CAST(strftime(DATE '1970-01-01' + CAST((epoch_us(ts) // 1000000 + 32400) // 86400 AS INTEGER), '%Y%m%d') AS BIGINT) AS partition,
       count(*) AS n
FROM events GROUP BY 1, 2""",
    "load_schema_enforced": "WITH " + PTS + """
SELECT user_id, app_id AS app_type_id, app_id * 100 + 7 AS app_id, t, round(power, 6) AS power FROM pts""",
})

ORACLE.update({
    "readings_range_nested": "WITH " + PTS + """
SELECT user_id, app_id AS app_type_id, app_id * 100 + 7 AS app_id, t, round(power, 6) AS power FROM pts
WHERE t >= epoch(TIMESTAMP '2024-01-08 00:00:00') AND t < epoch(TIMESTAMP '2024-01-15 00:00:00')""",
    "watermark_snapshots": ORACLE["watermark_merge"],
    "ingest_commits": "WITH " + _dense(86340) + f"""
SELECT user_id, count(*) AS n_points, CAST({PC} AS BIGINT) AS commited_at FROM dense
WHERE t > {PS} AND t <= {PC} AND (power > 0 OR power IS NULL) GROUP BY user_id""",
    "store_many_writers": ORACLE["store_month_shard"],
})


ORACLE.update({
    "daily_moments": f"SELECT * FROM ({ORACLE['daily_unusual']}) WHERE data_day = '{X.EPOCH + _dt.timedelta(days=X.AS_OF_DAY)}'",
    "readings_reconciled": """
SELECT event_id, user_id, CASE WHEN user_id % 3 <> 2 THEN event_type END AS event_type, value, epoch_us(ts) // 1000000 AS t,
       CAST(user_id % 3 AS VARCHAR) AS ser_id FROM events""",
    "load_quarantine": """
WITH rec AS (SELECT DISTINCT user_id, (epoch_us(ts) // 1000000 + 32400) // 86400 AS d FROM events)
SELECT CASE WHEN user_id % 7 = 0 THEN 'malformed record' WHEN user_id % 5 = 0 THEN 'required field is missing: user_id' ELSE 'accepted' END AS outcome,
       count(*) AS n FROM rec GROUP BY 1""",
})


ORACLE.update({
    "daily_job": HIST + f""", lastd AS (
  SELECT a.user_id, a.d, max(b.d) AS prev
  FROM daily a LEFT JOIN daily b ON a.user_id = b.user_id AND b.d BETWEEN a.d - 56 AND a.d - 1
  GROUP BY a.user_id, a.d
), ntag AS (SELECT user_id, d, count(*) AS n_tags FROM sess GROUP BY user_id, d)
SELECT h.user_id, {DAY('h.d')} AS data_day, h.d * 86400 + 54000 AS ymd, h.cnt, h.dur,
       coalesce({_flag('cnt', 's_cnt', 'q_cnt', '')}, false) AS u_h_cnt,
       coalesce(NOT {_flag('cnt', 's_cnt', 'q_cnt', '')} AND {_flag('cnt', 's_cnt', 'q_cnt', '-')}, false) AS u_l_cnt,
       coalesce({_flag('dur', 's_dur', 'q_dur', '')}, false) AS u_h_dur,
       coalesce(NOT {_flag('dur', 's_dur', 'q_dur', '')} AND {_flag('dur', 's_dur', 'q_dur', '-')}, false) AS u_l_dur,
       CAST(CASE WHEN l.prev IS NULL OR h.d - l.prev > 28 THEN -1 ELSE h.d - l.prev END AS BIGINT) AS i_day,
       t.n_tags
FROM hist h JOIN lastd l ON l.user_id = h.user_id AND l.d = h.d
JOIN ntag t ON t.user_id = h.user_id AND t.d = h.d""",
})


# true pairs: a full outer join of every reading of one type with every reading of the other
TRUE_PAIRS = """pr AS (
  SELECT user_id, CASE WHEN event_type = 'click' THEN '300' ELSE '301' END AS app,
         ((epoch_us(ts) // 1000000) // 7200) * 7200 AS t, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS power
  FROM events WHERE event_type IN ('click', 'view')
), tp AS (
  SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.t, b.t) AS t,
         coalesce(a.power, 0.0) + coalesce(b.power, 0.0) AS power
  FROM (SELECT * FROM pr WHERE app = '300') a FULL OUTER JOIN (SELECT * FROM pr WHERE app = '301') b
    ON a.user_id = b.user_id AND a.t = b.t
)"""

ORACLE.update({
    "pair_minmax": "WITH " + TRUE_PAIRS + """
SELECT user_id, t, round(min(power), 6) AS min_power, round(max(power), 6) AS max_power FROM tp GROUP BY user_id, t""",
    "daily_job_pairs": "WITH " + TRUE_PAIRS + """, al AS (
  SELECT user_id, app, t, power FROM pr UNION ALL SELECT user_id, '300301', t, power FROM tp
),
""" + _sessions_cte("al", 10, 21600, 0, "user_id, app, d") + f"""
SELECT user_id, app, {DAY()} AS data_day, count(*) AS cnt, CAST(sum(et - st) AS BIGINT) AS dur
FROM sess GROUP BY user_id, app, d""",
    "util_registry": _util_sql(28, "long").replace(
        "ug AS (SELECT DISTINCT user_id FROM events)", "ug AS (SELECT c_custkey AS user_id FROM customer WHERE c_acctbal > 0)"),
    "activity_slots": "WITH " + _dense(600) + f"""
SELECT user_id, app_id AS app_type_id, w * 600 AS st, max(CASE WHEN power > 20 THEN t END) AS la FROM dense
WHERE {PC} >= w * 600 AND t <= {PC} AND power > 0 GROUP BY user_id, app_id, w""",
})


# the same results, read from the bucketed history
ORACLE.update({"weekly_history": ORACLE["weekly_unusual"], "util_history": ORACLE["util_long"]})
