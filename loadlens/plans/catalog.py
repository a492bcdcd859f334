"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the whole landed tables (no id subsets or row caps) and
aliases its outputs to the names used by the SQL oracle.
"""

from __future__ import annotations

import datetime as dt
import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.power import power_kept
from loadlens.functions.time import (day_no, day_to_label, epoch_seconds, jst_hour, label_of_t,
                                     weekday_no, yyyymm, yyyymmdd)
from loadlens.operators import activity as A
from loadlens.operators import daily as D
from loadlens.operators import history as H
from loadlens.operators import ingest as I
from loadlens.operators import latenight as L
from loadlens.operators import payload as PL
from loadlens.operators import pairing as PR
from loadlens.operators import profile as P
from loadlens.operators import registry as G
from loadlens.operators import sessions as S
from loadlens.operators import sinks as SK
from loadlens.operators import store as ST
from loadlens.operators import utilization as U
from loadlens.operators import watermark as WM
from loadlens.operators import weekly as W
from loadlens import jobs as J
from loadlens.operators.commits import read_committed
from loadlens.plans import fixtures as X
from loadlens.plans import payload_input as PI
from loadlens.session import fresh_path
from loadlens.settings import special_users_df
from loadlens.sources.payloads import read_nested_range
from loadlens.sources.readings import read_differing_providers, read_provider_tables, readings_from_events, readings_in_range, readings_of_days
from loadlens.sources.registry import registry_from_customer
from loadlens.sources.schemas import NESTED_ESTIMATE, NESTED_MAIN
from loadlens.sources.tables import load_table
from loadlens.streaming.jobs import ingest_batch


def _day_str(col="day_no"):
    return F.date_format(F.date_from_unix_date(F.col(col).cast("int")), "yyyy-MM-dd")


def _r6(col):
    return F.round(F.col(col), 6)


def events(spark, sf):
    return load_table(spark, sf, "events")


def readings_all(spark, sf):
    return readings_from_events(events(spark, sf), app=X.DEF_APP)


def newest_day(spark, sf):
    """Newest data day of the readings: labels end there."""
    e = events(spark, sf)
    return e.agg(F.max(day_no(epoch_seconds(e, "ts")))).first()[0]


def recent_sessions(spark, sf, days):
    """Sessions of the ``days`` up to the as-of day; the time range reaches the scan."""
    e = readings_of_days(events(spark, sf), X.AS_OF_DAY - days + 1, X.AS_OF_DAY)
    return S.sessions(readings_from_events(e, app=X.DEF_APP), X.DEF.to_df(spark))


def def_sessions(spark, sf):
    return S.sessions(readings_all(spark, sf), X.DEF.to_df(spark))


def def_daily(spark, sf):
    return D.daily_metrics(def_sessions(spark, sf))


# --- daily family -----------------------------------------------------------

def q_daily_metrics(spark, sf):
    return def_daily(spark, sf).select(
        "user_id", _day_str().alias("data_day"), "ymd", "cnt", "dur")


def q_sessions(spark, sf):
    return def_sessions(spark, sf).select("user_id", _day_str().alias("data_day"), "st", "et")


def q_sessions_native(spark, sf):
    s = S.sessions_native(readings_all(spark, sf), X.DEF.to_df(spark))
    return s.select("user_id", _day_str().alias("data_day"), "st", "et")


def q_one_tags(spark, sf):
    t = S.one_tags(def_sessions(spark, sf))
    return t.select("user_id", _day_str().alias("data_day"),
                    F.size("tags").cast("long").alias("n_tags"),
                    F.col("tags")[0]["st"].alias("first_st"),
                    F.element_at("tags", -1)["et"].alias("last_et"))


def q_readings_packed(spark, sf):
    r = readings_all(spark, sf).filter(F.col("power").isNotNull()).withColumn("day_no", day_no("t"))
    packed = S.pack_readings(r, ["user_id", "day_no"])
    return (packed.groupBy("user_id", "day_no")
            .agg(F.sum(F.aggregate("ts_power", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])).alias("n"),
                 F.min(F.col("ts_power")[0]["t"]).alias("first_t"),
                 F.max(F.element_at("ts_power", -1)["t"]).alias("last_t"))
            .select("user_id", _day_str().alias("data_day"), "n", "first_t", "last_t"))


def q_daily_baseline(spark, sf):
    b = D.daily_baseline(def_daily(spark, sf))
    return b.select("user_id", _day_str().alias("data_day"), "n_hist",
                    _r6("avg_cnt").alias("avg_cnt"), _r6("sd_cnt").alias("sd_cnt"),
                    _r6("avg_dur").alias("avg_dur"), _r6("sd_dur").alias("sd_dur"))


def q_daily_unusual(spark, sf):
    u = D.daily_unusual(D.daily_baseline(def_daily(spark, sf)))
    return u.select("user_id", _day_str().alias("data_day"),
                    "u_h_cnt", "u_l_cnt", "u_h_dur", "u_l_dur")


def q_daily_moments(spark, sf):
    """The as-of day's flags from moments that were summed up 20 days earlier and rolled on since."""
    d = def_daily(spark, sf)
    day, first = X.AS_OF_DAY, X.AS_OF_DAY - 20
    days = F.col("day_no")
    state = D.roll_moments(D.moments_of(d, first), d.filter((days >= first) & (days < day)),
                           d.filter((days >= first - D.HISTORY_DAYS) & (days < day - D.HISTORY_DAYS)), day)
    u = D.daily_from_moments(d.filter(days == day), state)
    return u.select("user_id", _day_str().alias("data_day"), "u_h_cnt", "u_l_cnt", "u_h_dur", "u_l_dur")


def order_days(spark, sf):
    o = load_table(spark, sf, "orders")
    return (o.select(F.col("o_custkey").alias("user_id"),
                     day_no(epoch_seconds(o, "o_orderdate")).alias("day_no"))
            .distinct())


def q_interval_days(spark, sf):
    i = D.interval_days(order_days(spark, sf))
    return i.select("user_id", _day_str().alias("data_day"), "i_day")


QUERIES = {
    "daily_metrics": q_daily_metrics,
    "sessions": q_sessions,
    "sessions_native": q_sessions_native,
    "one_tags": q_one_tags,
    "readings_packed": q_readings_packed,
    "daily_baseline": q_daily_baseline,
    "daily_unusual": q_daily_unusual,
    "daily_moments": q_daily_moments,
    "interval_days": q_interval_days,
}


# --- weekly -----------------------------------------------------------------


def def_weekly(spark, sf):
    return W.weekly_trends(W.weekly_totals(def_daily(spark, sf), last_day=newest_day(spark, sf)))


def q_weekly_totals(spark, sf):
    w = W.weekly_totals(def_daily(spark, sf), last_day=newest_day(spark, sf))
    return w.select("user_id", "ymd", "w_cnt", "a_cnt", "w_dur", "a_dur")


def q_weekly_wow(spark, sf):
    return def_weekly(spark, sf).select("user_id", "ymd", "wow_cnt", "wow_dur")


def q_weekly_ma4(spark, sf):
    return def_weekly(spark, sf).select("user_id", "ymd", _r6("ma4_cnt").alias("ma4_cnt"),
                                        _r6("ma4_dur").alias("ma4_dur"))


def q_weekly_unusual(spark, sf):
    u = W.weekly_unusual(def_weekly(spark, sf))
    return u.select("user_id", "ymd", "u_h_cnt", "u_l_cnt", "u_h_dur", "u_l_dur")


# --- utilisation ------------------------------------------------------------

def user_grid(spark, sf):
    """Every user of the readings, with the catalogue's single type."""
    return (events(spark, sf).select("user_id").distinct()
            .withColumn("app_type_id", F.lit(X.DEF_APP)))


def _hours_out(df, prefix, nan_as=None):
    cols = []
    for h in range(24):
        c = F.col(f"{prefix}{h:02d}")
        if nan_as is not None:
            c = F.when(F.isnan(c), F.lit(nan_as)).otherwise(c)
        cols.append(F.round(c, 6).alias(f"h{h:02d}"))
    return df.select("user_id", *cols)


def q_session_start_hour(spark, sf):
    s = def_sessions(spark, sf)
    return s.select("user_id", _day_str().alias("data_day"), "st", jst_hour("st").cast("long").alias("h"))


def q_util_long(spark, sf):
    u = U.utilization_long(recent_sessions(spark, sf, 28), user_grid(spark, sf), X.AS_OF_DAY)
    return _hours_out(u, "l")


def q_util_short(spark, sf):
    u = U.utilization_short(recent_sessions(spark, sf, 7), user_grid(spark, sf), X.AS_OF_DAY)
    return _hours_out(u, "s", nan_as=-1.0)


def q_util_long_fraction(spark, sf):
    u = U.utilization_long_fraction(recent_sessions(spark, sf, 28), user_grid(spark, sf), X.AS_OF_DAY)
    return _hours_out(u, "l")


def q_util_weekday(spark, sf):
    u = U.utilization_weekday(recent_sessions(spark, sf, 56), user_grid(spark, sf), X.AS_OF_DAY)
    return _hours_out(u, "")


def q_weekday_no(spark, sf):
    d = readings_all(spark, sf).select(day_no("t").alias("day_no")).distinct()
    return d.select(_day_str().alias("data_day"),
                    weekday_no(F.date_from_unix_date(F.col("day_no").cast("int"))).cast("long").alias("w_day"))


# --- profile ----------------------------------------------------------------

def typed_readings(spark, sf):
    return readings_from_events(events(spark, sf))


def q_profile_minmax(spark, sf):
    days = readings_of_days(events(spark, sf), X.AS_OF_DAY - 13, X.AS_OF_DAY)
    r = P.profile_readings(readings_from_events(days), X.ALL_TYPE_THRESHOLDS.to_df(spark))
    p = P.profile_minmax(r, X.AS_OF_DAY)
    return p.select("user_id", F.col("app_type_id").alias("app"), "min_power", "max_power")


def q_profile_rolling(spark, sf):
    r = P.profile_readings(typed_readings(spark, sf), X.ALL_TYPE_THRESHOLDS.to_df(spark))
    p = P.profile_rolling(r, last_day=newest_day(spark, sf))
    return p.select("user_id", F.col("app_type_id").alias("app"), _day_str().alias("data_day"),
                    "min_power", "max_power")


# --- late night -------------------------------------------------------------

def ln_readings(spark, sf, distinct=True):
    # duplicates never change sessions (bucket min/max), so sessions skip the distinct shuffle
    r = readings_all(spark, sf)
    r = r.distinct() if distinct else r
    return L.latenight_readings(r, special_users_df(spark, X.LATENIGHT_SPECIAL))


def ln_sessions(spark, sf):
    return L.latenight_sessions(ln_readings(spark, sf, distinct=False), X.DEF.to_df(spark),
                                special_users_df(spark, X.LATENIGHT_SPECIAL))


def q_latenight_readings(spark, sf):
    return ln_readings(spark, sf).select("user_id", "ymd", "t", "power")


def q_latenight_sessions(spark, sf):
    return ln_sessions(spark, sf).filter("kept").select("user_id", "ymd", "st", "et")


def q_latenight_tags(spark, sf):
    t = L.latenight_tags(ln_sessions(spark, sf))
    return t.select("user_id", "ymd", F.size("tags").cast("long").alias("n_tags"))


# --- last activity ----------------------------------------------------------

def q_last_activity(spark, sf):
    la = A.last_activity(typed_readings(spark, sf), X.ALL_TYPE_THRESHOLDS.to_df(spark))
    return la.select("user_id", F.col("app_type_id").alias("app"), _day_str().alias("data_day"), "la")


def q_last_activity_carry(spark, sf):
    la = A.last_activity(typed_readings(spark, sf), X.ALL_TYPE_THRESHOLDS.to_df(spark))
    c = A.last_activity_carry(la)
    return c.select("user_id", F.col("app_type_id").alias("app"), _day_str().alias("data_day"), "la")


QUERIES.update({
    "weekly_totals": q_weekly_totals,
    "weekly_wow": q_weekly_wow,
    "weekly_ma4": q_weekly_ma4,
    "weekly_unusual": q_weekly_unusual,
    "session_start_hour": q_session_start_hour,
    "util_long": q_util_long,
    "util_short": q_util_short,
    "util_long_fraction": q_util_long_fraction,
    "util_weekday": q_util_weekday,
    "weekday_no": q_weekday_no,
    "profile_minmax": q_profile_minmax,
    "profile_rolling": q_profile_rolling,
    "latenight_readings": q_latenight_readings,
    "latenight_sessions": q_latenight_sessions,
    "latenight_tags": q_latenight_tags,
    "last_activity": q_last_activity,
    "last_activity_carry": q_last_activity_carry,
})


# --- registry, readings, pairing ---------------------------------------------


def registry(spark, sf):
    return registry_from_customer(load_table(spark, sf, "customer"))


def allowed_providers(spark, sf):
    n = load_table(spark, sf, "nation")
    return n.filter(F.col("n_regionkey") == X.ALLOW_REGION).select(
        F.col("n_nationkey").cast("string").alias("ser_id"))


def q_registry_active(spark, sf):
    return G.active_users(registry(spark, sf))


def q_registry_provider(spark, sf):
    return G.users_with_provider(registry(spark, sf), allowed_providers(spark, sf)).select("user", "ser_id")


def q_user_app_grid(spark, sf):
    users = G.users_with_provider(registry(spark, sf), allowed_providers(spark, sf))
    return G.user_app_grid(users, list(X.EVENT_TYPES)).select(
        "user_id", F.col("app_type_id").alias("app"))


def _event_cols(df):
    return df.select("event_id", "user_id", "event_type", "value", epoch_seconds(df, "ts").alias("t"))


def q_readings_range(spark, sf):
    e = readings_in_range(events(spark, sf), "ts", X.RANGE_START, X.RANGE_END)
    return _event_cols(e)


def q_readings_union_providers(spark, sf):
    """The providers' tables, landed as ser_id= folders and read as their union in one scan."""
    path = fresh_path(spark, "providers")
    e = events(spark, sf).withColumn("ser_id", F.pmod(F.col("user_id"), F.lit(3)).cast("string"))
    e.hint("rebalance", "ser_id").write.partitionBy("ser_id").parquet(path)
    u = read_provider_tables(spark, path)
    return u.select("event_id", "user_id", "event_type", "value",
                    epoch_seconds(u, "ts").alias("t"), "ser_id")


def q_readings_reconciled(spark, sf):
    """Three providers' tables that differ in columns, types, names and order, read as one declared schema."""
    e = events(spark, sf)
    tables = {
        "0": e,
        "1": e.select(F.col("value").cast("string").alias("value"), "ts", "event_type", F.col("user_id").cast("string").alias("USER_ID"),
                      F.col("event_id").cast("decimal(20,0)").alias("event_id"), F.lit(1).alias("extra")),
        "2": e.select(F.col("user_id").cast("int").alias("customer"), "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value"),
    }
    folders = {}
    for p, t in tables.items():
        user = "customer" if p == "2" else "user_id"
        folders[p] = fresh_path(spark, f"provider-{p}")
        t.filter(F.pmod(F.col(user).cast("long"), F.lit(3)) == int(p)).write.parquet(folders[p])
    schema = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("user_id", T.LongType(), False),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("ts", T.TimestampNTZType())])
    u = read_differing_providers(spark, folders, schema, {"2": {"user_id": "customer"}})
    return u.select("event_id", "user_id", "event_type", "value", epoch_seconds(u, "ts").alias("t"), "ser_id")


def gapped_readings(spark, sf):
    """Typed readings with power nulled on every 7th event, each row twice."""
    e = events(spark, sf)
    e = e.withColumn("value", F.when(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit(None))
                     .otherwise(F.col("value")))
    r = readings_from_events(e)
    return r.unionByName(r)


def _rcols(df):
    return df.select("user_id", F.col("app_type_id").alias("app"), "t", "power")


def q_readings_eligible(spark, sf):
    return _rcols(S.eligible_readings(gapped_readings(spark, sf), X.TYPE_THRESHOLDS.to_df(spark)))


def q_readings_distinct(spark, sf):
    return _rcols(gapped_readings(spark, sf).distinct())


def q_readings_nonnull(spark, sf):
    return _rcols(gapped_readings(spark, sf).filter(power_kept("power")))


def hourly_pair_input(spark, sf):
    """click -> '300', view -> '301', summed per (user, hour) with gaps kept null."""
    r = gapped_readings(spark, sf).filter(F.col("app_type_id").isin("click", "view")).distinct()
    r = r.withColumn("app_type_id", F.when(F.col("app_type_id") == "click", "300").otherwise("301"))
    return (r.withColumn("t", F.floor(F.col("t") / 3600) * 3600)
            .groupBy("user_id", "app_type_id", "t").agg(F.sum("power").alias("power")))


def q_null_safe_sum(spark, sf):
    p = PR.pair_fusion(hourly_pair_input(spark, sf))
    return p.select("user_id", F.col("t").alias("h"), _r6("power_a").alias("power_a"),
                    _r6("power_b").alias("power_b"), _r6("power").alias("power"))


def q_pair_fusion(spark, sf):
    p = PR.with_pair(hourly_pair_input(spark, sf))
    return p.select("user_id", F.col("app_type_id").alias("app"), F.col("t").alias("h"),
                    _r6("power").alias("power"))


# --- ingest windows and watermarks -------------------------------------------

def event_users(spark, sf):
    e = events(spark, sf)
    return e.select("user_id").distinct().withColumn(
        "ser_id", F.pmod(F.col("user_id"), F.lit(3)).cast("string"))


def _epoch_events(spark, sf):
    e = events(spark, sf)
    return e.select("user_id", epoch_seconds(e, "ts").alias("t"), "ts")


def wm_old(spark, sf):
    e = _epoch_events(spark, sf)
    e = e.filter((F.pmod(F.col("user_id"), F.lit(3)) != 0) & (F.col("ts") < F.lit(X.WM_CUT).cast("timestamp_ntz")))
    # every fifth user's stored watermark lies past anything that lands later: it must not go back
    ahead = F.when(F.pmod(F.col("user_id"), F.lit(5)) == 0, F.lit(X.WM_AHEAD)).otherwise(F.lit(0))
    return e.groupBy("user_id").agg((F.max("t") + F.max(ahead)).alias("commited_at"))


def wm_new(spark, sf, start=X.WM_CUT):
    e = _epoch_events(spark, sf)
    e = e.filter((F.pmod(F.col("user_id"), F.lit(2)) == 0) & (F.col("ts") >= F.lit(start).cast("timestamp_ntz")))
    return e.select("user_id", F.col("t").alias("commited_at"))


def q_ingest_chunks(spark, sf):
    e = _epoch_events(spark, sf)
    first = e.groupBy("user_id").agg(F.min("t").alias("st"))
    w = first.join(event_users(spark, sf), "user_id").withColumn("et", F.lit(X.NOW).cast("long"))
    return I.chunk_windows(w).select("user_id", "ser_id", "st", "et")


def q_ingest_first_run(spark, sf):
    return I.first_run_windows(event_users(spark, sf), X.NOW).select("user_id", "ser_id", "st", "et")


def q_ingest_windows(spark, sf):
    return I.ingest_windows(event_users(spark, sf), wm_old(spark, sf), X.NOW).select(
        "user_id", "ser_id", "st", "et")


def wm_history(spark, sf):
    """Daily snapshots: per user and day the day's last epoch, et_hr = yyyymmdd23."""
    e = _epoch_events(spark, sf).withColumn("day_no", day_no("t"))
    return (e.groupBy("user_id", "day_no").agg(F.max("t").alias("commited_at"))
            .withColumn("et_hr", (yyyymmdd(day_to_label("day_no")) * 100 + 23).cast("int")))


def q_watermark_latest(spark, sf):
    return WM.latest_snapshot(wm_history(spark, sf))


def q_watermark_join(spark, sf):
    j = event_users(spark, sf).join(wm_old(spark, sf), "user_id", "left")
    return j.select("user_id", F.col("commited_at").alias("st"))


def q_watermark_merge(spark, sf):
    return WM.merge_watermarks(wm_new(spark, sf), wm_old(spark, sf))


def q_watermark_carry(spark, sf):
    # new side: events at or after "now" -- none exist, so the old snapshot carries over
    now_text = datetime.fromtimestamp(X.NOW, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return WM.merge_watermarks(wm_new(spark, sf, now_text), wm_old(spark, sf))


QUERIES.update({
    "registry_active": q_registry_active,
    "registry_provider": q_registry_provider,
    "user_app_grid": q_user_app_grid,
    "readings_range": q_readings_range,
    "readings_union_providers": q_readings_union_providers,
    "readings_reconciled": q_readings_reconciled,
    "readings_eligible": q_readings_eligible,
    "readings_distinct": q_readings_distinct,
    "readings_nonnull": q_readings_nonnull,
    "null_safe_sum": q_null_safe_sum,
    "pair_fusion": q_pair_fusion,
    "ingest_chunks": q_ingest_chunks,
    "ingest_first_run": q_ingest_first_run,
    "ingest_windows": q_ingest_windows,
    "watermark_latest": q_watermark_latest,
    "watermark_join": q_watermark_join,
    "watermark_merge": q_watermark_merge,
    "watermark_carry": q_watermark_carry,
})


# --- payloads ----------------------------------------------------------------


def _pcols(df):
    return df.select("user_id", F.col("app_type_id").cast("long").alias("app_type_id"),
                     F.col("app_id").cast("long").alias("app_id"), "t", _r6("power").alias("power"))


def all_payloads(spark, sf):
    return PI.estimate_payloads(PI.payload_points(events(spark, sf)), X.NOW, 0)


def committed_payloads(spark, sf):
    return PI.estimate_payloads(PI.payload_points(events(spark, sf)), X.PAYLOAD_COMMIT, X.PAYLOAD_ST)


def q_payload_flatten(spark, sf):
    return _pcols(PL.flatten_estimates(all_payloads(spark, sf)))


def q_payload_committed(spark, sf):
    return _pcols(PL.flatten_estimates(committed_payloads(spark, sf)))


def q_activity_committed(spark, sf):
    p = PI.activity_payloads(PI.payload_points(events(spark, sf)), X.PAYLOAD_COMMIT)
    return _pcols(PL.flatten_activity(p))


def q_payload_nest(spark, sf):
    nested = PL.nest_estimates(PL.flatten_estimates(committed_payloads(spark, sf)))
    text = nested.select(F.to_json(F.struct("user_id", "data")).alias("json"))
    back = text.select(F.from_json("json", NESTED_ESTIMATE).alias("r")).select("r.*")
    return _pcols(PL.unnest_estimates(back))


def q_payload_unnest(spark, sf):
    pts = PI.payload_points(events(spark, sf))
    nested = PL.nest_estimates(pts)
    text = nested.select(F.to_json(F.struct("user_id", "data")).alias("json"))
    back = text.select(F.from_json("json", NESTED_ESTIMATE).alias("r")).select("r.*")
    return _pcols(PL.unnest_estimates(back))


def q_payload_by_day(spark, sf):
    p = all_payloads(spark, sf)
    ts = p.select(F.col("customer").alias("user_id"),
                  F.explode(F.element_at("data", 1)["timestamps"]).alias("t"))
    return (PL.with_partition(ts).groupBy("user_id", "partition")
            .agg(F.count(F.lit(1)).alias("n_ts"))
            .select("user_id", F.col("partition").cast("long").alias("day"), "n_ts"))


def q_payload_main(spark, sf):
    m = PL.nest_main(PL.flatten_main(committed_payloads(spark, sf)))
    return m.select("user_id", F.col("partition").cast("long").alias("day"),
                    F.size("data").cast("long").alias("n_main"))


def q_payload_records(spark, sf):
    rec = PL.payload_records(committed_payloads(spark, sf))
    est = F.from_json("est_json", NESTED_ESTIMATE)
    mai = F.from_json("main_json", NESTED_MAIN)
    return rec.select("user_id", F.col("partition").cast("long").alias("day"),
                      F.coalesce(F.size(est["data"]), F.lit(0)).cast("long").alias("n_est"),
                      F.coalesce(F.size(mai["data"]), F.lit(0)).cast("long").alias("n_main"))


QUERIES.update({
    "payload_flatten": q_payload_flatten,
    "payload_committed": q_payload_committed,
    "activity_committed": q_activity_committed,
    "payload_nest": q_payload_nest,
    "payload_unnest": q_payload_unnest,
    "payload_by_day": q_payload_by_day,
    "payload_main": q_payload_main,
    "payload_records": q_payload_records,
})


# --- store, labels, sinks ----------------------------------------------------


def event_cells(spark, sf, parity=None):
    e = events(spark, sf)
    if parity is not None:
        e = e.filter(F.pmod(F.col("event_id"), F.lit(2)) == parity)
    return e.select(F.col("user_id"), F.col("event_type").alias("app_type_id"),
                    label_of_t(epoch_seconds(e, "ts")).alias("ymd"),
                    F.lit("Daily").alias("family"), F.lit("value").alias("col"),
                    F.col("value").cast("string").alias("value"),
                    F.col("event_id").alias("version"))


def _cell_out(df, *extra):
    return df.select("user_id", F.col("app_type_id").alias("app"), "ymd",
                     F.round(F.col("value").cast("double"), 6).alias("value"), "version", *extra)


def q_store_upsert(spark, sf):
    first = ST.latest_cells(event_cells(spark, sf, 0))
    return _cell_out(ST.upsert(first, event_cells(spark, sf, 1)))


def q_store_latest_cell(spark, sf):
    e = events(spark, sf)
    keys = e.filter(F.col("value") > 100).select(
        "user_id", F.col("event_type").alias("app_type_id"),
        label_of_t(epoch_seconds(e, "ts")).alias("ymd"))
    return _cell_out(ST.lookup_cells(event_cells(spark, sf), keys))


def q_store_month_shard(spark, sf):
    path = fresh_path(spark, "cells")
    ST.upsert_table(spark, path, event_cells(spark, sf, 0))
    ST.upsert_table(spark, path, event_cells(spark, sf, 1))
    t = ST.stored_cells(spark, path)
    return _cell_out(t, F.col("yyyymm").cast("long").alias("yyyymm"))


def q_store_many_writers(spark, sf):
    """Runs appended side by side, a compaction between them, and the newest cell of all runs."""
    path = fresh_path(spark, "cells")
    ST.append_cells(spark, path, event_cells(spark, sf, 1))
    ST.append_cells(spark, path, event_cells(spark, sf, 0))
    ST.compact_store(spark, path, grace=0)
    ST.append_cells(spark, path, event_cells(spark, sf, 0))     # older cells that land again change nothing
    return _cell_out(ST.stored_cells(spark, path), F.col("yyyymm").cast("long").alias("yyyymm"))


def q_row_key(spark, sf):
    return ST.with_row_key(def_daily(spark, sf)).select("user_id", "ymd", "row_key")


def q_time_labels(spark, sf):
    e = events(spark, sf)
    y = label_of_t(epoch_seconds(e, "ts"))
    return e.select("event_id", y.alias("ymd"), yyyymm(y).cast("long").alias("yyyymm"),
                    yyyymmdd(y).cast("long").alias("yyyymmdd"))


def q_sink_partition_counts(spark, sf):
    r = typed_readings(spark, sf)
    r = r.withColumn("ser_id", F.pmod(F.col("user_id"), F.lit(3)).cast("string"))
    r = PL.with_partition(r)
    path = fresh_path(spark, "sink")
    SK.write_partitioned_json(r, path)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("app_type_id", T.StringType()),
                           T.StructField("t", T.LongType()), T.StructField("power", T.DoubleType())])
    back = SK.load_with_schema(spark, path, schema, {"ser_id": T.StringType(), "partition": T.IntegerType()})
    return back.groupBy("ser_id", "partition").agg(F.count(F.lit(1)).alias("n")).select(
        "ser_id", F.col("partition").cast("long").alias("partition"), "n")


def q_load_schema_enforced(spark, sf):
    pts = PI.payload_points(events(spark, sf))
    nested = PL.nest_estimates(pts).withColumn("ser_id", F.pmod(F.col("user_id").cast("long"), F.lit(3)).cast("string"))
    rec = nested.select(F.to_json(F.struct("user_id", "data")).alias("est_json"), "ser_id", "partition")
    text_path = fresh_path(spark, "est-text")
    SK.write_partitioned_text(rec, "est_json", text_path)
    loaded = SK.load_with_schema(spark, text_path, NESTED_ESTIMATE,
                                 {"ser_id": T.StringType(), "partition": T.IntegerType()})
    table_path = fresh_path(spark, "est-table")
    SK.load_into_table(loaded, table_path)
    return _pcols(PL.unnest_estimates(spark.read.parquet(table_path)))


def q_load_quarantine(spark, sf):
    """Records of every fifth user lack a required field and those of every seventh are cut off: what is loaded, and what is not and why."""
    nested = PL.nest_estimates(PI.payload_points(events(spark, sf)))
    user = F.col("user_id").cast("long")
    whole = F.to_json(F.struct(F.when(F.pmod(user, F.lit(5)) != 0, F.col("user_id")).alias("user_id"), "data"))
    text = F.when(F.pmod(user, F.lit(7)) == 0, F.substring(whole, 1, 40)).otherwise(whole)
    src, table, rest = (fresh_path(spark, n) for n in ("mixed-text", "good-table", "rejected"))
    SK.write_partitioned_text(nested.select(text.alias("est_json"), "partition"), "est_json", src, ("partition",))
    SK.load_with_quarantine(spark, src, NESTED_ESTIMATE, table, rest, {"partition": T.IntegerType()}, most_share=0.5)
    out = (spark.read.parquet(table).select(F.lit("accepted").alias("outcome"))
           .unionByName(spark.read.parquet(rest).select(F.col("_reason").alias("outcome"))))
    return out.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


QUERIES.update({
    "load_quarantine": q_load_quarantine,
    "store_upsert": q_store_upsert,
    "store_latest_cell": q_store_latest_cell,
    "store_month_shard": q_store_month_shard,
    "store_many_writers": q_store_many_writers,
    "row_key": q_row_key,
    "time_labels": q_time_labels,
    "sink_partition_counts": q_sink_partition_counts,
    "load_schema_enforced": q_load_schema_enforced,
})


# --- round trips through partitioned tables ----------------------------------


def _epoch_of(text):
    return int(dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=dt.timezone.utc).timestamp())


def q_readings_range_nested(spark, sf):
    """Nested per-day table written by partition, read back for [start, end) by partition + time."""
    pts = PI.payload_points(events(spark, sf))
    path = fresh_path(spark, "nested-days")
    SK.load_into_table(PL.nest_estimates(pts), path)
    lo, hi = _epoch_of(X.RANGE_START), _epoch_of(X.RANGE_END) - 1
    return _pcols(read_nested_range(spark, path, lo, hi))


def q_watermark_snapshots(spark, sf):
    """Old snapshot and merged snapshot written to their et_hr partitions; newest read back."""
    path = fresh_path(spark, "watermark")
    WM.write_snapshot(wm_old(spark, sf), path, 2024011523)
    old, _ = WM.read_latest_snapshot(spark, path)
    WM.write_snapshot(WM.merge_watermarks(wm_new(spark, sf), old).checkpoint(eager=True), path, 2024013023)
    return WM.read_latest_snapshot(spark, path)[0]


def q_ingest_commits(spark, sf):
    """Two ingest runs of one hour, and one that stopped before its commit: points and watermark of each user."""
    points, marks = fresh_path(spark, "points"), fresh_path(spark, "marks")
    payloads = committed_payloads(spark, sf)
    for half in (0, 1):
        ingest_batch(spark, payloads.filter(F.pmod(F.col("customer").cast("long"), F.lit(2)) == half), f"run-{half}", 2024013000, points, marks)
    # what a run leaves that stops after its points: a batch that no marker names
    stopped = PL.with_partition(PL.flatten_estimates(payloads).drop("commited_at")).withColumn("batch", F.lit("run-2~stopped"))
    stopped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(points)
    n = read_committed(spark, points).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_points"))
    return n.join(WM.read_latest_snapshot(spark, marks)[0], "user_id", "full").select("user_id", "n_points", "commited_at")


QUERIES.update({
    "readings_range_nested": q_readings_range_nested,
    "watermark_snapshots": q_watermark_snapshots,
    "ingest_commits": q_ingest_commits,
})


# --- job layer ---------------------------------------------------------------

def q_daily_job(spark, sf):
    """The daily job's full row per user-day (all days), as written to the store."""
    d = J.daily_job(readings_all(spark, sf), X.DEF.to_df(spark))
    return d.select("user_id", _day_str().alias("data_day"), "ymd", "cnt", "dur",
                    "u_h_cnt", "u_l_cnt", "u_h_dur", "u_l_dur", "i_day",
                    F.size("tags").cast("long").alias("n_tags"))


def pair_readings(spark, sf):
    """Readings of types 300 and 301 by the minute, several powers at one (user, t), one in seven a gap."""
    e = events(spark, sf)
    return e.filter(F.col("event_type").isin("click", "view")).select(
        "user_id", F.when(F.col("event_type") == "click", "300").otherwise("301").alias("app_type_id"),
        (F.floor(epoch_seconds(e, "ts") / 7200) * 7200).alias("t"),
        F.when(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit(None)).otherwise(F.col("value")).cast("double").alias("power"))


def q_pair_minmax(spark, sf):
    """Least and greatest sum of the true pairs per (user, t), from the fused rows."""
    p = PR.pair_fusion(pair_readings(spark, sf))
    return p.groupBy("user_id", "t").agg(F.round(F.min("power"), 6).alias("min_power"), F.round(F.max("power"), 6).alias("max_power"))


def q_daily_job_pairs(spark, sf):
    """The daily job over data that holds both paired types, so the fused type is in its result."""
    d = J.daily_job(pair_readings(spark, sf), X.PAIR_THRESHOLDS.to_df(spark))
    return d.select("user_id", F.col("app_type_id").alias("app"), _day_str().alias("data_day"), "cnt", "dur")


def q_util_registry(spark, sf):
    """Long utilisation over the registry's grid: active users without readings get zeros."""
    users = registry_from_customer(load_table(spark, sf, "customer")).filter("is_active = 1").select(
        F.regexp_extract("user", "_(.*)$", 1).cast("long").alias("user"))
    grid = G.user_app_grid(users, [X.DEF_APP])
    return _hours_out(U.utilization_long(recent_sessions(spark, sf, 28), grid, X.AS_OF_DAY), "l")


def q_activity_slots(spark, sf):
    """Latest eligible time per (user, type, payload slot) from landed activity payloads."""
    p = PI.activity_payloads(PI.payload_points(events(spark, sf)), X.PAYLOAD_COMMIT)
    th = X.PAYLOAD_THRESHOLDS.to_df(spark)
    return PL.slot_activity(PL.flatten_activity(p), th).select(
        "user_id", F.col("app_type_id").cast("long").alias("app_type_id"), "st", "la")


QUERIES.update({"daily_job": q_daily_job, "pair_minmax": q_pair_minmax, "daily_job_pairs": q_daily_job_pairs,
                "util_registry": q_util_registry, "activity_slots": q_activity_slots})


# --- bucketed daily history -------------------------------------------------

HISTORY_BUCKETS = 8


def history_table(spark, sf):
    """The daily job's cells written to a store and published as a table bucketed by key; returns its name."""
    store, table = fresh_path(spark, "history-store"), f"history_{uuid.uuid4().hex}"
    d = D.daily_metrics(def_sessions(spark, sf), with_tags=True)
    cells = J.to_cells(d, J.FAMILY_DAILY, {"cnt": "cnt", "dur": "dur"}, 1).unionByName(J.tag_cells(d, "Otag", 1))
    ST.append_cells(spark, store, cells)
    ST.mark_covered(spark, store, "daily", 0, newest_day(spark, sf) or 0)
    H.publish(spark, store, table, HISTORY_BUCKETS, location=fresh_path(spark, "history"))
    return table


def q_weekly_history(spark, sf):
    """Weekly flags of every label from the bucketed history: no exchange of its rows."""
    rows = H.active_days(spark.table(history_table(spark, sf)))
    w = J.weekly_job(rows, last_day=newest_day(spark, sf), dealt=True)
    return w.select(F.col("user_id").cast("long").alias("user_id"), "ymd", "u_h_cnt", "u_l_cnt", "u_h_dur", "u_l_dur")


def q_util_history(spark, sf):
    """Long utilisation from the session lists of the bucketed history; only the grid is exchanged."""
    rows = H.complete_history(spark, history_table(spark, sf), X.AS_OF_DAY - 28, X.AS_OF_DAY)
    grid = user_grid(spark, sf).withColumn("user_id", F.col("user_id").cast("string"))
    u = J.utilization_from_sessions(H.sessions(rows), grid, X.AS_OF_DAY, "long")
    return _hours_out(u.withColumn("user_id", F.col("user_id").cast("long")), "l")


QUERIES.update({"weekly_history": q_weekly_history, "util_history": q_util_history})
