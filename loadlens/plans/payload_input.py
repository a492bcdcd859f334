"""Estimate / activity payloads derived from ``events`` inside the plan.

Each (user, fetch window) becomes one payload with parallel arrays aligned on
the window's sorted timestamps; a type without a value at a timestamp gets a
null (a sensor gap).  Everything is grouped per (user, window), so one array
is bounded by the window length in seconds times the number of types.  The
payload is cast to the explicit landed-file schema (files themselves are read
with ``sources.payloads``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.time import epoch_seconds
from loadlens.plans import fixtures as X
from loadlens.sources.schemas import ACTIVITY_PAYLOAD, ESTIMATE_PAYLOAD

WINDOW = 86340


def payload_points(events: DataFrame) -> DataFrame:
    """(user_id string, app_type_id int, app_id int, t, power): gaps on every 7th event, zeros on every 11th.

    The appliance's own id is the type's times 100, plus 7.
    """
    types = F.array(*[F.lit(t) for t in X.EVENT_TYPES])
    p = (F.when(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit(None).cast("double"))
         .when(F.pmod(F.col("event_id"), F.lit(11)) == 0, F.lit(0.0))
         .otherwise(F.col("value")))
    r = events.select(F.col("user_id").cast("string").alias("user_id"),
                      F.array_position(types, F.col("event_type")).cast("int").alias("app_type_id"),
                      epoch_seconds(events, "ts").alias("t"), p.alias("power"))
    return (r.groupBy("user_id", "app_type_id", "t").agg(F.max("power").alias("power"))
            .select("user_id", "app_type_id", (F.col("app_type_id") * 100 + 7).alias("app_id"), "t", "power"))


def _aligned(points: DataFrame, window: int) -> DataFrame:
    """One row per (user, window): sorted timestamps, per-type aligned powers, main.

    One row per timestamp first, with a conditional column per type, then one
    sorted list per window from which every array is read by position: linear
    in the points plus a sort.  A type without any point in the window is left out.
    """
    kinds = range(1, len(X.EVENT_TYPES) + 1)
    pts = points.withColumn("w", F.floor(F.col("t") / F.lit(window)))
    row = pts.groupBy("user_id", "w", "t").agg(
        F.sum("power").alias("main"),
        *[F.max(F.when(F.col("app_type_id") == k, F.col("power"))).alias(f"p{k}") for k in kinds],
        *[F.max(F.col("app_type_id") == k).alias(f"h{k}") for k in kinds])
    g = row.groupBy("user_id", "w").agg(
        F.sort_array(F.collect_list(F.struct("t", "main", *[f"p{k}" for k in kinds]))).alias("rows"),
        *[F.bool_or(f"h{k}").alias(f"h{k}") for k in kinds])
    per_app = F.array(*[F.when(F.col(f"h{k}"), F.struct(F.lit(k).alias("app_id"), F.col(f"rows.p{k}").alias("pwrs"))) for k in kinds])
    return g.select("user_id", "w", F.col("rows.t").alias("ts"), F.col("rows.main").alias("main"),
                    F.filter(per_app, lambda x: x.isNotNull()).alias("per_app"))


def _cast_to(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def estimate_payloads(points: DataFrame, commited_at: int, st: int, window: int = WINDOW) -> DataFrame:
    j = _aligned(points, window)
    app_type = F.transform("per_app", lambda p: F.struct(
        p["app_id"].alias("app_id"),
        F.array(F.struct((p["app_id"] * 100 + 7).alias("id"), p["pwrs"].alias("pwrs"))).alias("apps")))
    payload = j.select(
        F.col("user_id").alias("customer"),
        F.lit(commited_at).cast("long").alias("commited_at"),
        F.lit(st).cast("long").alias("st"),
        F.array(F.struct(F.col("ts").alias("timestamps"), F.col("main").alias("main_pwrs"),
                         app_type.alias("app_type"))).alias("data"))
    return _cast_to(payload, ESTIMATE_PAYLOAD)


def activity_payloads(points: DataFrame, fixed_at: int, window: int = 600) -> DataFrame:
    j = _aligned(points, window)
    types = F.transform("per_app", lambda p: F.struct(
        p["app_id"].alias("appliance_type_id"),
        F.array(F.struct((p["app_id"] * 100 + 7).alias("appliance_id"), p["pwrs"].alias("powers"))).alias("appliances")))
    payload = j.select(
        F.col("user_id").alias("customer"),
        F.lit(fixed_at).cast("long").alias("fixed_at"),
        (F.col("w") * window).cast("long").alias("st"),
        F.array(F.struct(F.col("ts").alias("timestamps"), types.alias("appliance_types"))).alias("data"))
    return _cast_to(payload, ACTIVITY_PAYLOAD)
