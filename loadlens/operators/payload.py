"""Payload reshaping: parallel arrays <-> rows <-> nested per-day records.

A payload holds, per user and fetch window, ``timestamps[i]`` with
``pwrs[i]`` for the first appliance of every type and ``main_pwrs[i]``.
Flattening zips the arrays (no Python); nesting groups per (user, JST day),
so one record is bounded by the 86,400 seconds of a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.time import yyyymmdd, label_of_t


def _kept(p):
    return (p > 0) | p.isNull()


def _zipped(times, powers):
    """(t, power) pairs where both arrays have the index; a short power array invents no sensor gap."""
    n = F.least(F.size(times), F.size(powers))
    return F.arrays_zip(F.slice(times, F.lit(1), n).alias("t"), F.slice(powers, F.lit(1), n).alias("power"))


def flatten_estimates(payload: DataFrame) -> DataFrame:
    """Finalised estimate points: (user_id, app_type_id, app_id, t, power, commited_at).

    ``app_id`` is the first appliance's own id.  Keeps ``st < t <= commited_at``
    and power > 0 or null (null is a sensor gap); payloads without
    ``commited_at`` give nothing.
    """
    d = payload.filter(F.col("commited_at").isNotNull()).select(
        F.col("customer").alias("user_id"), "commited_at", "st",
        F.try_element_at("data", F.lit(1)).alias("d"))
    at = d.select("user_id", "commited_at", "st", F.col("d.timestamps").alias("ts"),
                  F.explode("d.app_type").alias("at"))
    app = F.try_element_at("at.apps", F.lit(1))
    z = at.select("user_id", "commited_at", "st", F.col("at.app_id").alias("app_type_id"), app["id"].alias("app_id"),
                  F.inline(_zipped(F.col("ts"), app["pwrs"])))
    return z.filter((F.col("t") > F.col("st")) & (F.col("t") <= F.col("commited_at"))
                    & _kept(F.col("power")) & F.col("t").isNotNull()
                    ).select("user_id", "app_type_id", "app_id", "t", "power", "commited_at")


def flatten_main(payload: DataFrame, require_estimate: bool = True) -> DataFrame:
    """Finalised whole-house points (user_id, t, main) where main_pwrs has index i.

    With ``require_estimate`` a point is kept only when some type kept an
    estimate at the same index (power > 0 or null) -- checked inside the
    payload row with ``exists``, so no join against the estimate points is
    needed.
    """
    d = payload.filter(F.col("commited_at").isNotNull()).select(
        F.col("customer").alias("user_id"), "commited_at", "st",
        F.try_element_at("data", F.lit(1)).alias("d"))
    z = d.select("user_id", "commited_at", "st",
                 F.posexplode(F.col("d.timestamps")).alias("i", "t"),
                 F.col("d.main_pwrs").alias("mp"), F.col("d.app_type").alias("at"))
    # get() is null out of range, so the size guard holds whatever order the filters run in
    z = z.withColumn("main", F.get(F.col("mp"), F.col("i")))
    keep = ((F.col("i") < F.size("mp")) & (F.col("t") > F.col("st"))
            & (F.col("t") <= F.col("commited_at")) & _kept(F.col("main")))
    if require_estimate:
        def kept_at_i(a):
            pw = F.try_element_at(a["apps"], F.lit(1))["pwrs"]
            return (F.col("i") < F.size(pw)) & _kept(F.try_element_at(pw, F.col("i") + 1))
        keep = keep & F.exists(F.coalesce(F.col("at"), F.array()), kept_at_i)
    return z.filter(keep).select("user_id", "t", "main")


def flatten_activity(payload: DataFrame) -> DataFrame:
    """Activity variant: fixed_at >= st, t <= fixed_at, power > 0; all types, appliances[0].

    (user_id, app_type_id, app_id, st, t, power); ``st`` is the payload's slot.
    """
    d = payload.filter(F.col("fixed_at").isNotNull() & (F.col("fixed_at") >= F.col("st"))).select(
        F.col("customer").alias("user_id"), "fixed_at", "st", F.try_element_at("data", F.lit(1)).alias("d"))
    at = d.select("user_id", "fixed_at", "st", F.col("d.timestamps").alias("ts"),
                  F.explode("d.appliance_types").alias("at"))
    app = F.try_element_at("at.appliances", F.lit(1))
    z = at.select("user_id", "fixed_at", "st", F.col("at.appliance_type_id").alias("app_type_id"),
                  app["appliance_id"].alias("app_id"), F.inline(_zipped(F.col("ts"), app["powers"])))
    return z.filter((F.col("t") <= F.col("fixed_at")) & (F.col("power") > 0)).select(
        "user_id", "app_type_id", "app_id", "st", "t", "power")


def slot_activity(points: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Latest eligible time per (user, type, slot) of flattened activity payloads."""
    r = points.withColumn("app_type_id", F.col("app_type_id").cast("string")).join(thresholds, "app_type_id")
    return (r.groupBy("user_id", "app_type_id", "st")
            .agg(F.max(F.when(F.col("power") > F.col("min_power"), F.col("t"))).alias("la")))


def with_partition(df: DataFrame) -> DataFrame:
    """``partition`` = yyyymmdd of the JST day of ``t``."""
    return df.withColumn("partition", yyyymmdd(label_of_t("t")))


def nest_estimates(points: DataFrame) -> DataFrame:
    """Per (user, day): data[] of (timestamp, app_types[] of (app_type_id, apps[] of (app_id, pwr))).

    Partially-aggregated steps: per point (a payload that landed twice counts
    once, the greater power of two wins), per timestamp, then per day.
    """
    p = (with_partition(points).groupBy("user_id", "partition", "t", "app_type_id", "app_id")
         .agg(F.max("power").alias("power")))
    per_ts = p.groupBy("user_id", "partition", "t").agg(
        F.sort_array(F.collect_list(F.struct(
            "app_type_id",
            F.array(F.struct("app_id", F.col("power").alias("pwr"))).alias("apps"),
        ))).alias("app_types"))
    return per_ts.groupBy("user_id", "partition").agg(
        F.sort_array(F.collect_list(F.struct(F.col("t").alias("timestamp"), "app_types"))).alias("data"))


def nest_main(main_points: DataFrame, est_points: DataFrame | None = None) -> DataFrame:
    """Whole-house series per (user, day).

    ``est_points`` (optional) keeps only timestamps where an estimate was
    kept; it is not needed for points from ``flatten_main(require_estimate=True)``.
    """
    m = main_points
    if est_points is not None:
        m = m.join(est_points.select("user_id", "t").distinct(), ["user_id", "t"], "left_semi")
    m = with_partition(m).groupBy("user_id", "partition", "t").agg(F.max("main").alias("main"))
    return m.groupBy("user_id", "partition").agg(
        F.sort_array(F.collect_list(F.struct(F.col("t").alias("timestamp"), F.col("main").alias("w_hp"))))
        .alias("data"))


def payload_points(payload: DataFrame) -> DataFrame:
    """Both series in one pass: (user_id, t, app_types, kept_main, main), one row per payload timestamp.

    ``app_types`` holds the estimates kept at the index (power > 0 or null);
    the whole-house value is kept when it has the index, is > 0 or null, and
    some estimate was kept there.
    """
    d = payload.filter(F.col("commited_at").isNotNull()).select(
        F.col("customer").alias("user_id"), "commited_at", "st",
        F.try_element_at("data", F.lit(1)).alias("d"))
    z = d.select("user_id", "commited_at", "st", F.posexplode("d.timestamps").alias("i", "t"),
                 F.col("d.main_pwrs").alias("mp"), F.coalesce(F.col("d.app_type"), F.array()).alias("at"))
    z = z.filter((F.col("t") > F.col("st")) & (F.col("t") <= F.col("commited_at")))

    def first(a):
        return F.try_element_at(a["apps"], F.lit(1))

    kept = F.filter("at", lambda a: (F.col("i") < F.size(first(a)["pwrs"])) & _kept(F.get(first(a)["pwrs"], F.col("i"))))
    types = F.transform(kept, lambda a: F.struct(
        a["app_id"].alias("app_type_id"),
        F.array(F.struct(first(a)["id"].alias("app_id"), F.get(first(a)["pwrs"], F.col("i")).alias("pwr"))).alias("apps")))
    main = F.get(F.col("mp"), F.col("i"))
    return z.select("user_id", "t", types.alias("app_types"), main.alias("main"),
                    (F.coalesce(F.col("i") < F.size("mp"), F.lit(False)) & _kept(main) & (F.size(types) > 0)).alias("kept_main"))


def payload_records(payload: DataFrame) -> DataFrame:
    """est_json and main_json per (user, day); a side without points is null.

    One scan: points of both series are folded per timestamp, then per day
    with one conditional list each, and only the lists become JSON.
    """
    p = with_partition(payload_points(payload)).groupBy("user_id", "partition", "t").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("app_types")))).alias("app_types"),
        F.max(F.when(F.col("kept_main"), F.col("main"))).alias("w_hp"), F.bool_or("kept_main").alias("kept_main"))
    days = p.groupBy("user_id", "partition").agg(
        F.sort_array(F.collect_list(F.when(F.size("app_types") > 0, F.struct(F.col("t").alias("timestamp"), "app_types")))).alias("est"),
        F.sort_array(F.collect_list(F.when(F.col("kept_main"), F.struct(F.col("t").alias("timestamp"), "w_hp")))).alias("main"))

    def record(name):
        return F.when(F.size(name) > 0, F.to_json(F.struct("user_id", F.col(name).alias("data")))).alias(f"{name}_json")

    return days.select("user_id", "partition", record("est"), record("main")).filter(
        F.col("est_json").isNotNull() | F.col("main_json").isNotNull())


def unnest_estimates(nested: DataFrame) -> DataFrame:
    """data.app_types.apps.pwr flattened with explode_outer at each level."""
    d = nested.select("user_id", F.explode_outer("data").alias("d"))
    a = d.select("user_id", F.col("d.timestamp").alias("t"), F.explode_outer("d.app_types").alias("a"))
    p = a.select("user_id", "t", F.col("a.app_type_id").alias("app_type_id"), F.explode_outer("a.apps").alias("p"))
    return p.select("user_id", "app_type_id", F.col("p.app_id").alias("app_id"), "t", F.col("p.pwr").alias("power"))


def unnest_main(nested: DataFrame) -> DataFrame:
    """Whole-house records (user_id, data[] of (timestamp, w_hp)) -> (user_id, t, main)."""
    d = nested.select("user_id", F.explode_outer("data").alias("d"))
    return d.select("user_id", F.col("d.timestamp").alias("t"), F.col("d.w_hp").alias("main"))
