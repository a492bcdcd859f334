"""Late-night sessions: readings 22:00-04:59 JST labelled by the midnight between.

Regular users contribute only readings in [midnight, midnight + 5 h); users in
the special table contribute the whole 22:00-04:59 range.  Output sessions
are shifted by the special user's offsets, regular users get the end offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.time import latenight_label
from loadlens.operators.sessions import eligible_readings, sessions_from_eligible
from loadlens.settings import LATENIGHT_END_HOUR, LATENIGHT_START_HOUR, SPECIAL_USER_OFFSETS


def latenight_readings(readings: DataFrame, special: DataFrame,
                       start_hour: int = LATENIGHT_START_HOUR,
                       end_hour: int = LATENIGHT_END_HOUR) -> DataFrame:
    """Readings with ``ymd`` = late-night midnight; ``special`` is a small broadcast table."""
    m = latenight_label("t", start_hour)
    r = readings.withColumn("ymd", m)
    r = r.join(special.select("user_id", F.lit(True).alias("is_special")), "user_id", "left")
    rel = F.col("t") - F.col("ymd")
    regular = (rel >= 0) & (rel < end_hour * 3600)
    special_ok = (rel >= -(24 - start_hour) * 3600) & (rel < end_hour * 3600)
    keep = F.when(F.col("is_special").isNotNull(), special_ok).otherwise(regular)
    return r.filter(keep).drop("is_special")


def latenight_sessions(ln_readings: DataFrame, thresholds: DataFrame, special: DataFrame,
                       default_end_offset: int = SPECIAL_USER_OFFSETS[1]) -> DataFrame:
    """(user_id, app_type_id, ymd, st, et, kept) with offsets applied.

    Rows with ``kept = false`` are keys whose sessions were all too short;
    they make the empty late-night lists.
    """
    el = eligible_readings(ln_readings, thresholds)
    sess = sessions_from_eligible(el, ["user_id", "app_type_id", "ymd"], keep_short=True)
    sess = sess.withColumn("kept", (F.col("et") - F.col("st")) > F.col("min_duration"))
    sess = sess.join(special, "user_id", "left")
    st = F.col("st") + F.coalesce(F.col("start_offset"), F.lit(0))
    et = F.col("et") + F.coalesce(F.col("end_offset"), F.lit(default_end_offset))
    return sess.select("user_id", "app_type_id", "ymd", st.alias("st"), et.alias("et"), "kept")


def latenight_tags(ln_sessions: DataFrame) -> DataFrame:
    """Sorted session list per key; empty list when every session was too short."""
    kept = F.when(F.col("kept"), F.struct("st", "et"))
    return ln_sessions.groupBy("user_id", "app_type_id", "ymd").agg(
        F.sort_array(F.collect_list(kept)).alias("tags"))
