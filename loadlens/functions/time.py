"""Business-calendar expressions.

The data day of a reading is its JST calendar date.  A day is labelled by
the end of that day, ``ymd = day_no * 86400 + 54000`` (15:00 UTC), whose UTC
date equals the JST data day.  ``day_no`` is the integer unix date of the JST
day and is what windows order on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.settings import DAY, JST_OFFSET, LABEL_OFFSET


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds(df: DataFrame, col: str) -> Column:
    """Whole epoch seconds of a timestamp column.

    ``timestamp_ntz`` values are wall-clock UTC (as in the landed tables),
    ``timestamp`` values are instants; neither depends on the session zone.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        c = F.col(col)
        # wall-clock fields of a timestamp_ntz are zone-free
        return (F.unix_date(F.to_date(c)).cast("long") * F.lit(DAY)
                + F.hour(c) * F.lit(3600) + F.minute(c) * F.lit(60) + F.second(c)).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(F.col(col))
    return F.col(col).cast("long")


def day_no(t) -> Column:
    """Integer JST day number of epoch seconds ``t``."""
    return F.floor((_c(t) + F.lit(JST_OFFSET)) / F.lit(DAY)).cast("long")


def data_day(t) -> Column:
    """JST calendar date of epoch seconds ``t``."""
    return F.date_from_unix_date(day_no(t).cast("int"))


def day_to_label(day) -> Column:
    """ymd label (epoch seconds) of a day number."""
    return (_c(day) * F.lit(DAY) + F.lit(LABEL_OFFSET)).cast("long")


def label_of_t(t) -> Column:
    return day_to_label(day_no(t))


def jst_hour(t) -> Column:
    """JST hour of day (0..23) of epoch seconds."""
    return F.pmod(F.floor((_c(t) + F.lit(JST_OFFSET)) / F.lit(3600)), F.lit(24)).cast("int")


def latenight_label(t, start_hour: int = 22) -> Column:
    """Epoch of the JST midnight that a late-night reading belongs to.

    Readings from ``start_hour`` JST onwards belong to the following midnight.
    """
    shifted = _c(t) + F.lit(JST_OFFSET + (24 - start_hour) * 3600)
    return (F.floor(shifted / F.lit(DAY)) * F.lit(DAY) - F.lit(JST_OFFSET)).cast("long")


def weekday_no(day) -> Column:
    """Monday = 0 for a date column."""
    return F.weekday(_c(day))


def yyyymm(label) -> Column:
    """yyyymm (int) of the UTC date of an epoch label."""
    d = F.date_from_unix_date(F.floor(_c(label) / F.lit(DAY)).cast("int"))
    return (F.year(d) * 100 + F.month(d)).cast("int")


def yyyymmdd(label) -> Column:
    d = F.date_from_unix_date(F.floor(_c(label) / F.lit(DAY)).cast("int"))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def months_between(lo_day: int, hi_day: int) -> list[int]:
    """yyyymm ids of the label days lo..hi (a label's UTC date is its data day)."""
    out, d = [], dt.date(1970, 1, 1) + dt.timedelta(days=lo_day)
    end = dt.date(1970, 1, 1) + dt.timedelta(days=hi_day)
    while d <= end:
        m = d.year * 100 + d.month
        if not out or out[-1] != m:
            out.append(m)
        d += dt.timedelta(days=1)
    return out
