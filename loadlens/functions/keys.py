"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadlens.settings import PROVIDER_PATTERN


def provider_id(user) -> Column:
    """Provider prefix of a ``<provider>_<alnum>`` user id."""
    user = F.col(user) if isinstance(user, str) else user
    return F.regexp_extract(user, PROVIDER_PATTERN, 1)


def row_key(user, ymd, app) -> Column:
    """Store row key: md5(trim(user) || trim(ymd)) || app."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (user, ymd, app)]
    u, y, a = (c.cast("string") for c in cols)
    return F.concat(F.md5(F.concat(F.trim(u), F.trim(y))), a)
