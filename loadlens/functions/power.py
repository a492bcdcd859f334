"""Power expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_safe_sum(a, b) -> Column:
    """a + b with a missing side counted as 0.0 (null + null = 0.0).

    Text inputs are trimmed and parsed leniently, so 'null' (or any
    non-number) counts as missing instead of failing under ANSI casts.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b

    def num(c):
        return c.try_cast("double")   # no-op for doubles; text is trimmed, 'null' -> null

    return F.coalesce(num(a), F.lit(0.0)) + F.coalesce(num(b), F.lit(0.0))


def power_kept(p, drop_zero: bool = False) -> Column:
    """Reading filter: non-null power (optionally also non-zero)."""
    p = F.col(p) if isinstance(p, str) else p
    return p.isNotNull() & (p != 0.0) if drop_zero else p.isNotNull()
