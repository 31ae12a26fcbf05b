"""Numeric helpers: safe division, rates, clamps and NULL-to-FALSE flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """NULL when the divisor is 0 or NULL; always a double (never decimal)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def rate_pct(num: Column | str, den: Column | str, decimals: int = 2) -> Column:
    """ROUND(SAFE_DIVIDE(num, den) * 100, decimals)."""
    return F.round(safe_divide(num, den) * F.lit(100.0), decimals)


def cents_to_euros(c: Column | str) -> Column:
    return F.round(_c(c) / F.lit(100.0), 2)


def clamp(c: Column | str, lo, hi) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (``least``/``greatest`` would skip the NULL)."""
    x = _c(c)
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def keep_between(c: Column | str, lo, hi) -> Column:
    """Value inside [lo, hi], else NULL."""
    x = _c(c)
    return F.when(x.between(lo, hi), x)


def keep_at_least(c: Column | str, lo) -> Column:
    """Value if >= lo, else NULL."""
    x = _c(c)
    return F.when(x >= lo, x)


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN TRUE ELSE FALSE: a NULL condition gives FALSE."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))
