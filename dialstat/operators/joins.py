"""Join helpers: NULL-safe key joins and broadcasts behind a checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialstat.session import stored

# A broadcast side is written and measured first; above this many rows, or bytes
# of its values, the join stays a shuffle join. A ranking holds three at most.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table's values: 8 for each fixed-width one, the length of each text."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    fixed = 8 * (len(df.columns) - len(text))
    length = F.lit(fixed)
    for c in text:
        length = length + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) + F.lit(8)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def checked_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, known_small: bool = False, *,
                  max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Write ``df`` to the shared work folder (callers pass aggregates) and measure it there.

    Returns ``(df, True)`` with a broadcast hint when it has at most ``max_rows`` rows and
    ``max_bytes`` bytes, else ``(df, False)`` so the caller's join remains a shuffle join.
    Nothing stays cached, and the files survive the loss of executors.
    ``known_small`` skips the count for tables whose bound is already proven
    (their key's domain is bounded, or they roll up a checked table).
    """
    if known_small:
        return F.broadcast(df), True
    kept = stored(df, "small")
    rows, size = measured(kept)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(kept), True
    return kept, False


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` treating NULL = NULL, keeping the left copy of the key columns."""
    if not cols:
        raise ValueError("a key join needs at least one key column")
    renamed = {c: f"__r_{c}" for c in cols}
    r = right.select(*[F.col(c).alias(renamed.get(c, c)) for c in right.columns])
    cond: Column | None = None
    for c, rc in renamed.items():
        e = left[c].eqNullSafe(r[rc])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*renamed.values())


def equi_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Plain-equality join (NULL keys never match), keeping the left copy of the keys."""
    renamed = {c: f"__r_{c}" for c in cols}
    r = right.select(*[F.col(c).alias(renamed.get(c, c)) for c in right.columns])
    cond: Column | None = None
    for c, rc in renamed.items():
        e = left[c] == r[rc]
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*renamed.values())
