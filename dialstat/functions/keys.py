"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "_null_"
SEPARATOR = "|"


def surrogate_key(cols: Sequence[str | Column]) -> Column:
    """Hex MD5 of the '|'-joined text of the columns, NULL written as '_null_'.

    ``concat`` (not ``concat_ws``) with explicit COALESCE, so a NULL never
    vanishes from the key. Values holding '|' or '_null_' can collide, as in
    the published macro.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        col = F.col(c) if isinstance(c, str) else c
        if i:
            parts.append(F.lit(SEPARATOR))
        parts.append(F.coalesce(col.cast("string"), F.lit(NULL_TOKEN)))
    return F.md5(F.concat(*parts))
