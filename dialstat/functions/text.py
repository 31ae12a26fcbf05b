"""Text normalisation helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialstat.params import TEXT_SENTINELS

# The characters with the Unicode White_Space property, which TRIM
# removes (tab through carriage return, space, NEL, NBSP, ogham space,
# U+2000-U+200A, line/paragraph separators, narrow NBSP, medium mathematical
# space, ideographic space).
UNICODE_SPACES = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c: Column | str) -> Column:
    """TRIM with the warehouse's meaning (all leading/trailing Unicode whitespace).

    A character-set trim (no regular expression): Spark's one-argument ``trim``
    strips only ' '.
    """
    return F.btrim(_c(c), F.lit(UNICODE_SPACES))


def norm_text(c: Column | str) -> Column:
    """LOWER(TRIM(x))."""
    return F.lower(utrim(c))


def whitelist(c: Column | str, allowed: Iterable[str]) -> Column:
    """Normalised value if it is in ``allowed``, else NULL (sentinels included)."""
    n = norm_text(c)
    return F.when(n.isin(list(allowed)), n)


def drop_sentinels(c: Column | str, sentinels: Iterable[str] = TEXT_SENTINELS) -> Column:
    """Normalised value, with sentinel texts ('unknown', '') turned into NULL."""
    n = norm_text(c)
    return F.when(~n.isin(list(sentinels)), n)


def yes_no(c: Column | str) -> Column:
    """'yes' -> TRUE, 'no' -> FALSE, anything else -> NULL."""
    n = norm_text(c)
    return F.when(n == "yes", F.lit(True)).when(n == "no", F.lit(False))
