"""Column helpers: every function returns a ``Column`` and stays in codegen (no UDFs)."""

from dialstat.functions.keys import surrogate_key
from dialstat.functions.numeric import (
    cents_to_euros,
    clamp,
    flag,
    keep_at_least,
    keep_between,
    rate_pct,
    safe_divide,
)
from dialstat.functions.text import norm_text, utrim, whitelist, yes_no

__all__ = [
    "cents_to_euros", "clamp", "flag", "keep_at_least", "keep_between", "norm_text",
    "rate_pct", "safe_divide", "surrogate_key", "utrim", "whitelist", "yes_no",
]
