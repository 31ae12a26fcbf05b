"""Planted faults: key rules laid over the derived relations, so that every rule and check has rows to act on.

Each rule is ``column: [(divisor, value), ...]``: the first rule whose divisor divides the row's
integer key gives the value. Rules read the unchanged row. Used by the rule and check queries only;
the relations themselves stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW_FAULTS = {
    "day_of_week": [(41, "0"), (43, "32")],
    "month": [(67, "' MAY '"), (71, "'unknown'"), (73, "NULL")],
    "duration": [(47, "-5"), (53, "0")],
    "previous": [(59, "-1")],
    "pdays": [(83, "-7")],
    "balance": [(79, "0")],
    "y": [(61, "concat('answer-', cast(_row_id % 37 as string))")],
}
CLEAN_FAULTS = {
    "row_id": [(101, "row_id + 1")],
    "contact_month": [(103, "'mai'")],
    "age": [(107, "17")],
}
MART_FAULTS = {
    "conversion_rate_pct": [(89, "conversion_rate_pct + 1.5D")],
    "unsuccessful_contacts": [(97, "-1")],
}
TEXT_FAULTS = {
    "age": [(23, "'x'"), (29, "'2.5'"), (31, "'  7 '"), (37, "''")],
    "balance": [(41, "'9007199254740993'"), (43, "'-9223372036854775808'")],
    "pdays": [(47, "'9223372036854775808'")],
}


def with_faults(df: DataFrame, faults: dict, key: str) -> DataFrame:
    """``df`` with the planted values, each cast to its column's type."""
    types = dict(df.dtypes)
    out = {}
    for column, rules in faults.items():
        value = F.col(f"`{column}`")
        for divisor, planted in reversed(rules):
            value = F.when(F.col(key) % divisor == 0, F.expr(planted).cast(types[column])).otherwise(value)
        out[column] = value
    return df.withColumns(out)
