from pyspark.sql import functions as F

from dialstat.functions import clamp, norm_text, safe_divide, surrogate_key, utrim
from dialstat.functions.numeric import cents_to_euros, rate_pct
from dialstat.sources.ingest import coerce_integer_text


def col_values(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_unicode_trim_strips_tab_newline_nbsp_em_space(spark):
    got = col_values(spark, ["\tAdmin ", " x ", " y\n", None, "a b"], "string", utrim)
    assert got == ["Admin", "x", "y", None, "a b"]


def test_norm_text_lowers_after_trim(spark):
    assert col_values(spark, ["\tAdmin ", "UNKNOWN", "", " x "], "string", norm_text) == ["admin", "unknown", "", "x"]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (None, 2), (0, 5)], "a long, b long")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, None, 0.0]


def test_rate_pct_is_double_and_rounded(spark):
    df = spark.createDataFrame([(1, 3), (2, 25), (0, 0)], "a long, b long")
    out = df.select(rate_pct("a", "b").alias("r"))
    assert out.schema["r"].dataType.typeName() == "double"
    assert [r[0] for r in out.collect()] == [33.33, 8.0, None]


def test_clamp_keeps_null(spark):
    got = col_values(spark, [None, -10001, -10000, 100000, 100001], "long", lambda c: clamp(c, -10000, 100000))
    assert got == [None, -10000, -10000, 100000, 100000]


def test_surrogate_key_contract(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("_null_", "c")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key(["x", "y"])).collect()]
    assert keys[0] == keys[1]  # documented collision on '|'
    assert keys[2] == keys[3]  # NULL is written as '_null_'
    assert all(len(k) == 32 and all(ch in "0123456789abcdef" for ch in k) for k in keys)


def test_numeric_text_coercion(spark):
    got = col_values(spark, ["3.0", " 7 ", "x", None, "2.5", "-4"], "string", coerce_integer_text)
    assert got == [3, 7, None, None, None, -4]
    big = ["9007199254740993", "-9223372036854775808", "9223372036854775808", "+12", "", "1e3"]
    assert col_values(spark, big, "string", coerce_integer_text) == [9007199254740993, -(2**63), None, 12, None, 1000]


def test_cents_to_euros(spark):
    assert col_values(spark, [12345, 5, None], "long", cents_to_euros) == [123.45, 0.05, None]
