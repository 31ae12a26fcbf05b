"""Ingest preparation: validation, load stamp, dense ids, coercion, profiles."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from dialstat.operators.ordinal import dense_row_number
from dialstat.params import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS, TARGET_VALUES
from dialstat.schema import RAW_SCHEMA

FEATURE_COLUMNS = tuple(c for c in RAW_COLUMNS if c != "y")


def _bad_target(target: str) -> Column:
    return F.col(target).isNotNull() & ~F.col(target).isin(list(TARGET_VALUES))


def _bad_target_message(bad: Column, distinct: Column) -> Column:
    return F.format_string("invalid target values: %d distinct in %d rows", distinct, bad)


def validation_report(df: DataFrame, expected=RAW_COLUMNS, target: str = "y") -> DataFrame:
    """I1 as a relation (is_valid, message, invalid_value, row_count).

    One verdict row (invalid_value NULL, row_count = all rows; the first failure wins: missing
    columns, empty, integer ``age``, target values outside {yes, no}, NULL ignored), then one row for
    every invalid target value with its number of rows, however many there are.
    """
    spark = df.sparkSession
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        return spark.range(1).select(
            F.lit(False).alias("is_valid"), F.lit(f"missing columns: {missing}").alias("message"),
            F.lit(None).cast("string").alias("invalid_value"), F.lit(None).cast("long").alias("row_count"))
    age_is_int = isinstance(df.schema["age"].dataType, (IntegerType, LongType))
    values = df.groupBy(F.col(target).alias("value"), _bad_target(target).alias("bad")).agg(
        F.count(F.lit(1)).alias("row_count"))
    stats = values.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"),
                       F.coalesce(F.sum(F.when(F.col("bad"), F.col("row_count"))), F.lit(0)).alias("bad"),
                       F.count_if("bad").alias("distinct"))
    message = (
        F.when(F.col("n") == 0, F.lit("dataframe is empty"))
        .when(F.lit(not age_is_int), F.lit(f"wrong type for 'age': {df.schema['age'].dataType.simpleString()}"))
        .when(F.col("bad") > 0, _bad_target_message(F.col("bad"), F.col("distinct")))
        .otherwise(F.lit("")))
    verdict = stats.select((message == "").alias("is_valid"), message.alias("message"),
                           F.lit(None).cast("string").alias("invalid_value"), F.col("n").alias("row_count"))
    return verdict.unionByName(values.where("bad").select(
        F.lit(False).alias("is_valid"), F.lit("invalid target value").alias("message"),
        F.col("value").alias("invalid_value"), "row_count"))


def schema_problem(df: DataFrame) -> str:
    """What the schema alone says against a load: missing columns, ``age`` not a whole number."""
    missing = sorted(set(RAW_COLUMNS) - set(df.columns))
    if missing:
        return f"missing columns: {missing}"
    kind = df.schema["age"].dataType
    return "" if isinstance(kind, (IntegerType, LongType)) else f"wrong type for 'age': {kind.simpleString()}"


def validation_metrics(required=()) -> list[Column]:
    """The counts that I1 and A7 judge: one aggregate, or metrics observed during a write."""
    return [F.count(F.lit(1)).alias("n"), F.count_if(_bad_target("y")).alias("bad"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]]


def verdict(counts: dict, schema: str = "") -> str:
    """The first failure that the counts and the schema show; empty if there is none."""
    if schema.startswith("missing columns"):
        return schema
    if counts["n"] == 0:
        return "dataframe is empty"
    if schema:
        return schema
    if counts["bad"]:
        return f"invalid target values in {counts['bad']} rows"
    nulls = {c.removeprefix("null_"): v for c, v in counts.items() if c.startswith("null_") and v}
    return f"REQUIRED fields hold NULLs: {nulls}" if nulls else ""


def validate(df: DataFrame, required=("_row_id",)) -> tuple[bool, str]:
    """I1 (+ A7 on source columns) for the driver in one aggregate pass; ``(ok, message)``.

    The message holds counts; :func:`validation_report` lists the values. REQUIRED columns
    present in the source are checked for NULLs in the same pass.
    """
    schema = schema_problem(df)
    if schema.startswith("missing columns"):
        return False, schema
    counts = df.agg(*validation_metrics([c for c in required if c in df.columns]),
                    F.count_distinct(F.when(_bad_target("y"), F.col("y"))).alias("distinct")).first().asDict()
    message = verdict(counts, schema)
    if message.startswith("invalid target values"):
        message = f"invalid target values: {counts['distinct']} distinct in {counts['bad']} rows"
    return not message, message


def stamp_load_ts(df: DataFrame, run_ts: _dt.datetime, col: str = "_dbt_loaded_at") -> DataFrame:
    """One load timestamp for the whole load (a literal, not a per-row clock)."""
    return df.withColumn(col, F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))


def add_dense_row_id(df: DataFrame, order_key: str, col: str = "_row_id", observe=None) -> DataFrame:
    """Dense 1..n in the order of a key, without a one-task window."""
    return dense_row_number(df, order_key, col, observe=observe)


def coerce_integer_text(c: Column | str) -> Column:
    """I4: text -> integer like ``to_numeric(errors='coerce')`` for integral data.

    '3.0' -> 3, ' 7 ' -> 7, 'x' -> NULL, '2.5' -> NULL. Whole numbers are read as such, digit by
    digit; only other forms ('3.0', '1e3') go through a double.
    """
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    d = text.try_cast("double")
    whole = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    integral = d.isNotNull() & (d == F.floor(d)) & (F.abs(d) < F.lit(9.2e18))
    return F.when(whole, F.trim(text).try_cast("bigint")).when(integral, F.floor(d).cast("long"))


def coerce_numeric(df: DataFrame, cols=NUMERIC_COLUMNS) -> DataFrame:
    """I4 over several columns; integral columns keep their values untouched."""
    kinds = dict(df.dtypes)
    return df.withColumns({
        c: F.col(c).cast("long") if kinds[c] in ("tinyint", "smallint", "int", "bigint") else coerce_integer_text(c)
        for c in cols if c in df.columns})


def coerce_categorical(df: DataFrame, cols=CATEGORICAL_COLUMNS) -> DataFrame:
    """Categorical columns as text; a missing value stays NULL (never the text 'nan')."""
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in cols if c in df.columns})


def prepare_for_load(df: DataFrame, run_ts: _dt.datetime, order_key: str | None = None, observe=None) -> DataFrame:
    """Ids, stamp, categorical text, numeric coercion.

    With ``order_key`` the rows are numbered 1..n in its order, which writes them once; ``observe``
    (an Observation and its metrics) is measured during that write.
    """
    out = df if order_key is None else add_dense_row_id(df, order_key, observe=observe)
    out = stamp_load_ts(out, run_ts)  # after the numbering, whose write may observe the source's own times
    out = coerce_numeric(coerce_categorical(out))
    return out.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def required_field_nulls(df: DataFrame, required=("_row_id", "_dbt_loaded_at")) -> DataFrame:
    """NULL count of each REQUIRED field, one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c.strip('_')}") for c in required])


def assert_required(df: DataFrame, required=("_row_id", "_dbt_loaded_at")) -> None:
    """A7 gate: raise before any write when a REQUIRED field holds NULLs."""
    r = required_field_nulls(df, required).first()
    bad = {k: v for k, v in r.asDict().items() if v}
    if bad:
        raise ValueError(f"REQUIRED fields hold NULLs: {bad}")


def null_counts(df: DataFrame) -> DataFrame:
    """I8: NULL count of every column, one aggregate pass, as rows (column_name, null_count)."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_count)")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns holding NULLs with count and percent (2 dp), one aggregate pass."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__total"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    rows = agg.selectExpr("__total", f"stack({len(cols)}, {stack}) as (column_name, null_count)")
    return rows.where(F.col("null_count") > 0).select(
        "column_name", "null_count",
        F.round(F.col("null_count") * F.lit(100.0) / F.col("__total"), 2).alias("null_pct"),
    )


def dataset_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))


def dtypes_frame(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types (schema only, no job)."""
    return df.dtypes


def dataset_head(df: DataFrame, n: int = 5, order_key: str = "_row_id") -> DataFrame:
    """One row per column: (position, column_name, data_type, head_1 .. head_n as text), by ``order_key``."""
    first = df.orderBy(order_key).limit(n).agg(F.array_sort(F.collect_list(F.struct(
        F.col(f"`{order_key}`").alias("__order"), *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)])))
        .alias("rows"))  # n rows
    return first.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
        *[F.get(F.col("rows"), k)[f"c{i}"].alias(f"head_{k + 1}") for k in range(n)])
        for i, (c, t) in enumerate(df.dtypes)])))


def target_value_counts(df: DataFrame, target: str = "y") -> DataFrame:
    """Target distribution, NULL dropped, most frequent first."""
    return (
        df.where(F.col(target).isNotNull())
        .groupBy(target)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(target))
    )


def preview(df: DataFrame, n: int = 5, order_key: str = "_row_id") -> DataFrame:
    """Dry-run preview of the prepared data (head), no sink."""
    return df.orderBy(order_key).limit(n)


def combine_features_target(features: DataFrame, target: DataFrame, key: str = "_row_id") -> DataFrame:
    """Column-wise combine of features and target on an explicit record key
    (a full outer join: a row missing on one side keeps NULLs, as index alignment does)."""
    return features.join(target, on=key, how="full_outer")


def split_features_target(raw: DataFrame, key: str = "_row_id") -> tuple[DataFrame, DataFrame]:
    return raw.select(key, *[F.col(f"`{c}`") for c in FEATURE_COLUMNS]), raw.select(key, "y")


def read_raw(spark, path: str, schema: StructType = RAW_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """A1: typed scan of a stored raw table with the explicit schema (no inference)."""
    return spark.read.schema(schema).format(fmt).load(path)
