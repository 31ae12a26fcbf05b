"""Helpers shared by the corpus operators: staged tables, Arrow annotation, names."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that separate words, as a Java regular expression class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Text of this many bytes is worked on at a time inside a Python worker.
CHUNK_BYTES = 2 << 20
#: Rows of an Arrow batch that are copied into Python objects at a time.
ROWS_AT_ONCE = 2048


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only for local masters."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark.sparkContext.getCheckpointDir()
        if not base:
            base = tempfile.mkdtemp(prefix="corpus-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage durably.

    Work used by several branches goes through here, so that it is done once and survives
    the loss of executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpus-stage/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, in any letter case, alone or as its beginning."""
    have = {c.lower() for c in df.columns}
    while any(c.startswith(name.lower()) for c in have):
        name += "_"
    return name


def words_col(text) -> F.Column:
    """The words of a text as an array; null and blank texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+")
    return F.filter(parts, lambda w: w != "")


def count_words(text) -> F.Column:
    """Number of words as a long, without keeping the words."""
    flat = F.btrim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "))
    return F.when(flat == "", F.lit(0)).otherwise(F.size(F.split(flat, "\\x20+"))).cast("long")


def ascii_lower(text) -> F.Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Work that runs inside gets its Arrow batches of ``size`` bytes at most, not of 10,000 texts; the setting is put back."""
    with _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size):
        yield


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside (staged tables, collected rows) delete their shuffle files as they end; the setting is put back."""
    with _setting(spark, _CLEANUP, "true"):
        yield


def shuffled_once(df: DataFrame) -> DataFrame:
    """``df``, which ends in a shuffle, over an RDD: the shuffle is written here, and all later queries on it read the same files.

    The RDD is Spark's own, not one of Python: its tasks would keep Python workers beside those of the queries.
    """
    spark = df.sparkSession
    with _setting(spark, _CLEANUP, "false"):  # the files go with the RDD
        return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.javaRDD(), df._jdf.schema()), spark)


@contextmanager
def _setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


def slices(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of at most about ``limit`` bytes each (a longer text stands alone)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def _give_back() -> None:
    """Freed memory goes back to the system, as far as the C library can do that (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, and freed memory given back at its end.

    Spark keeps Python workers for later tasks; without this each of them holds the most that one of its tasks took.
    """
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidied


def annotate(df: DataFrame, column: str, fields: T.StructType, name: str,
             make: Callable[[], Callable[[list[bytes | None]], list[tuple]]],
             keep: list[str] | None = None, limit: int = CHUNK_BYTES, at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """``df`` (or its columns ``keep``) with one struct column ``name`` made from a text column.

    ``make`` runs once in each task and gives the function that turns a list of UTF-8 texts
    (None for null) into one tuple per text, in the order of ``fields``. Rows pass through
    unchanged and in order, a few MB of text and ``at_once`` rows at a time.
    """
    keep = df.columns if keep is None else keep
    given = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, column])])
    at, kept = given.columns.index(column), len(keep)
    if len(given.columns) == kept:
        out = T.StructType([*given.schema.fields, T.StructField(name, fields)])
    else:
        out = T.StructType([*given.schema.fields[:kept], T.StructField(name, fields)])
    kind = pa.struct([(f.name, _arrow(f.dataType)) for f in fields.fields])

    def run(batches):
        work = make()
        for whole in batches:
            for first in range(0, whole.num_rows, at_once):
                batch = whole.slice(first, at_once)
                texts = batch.column(at).cast(pa.binary()).to_pylist()
                for lo, hi in slices(texts, limit):
                    rows = work(texts[lo:hi])
                    made = pa.StructArray.from_arrays(
                        [pa.array([r[j] for r in rows], kind.field(j).type) for j in range(kind.num_fields)],
                        fields=[kind.field(j) for j in range(kind.num_fields)])
                    part = batch.slice(lo, hi - lo)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:kept], made], names=[*part.schema.names[:kept], name])

    return given.mapInArrow(tidy(run), out)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(),
            T.BinaryType: pa.binary(), T.BooleanType: pa.bool_()}[type(kind)]


def struct_of(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])
