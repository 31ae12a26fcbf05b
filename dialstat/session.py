"""Session settings and the shared work folder.

Work that must outlive an executor (checkpoints, written tables, stored
check failures) goes under the folder the cluster names in
``spark.checkpoint.dir``; a local fallback is only set when it is unset,
as in tests.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folder of the intermediate tables of the enclosing ``scratch`` block, if there is one.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)

_SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods above 8000 bytes of bytecode are never JIT-compiled by the JVM;
    # the wide CASE projections of the cleaning stage cross that line, so let Spark fall
    # back to split (JIT-able) expression code for such plans instead of interpreting.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "dialstat") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in _SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    if master.startswith("local"):
        # One machine: keep small CPU-heavy shuffles spread over all cores.
        builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings results depend on, and make sure a checkpoint folder exists."""
    for k, v in _SQL_DEFAULTS.items():
        spark.conf.set(k, v)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            # Only for tests and laptops: executors on other machines cannot see such a folder.
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            shared = tempfile.mkdtemp(prefix="dialstat-ckpt-")
            atexit.register(shutil.rmtree, shared, ignore_errors=True)
            spark.conf.set("spark.checkpoint.dir", shared)
        sc.setCheckpointDir(shared)
    return spark


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (a temporary one on local masters only)."""
    prepare(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return os.path.join(base, "dialstat", *parts)


def fresh_work_dir(spark: SparkSession, name: str) -> str:
    """A path that no other call gets; inside a ``scratch`` block, under the block's folder."""
    own = f"{name}-{uuid.uuid4().hex[:12]}"
    inside = _SCRATCH.get()
    return os.path.join(inside, own) if inside else work_dir(spark, own)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables made inside the block share one folder, removed when the block ends.

    Only for work whose results are written or collected inside: a DataFrame that leaves the block
    may still read its tables. A query that returns a lazy DataFrame therefore leaves its tables in
    the shared folder, as checkpoints are, for the cluster's own clean-up.
    """
    folder = work_dir(spark, f"scratch-{uuid.uuid4().hex[:12]}")
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write once as Parquet in the shared work folder and read it back.

    One job (an eager ``checkpoint()`` would compute the plan twice); the files survive the
    loss of executors and give the planner real sizes.
    """
    path = fresh_work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
