"""Published tables and views (A6, A10, A11, A13): names in the session catalog that outlive the session's views.

Every build writes its layers into its own folder. ``publish`` registers them as tables named after
the build and then points the public name, a view, at them: one catalog change, made only when the
build has passed its gates. Readers see the old rows or the new ones, never none; a failed build changes no name.
Old versions stay until ``drop_old`` so that readers who started before the switch can finish.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from dialstat.session import work_dir
from dialstat.sources.sinks import PARTITION_COL

_VERSION = "__v_"


def ensure_database(spark: SparkSession, database: str) -> None:
    """The database, kept in the shared folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{work_dir(spark, 'catalog', database + '.db')}'")


def register_version(spark: SparkSession, database: str, name: str, version: str, path: str) -> str:
    """A table over the Parquet files at ``path``; its rows are not copied."""
    table = f"`{database}`.`{name}{_VERSION}{version}`"
    columns = spark.read.parquet(path).columns
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    if PARTITION_COL in columns:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return table


def publish(spark: SparkSession, database: str, paths: dict[str, str], version: str) -> list[str]:
    """Register each layer's files as a version and switch the public names to it; the names."""
    ensure_database(spark, database)
    tables = {name: register_version(spark, database, name, version, path) for name, path in paths.items()}
    for name, table in tables.items():  # all versions exist before the first name changes
        columns = ", ".join(f"`{c}`" for c in spark.table(table).columns if c != PARTITION_COL)
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT {columns} FROM {table}")
    return [f"{database}.{name}" for name in tables]


def versions(spark: SparkSession, database: str, name: str) -> list[str]:
    """The registered versions of a name, oldest first (versions are named so that they sort by time)."""
    found = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"{name.lower()}{_VERSION}")]
    return sorted(found)


def drop_old(spark: SparkSession, database: str, names: Sequence[str], keep: int = 2) -> list[str]:
    """Unregister all but the newest ``keep`` versions of each name (their files are the folder owner's to remove)."""
    gone = [t for name in names for t in versions(spark, database, name)[:-keep or None]]
    for t in gone:
        spark.sql(f"DROP TABLE `{database}`.`{t}`")
    return gone


def read(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")
