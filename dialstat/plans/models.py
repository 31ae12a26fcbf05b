"""Q13 / A2: layers as models that name their inputs; the order of the build follows from them.

A model is stored once, read back by whatever needs it, and judged by its checks. A failed check stops
only what depends on the model; all else is built. What a build has finished is noted beside the
stored layer, so a second run over the same folder goes on from there.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.operators import quality as Q
from dialstat.session import exists
from dialstat.sources import sinks as S

BUILT, REUSED, FAILED, SKIPPED = "built", "reused", "failed", "skipped"


@dataclass(frozen=True)
class Model:
    """``make`` gets the inputs, in the order of ``inputs``, as DataFrames. ``partitioned`` stores by month range."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[..., DataFrame]
    checks: tuple[Q.Check, ...] = ()
    partitioned: bool = False


@dataclass
class Outcome:
    status: str
    rows: int | None = None
    failed_checks: list[str] = field(default_factory=list)
    because: str | None = None


def ordered(models: Sequence[Model], given: Sequence[str] = ()) -> list[Model]:
    """The models, inputs before what needs them; models without order between them by name."""
    by_name = {m.name: m for m in models}
    if len(by_name) < len(models):
        raise ValueError("two models have one name")
    unknown = {i for m in models for i in m.inputs} - set(by_name) - set(given)
    if unknown:
        raise ValueError(f"no model makes {sorted(unknown)}")
    sorter = TopologicalSorter({n: {i for i in by_name[n].inputs if i in by_name} for n in sorted(by_name)})
    return [by_name[n] for n in sorter.static_order()]


def _note(spark: SparkSession, folder: str, name: str) -> Outcome | None:
    """What an earlier run noted of a finished model."""
    path = f"{folder}/_finished/{name}"
    if not exists(spark, f"{path}/_SUCCESS"):
        return None
    return Outcome(REUSED, spark.read.schema("rows long").parquet(path).first()["rows"])


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/{name}")
    return table.drop(S.PARTITION_COL) if S.PARTITION_COL in table.columns else table


def build(spark: SparkSession, models: Sequence[Model], folder: str, given: Mapping[str, DataFrame] | None = None) -> dict[str, Outcome]:
    """Build the models into ``folder``; ``given`` are relations that no model makes.

    A model whose checks fail is stored (so that its rows can be looked at) and not noted as finished: the
    next run makes it again. A model is also made again if one of its inputs was.
    """
    given, out = dict(given or {}), {}
    for model in ordered(models, list(given)):
        stopped = [i for i in model.inputs if i in out and out[i].status in (FAILED, SKIPPED)]
        if stopped:
            out[model.name] = Outcome(SKIPPED, because=stopped[0])
            continue
        anew = any(i in out and out[i].status == BUILT for i in model.inputs)
        done = None if anew else _note(spark, folder, model.name)
        if done:
            out[model.name] = done
            continue
        inputs = [given[i] if i in given else read(spark, folder, i) for i in model.inputs]
        made, path = model.make(*inputs), f"{folder}/{model.name}"
        if model.partitioned:
            S.write_range_partitioned(made, path)
        else:
            S.overwrite_parquet(made, path)
        stored = read(spark, folder, model.name)
        rows = stored.count()
        checked = Q.summarize({model.name: stored}, model.checks).collect() if model.checks else []
        failed = sorted(r["check_name"] for r in checked if r["status"] == "fail")  # a row a declared check
        out[model.name] = Outcome(FAILED if failed else BUILT, rows, failed)
        if not failed:
            S.overwrite_parquet(spark.range(1).select(F.lit(rows).cast("long").alias("rows")), f"{folder}/_finished/{model.name}")
    return out


def outcomes(spark: SparkSession, built: Mapping[str, Outcome]) -> DataFrame:
    """(model, status, rows, failed_checks, because): one row a declared model."""
    return spark.createDataFrame(
        [(n, o.status, o.rows, ",".join(o.failed_checks), o.because) for n, o in built.items()],
        "model string, status string, rows long, failed_checks string, because string")
