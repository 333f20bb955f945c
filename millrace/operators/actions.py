"""What runs around a plan: registered functions, per-partition work, counters, kept results, bounded collects."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from millrace.plans.bounds import collect_bounded


def register(spark: SparkSession, name: str, f: Callable, returns: str | T.DataType = "string", batched: bool = False) -> None:
    """Makes ``f`` a function of SQL. With ``batched`` it maps pandas Series to a Series (Arrow batches), else it is called per row."""
    spark.udf.register(name, F.pandas_udf(f, returns) if batched else F.udf(f, returns, useArrow=True))


def per_partition(df: DataFrame, f: Callable[[int, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | T.StructType) -> DataFrame:
    """``f(partition number, its rows in frames)`` for every partition."""
    return df.mapInPandas(lambda frames: f(TaskContext.get().partitionId(), frames), schema)


def partition_sizes(df: DataFrame) -> DataFrame:
    """``part, n`` of every partition that has rows."""
    return df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))


def counted(df: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, and counters that are filled while an action reads it (``observation.get``).

    A counter is any aggregate, of one number or a whole histogram: ``F.count_if(...)``, ``F.sum(...)``, ``histogram(...)``.
    Tasks that run twice count once, unlike with accumulators.
    """
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counters.items()]), seen


def histogram(value: Column, bounds: Sequence[float]) -> Column:
    """Rows below each of ``bounds`` (from the one before on) and above the last, as an array; nulls are in none."""
    edges = [None, *bounds, None]
    inside = [(F.lit(True) if a is None else value >= a) & (F.lit(True) if b is None else value < b) & value.isNotNull() for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.count_if(c) for c in inside])


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df`` persisted while the block runs."""
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist()


def lineage(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text, without running it."""
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def collect_map(df: DataFrame, key: str, value: str, max_rows: int = 100_000) -> dict:
    """A small table as a dict; of repeated keys the least value. More than ``max_rows`` keys are an error."""
    return {r[0]: r[1] for r in collect_bounded(df.groupBy(key).agg(F.min(value)), max_rows, "map")}


def to_pandas(df: DataFrame, max_rows: int = 100_000) -> pd.DataFrame:
    """A small table as a frame; more than ``max_rows`` rows are an error."""
    out = df.limit(max_rows + 1).toPandas()
    if len(out) > max_rows:
        raise ValueError(f"more than {max_rows} rows")
    return out


def for_each(df: DataFrame, f: Callable[[Row], None]) -> None:
    """Calls ``f`` on every row where it is; ``f`` must bear repeats."""
    df.foreach(f)


def _through(batches: Iterator[pa.RecordBatch], command: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lines = "".join(f"{x}\n" for x in b.column(0).to_pylist() if x is not None)
        done = subprocess.run(list(command), input=lines, capture_output=True, text=True, check=True)
        yield pa.RecordBatch.from_arrays([pa.array(done.stdout.splitlines(), pa.string())], names=["line"])


def piped(df: DataFrame, column: str, command: Sequence[str]) -> DataFrame:
    """``line``: what an outside program prints for the lines of ``column``, batch by batch; a failure of it fails the task."""
    return df.select(F.col(column).cast("string")).mapInArrow(lambda b: _through(b, command), "line string")
