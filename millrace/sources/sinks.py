"""Writers. Modes are ``overwrite`` unless given, so a run can be repeated."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, Row, functions as F


def write_text(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    df.select(F.col(column).cast("string")).write.mode(mode).text(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Partitioned output replaces only the partitions it brings, if the mode is ``overwrite``."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("sep", sep).option("header", header).csv(path)


def write_single(df: DataFrame, path: str, sep: str = "\t") -> None:
    """One part file; for results that one task can hold."""
    df.coalesce(1).write.mode("overwrite").option("sep", sep).csv(path)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0, mode: str = "overwrite") -> None:
    """A managed table, partitioned and bucketed (buckets co-locate later joins on the same key)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by and buckets:
        w = w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    w.saveAsTable(name)


def insert(df: DataFrame, name: str, overwrite: bool = False) -> None:
    df.write.insertInto(name, overwrite=overwrite)


def write_per_group(df: DataFrame, path: str, group: str, column: str) -> None:
    """A folder of text lines per group."""
    df.select(F.col(group), F.col(column).cast("string").alias("value")).write.mode("overwrite").partitionBy(group).text(path)


def pretty_json(df: DataFrame, max_rows: int = 10_000, indent: int = 4) -> str:
    """A small report as sorted, indented JSON."""
    from millrace.plans.bounds import collect_bounded

    return json.dumps([r.asDict(recursive=True) for r in collect_bounded(df, max_rows, "report")], sort_keys=True, indent=indent, default=str)


def upsert_documents(df: DataFrame, key: str, send: Callable[[str, str], None]) -> None:
    """Calls ``send(key, json)`` for every row, from the task that holds it; ``send`` must bear repeats."""

    def run(rows: Iterator[Row]) -> None:
        for r in rows:
            send(str(r["k"]), r["j"])

    df.select(F.col(key).cast("string").alias("k"), F.to_json(F.struct("*")).alias("j")).foreachPartition(run)


def upsert_batches(df: DataFrame, key: str, send: Callable[[list[tuple[str, str]]], None], batch: int = 500) -> None:
    """Calls ``send([(key, json), ...])`` with at most ``batch`` rows at a time, from the task that holds them; ``send`` must bear repeats."""

    def run(rows: Iterator[Row]) -> None:
        pairs = ((str(r["k"]), r["j"]) for r in rows)
        while part := list(islice(pairs, batch)):
            send(part)

    df.select(F.col(key).cast("string").alias("k"), F.to_json(F.struct("*")).alias("j")).foreachPartition(run)


def expired(df: DataFrame, day: str, today: str, keep_days: int) -> DataFrame:
    """Rows (of folders, say) older than ``keep_days``."""
    return df.where(F.datediff(F.to_date(F.lit(today)), F.to_date(F.col(day))) > keep_days)


def update_document(df: DataFrame, sets: dict | None = None, renames: dict | None = None, pushes: dict | None = None) -> DataFrame:
    """Sets columns, renames them and appends to arrays, in this order."""
    for c, v in (sets or {}).items():
        df = df.withColumn(c, v if hasattr(v, "alias") else F.lit(v))
    for a, b in (renames or {}).items():
        df = df.withColumnRenamed(a, b)
    for c, v in (pushes or {}).items():
        df = df.withColumn(c, F.array_append(F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)), v if hasattr(v, "alias") else F.lit(v)))
    return df
