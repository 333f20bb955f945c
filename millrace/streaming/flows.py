"""Structured Streaming flows (extensions: the batch operators have their own modules)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_folder(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def windowed_counts(events: DataFrame, ts: str, key: str, value: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and totals per key and tumbling window; rows later than ``late`` are dropped by the watermark."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), key, "n", "total")


def session_counts(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    """Sessions per key by inactivity."""
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def alerts(events: DataFrame, condition: str, act: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs ``act`` on the rows of each micro-batch that meet ``condition``; the query reads what is there and ends."""
    return events.where(condition).writeStream.foreachBatch(act).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def land(events: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None):
    """Writes a stream as parquet, each row once."""
    w = events.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append")
    return (w.partitionBy(*partition_by) if partition_by else w).start(path)
