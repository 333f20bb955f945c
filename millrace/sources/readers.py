"""Readers. Schemas are given, never inferred, unless a reader says so."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of files, folders or globs, gzipped ones too."""
    return spark.read.text(path)


def delimited(spark: SparkSession, path: str, sep: str, schema: T.StructType | str, quote: str = '"', header: bool = False, null: str | None = None, bad_column: str | None = None) -> DataFrame:
    """Separated values (``sep`` of any length). With ``bad_column`` lines that don't fit are kept there, else their fields are null."""
    r = spark.read.option("sep", sep).option("quote", quote).option("header", header).option("mode", "PERMISSIVE")
    if null is not None:
        r = r.option("nullValue", null)
    if bad_column:
        r = r.option("columnNameOfCorruptRecord", bad_column)
    return r.schema(schema).csv(path)


def delimited_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """With a header and types taken from the data (a pass of its own; for exploration)."""
    return spark.read.option("sep", sep).option("header", True).option("inferSchema", True).csv(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A file that is one JSON array."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema is not None else r).json(path)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def external_table(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """A reader under a table's name."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def partitions_of_days(spark: SparkSession, path: str, column: str, last_day: str, days: int, schema: T.StructType | None = None) -> DataFrame:
    """The last ``days`` days up to ``last_day`` of a table partitioned by date; missing days are no error, other days aren't read."""
    r = spark.read.option("ignoreMissingFiles", True)
    df = (r.schema(schema) if schema is not None else r).parquet(path)
    end = F.to_date(F.lit(last_day))
    day = F.to_date(F.col(column).cast("string"))
    return df.where((day > F.date_sub(end, days)) & (day <= end))


def jdbc(spark: SparkSession, url: str, table: str, predicates: Sequence[str] | None = None, **properties: str) -> DataFrame:
    """A database table or ``(query) alias``, one task per predicate."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties) if predicates else spark.read.jdbc(url, table, properties=properties)


def sqlite(spark: SparkSession, file: str, query: str, schema: T.StructType | str, max_rows: int = 1_000_000) -> DataFrame:
    """Rows of a local SQLite query; a bounded lookup table, so more than ``max_rows`` is an error."""
    con = sqlite3.connect(file)
    try:
        rows = con.execute(query).fetchmany(max_rows + 1)
    finally:
        con.close()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows")
    return spark.createDataFrame(rows, schema)


def lookup_json(spark: SparkSession, text: str, schema: T.StructType | str) -> DataFrame:
    """A small service reply (JSON list of objects) as a table."""
    return spark.createDataFrame(json.loads(text), schema)


def nested_tuples(df: DataFrame, bag: str, mapping: str, sep: str = ",", kv: str = "#") -> DataFrame:
    """Text columns ``{(a),(b)}`` and ``[k#v,k#v]`` as an array and a map."""
    items = F.filter(F.transform(F.split(F.regexp_replace(bag, r"[{}()]", ""), sep), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumns({bag: items, mapping: F.str_to_map(F.regexp_replace(mapping, r"[\[\]]", ""), F.lit(sep), F.lit(kv))})


def cells(df: DataFrame, row: str, ttl_from: object | None = None) -> DataFrame:
    """Latest version of each ``row, cf, qualifier`` of ``(row, cf, qualifier, ts, value)``, cells older than ``ttl_from`` aside."""
    d = df.where(F.col("ts") >= ttl_from) if ttl_from is not None else df
    return d.groupBy(row, "cf", "qualifier").agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))
