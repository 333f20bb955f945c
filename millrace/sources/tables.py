"""Tables over folders: external and managed ones, loaded data, partitions by date, bucketed inserts, versioned cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_external(spark: SparkSession, name: str, path: str, columns: str, partitioned_by: Sequence[str] = (), fmt: str = "parquet", **options: str) -> DataFrame:
    """A table over a folder, which dropping the table leaves alone. Partitions are known once added (``add_partition``) or found (``find_partitions``)."""
    opts = f" OPTIONS ({', '.join(f'{k!r} {v!r}' for k, v in options.items())})" if options else ""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} ({columns}) USING {fmt}{opts}{parts} LOCATION '{path}'")
    return spark.table(name)


def add_partition(spark: SparkSession, name: str, values: dict[str, str], path: str) -> None:
    """Makes a folder a partition; one that is there already is left as it is."""
    spec = ", ".join(f"{k} = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {_q(name)} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{path}'")


def find_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {_q(name)}")


def load_data(spark: SparkSession, name: str, path: str, fmt: str = "parquet", overwrite: bool = False, **options: str) -> None:
    """Puts the rows of files into a table, by position, checked against its columns; partitions follow from the rows."""
    rows = spark.read.options(**options).schema(spark.table(name).schema).format(fmt).load(path)
    rows.write.insertInto(name, overwrite=overwrite)


def create_bucketed(spark: SparkSession, name: str, like: DataFrame, path: str, bucket_by: Sequence[str], buckets: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """An empty table whose inserts are bucketed (and partitioned by what the rows say), so that joins on the bucket columns need no shuffle."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} ({columns}) USING parquet{parts} CLUSTERED BY ({', '.join(bucket_by)}) SORTED BY ({', '.join(bucket_by)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def insert_bucketed(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Inserts by name into a bucketed table; with ``overwrite`` only the partitions that the rows bring are replaced."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=overwrite)
    finally:
        spark.conf.set(mode, before)


def tables_of(spark: SparkSession, database: str = "default") -> DataFrame:
    """``name, kind, temporary`` of the catalog's tables."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, kind string, temporary boolean")


def find(df: DataFrame, query: dict) -> DataFrame:
    """Rows that meet a document query: values, or ``{"$gt": x}`` and the like (``$gte $lt $lte $ne $in $exists``); ``$or`` takes a list of queries."""
    ops = {"$gt": Column.__gt__, "$gte": Column.__ge__, "$lt": Column.__lt__, "$lte": Column.__le__, "$ne": lambda c, v: ~c.eqNullSafe(F.lit(v)), "$in": lambda c, v: c.isin(*v), "$exists": lambda c, v: c.isNotNull() if v else c.isNull()}

    def test(q: dict) -> Column:
        out = F.lit(True)
        for name, want in q.items():
            if name == "$or":
                alt = F.lit(False)
                for x in want:
                    alt |= test(x)
                out &= alt
            elif isinstance(want, dict):
                for op, v in want.items():
                    out &= ops[op](F.col(name), v)
            else:
                out &= F.col(name).isNull() if want is None else F.col(name) == want
        return out

    return df.where(test(query))


def put_cells(df: DataFrame, path: str) -> None:
    """Adds versions of cells (``row, family, qualifier, ts, value``); nothing is rewritten."""
    df.select("row", "family", "qualifier", "ts", "value").write.mode("append").parquet(path)


def get_cells(spark: SparkSession, path: str, row: str | None = None, low: str | None = None, high: str | None = None, versions: int = 1, since: object | None = None) -> DataFrame:
    """The latest ``versions`` of each cell of one row, or of the rows from ``low`` to before ``high``; cells older than ``since`` are gone. Keys reach the scan as filters."""
    d = spark.read.parquet(path)
    for use, cond in ((row, F.col("row") == row), (low, F.col("row") >= low), (high, F.col("row") < high), (since, F.col("ts") >= since)):
        if use is not None:
            d = d.where(cond)
    w = Window.partitionBy("row", "family", "qualifier").orderBy(F.desc("ts"), F.desc("value"))
    return d.withColumn("version", F.row_number().over(w)).where(F.col("version") <= versions)
