"""Samples and splits. Those by key hash are the same on every run and however the table is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_WHOLE = 1 << 40


def unit_hash(*keys: str, seed: int = 1) -> Column:
    """A number in [0, 1) by the keys' hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(_WHOLE)) / float(_WHOLE)


def split(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 1) -> list[DataFrame]:
    """Disjoint parts that make up the table, sized about by ``weights``; rows with equal keys go together."""
    total, low, out = sum(weights), 0.0, []
    u = unit_hash(*keys, seed=seed)
    for i, w in enumerate(weights):
        high = low + w / total
        out.append(df.where((u >= low) & (u < high)) if i < len(weights) - 1 else df.where(u >= low))
        low = high
    return out


def sample_keys(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """All rows of ``n`` distinct keys (all, if fewer), those of least hash; a null key is none."""
    chosen = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(unit_hash(key, seed=seed), key).limit(n)
    return df.join(chosen, key, "left_semi")


def stratified(df: DataFrame, stratum: str, fractions: dict, seed: int = 1) -> DataFrame:
    """About the given fraction of each stratum's rows; strata not named give none."""
    return df.stat.sampleBy(stratum, fractions, seed)


def exactly(df: DataFrame, keys: Sequence[str], n: int, seed: int = 1) -> DataFrame:
    """``n`` rows without replacement, those of least hash of ``keys`` (a full key)."""
    return df.orderBy(unit_hash(*keys, seed=seed), *keys).limit(n)


def with_replacement(df: DataFrame, fraction: float, seed: int = 1) -> DataFrame:
    return df.sample(True, fraction, seed)


def modes(df: DataFrame, column: str) -> DataFrame:
    """The commonest values of a column, all that tie."""
    g = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = g.agg(F.max("n").alias("n"))
    return g.join(F.broadcast(top), "n").select(column, "n")  # top is one row


def repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that come more than once."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def joined_counts(df: DataFrame, key: str, label: str) -> DataFrame:
    """``label;count`` pairs of each key in one text, by label."""
    c = df.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.transform(F.array_sort(F.collect_list(F.struct(F.col(label).cast("string").alias("l"), "n"))), lambda x: F.concat_ws(";", x["l"], x["n"].cast("string")))
    return c.groupBy(key).agg(F.concat_ws(",", pairs).alias("counts"))


def price_steps(spark, price: float, most: int) -> DataFrame:
    """Tenths of a litre up to ``most`` litres at which the rounded price jumps by 2 or more, with the price."""
    d = spark.range(1, most * 10 + 1).select((F.col("id") / 10).alias("litres")).withColumn("total", F.round(F.col("litres") * price).cast("bigint"))
    before = F.round((F.col("litres") - 0.1) * price).cast("bigint")
    return d.withColumn("jump", F.col("total") - before).where("jump >= 2")


def running_rank(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Each row's place within its key and the key's size."""
    w = Window.partitionBy(key)
    return df.withColumns({"place": F.row_number().over(w.orderBy(*order)), "of": F.count(F.lit(1)).over(w)})
