"""Aggregates and roll-ups that are more than one call."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import combinations, combinations_with_replacement

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.scalar import path_prefixes

SENTINEL = -999


def prefix_rollup(df: DataFrame, path: str, aggs: list[Column], sep: str = "^") -> DataFrame:
    """Aggregates for every prefix of a hierarchical key (store, store and branch, ...). Partial sums are combined by whole path first."""
    return df.withColumn("prefix", F.explode(path_prefixes(F.col(path), sep))).groupBy("prefix").agg(*aggs)


def powerset_rollup(df: DataFrame, keys: Sequence[str], aggs: list[Column]) -> DataFrame:
    """Aggregates for every non-empty subset of ``keys``; a key outside the subset is null and ``subset`` names those inside."""
    ids = [F.when(F.grouping(k) == 0, F.lit(k)) for k in keys]
    return df.cube(*keys).agg(F.concat_ws("+", *ids).alias("subset"), *aggs).where(F.col("subset") != "")


def combination_counts(df: DataFrame, keys: Sequence[str], size: int = 2) -> DataFrame:
    """Row counts for every combination of ``size`` of the keys, in one pass by grouping sets."""
    sets = [list(c) for c in combinations(keys, size)]
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(F.concat_ws("+", *[F.when(F.grouping(k) == 0, F.lit(k)) for k in keys]).alias("keys"), F.count(F.lit(1)).alias("n"))


def mean_std(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``n, mean, sd`` per key with the variance ``sum(x^2) / (n - 1) - mean^2``; nulls are skipped; mean and sd are -999 for fewer than two values."""
    x = F.col(value).cast("double")
    g = df.where(x.isNotNull()).groupBy(*keys).agg(F.count(x).alias("n"), F.sum(x).alias("_s"), F.sum(x * x).alias("_q"))
    many = F.col("n") > 1
    mean = F.col("_s") / F.col("n")
    return g.select(*keys, "n", F.when(many, mean).otherwise(float(SENTINEL)).alias("mean"), F.when(many, F.sqrt(F.greatest(F.try_divide(F.col("_q"), F.col("n") - 1) - mean * mean, F.lit(0.0)))).otherwise(float(SENTINEL)).alias("sd"))


def percentile_table(df: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int] = tuple(range(1, 100)), mode: str = "all", ceil: bool = False) -> DataFrame:
    """Nearest-rank percentiles: the value at rank ``floor(p * (n - 1) / 100) + 1`` of each key's values, rounded to 4 places.

    ``mode`` "all" ranks all rows and takes p in 1..100; "distinct" ranks distinct values and gives each rank only
    its largest p. ``ceil`` rounds values up to whole numbers. Other p raise ValueError. Values are combined per key
    before ranking, so a key's window holds its distinct values, with their counts.
    """
    top = 100 if mode == "all" else 99
    if any(not 1 <= p <= top for p in percents) or mode not in ("all", "distinct"):
        raise ValueError("percents out of range or unknown mode")
    v = F.round(F.col(value).cast("double"), 4)
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, (F.ceil(v).cast("double") if ceil else v).alias("value")).agg(F.count(F.lit(1)).alias("_c"))
    if mode == "distinct":
        counted = counted.withColumn("_c", F.lit(1).cast("bigint"))
    w = Window.partitionBy(*keys).orderBy("value")
    ranked = counted.withColumns({"_hi": F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)), "_n": F.sum("_c").over(Window.partitionBy(*keys))})
    rank = F.floor(F.col("p") * (F.col("_n") - 1) / 100) + 1
    out = ranked.withColumn("p", F.explode(F.array(*[F.lit(int(p)) for p in percents]))).where((rank > F.col("_hi") - F.col("_c")) & (rank <= F.col("_hi")))
    if mode == "distinct":
        return out.groupBy(*keys, "value").agg(F.max("p").alias("p")).select(*keys, F.col("p").cast("bigint").alias("p"), "value")
    return out.select(*keys, F.col("p").cast("bigint").alias("p"), "value")


def high_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``mean`` (rounded to 6 places) and ``high_mean``, the mean of values not below it."""
    x = F.col(value).cast("double")
    mean = df.groupBy(*keys).agg(F.round(F.avg(x), 6).alias("mean"))
    return df.join(mean, list(keys)).groupBy(*keys).agg(F.first("mean").alias("mean"), F.avg(F.when(x >= F.col("mean"), x)).alias("high_mean"))


def pareto_tags(df: DataFrame, keys: Sequence[str], value: str, name: str = "") -> DataFrame:
    """Each row with ``tag``: ``name`` and H at or above the high mean, M at or above the mean, else L."""
    x = F.col(value).cast("double")
    return df.join(high_mean(df, keys, value), list(keys)).withColumn("tag", F.concat(F.lit(name), F.when(x >= F.col("high_mean"), "H").when(x >= F.col("mean"), "M").otherwise("L")))


def pearson(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Correlation per key over rows that have both; null where it is not defined."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = both.groupBy(*keys) if keys else both.groupBy()
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return g.agg(F.count(F.lit(1)).alias("n"), F.corr(a, b).alias("r"))


def correlation_pairs(df: DataFrame, columns: Sequence[str], least: float = 0.0) -> DataFrame:
    """Every pair of columns with its correlation and t value, in one aggregate; pairs below ``least`` in size are left out."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)], F.count(F.lit(1)).alias("n"))
    rows = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    out = one.select("n", F.explode(rows).alias("p")).select("p.*", "n")
    return out.where(F.abs("r") >= least).withColumn("t", F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r"))))


def near_zero_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, variance`` (sample) of numeric columns, in one aggregate."""
    one = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("variance")) for c in columns])).alias("x")).select("x.*")


def entropy(df: DataFrame, column: str) -> DataFrame:
    """Shannon entropy in bits of a column's distribution; nulls are a value of their own."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("c"))
    whole = counts.agg(F.sum("c").alias("t"), F.sum(F.col("c") * F.log2(F.col("c").cast("double"))).alias("w"))
    return whole.select((F.log2(F.col("t").cast("double")) - F.col("w") / F.col("t")).alias("entropy"))


def argmax(df: DataFrame, keys: Sequence[str], pick: str, by: str) -> DataFrame:
    """Per key the ``pick`` of the largest ``by``; of ties the least ``pick``."""
    best = df.groupBy(*keys, F.col(pick).alias("_p")).agg(F.max(by).alias("_b"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_b"), "_p")
    return best.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*keys, F.col("_p").alias(pick), F.col("_b").alias(by))


def split_good_bad(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """The rows for which ``good`` holds and the others (false or null)."""
    ok = F.coalesce(good, F.lit(False))
    return df.where(ok), df.where(~ok)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def hour_pivot(df: DataFrame, key: str, hour: Column, value: Column | None = None) -> DataFrame:
    """One row per key with 24 columns ``h00..h23``, 0 where there is nothing."""
    out = [F.coalesce(F.sum(F.when(F.col("_h") == h, F.col("_v"))), F.lit(0)).cast("bigint").alias(f"h{h:02d}") for h in range(24)]
    return df.select(F.col(key), hour.alias("_h"), (value if value is not None else F.lit(1)).alias("_v")).groupBy(key).agg(*out)


def covariances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``x, y, covariance`` (population) of every pair of columns, each with itself too, in one aggregate over rows without nulls."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.dropna(subset=list(columns)).agg(*[F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("covariance")) for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(rows).alias("p")).select("p.*")


def standardised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with mean 0 and population deviation 1 in place of the given ones; 0 where there is no spread."""
    one = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    scaled = {c: (F.col(c) - F.lit(one[f"m{i}"])) / F.lit(one[f"s{i}"]) if one[f"s{i}"] else F.when(F.col(c).isNotNull(), 0.0) for i, c in enumerate(columns)}
    return df.withColumns(scaled)


def matrix_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """``i, j, v`` of the product of two matrices held as cells ``i, j, v``; cells that are 0 need not be there."""
    right = b.select(F.col("i").alias("k"), F.col("j").alias("_j"), F.col("v").alias("_v"))
    return a.select("i", F.col("j").alias("k"), "v").join(right, "k").groupBy("i", F.col("_j").alias("j")).agg(F.sum(F.col("v") * F.col("_v")).alias("v"))


def transposed(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def beside(a: DataFrame, b: DataFrame, order_a: Sequence[Column], order_b: Sequence[Column]) -> DataFrame:
    """The rows of two tables side by side by their places in the given orders; the shorter one is filled with nulls."""
    from millrace.operators.windows import row_numbers

    return row_numbers(a, order_a, "_at").join(row_numbers(b, order_b, "_at"), "_at", "full").withColumnRenamed("_at", "place")


def merged_lines(a: DataFrame, b: DataFrame, line: str, keys: tuple[Sequence[int], Sequence[int]], values: tuple[Sequence[int], Sequence[int]], sep: str = "\t") -> DataFrame:
    """``line``: lines of two folders with the same key fields made one: the key, then the chosen fields of each (positions from 1). Lines without a partner are left out."""
    cut = lambda df, k, v, n: df.select(F.split(line, F.lit("\\Q" + sep + "\\E")).alias("f")).select(F.concat_ws(sep, *[F.get("f", F.lit(i - 1)) for i in k]).alias("_k"), F.concat_ws(sep, *[F.get("f", F.lit(i - 1)) for i in v]).alias(n))
    both = cut(a, keys[0], values[0], "_a").join(cut(b, keys[1], values[1], "_b"), "_k")
    return both.select(F.concat_ws(sep, "_k", "_a", "_b").alias(line))


def streamed_sorted(df: DataFrame, keys: Sequence[str], order: Sequence[Column], f: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Secondary sort: rows of one key come to one task, sorted by key and ``order``, and pass ``f`` as a stream of frames; nothing is held but what ``f`` keeps."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(f, schema)
