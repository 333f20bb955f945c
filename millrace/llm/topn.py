"""The first N rows of every group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def score_bin(score: Column, per_doubling: int = 8) -> Column:
    """A whole number that never falls as the score rises; at most a few thousand values for any score."""
    size = F.floor(F.log2(F.abs(score.cast("double")) + 1) * per_doubling)
    return F.when(score >= 0, size).otherwise(-size).cast("int")


def top_n(df: DataFrame, groups: list[str], score: str, ties: list[Column], n: int, distinct: bool = False, salts: int = 32) -> DataFrame:
    """The first ``n`` rows (all, if fewer) of each group by ``score`` descending, then ``ties``, with their ``rank``.

    Rows with a null score are left out; null group keys form a group of their own; ``ties`` should order rows with
    one score fully, else which of them comes first isn't fixed; repeated rows count each, with ``distinct`` once; an
    empty table gives no rows; all columns of ``df`` come back, but one named ``rank`` is replaced.

    All rows are shuffled once, each group over ``salts`` (at most 60) places by a hash of the row, so a group with a
    third of all rows is spread, and equal rows meet. A histogram of each group's scores, counted in those places and
    then combined, gives the highest bin from which at least ``n`` rows remain; it goes back to just the places that
    hold the group. Rows below it are dropped where they are; only the rest is ranked, and of that each task sends on
    at most ``n`` rows a group.
    """
    p = "_"
    while any(c.lower().startswith(p) for c in df.columns):
        p += "_"
    bin_, n_, above, cut_, salt, places, key = (f"{p}{x}" for x in ("bin", "n", "above", "cut", "salt", "places", "key"))
    own = [f"`{c}`" for c in df.columns]
    # The key is a hash without nulls, so both sides of the join are partitioned as the rows already are.
    spread = df.where(F.col(score).isNotNull()).withColumns({key: F.xxhash64(*groups), salt: F.coalesce(F.pmod(F.xxhash64(*own), F.lit(salts)).cast("int"), F.lit(0))}).repartition(key, salt)
    scored = (spread.distinct() if distinct else spread).withColumn(bin_, F.coalesce(score_bin(F.col(score)), F.lit(0)))
    w = Window.partitionBy(key, *groups).orderBy(F.desc(bin_))
    cut = (
        scored.groupBy(key, salt, *groups, bin_)
        .agg(F.count(F.lit(1)).alias(n_))
        .groupBy(key, *groups, bin_)
        .agg(F.sum(n_).alias(n_), F.bit_or(F.expr(f"shiftleft(1L, {salt})")).alias(places))
        .withColumn(above, F.sum(n_).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(key, *groups)
        .agg(F.coalesce(F.max(F.when(F.col(above) >= n, F.col(bin_))), F.min(bin_)).alias(cut_), F.bit_or(places).alias(places))
        .select(F.col(key).alias(f"{p}k"), *[F.col(g).alias(f"{p}g{i}") for i, g in enumerate(groups)], F.coalesce(cut_, F.lit(0)).alias(cut_), F.explode(F.expr(f"filter(sequence(0, {salts - 1}), x -> getbit({places}, x) = 1)")).alias(f"{p}s"))
    )
    same = (F.col(key) == F.col(f"{p}k")) & (F.col(salt) == F.col(f"{p}s"))
    for i, g in enumerate(groups):
        there = F.col(f"{p}g{i}")
        same &= F.coalesce(F.col(g) == there, F.col(g).isNull() & there.isNull())
    left = scored.join(cut, same & (F.col(bin_) >= F.col(cut_))).select(*df.columns)
    order = Window.partitionBy(*groups).orderBy(F.desc(score), *ties)
    return left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
