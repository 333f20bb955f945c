"""Window operators: gaps, running figures, forward fill, islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import ensure_checkpoint_dir


def order_gaps(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """``gap``: days since the key's previous row, null for the first. Rows of one day follow each other with 0."""
    w = Window.partitionBy(*keys).orderBy(day)
    return df.withColumn("gap", F.datediff(F.col(day), F.lag(day).over(w)))


def running_totals(df: DataFrame, keys: Sequence[str], day: str, amount: str) -> DataFrame:
    """One row per key and day with the number and total of rows so far."""
    daily = df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_a"))
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(*keys, day, F.sum("_n").over(w).alias("frequency"), F.sum("_a").over(w).alias("monetary"))


def fill_forward(states: DataFrame, keys: Sequence[str], day: str, end: Column, out: str = "cal_date") -> DataFrame:
    """Each row repeated for every day until the key's next row or ``end``; rows after ``end`` are left out. Days must be unique per key."""
    w = Window.partitionBy(*keys).orderBy(day)
    last = F.least(F.coalesce(F.date_sub(F.lead(day).over(w), 1), end), end)
    return states.withColumn("_last", last).where(F.col(day) <= end).withColumn(out, F.explode(F.sequence(F.col(day), F.col("_last"), F.expr("interval 1 day")))).drop("_last")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The key's first row in ``order`` (give a full order for a fixed result)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def islands(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Runs of consecutive whole numbers: ``low, high, n`` and ``label`` (``low~high``, or the number alone). Repeats count once."""
    w = Window.partitionBy(*keys).orderBy(number)
    d = df.select(*keys, F.col(number)).where(F.col(number).isNotNull()).distinct().withColumn("_g", F.col(number) - F.row_number().over(w))
    g = d.groupBy(*keys, "_g").agg(F.min(number).alias("low"), F.max(number).alias("high"), F.count(F.lit(1)).alias("n")).drop("_g")
    return g.withColumn("label", F.when(F.col("low") == F.col("high"), F.col("low").cast("string")).otherwise(F.concat_ws("~", F.col("low").cast("string"), F.col("high").cast("string"))))


def missing_days(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """The days between a key's consecutive rows that have no row."""
    w = Window.partitionBy(*keys).orderBy(day)
    d = df.select(*keys, F.col(day)).distinct().withColumn("_p", F.lag(day).over(w)).where(F.datediff(F.col(day), F.col("_p")) > 1)
    return d.select(*keys, F.explode(F.sequence(F.date_add("_p", 1), F.date_sub(F.col(day), 1), F.expr("interval 1 day"))).alias("missing"))


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "row") -> DataFrame:
    """A global index from 0 in ``order``, without gathering the rows in one task; give a full order for a fixed result.

    The table is range-partitioned and sorted; a row's number in its partition is added to the sizes of the partitions
    before it (one row a partition). Sizes and rows come from the same sorted table, written once to the checkpoint
    folder, so no partition can be cut differently when it is read again.
    """
    ensure_checkpoint_dir(df.sparkSession)
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mono", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_mono", 33).alias("_part")
    sizes = parts.groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(w), F.lit(0)).alias("_off"))
    here = parts.withColumn("_part", F.shiftright("_mono", 33))
    return here.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_off") + F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_mono", "_off")


def roc_points(df: DataFrame, score: str, label: str, buckets: int = 256) -> DataFrame:
    """True and false positive rates at every distinct score, highest first; rows without score or label are left out.

    Exact for scores of any number and fineness: scores are combined, cut into ``buckets`` ranges by approximate
    quantiles, summed within each range in parallel, and raised by the totals of the ranges above (one row a range).
    """
    by = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias(score)).agg(F.sum(F.col(label)).alias("_p"), F.sum(1 - F.col(label)).alias("_n"))
    cuts = sorted(set(by.approxQuantile(score, [i / buckets for i in range(1, buckets)], 0.5 / buckets)))
    bucket = F.size(F.filter(F.lit(cuts).cast("array<double>"), lambda x: x <= F.col(score))) if cuts else F.lit(0)
    d = by.withColumn("_b", bucket)
    ranges = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    sums = d.groupBy("_b").agg(F.sum("_p").alias("_bp"), F.sum("_n").alias("_bn"))
    sums = sums.select("_b", F.coalesce(F.sum("_bp").over(ranges), F.lit(0)).alias("_up"), F.coalesce(F.sum("_bn").over(ranges), F.lit(0)).alias("_un"), F.sum("_bp").over(every).alias("_tp"), F.sum("_bn").over(every).alias("_tn"))
    inside = Window.partitionBy("_b").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rate = lambda own, up, whole: F.try_divide(F.sum(own).over(inside) + F.col(up), F.col(whole))
    return d.join(F.broadcast(sums), "_b").select(score, rate("_p", "_up", "_tp").alias("tpr"), rate("_n", "_un", "_tn").alias("fpr"))
