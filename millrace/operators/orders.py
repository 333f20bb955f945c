"""The one reading of the member orders that features and rolling totals share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.parse import clean_path, clean_text, parse_day

#: Amounts are summed as whole numbers of this many parts, so sums don't depend on the order of rows.
AMOUNT_PARTS = 10_000


def clean_orders(df: DataFrame) -> DataFrame:
    """``so_id, shop_id, member_id, day (days since 1970), amount_parts`` of complete orders, an ``so_id`` once.

    Orders without number, shop, member, date or amount (null, empty, -999 and the like) are left out. Where copies
    of an order differ, the least in the order of these columns counts, so the result doesn't depend on row order.
    """
    rows = df.select(
        F.col("so_id"),
        clean_path(F.col("shop_id")).alias("shop_id"),
        clean_text(F.col("member_id")).alias("member_id"),
        F.unix_date(parse_day(F.col("so_date"))).alias("day"),
        F.when((F.col("amount") != -999) & ~F.isnan("amount"), F.round(F.col("amount") * AMOUNT_PARTS)).cast("bigint").alias("amount_parts"),
    ).dropna()
    return rows.groupBy("so_id").agg(F.min(F.struct("shop_id", "member_id", "day", "amount_parts")).alias("o")).select("so_id", "o.*")
