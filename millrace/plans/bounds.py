"""Broadcast only behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 50_000, max_bytes: int = 16 << 20) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows and ``max_bytes`` bytes (as text), else ``df`` as it is (a shuffled join follows).

    The check reads at most ``max_rows + 1`` rows of ``df``; use it on tables that are cheap to read.
    """
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """All rows of ``df`` on the driver, or a ValueError if there are more than ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; raise the bound or split it")
    return rows
