"""Column profiles in one to three dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def parse_spec(spec: str) -> list[tuple[int, str, str]]:
    """``idx:name:N|C,...`` as (index, name, type). Other types, missing parts and doubled names raise ValueError."""
    out = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        bits = part.split(":")
        if len(bits) != 3 or not bits[0].strip().isdigit() or bits[2] not in ("N", "C"):
            raise ValueError(f"not idx:name:N|C: {part!r}")
        out.append((int(bits[0]), bits[1], bits[2]))
    if len({n for _, n, _ in out}) != len(out):
        raise ValueError("a name comes twice")
    return out


def select_spec(df: DataFrame, spec: str) -> DataFrame:
    """The columns of a spec by position (from 0), numeric ones as double (null where they are no number)."""
    cols = df.columns
    return df.select(*[(F.col(f"`{cols[i]}`").try_cast("double") if kind == "N" else F.col(f"`{cols[i]}`")).alias(name) for i, name, kind in parse_spec(spec)])


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n, total, mean, sd (population), low, high`` of all columns from one aggregate; all null but ``n`` for empty ones."""
    stats = lambda c: F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.sum(F.col(c).cast("double")).alias("total"), F.avg(F.col(c).cast("double")).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("sd"), F.min(F.col(c).cast("double")).alias("low"), F.max(F.col(c).cast("double")).alias("high"))
    return df.agg(*[stats(c).alias(c) for c in columns]).select(F.explode(F.array(*columns)).alias("x")).select("x.*")


def profile_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, n`` of all columns, in one pass by grouping sets; nulls are a value."""
    name = F.concat_ws("", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in columns])
    value = F.coalesce(*[F.when(F.grouping(c) == 0, F.col(c).cast("string")) for c in columns])
    return df.groupingSets([[F.col(c)] for c in columns], *columns).agg(name.alias("column"), value.alias("value"), F.count(F.lit(1)).alias("n")).select("column", "value", "n")


def profile_2d(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def profile_3d(df: DataFrame, a: str, b: str, value: str) -> DataFrame:
    x = F.col(value).cast("double")
    return df.groupBy(a, b).agg(F.count(x).alias("n"), F.sum(x).alias("total"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("sd"), F.min(x).alias("low"), F.max(x).alias("high"))


def nested_json(profile: DataFrame, a: str, b: str, cells: Sequence[str]) -> DataFrame:
    """One JSON document per value of ``a``: value of ``b`` to its cells. Null keys are written ``null``."""
    key = F.coalesce(F.col(b).cast("string"), F.lit("null"))
    return profile.groupBy(a).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key.alias("key"), F.struct(*cells).alias("value")))))).alias("json"))
