"""Trailing totals by block decomposition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

#: How many days of its points an entity sends to one place, in multiples of the widest window.
STRETCH = 4
_SLICE = 100_000


def trailing(seg: np.ndarray, day: np.ndarray, figures: Sequence[np.ndarray], at_seg: np.ndarray, at_day: np.ndarray, width: int) -> list[np.ndarray]:
    """Of each figure its total over the ``width`` days that end at each asked day.

    Days, sorted within ``seg``, are cut into blocks of ``width``; sums run forth (prefixes) and back (suffixes) inside
    each block. A total is the prefix up to the asked day in its own block and the suffix of the block before.
    """
    if not len(seg) or not len(at_seg):
        return [np.zeros(len(at_seg), np.int64) for _ in figures]
    low = min(int(day.min()), int(at_day.min())) - width
    span = max(int(day.max()), int(at_day.max())) - low + 3
    key = seg * span + (day - low)
    block = seg * span + day // width - low // width
    own = at_seg * span + at_day // width - low // width
    fresh = np.append(True, block[1:] != block[:-1])
    starts, which = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    ends = np.append(starts[1:], len(block)) - 1
    upto = np.searchsorted(key, at_seg * span + (at_day - low), "right") - 1
    since = np.searchsorted(key, at_seg * span + (at_day - width + 1 - low), "left")
    has_prefix = (upto >= 0) & (block[np.maximum(upto, 0)] == own)
    has_suffix = (since < len(block)) & (block[np.minimum(since, len(block) - 1)] == own - 1)
    out = []
    for f in figures:
        c = np.cumsum(f)
        prefix = c - (c[starts] - f[starts])[which]
        suffix = c[ends][which] - c + f
        out.append(np.where(has_prefix, prefix[np.maximum(upto, 0)], 0) + np.where(has_suffix, suffix[np.minimum(since, len(block) - 1)], 0))
    return out


class _Stream:
    """The figures of the current entity that later days may still need, over batches sorted by entity, stretch and day."""

    def __init__(self, widest: int) -> None:
        self.widest = widest
        self.key: tuple | None = None
        self.kept = [np.zeros(0, np.int64)] * 3  # day, total, n
        self.pending: tuple | None = None  # the last figure's entity (one row) and day

    def segments(self, entity: pa.Array, stretch: np.ndarray) -> tuple[np.ndarray, bool]:
        """A number for each (entity, stretch), and if the first one goes on from the batch before."""
        goes_on = self.key == (entity[0].as_py(), int(stretch[0]))
        fresh = np.zeros(len(entity), np.int64)
        if len(entity) > 1:
            fresh[1:] = ~pc.equal(entity[1:], entity[:-1]).to_numpy(zero_copy_only=False) | (stretch[1:] != stretch[:-1])
        self.key = (entity[len(entity) - 1].as_py(), int(stretch[-1]))
        return np.cumsum(fresh), goes_on

    def figures(self, seg: np.ndarray, goes_on: bool, rows: list[np.ndarray], real: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """All figures that the batch's days may need, with their segment; keeps those of the last one for the next batch."""
        at = np.flatnonzero(real)
        old = self.kept if goes_on else [x[:0] for x in self.kept]
        all_seg = np.append(np.zeros(len(old[0]), np.int64), seg[at])
        merged = [np.append(o, r[at]) for o, r in zip(old, rows, strict=True)]
        last = (all_seg == seg[-1]) & (merged[0] > rows[0][-1] - 2 * self.widest)
        self.kept = [m[last] for m in merged]
        return all_seg, merged


def _column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


def _numbers(b: pa.RecordBatch, name: str) -> np.ndarray:
    return _column(b, name).to_numpy(zero_copy_only=False).astype(np.int64)


def _at_points(batches: Iterator[pa.RecordBatch], widths: Sequence[int], names: list[str]) -> Iterator[pa.RecordBatch]:
    state = _Stream(max(widths))
    for b in batches:
        if not b.num_rows:
            continue
        day, asked = _numbers(b, "day"), _numbers(b, "asked") == 1
        seg, goes_on = state.segments(_column(b, "entity"), _numbers(b, "stretch"))
        all_seg, (days, total, n) = state.figures(seg, goes_on, [day, _numbers(b, "total"), _numbers(b, "n")], ~asked)
        at = np.flatnonzero(asked)
        if len(at):
            got = [x for w in widths for x in trailing(all_seg, days, (total, n), seg[at], day[at], w)]
            kept = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([_column(kept, c) for c in ("entity", "day", "payload")] + [pa.array(x) for x in got], names=names)


def _all_days(batches: Iterator[pa.RecordBatch], widths: Sequence[int], names: list[str]) -> Iterator[pa.RecordBatch]:
    state = _Stream(max(widths))
    last = 0

    def given(entity: pa.Array, seg: np.ndarray, start: np.ndarray, size: np.ndarray, known: tuple) -> Iterator[pa.RecordBatch]:
        """Totals for ``size`` days from each ``start`` on."""
        bounds = np.append(0, np.cumsum(size))
        for lo in range(0, int(bounds[-1]), _SLICE):
            place = np.arange(lo, min(lo + _SLICE, int(bounds[-1])))
            row = np.searchsorted(bounds, place, "right") - 1
            day = start[row] + place - bounds[row]
            who = entity.take(pa.array(row))
            for w in widths:
                total, n = trailing(known[0], known[1], known[2:], seg[row], day, w)
                yield pa.RecordBatch.from_arrays([who, pa.array(day.astype(np.int32)), pa.array(np.full(len(day), w, np.int32)), pa.array(total), pa.array(n)], names=names)

    for b in batches:
        if not b.num_rows:
            continue
        last = int(_numbers(b, "last")[0])
        day, entity = _numbers(b, "day"), _column(b, "entity")
        before, kept = state.pending, state.kept
        seg, goes_on = state.segments(entity, np.zeros(len(day), np.int64))
        all_seg, known = state.figures(seg, goes_on, [day, _numbers(b, "total"), _numbers(b, "n")], np.ones(len(day), bool))
        if before is not None:  # the days that follow the last figure of the batch before
            upto = day[0] if goes_on else last + 1
            yield from given(before[0], np.zeros(1, np.int64), np.array([before[1]]), np.array([upto - before[1]]), (np.zeros(len(kept[0]), np.int64), *kept))
        until = np.where(seg[1:] == seg[:-1], day[1:], last + 1)
        yield from given(entity[:-1], seg[:-1], day[:-1], until - day[:-1], (all_seg, *known))
        state.pending = (entity[len(entity) - 1 :], int(day[-1]))
    if state.pending is not None:
        who, day = state.pending
        yield from given(who, np.zeros(1, np.int64), np.array([day]), np.array([last + 1 - day]), (np.zeros(len(state.kept[0]), np.int64), *state.kept))


def _daily(events: DataFrame, entity: str, day: str, amount: str) -> DataFrame:
    """Totals and counts by entity and day, combined before the shuffle: no entity is larger than its days."""
    d = events.select(F.col(entity).alias("entity"), F.col(day).cast("int").alias("day"), F.col(amount).cast("bigint").alias("amount"))
    return d.where("entity is not null and day is not null").groupBy("entity", "day").agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("n"))


def trailing_at(events: DataFrame, points: DataFrame, entity: str, day: str, amount: str, widths: Sequence[int]) -> DataFrame:
    """``entity, day, payload`` of each point, and ``total_<width>, n_<width>`` over the days up to and including its day.

    ``points`` has the columns ``entity`` and ``day``; all its columns come back in the struct ``payload``. Totals are in
    the units of ``amount``, whole numbers; without any event they are 0. Points without entity or day give no row;
    repeated points give a row each; otherwise as ``rolling_totals``.

    One shuffle serves all widths: points are sorted in among the daily figures and answered as the sorted rows pass,
    with no more kept than two windows of an entity. An entity's rows are spread by stretches of days, figures near
    the end of one going to the next too, so an entity with a third of all points does not meet in one task.
    """
    widest = max(widths)
    size = STRETCH * widest
    stretch = F.floor(F.col("day") / size).cast("int")
    asked = points.select(F.col(entity).alias("entity"), F.col(day).cast("int").alias("day"), F.struct(*[F.col(c) for c in points.columns]).alias("payload")).where("entity is not null and day is not null")
    asked = asked.select("entity", stretch.alias("stretch"), "day", F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("n"), F.lit(1).alias("asked"), "payload")
    near = F.when(F.pmod("day", F.lit(size)) > size - widest, F.array(stretch, stretch + 1)).otherwise(F.array(stretch))
    daily = _daily(events, entity, day, amount).select("entity", F.explode(near).alias("stretch"), "day", "total", "n", F.lit(0).alias("asked"), F.lit(None).cast(asked.schema["payload"].dataType).alias("payload"))
    out = T.StructType([T.StructField("entity", asked.schema["entity"].dataType), T.StructField("day", T.IntegerType()), T.StructField("payload", asked.schema["payload"].dataType)] + [T.StructField(f"{x}_{w}", T.LongType()) for w in widths for x in ("total", "n")])
    names = out.fieldNames()
    return daily.unionByName(asked).repartition("entity", "stretch").sortWithinPartitions("entity", "stretch", "day", "asked").mapInArrow(lambda b: _at_points(b, widths, names), out)


def rolling_totals(events: DataFrame, entity: str, day: str, amount: str, widths: int | Sequence[int], points: DataFrame | None = None, parts: int = 1) -> DataFrame:
    """``entity, day, width, total, average, n`` over the ``width`` days up to and including each day, for each of ``widths``.

    ``day`` is in days since 1970, ``amount`` whole numbers of ``1/parts``; ``average`` is the total divided by
    ``width``. With ``points`` (columns ``entity`` and ``day``) rows come for just those days, days without any
    event included; without it, for every entity's every day from its first event to the last day of the table.
    Rows without entity or day are left out; a null amount counts as an event of amount 0; repeated rows count
    each; an empty table gives no rows (with points: zeros).

    Days are cut into blocks as long as the window; every total is one suffix of a block plus one prefix of the next.
    Daily figures are shuffled once for all widths and read as sorted streams, so neither wide windows nor long
    histories need more memory than two windows of one entity.
    """
    widths = [widths] if isinstance(widths, int) else list(widths)
    if points is not None:
        days = points.select(F.col(entity).alias(entity), F.col(day).cast("int").alias(day)).distinct()
        got = trailing_at(events, days, entity, day, amount, widths)
        each = F.explode(F.array(*[F.struct(F.lit(w).alias("width"), F.col(f"total_{w}").alias("sum"), F.col(f"n_{w}").alias("n")) for w in widths]))
        got = got.select("entity", "day", each.alias("x")).select("entity", "day", "x.*")
    else:
        daily = _daily(events, entity, day, amount)
        out = T.StructType([T.StructField("entity", daily.schema["entity"].dataType), T.StructField("day", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("sum", T.LongType()), T.StructField("n", T.LongType())])
        names = out.fieldNames()
        whole = daily.withColumn("last", daily.agg(F.max("day")).scalar())
        got = whole.repartition("entity").sortWithinPartitions("entity", "day").mapInArrow(lambda b: _all_days(b, widths, names), out)
    return got.select("entity", "day", "width", (F.col("sum") / parts).alias("total"), (F.col("sum") / parts / F.col("width")).alias("average"), "n")
