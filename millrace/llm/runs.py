"""Runs of consecutive equal events."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_COLUMNS = ["entity", "value", "n", "start", "end", "first_id", "last_id"]


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays agree, nulls with nulls."""
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


class _Stream:
    """The runs of a sorted partition, batch by batch; the one that may still go on is kept back."""

    def __init__(self) -> None:
        self.open: list[pa.Array] | None = None  # the columns of the run so far, one row
        self.place = 0  # runs given out

    def feed(self, entity: pa.Array, start: pa.Array, row_id: pa.Array, value: pa.Array) -> list[pa.Array] | None:
        """The runs that this batch closes."""
        before = [pa.concat_arrays([o, a[:-1]]) if self.open else a[:-1] for o, a in zip(self.open_ends(), (entity, start, row_id, value), strict=True)]
        skip = 0 if self.open else 1
        e, s, i, v = (np.concatenate((np.zeros(skip, bool), _same(a[skip:], b))) for a, b in zip((entity, start, row_id, value), before, strict=True))
        keep = np.flatnonzero(~(e & s & i))  # a row sent twice stands next to its copy
        if not len(keep):
            return None
        at = pa.array(keep)
        entity, start, row_id, value = (a.take(at) for a in (entity, start, row_id, value))
        # Copies may differ in their value; the one kept is compared with the row kept before it.
        v[keep[1:]] = _same(value[1:], value[:-1])
        if self.open:
            v[keep[0]] = _same(value[:1], self.open[1])[0]
        bound = np.flatnonzero(~(e & v)[keep])  # the events that differ from their predecessor
        ends = np.append(bound[1:], len(keep)) - 1  # the row before the next boundary
        head = bound[0] if len(bound) else len(keep)
        if head:
            o = self.open
            self.open = [o[0], o[1], pa.array([o[2][0].as_py() + int(head)], pa.int64()), o[3], start[head - 1 : head], o[5], row_id[head - 1 : head]]
        if not len(bound):
            return None
        first, last = pa.array(bound), pa.array(ends)
        runs = [entity.take(first), value.take(first), pa.array(ends - bound + 1, pa.int64()), start.take(first), start.take(last), row_id.take(first), row_id.take(last)]
        closed = [pa.concat_arrays([o, r[:-1]]) if self.open else r[:-1] for o, r in zip(self.open or runs, runs, strict=True)]
        self.open = [r[-1:] for r in runs]
        return closed

    def open_ends(self) -> list:
        o = self.open
        return [o[0], o[4], o[6], o[1]] if o else [None] * 4


def _local_runs(batches: Iterator[pa.RecordBatch], min_rows: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    stream, begun = _Stream(), False

    def give(cols: list[pa.Array], last: bool) -> pa.RecordBatch:
        nonlocal begun
        edge = np.zeros(len(cols[0]), bool)
        if len(edge) and not begun:
            edge[0] = begun = True
        if last:
            edge[-1] = True
        kept = pa.array(np.flatnonzero(edge | ((cols[2].to_numpy() >= min_rows) & ~cols[1].is_null().to_numpy(zero_copy_only=False))))
        return pa.RecordBatch.from_arrays([c.take(kept) for c in [*cols, pa.array(edge)]], names=names)

    for b in batches:
        if b.num_rows and (closed := stream.feed(*b.columns)) is not None and len(closed[0]):
            yield give(closed, False)
    if stream.open is not None:
        yield give(stream.open, True)


def _join_runs(df: DataFrame, keys: list[str], never: Column) -> DataFrame:
    """Collapses neighbours with the same ``value`` within ``keys``, in the order of ``start, first_id``.

    Input and output rows are runs (``value, n, start, end, first_id, last_id``); ``never`` marks rows that don't go
    on from their predecessor whatever their values. Only boundary rows stay, plus the last row of each partition:
    a boundary's successor tells where its run ends, and the difference of their positions how long it is.
    """
    w = Window.partitionBy(*keys).orderBy("start", "first_id")
    d = df.withColumns(
        {
            "_pos": F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_bound": never | ~F.coalesce(F.col("value").eqNullSafe(F.lag("value").over(w)), F.lit(False)) | F.lag("n").over(w).isNull(),
            "_pend": F.lag("end").over(w),
            "_pid": F.lag("last_id").over(w),
            "_final": F.lead("n").over(w).isNull(),
        }
    ).where("_bound or _final")
    after = lambda c: F.lead(c).over(w)
    d = d.withColumns({"_nb": after("_bound"), "_np": after("_pos"), "_npe": after("_pend"), "_npi": after("_pid"), "_nn": after("n"), "_ne": after("end"), "_ni": after("last_id")}).where("_bound")
    pick = lambda last, closed, tail: F.when(F.col("_nb").isNull(), last).when(F.col("_nb"), closed).otherwise(tail)
    return d.withColumns(
        {
            "n": pick(F.col("n"), F.col("_np") - F.col("_pos"), F.col("_np") - F.col("_pos") + F.col("_nn")),
            "end": pick(F.col("end"), F.col("_npe"), F.col("_ne")),
            "last_id": pick(F.col("last_id"), F.col("_npi"), F.col("_ni")),
        }
    )


def in_order(events: DataFrame, entity: str, instant: str, row_id: str, value: str) -> DataFrame:
    """``entity, start, id, value`` of the events that have an entity and an instant, in ranges of about equal size, sorted."""
    rows = events.select(F.col(entity).alias("entity"), F.col(instant).cast("bigint").alias("start"), F.col(row_id).alias("id"), F.col(value).alias("value")).where("entity is not null and start is not null")
    return rows.repartitionByRange("entity", "start", "id").sortWithinPartitions("entity", "start", "id", F.col("value").asc_nulls_last())


def collapse_runs(events: DataFrame, entity: str, instant: str, row_id: str, value: str, min_rows: int = 1) -> DataFrame:
    """One row per run of consecutive events with one value: ``entity, value, first_id, last_id, start, end, duration, n``.

    Each entity's events are ordered by ``instant`` (a whole number) and ``row_id``. A null value ends a run and
    belongs to none. Rows with a null entity or instant are left out; rows with the same entity, instant and
    ``row_id`` count once (with the least value that isn't null); an empty table gives no runs; other columns of
    ``events`` don't matter. Runs of fewer than ``min_rows`` rows are left out. ``entity``, ``row_id`` and ``value``
    are of plain types (numbers, texts).

    Events are sorted into ranges of about equal size, so an entity with a third of all rows, even within one day or
    one instant, is spread over as many tasks as it needs. Each range is read as a stream: rows that differ from
    their predecessor are boundaries, the next boundary's position gives the count and the row before it the end.
    Only the first and the last run of a range can go on elsewhere; those two meet their entity's others in a window,
    the rest is passed through it under a key of its own.
    """
    rows = in_order(events, entity, instant, row_id, value)
    kind = {f.name: f.dataType for f in rows.schema}
    out = T.StructType([T.StructField(c, {"n": T.LongType(), "end": kind["start"], "first_id": kind["id"], "last_id": kind["id"]}.get(c) or kind[c]) for c in _COLUMNS] + [T.StructField("edge", T.BooleanType())])
    names = out.fieldNames()
    local = rows.mapInArrow(lambda batches: _local_runs(batches, min_rows, names), out).withColumn("range", F.spark_partition_id()).withColumn("part", F.when(~F.col("edge"), F.col("range")))
    w = Window.partitionBy("entity", "part").orderBy("start", "first_id")
    met = _join_runs(local, ["entity", "part"], F.col("part").isNotNull() | F.coalesce(F.lag("range").over(w) == F.col("range"), F.lit(False)))
    return met.where((F.col("n") >= min_rows) & F.col("value").isNotNull()).select("entity", "value", "first_id", "last_id", "start", "end", (F.col("end") - F.col("start")).alias("duration"), "n")
