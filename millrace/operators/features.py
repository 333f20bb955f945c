"""Wide feature rows per entity, streamed from sorted buckets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

_NEVER = -(2**31)


class _Counters:
    """Running count, total, first and latest day of each (entity, kind) over batches that come sorted by entity, kind, day and ``probe``."""

    def __init__(self) -> None:
        self.key: tuple | None = None
        self.carry = (0, 0, _NEVER, _NEVER)

    def feed(self, entity: pa.Array, kind: pa.Array, day: np.ndarray, n: np.ndarray, total: np.ndarray, event: np.ndarray) -> tuple[np.ndarray, ...]:
        size = len(day)
        fresh = np.ones(size, bool)
        if size > 1:
            same = pc.and_(pc.equal(entity[1:], entity[:-1]), pc.equal(kind[1:], kind[:-1]))
            fresh[1:] = ~same.to_numpy(zero_copy_only=False)
        goes_on = self.key == (entity[0].as_py(), kind[0].as_py())
        starts = np.flatnonzero(fresh)
        segment = np.cumsum(fresh) - 1
        carry = self.carry if goes_on else (0, 0, _NEVER, _NEVER)

        def running(x: np.ndarray, base: int) -> np.ndarray:
            c = np.cumsum(x)
            out = c - (c[starts] - x[starts])[segment]
            out[segment == 0] += base
            return out

        count, amount = running(n, carry[0]), running(total, carry[1])
        at = np.maximum.accumulate(np.where(event, np.arange(size), -1))
        latest = np.where(at >= starts[segment], day[np.maximum(at, 0)], np.where(segment == 0, carry[3], _NEVER))
        marks = np.where(event, np.arange(size), size)
        head = np.minimum.reduceat(marks, starts)[segment]
        first = np.where((segment == 0) & (carry[2] != _NEVER), carry[2], np.where(head <= np.arange(size), day[np.minimum(head, size - 1)], _NEVER))
        self.key = (entity[size - 1].as_py(), kind[size - 1].as_py())
        self.carry = (int(count[-1]), int(amount[-1]), int(first[-1]), int(latest[-1]))
        return count, amount, first, latest, fresh


def _numbers(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _at_probes(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    state = _Counters()
    for b in batches:
        if not b.num_rows:
            continue
        probe = _numbers(b, "probe") == 1
        count, amount, first, latest, _ = state.feed(b.column(b.schema.get_field_index("entity")), b.column(b.schema.get_field_index("kind")), _numbers(b, "day"), _numbers(b, "n"), _numbers(b, "total"), ~probe)
        at = np.flatnonzero(probe)
        if len(at):
            none = latest[at] == _NEVER
            day = _numbers(b, "day")[at]
            got = [
                pa.array((latest[at] - first[at]).astype(np.int64), mask=none),
                pa.array((day - latest[at]).astype(np.int64), mask=none),
                pa.array(count[at].astype(np.int64)),
                pa.array(amount[at].astype(np.int64)),
            ]
            kept = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([kept.column(kept.schema.get_field_index(c)) for c in ("entity", "kind", "day", "payload")] + got, names=names)


def _wide(batches: Iterator[pa.RecordBatch], kinds: list, as_of: int, parts: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    state = _Counters()
    place = {k: i for i, k in enumerate(kinds)}
    entity = None
    row: dict[int, tuple[int, int, int]] = {}
    done: list[tuple[object, dict[int, tuple[int, int, int]]]] = []

    def flush() -> pa.RecordBatch:
        r, f, m = (np.full((len(done), len(kinds)), np.nan) for _ in range(3))
        f[:], m[:] = 0, 0
        for i, (_, values) in enumerate(done):
            for k, (latest, count, amount) in values.items():
                r[i, k], f[i, k], m[i, k] = as_of - latest, count, amount
        arrays = [pa.array([e for e, _ in done])]
        for k in range(len(kinds)):
            arrays += [pa.array(r[:, k], mask=np.isnan(r[:, k])).cast(pa.int64()), pa.array(f[:, k].astype(np.int64)), pa.array(m[:, k] / parts)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for b in batches:
        if not b.num_rows:
            continue
        who, kind = b.column(b.schema.get_field_index("entity")), b.column(b.schema.get_field_index("kind"))
        count, amount, _, latest, fresh = state.feed(who, kind, _numbers(b, "day"), _numbers(b, "n"), _numbers(b, "total"), np.ones(b.num_rows, bool))
        ends = np.append(np.flatnonzero(fresh)[1:] - 1, b.num_rows - 1)
        ends = np.unique(ends[ends >= 0])
        for i, e, k in zip(ends, who.take(pa.array(ends)).to_pylist(), kind.take(pa.array(ends)).to_pylist(), strict=True):
            if e != entity:
                if entity is not None:
                    done.append((entity, row))
                entity, row = e, {}
            if k in place:
                row[place[k]] = (int(latest[i]), int(count[i]), int(amount[i]))
        if len(done) >= 1000:
            yield flush()
    if entity is not None:
        done.append((entity, row))
    if done:
        yield flush()


def _daily(events: DataFrame, entity: str, kind: str, day: str, amount: str) -> DataFrame:
    """Counts and totals by entity, kind and day: combined before the shuffle, so no entity is larger than its kinds times days."""
    return events.select(F.col(entity).alias("entity"), F.col(kind).alias("kind"), F.col(day).cast("int").alias("day"), F.col(amount).cast("bigint").alias("amount")).where("entity is not null and kind is not null and day is not null").groupBy("entity", "kind", "day").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("amount"), F.lit(0)).alias("total"))


def entity_features(events: DataFrame, entity: str, kind: str, day: str, amount: str, kinds: Sequence | None = None, as_of: int | None = None, parts: int = 1, max_kinds: int = 5000) -> DataFrame:
    """One wide row per entity: ``entity``, then for each of ``kinds`` ``r_<kind>`` (days from the latest event to ``as_of``, null if none), ``f_<kind>`` (events) and ``m_<kind>`` (total of ``amount`` / ``parts``).

    Counts events up to and including day ``as_of`` (days since 1970; None: the last day of the events). Without
    ``kinds`` it takes all kinds that the events have, in order, at most ``max_kinds``. Events without entity, kind or day are left
    out; a null amount counts as an event of amount 0; events of other kinds are ignored (``kind_report`` tells how
    many there are) but their entities still get a row; repeated rows count each; an empty table gives no rows; other columns don't matter. Column names have
    anything but letters and digits of a kind replaced by ``_``.

    Events are combined by entity, kind and day before they are shuffled, bucketed by entity and sorted by entity,
    kind and day; runs then stream into counters and leave as wide rows without another shuffle.
    """
    if as_of is None:
        as_of = events.agg(F.max(F.col(day).cast("int"))).first()[0] or 0
    kinds = sorted(r[0] for r in events.select(kind).where(F.col(kind).isNotNull()).distinct().limit(max_kinds + 1).collect()) if kinds is None else list(kinds)
    if len(kinds) > max_kinds:
        raise ValueError(f"{len(kinds)} kinds; at most {max_kinds} make a row")
    names = ["entity"] + [f"{p}_{_safe(k)}" for k in kinds for p in ("r", "f", "m")]
    daily = _daily(events.where(F.col(day) <= as_of), entity, kind, day, amount)
    fields = [T.StructField("entity", daily.schema["entity"].dataType)]
    for name in names[1:]:
        fields.append(T.StructField(name, T.DoubleType() if name[0] == "m" else T.LongType()))
    return daily.repartition("entity").sortWithinPartitions("entity", "kind", "day").mapInArrow(lambda b: _wide(b, kinds, as_of, parts, names), T.StructType(fields))


def kind_report(events: DataFrame, entity: str, kind: str, kinds: Sequence) -> DataFrame:
    """``kind, listed, entities, events`` of every kind that the events have: what a feature table of ``kinds`` holds and what it leaves out.

    Null kinds form a row of their own, which isn't listed; entities are counted without nulls; an empty table gives no rows.
    """
    pairs = events.groupBy(F.col(kind).alias("kind"), F.col(entity).alias("entity")).agg(F.count(F.lit(1)).alias("n"))
    rows = pairs.groupBy("kind").agg(F.count("entity").alias("entities"), F.sum("n").alias("events"))
    return rows.select("kind", F.coalesce(F.col("kind").isin(*kinds), F.lit(False)).alias("listed"), "entities", "events")


def features_at(events: DataFrame, probes: DataFrame, entity: str, kind: str, day: str, amount: str, probe_day: str) -> DataFrame:
    """The features of each probe's entity and kind as of the probe's day: ``entity, kind, day, payload, span, recency, frequency, total``.

    ``probes`` has the columns ``entity``, ``kind`` and ``probe_day``; all its columns come back in the struct
    ``payload``. Events of the probe's day count. Without any event so far ``span`` and ``recency`` are null and
    the others 0. Probes without entity, kind or day give no row; repeated probes give a row each.

    Probes are sorted in among the combined events, behind those of their day, and answered by the same counters.
    """
    payload = F.struct(*[F.col(c) for c in probes.columns])
    asked = probes.select(F.col(entity).alias("entity"), F.col(kind).alias("kind"), F.col(probe_day).cast("int").alias("day"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("total"), F.lit(1).alias("probe"), payload.alias("payload")).where("entity is not null and kind is not null and day is not null")
    shape = asked.schema["payload"].dataType
    daily = _daily(events, entity, kind, day, amount).select("*", F.lit(0).alias("probe"), F.lit(None).cast(shape).alias("payload"))
    out = T.StructType([asked.schema["entity"], asked.schema["kind"], T.StructField("day", T.IntegerType()), T.StructField("payload", shape)] + [T.StructField(c, T.LongType()) for c in ("span", "recency", "frequency", "total")])
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in out])
    names = out.fieldNames()
    return daily.unionByName(asked).repartition("entity").sortWithinPartitions("entity", "kind", "day", "probe").mapInArrow(lambda b: _at_probes(b, names), out)


def _safe(kind: object) -> str:
    return "".join(c if c.isalnum() else "_" for c in str(kind))
