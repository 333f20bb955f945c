"""Sessions from occupancy bitmaps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.scalar import row_hashes

#: Bytes of bitmap that are closed at a time: they should stay in a core's cache.
_AT_ONCE = 1 << 19


def _moved_up(x: np.ndarray, step: int) -> np.ndarray:
    words, bits = divmod(step, 64)
    out = np.zeros_like(x)
    keep = x.shape[1] - words
    if keep > 0:
        out[:, words:] = x[:, :keep] << np.uint64(bits)
        if bits and keep > 1:
            out[:, words + 1 :] |= x[:, : keep - 1] >> np.uint64(64 - bits)
    return out


def _moved_down(x: np.ndarray, step: int) -> np.ndarray:
    words, bits = divmod(step, 64)
    out = np.zeros_like(x)
    keep = x.shape[1] - words
    if keep > 0:
        out[:, :keep] = x[:, words:] >> np.uint64(bits)
        if bits and keep > 1:
            out[:, : keep - 1] |= x[:, words + 1 :] << np.uint64(64 - bits)
    return out


def close_bitmaps(x: np.ndarray, gap: int) -> np.ndarray:
    """Morphological closing of bitmaps, one a row of 64-bit words: fills every hole between set bits at most ``gap`` apart.

    Dilation and erosion by ``gap - 1`` positions, each by shifts that double. Rows need ``gap - 1`` bits of room at the end.
    """
    reach = max(gap - 1, 0)
    steps, done = [], 0
    while done < reach:
        steps.append(min(done + 1, reach - done))
        done += steps[-1]
    for step in steps:
        x = x | _moved_up(x, step)
    for step in steps:
        x = x & _moved_down(x, step)
    return x


def bits_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and position of every set bit, in order."""
    row, word = np.nonzero(x)
    at, bit = np.nonzero(np.unpackbits(x[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return row[at], word[at] * 64 + bit


def runs_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last position of the runs of set bits."""
    row, first = bits_of(x & ~_moved_up(x, 1))
    return row, first, bits_of(x & ~_moved_down(x, 1))[1]


def chunk_runs(chunk: np.ndarray, second: np.ndarray, n: np.ndarray, gap: int) -> tuple[np.ndarray, ...]:
    """(chunk, first second, last second, rows) of the sessions in each chunk; ``chunk`` counts up from 0, ``second`` ascends within it."""
    starts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
    low = second[starts]
    span = second[np.append(starts[1:], len(chunk)) - 1] - low
    order = np.argsort(span, kind="stable")  # bitmaps of like length together
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    cell = np.argsort(place[chunk], kind="stable")
    row, bit = place[chunk][cell], (second - low[chunk])[cell]
    ends = np.append(0, np.cumsum(np.bincount(row)))
    words = (span[order] + gap) // 64 + 1
    found = []
    at = 0
    while at < len(order):
        upto = min(len(order), at + max(1, int(_AT_ONCE // (8 * words[at]))))
        while upto - at > 1 and (upto - at) * words[upto - 1] * 8 > 2 * _AT_ONCE:
            upto = at + (upto - at) // 2
        own = slice(ends[at], ends[upto])
        x = np.zeros((upto - at, int(words[upto - 1])), np.uint64)
        np.bitwise_or.at(x, (row[own] - at, bit[own] // 64), np.uint64(1) << (bit[own] % 64).astype(np.uint64))
        r, first, last = runs_of(close_bitmaps(x, gap))
        which = order[at + r]
        found.append((which, first + low[which], last + low[which]))
        at = upto
    c, s, e = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((s, c))
    c, s, e = c[order], s[order], e[order]
    wide = int(second.max()) + 1
    run = np.searchsorted(c * wide + s, chunk * wide + second, "right") - 1
    return c, s, e, np.bincount(run, weights=n, minlength=len(c)).astype(np.int64)


def _sessions(batches: Iterator[pa.RecordBatch], gap: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches come sorted by entity, chunk and second; the last chunk of each waits for the next one."""
    kept: list[pa.RecordBatch] = []

    def give(b: pa.RecordBatch) -> pa.RecordBatch:
        entity, day, s, n = b.columns
        fresh = np.zeros(b.num_rows, bool)
        fresh[1:] = ~pc.and_(pc.equal(entity[1:], entity[:-1]), pc.equal(day[1:], day[:-1])).to_numpy(zero_copy_only=False)
        heads = np.append(0, np.flatnonzero(fresh))
        c, first, last, count = chunk_runs(np.cumsum(fresh), s.to_numpy().astype(np.int64), n.to_numpy(), gap)
        at = pa.array(heads[c])
        return pa.RecordBatch.from_arrays([entity.take(at), day.take(at), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(count)], names=names)

    def whole() -> pa.RecordBatch:
        return pa.concat_batches(kept) if len(kept) > 1 else kept[0]

    for b in batches:
        if not b.num_rows:
            continue
        other = pc.or_(pc.not_equal(b.column(0), b.column(0)[-1]), pc.not_equal(b.column(1), b.column(1)[-1]))
        cut = int(pc.sum(other).as_py() or 0)  # rows of earlier chunks
        if cut:
            kept.append(b.slice(0, cut))
            yield give(whole())
            kept = []
        elif kept and (kept[-1].column(0)[-1] != b.column(0)[0] or kept[-1].column(1)[-1] != b.column(1)[0]):
            yield give(whole())
            kept = []
        kept.append(b.slice(cut))
    if kept:
        yield give(whole())


def sessionize(df: DataFrame, entity: Column, second: Column, gap: int = 1800, chunk: int = 86_400, once: Sequence[str] = ()) -> DataFrame:
    """Sessions of each entity: ``entity, start_second, end_second, duration, n_rows``.

    A session ends where the next row of the entity is more than ``gap`` seconds later. Every row of ``df`` counts, rows
    that are equal in the columns ``once`` (if any are given) only once; rows with a null ``entity`` or ``second`` are
    left out; rows at the same second belong together; an empty table gives no sessions; other columns of ``df`` don't
    matter. ``second`` is an epoch in whole seconds.

    Rows are first counted by entity and second (with a partial count before the shuffle), so an entity's size from
    here on is bounded by the time it spans; of the columns ``once`` only a hash of 128 bits is shuffled. Each entity's
    chunk of time then becomes an occupancy bitmap, one bit a second; many bitmaps at a time are closed by ``gap`` with
    doubling shifts, and their runs, joined with the counts, are the chunk's sessions. At most ``chunk / gap`` of them an
    entity and chunk go on to be joined across chunk edges.
    """
    rows = df.select(entity.alias("entity"), second.cast("bigint").alias("t"), *[h.alias(f"h{i}") for i, h in enumerate(row_hashes(once) if once else [])]).where("entity is not null and t is not null")
    cells = (rows.distinct() if once else rows).groupBy("entity", "t").agg(F.count(F.lit(1)).alias("n"))
    kind = cells.schema["entity"].dataType
    chunks = cells.select("entity", F.floor(F.col("t") / chunk).cast("bigint").alias("chunk"), F.pmod("t", F.lit(chunk)).cast("int").alias("s"), "n").repartition("entity", "chunk").sortWithinPartitions("entity", "chunk", "s")
    out = T.StructType([T.StructField("entity", kind), T.StructField("chunk", T.LongType()), T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType()), T.StructField("n", T.LongType())])
    names = out.fieldNames()
    parts = chunks.mapInArrow(lambda batches: _sessions(batches, gap, names), out).select("entity", (F.col("chunk") * chunk + F.col("s")).alias("s"), (F.col("chunk") * chunk + F.col("e")).alias("e"), "n")
    w = Window.partitionBy("entity").orderBy("s")
    return (
        parts.withColumn("fresh", F.coalesce(F.col("s") - F.lag("e").over(w) > gap, F.lit(True)).cast("int"))
        .withColumn("nr", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("entity", "nr")
        .agg(F.min("s").alias("start_second"), F.max("e").alias("end_second"), F.sum("n").alias("n_rows"))
        .select("entity", "start_second", "end_second", (F.col("end_second") - F.col("start_second")).alias("duration"), "n_rows")
    )
