import random

import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import numpy as np
from millrace.operators.sessions import _sessions, close_bitmaps, runs_of, sessionize


def brute(times, gap):
    out = []
    for t in sorted(times):
        if out and t - out[-1][1] <= gap:
            out[-1] = (out[-1][0], t, out[-1][2] + 1)
        else:
            out.append((t, t, 1))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=30), st.integers(1, 40))
def test_closing_joins_exactly_what_is_near(times, gap):
    x = np.zeros((2, 6), np.uint64)
    for t in times:
        x[1, t // 64] |= np.uint64(1 << (t % 64))
    row, first, last = runs_of(close_bitmaps(x, gap))
    assert set(row.tolist()) == {1}
    assert list(zip(first.tolist(), last.tolist(), strict=True)) == [(a, b) for a, b, _ in brute(set(times), gap)]


def test_streams_of_any_batches():
    random.seed(5)
    cells = sorted({(random.choice("abc"), random.randint(0, 4), random.randint(0, 99)) for _ in range(200)})
    rows = [(*c, random.randint(1, 3)) for c in cells]
    want = [(e, d, *x) for e, d in sorted({c[:2] for c in cells}) for x in brute([s for a, b, s, n in rows if (a, b) == (e, d) for _ in range(n)], 9)]
    for size in (1, 2, 7, 50, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + size], strict=True)], names=list("edsn")) for k in range(0, len(rows), size)]
        assert [tuple(r.values()) for b in _sessions(iter(batches), 9, ["e", "c", "s", "t", "n"]) for r in b.to_pylist()] == want


def test_equal_rows_count_once(spark):
    df = spark.createDataFrame([("a", 5, None, "x"), ("a", 5, None, "x"), ("a", 5, "x", None), ("a", 9, "x", None)], "who string, t bigint, p string, q string")
    assert [r["n_rows"] for r in sessionize(df, F.col("who"), F.col("t"), once=df.columns).collect()] == [3]


def test_sessions_match_brute_force_across_chunks(spark):
    random.seed(1)
    rows = [(random.choice("abc"), random.randint(0, 4000), "x") for _ in range(400)] + [("hot", t, "x") for t in range(0, 3000, 7)] * 3
    df = spark.createDataFrame(rows, "who string, t bigint, n string")
    got = {tuple(r) for r in sessionize(df, F.col("who"), F.col("t"), gap=20, chunk=100).select("entity", "start_second", "end_second", "n_rows").collect()}
    want = {(w, *s) for w in {r[0] for r in rows} for s in brute([t for x, t, _ in rows if x == w], 20)}
    assert got == want


def test_gap_limit_nulls_ties_and_empty(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1800), ("a", 3601), ("a", 3601), (None, 5), ("b", None)], "entity string, s bigint")
    got = sorted(tuple(r) for r in sessionize(df, F.col("entity"), F.col("s")).collect())
    assert got == [("a", 0, 1800, 1800, 2), ("a", 3601, 3601, 0, 2)]
    assert sessionize(df.where("false"), F.col("entity"), F.col("s")).count() == 0
