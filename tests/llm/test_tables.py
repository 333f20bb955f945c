import random
from itertools import groupby

import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm.queries_tables import action_key, p1_found, p1_runs
from millrace.llm.runs import _local_runs, collapse_runs, in_order
from millrace.llm.topn import score_bin, top_n


def brute_runs(rows, least):
    out = []
    for who in {r[0] for r in rows if r[0] is not None}:
        own = sorted((r for r in rows if r[0] == who and r[1] is not None), key=lambda r: (r[1], r[2]))
        for value, run in groupby(own, key=lambda r: r[3]):
            run = list(run)
            if value is not None and len(run) >= least:
                out.append((who, value, run[0][2], run[-1][2], run[0][1], run[-1][1], run[-1][1] - run[0][1], len(run)))
    return sorted(out)


SCHEMA = "entity string, start bigint, id bigint, block string, value string"


def test_runs_match_brute_force_across_ranges(spark):
    random.seed(2)
    for least in (1, 2, 3):
        rows = [(random.choice(["hot", "hot", "hot", "b", None]), random.choice([random.randint(-20, 200), random.randint(0, 30), None]), i, random.choice(["x", "x", "x", "y", None]), "other") for i in range(400)]
        df = spark.createDataFrame(rows + rows[:50], SCHEMA)
        got = sorted(tuple(r) for r in collapse_runs(df, "entity", "start", "id", "block", least).collect())
        assert got == brute_runs(rows, least)


def test_streams_of_any_batches():
    random.seed(12)
    for size in (1, 2, 3, 7, 100):
        rows = sorted((random.choice("ab"), random.randint(0, 9), random.randint(0, 3), random.choice(["x", "x", "y"])) for _ in range(60))
        once = {r[:3]: r for r in reversed(rows)}
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + size], strict=True)], names=list("abcd")) for k in range(0, 60, size)]
        got = [tuple(r.values())[:7] for b in _local_runs(iter(batches), 1, ["entity", "value", "n", "start", "end", "first_id", "last_id", "edge"]) for r in b.to_pylist()]
        want = [(w, v, n, s, e, f, k) for w, v, f, k, s, e, _, n in brute_runs([(a, t, i, v) for a, t, i, v in once.values()], 1)]
        assert sorted(got) == sorted(want)


def test_one_author_in_one_day_is_split_over_tasks(spark):
    rows = [("hot", 1_000 + k // 50, k, "x" if k % 97 else "y", None) for k in range(8_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would fit one task
    sizes = [r[1] for r in in_order(df, "entity", "start", "id", "block").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4_000
    assert sorted(tuple(r) for r in collapse_runs(df, "entity", "start", "id", "block").collect()) == brute_runs(rows, 1)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_long_run_and_empty(spark):
    df = spark.createDataFrame([("a", t, t, "x", None) for t in range(0, 1000, 3)], SCHEMA)
    r = collapse_runs(df, "entity", "start", "id", "block").collect()
    assert len(r) == 1 and r[0]["n"] == 334 and r[0]["duration"] == 999
    assert collapse_runs(df.where("false"), "entity", "start", "id", "block").count() == 0


def test_action_spellings(spark):
    said = ["album.view", "ALBUM-VIEW", " album_view", "/album/view/", "album . view", "album.view?id=3", "album.view#c2", "album.view:55"]
    got = {r[0] for r in spark.createDataFrame([(x,) for x in said], "a string").select(action_key(F.col("a"))).collect()}
    assert got == {"album.view"}


def test_top_n_matches_brute_force(spark):
    random.seed(3)
    rows = [(random.choice(["hot", "hot", None, "c"]), f"i{random.randint(0, 90)}", random.choice([None, 0, 1, 1, 7, 7, -3, random.randint(-50, 5000)]), random.choice([None, 1.5, 2.5]), "k") for _ in range(900)]
    df = spark.createDataFrame(rows, "shop string, item string, qt int, _bin double, rank string").distinct()
    for n in (1, 5, 400):
        got = sorted(((r["shop"], r["rank"], r["item"], r["qt"], r["_bin"]) for r in top_n(df, ["shop"], "qt", [F.col("_bin").desc_nulls_last(), F.col("item")], n).collect()), key=repr)
        want = []
        for shop in ("hot", None, "c"):
            own = sorted({(r[1], r[2], r[3]) for r in rows if r[0] == shop and r[2] is not None}, key=lambda r: (-r[1], r[2] is None, -(r[2] or 0), r[0]))
            want += [(shop, i + 1, *x) for i, x in enumerate(own[:n])]
        assert got == sorted(want, key=repr)
    assert top_n(df.where("false"), ["shop"], "qt", [F.col("item")], 3).count() == 0


def test_bins_never_fall(spark):
    x = [-1e12, -55.5, -1, -0.1, 0, 0.1, 1, 2, 3, 100, 101, 1e15]
    b = [r[0] for r in spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, v double").orderBy("i").select(score_bin(F.col("v"))).collect()]
    assert b == sorted(b)


def test_copies_of_a_line_count_once_even_if_they_differ(spark, tmp_path):
    lines = [(1, "a", 100, None, "x.y"), (1, "a", 100, None, "x.y"), (2, "a", 101, None, "X-Y"), (3, "a", 102, None, "z")]
    odd = [(2, "a", 900, None, "z"), (4, None, 103, None, "z"), (4, "a", None, None, "z")]
    for name, rows, want in (("same", lines, [("a", 1, 2)]), ("odd", lines + odd, [("a", 1, 2)])):
        d = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, "log_id bigint, author string, op_at bigint, op_date string, action string").write.parquet(f"{d}/userlog.parquet")
        spark.createDataFrame([(1, "x.y"), (2, "z")], "action_id int, action_name string").write.parquet(f"{d}/action_names.parquet")
        assert [tuple(r) for r in p1_found(spark, d).collect()] == want
        assert sorted((r["first_log_id"], r["n"]) for r in p1_runs(spark, d).collect()) == [(1, 2), (3, 1)]
