"""Functions, merges, fits, tasks, and what talks to the outside, on small fixtures."""

import datetime as dt
import io
import math
import random
import sqlite3

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import scalar as fn
from millrace.operators import actions, fits, relational as rel, tasks, windows as win
from millrace.sources import outside, tables


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def test_records_headers_and_broken_lines(spark):
    lines = [('id,name', 0, None), ('1,"a, b"', 1, "a, b"), ("1", -1, None), ("1,2,3", -1, None), ("", -1, None), (None, -1, None)]
    got = spark.createDataFrame([(i, x[0]) for i, x in enumerate(lines)], "i int, l string").orderBy("i").select(fn.parse_record(F.col("l"), ["id", "name"]).alias("r")).collect()
    assert [(r["r"]["status"], r["r"]["name"]) for r in got] == [x[1:] for x in lines]


def test_small_functions(spark):
    assert one(spark, fn.unescape_unicode(fn.escape_unicode(F.lit("旅\\n é")))) == "旅\\n é"
    assert one(spark, fn.labelled(F.lit("z"), {"a": 1}, 9)) == 9 and one(spark, fn.labelled(F.lit(None).cast("string"), {"a": 1})) is None
    assert one(spark, fn.seconds_between(F.lit(dt.datetime(2024, 1, 1)), F.lit(dt.datetime(2024, 1, 1, 0, 1, 0, 500_000)))) == 60.5
    p = one(spark, fn.polar(F.lit(0.0), F.lit(-2.0)))
    assert (p["length"], p["angle"], round(p["blue"], 6)) == (2.0, 270.0, 1.0)


def test_matrices_merges_and_places(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3, (5, 4)), rng.integers(0, 3, (4, 6))
    cells = lambda m: spark.createDataFrame([(i, j, int(v)) for (i, j), v in np.ndenumerate(m) if v], "i int, j int, v bigint")
    got = np.zeros((5, 6), int)
    for r in rel.matrix_product(cells(a), cells(b)).collect():
        got[r["i"], r["j"]] = r["v"]
    assert (got == a @ b).all()
    x, y = spark.createDataFrame([("a", 1), ("c", 2)], "k string, n int"), spark.createDataFrame([("z",)], "m string")
    assert sorted(map(tuple, rel.beside(x, y, [F.desc("k")], [F.col("m")]).collect())) == [(0, "c", 2, "z"), (1, "a", 1, None)]
    lines = lambda *t: spark.createDataFrame([(v,) for v in t], "l string")
    assert [r[0] for r in rel.merged_lines(lines("1|a|b", "2|c|d", "x"), lines("q|1|r"), "l", ([1], [2]), ([2], [1, 3]), "|").collect()] == ["1|a|q|r"]
    z = rel.standardised(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double"), ["a", "b"]).collect()
    assert [tuple(r) for r in z] == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_row_numbers_and_exact_curve(spark):
    random.seed(7)
    rows = [(random.choice([0.1, 0.1, 0.5, random.random() / 1e6, None]), random.choice([0, 1])) for _ in range(800)]
    df = spark.createDataFrame(rows, "score double, label bigint")
    scores = [s for s, _ in rows if s is not None]
    got = {r["score"]: (r["tpr"], r["fpr"]) for r in win.roc_points(df, "score", "label", buckets=7).collect()}
    pos, neg = sum(y for s, y in rows if s is not None), sum(1 - y for s, y in rows if s is not None)
    assert got.keys() == set(scores)
    for t in list(got)[::9]:
        assert got[t] == pytest.approx((sum(y for s, y in rows if s is not None and s >= t) / pos, sum(1 - y for s, y in rows if s is not None and s >= t) / neg))
    assert win.roc_points(df.where("false"), "score", "label").count() == 0
    n = spark.range(500).select((F.col("id") * 37 % 500).alias("v"))
    assert all(r["v"] == r["row"] for r in win.row_numbers(n, [F.col("v")]).collect())


def test_fits_by_gradients(spark):
    rng = np.random.default_rng(3)
    x = np.hstack([np.ones((300, 1)), rng.normal(size=(300, 2))])
    true = np.array([0.5, -2.0, 1.0])
    lin = spark.createDataFrame([(v.tolist(), float(v @ true)) for v in x], "x array<double>, label double")
    log = spark.createDataFrame([(v.tolist(), float(v @ true + rng.logistic() > 0)) for v in x], "x array<double>, label double").cache()
    w = np.array([0.1, 0.2, -0.3])
    for df, kind in ((lin, "linear"), (log, "logistic")):
        grad = fits.loss_and_gradient(df, w, kind, 0.1)[1]
        assert grad == pytest.approx(fits.numeric_gradient(lambda v: fits.loss_and_gradient(df, v, kind, 0.1)[0], w), abs=1e-5)  # noqa: B023
    best, values = fits.conjugate_gradient(fits.quadratic_loss(lin, size=3), np.zeros(3), 200)
    assert best == pytest.approx(true, abs=1e-4) and values == sorted(values, reverse=True)
    _, losses = fits.descend(log, "logistic", 3, alpha=2.0, iterations=5)
    assert losses[-1] < losses[0] == pytest.approx(math.log(2))
    g = fits.grid(log, log, "logistic", 3, [2.0], [0.0, 5.0], iterations=5)
    assert g[0][2] < g[1][2] and g[0][2] == pytest.approx(fits.loss_and_gradient(log, fits.descend(log, "logistic", 3, alpha=2.0, iterations=5)[0], "logistic")[0])
    y = np.eye(2)[rng.integers(0, 2, 20)]
    layers = [rng.normal(size=(3, 3)), rng.normal(size=(2, 4))]
    _, grads = fits.network_cost(x[:20, 1:], y, layers, 0.5)
    flat = lambda v: [v[:9].reshape(3, 3), v[9:].reshape(2, 4)]
    assert np.concatenate([m.ravel() for m in grads]) == pytest.approx(fits.numeric_gradient(lambda v: fits.network_cost(x[:20, 1:], y, flat(v), 0.5)[0], np.concatenate([m.ravel() for m in layers])), abs=1e-5)


def test_axes_kernels_and_factors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 1)) @ np.array([[1.0, 2.0, -1.0]]) + [5.0, 0.0, 1.0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, x array<double>")
    scores, axes, centre, shares = fits.centred_scores(df, 1)
    assert shares[0] == pytest.approx(1) and sum(r["scores"][0] for r in scores.collect()) == pytest.approx(0, abs=1e-8)
    assert all(r["recovered"] == pytest.approx(r["x"]) for r in fits.from_scores(scores, axes, centre).collect())
    ring = [(i, [r * math.cos(i), r * math.sin(i)], float(r > 1)) for i in range(200) for r in (0.5, 2.0)]
    rows = spark.createDataFrame([(2 * k + i, v, y) for k, (i, v, y) in enumerate(ring)], "id int, x array<double>, label double")
    assert fits.kernel_svm_grid(rows, rows, "x", "id", [10.0], [1.0], 40)[0][2] == 1.0
    r = spark.createDataFrame([(1, 1, 3.0), (1, 2, 1.0)], "user int, item int, rating double")
    u, i = (spark.createDataFrame(v, "id int, features array<float>") for v in ([(1, [1.0, 1.0])], [(1, [1.0, 1.0]), (2, [1.0, 0.0])]))
    assert fits.factor_cost(r, u, i, 2.0) == pytest.approx(0.5 + 5.0)
    d = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (4.0, 4.0)], "a double, b double")
    m, c = np.array([7 / 3, 7 / 3]), np.cov(np.array([[1, 2, 4], [2, 1, 4.0]]), bias=True)
    want = [-0.5 * (v - m) @ np.linalg.inv(c) @ (v - m) - math.log(2 * math.pi) - 0.5 * math.log(np.linalg.det(c)) for v in np.array([[1, 2], [2, 1], [4, 4.0]])]
    assert [q["log_density"] for q in fits.gaussian_density(d, ["a", "b"]).collect()] == pytest.approx(want)
    assert fits.gaussian_density(d.withColumn("b", F.col("a")), ["a", "b"]).first()["log_density"] is None


def test_tasks_run_in_order_once_and_again(spark, tmp_path):
    ran = []

    def step(name, *requires):
        def make(*inputs):
            ran.append(name)
            return spark.createDataFrame([(sum(i.first()["n"] for i in inputs) + 1,)], "n bigint")

        return tasks.Task(name, make, f"{tmp_path}/{name}", requires)

    graph = [step("d", "b", "c"), step("b", "a"), step("c", "a"), step("a"), step("other")]
    done = {x.name: x for x in tasks.run(spark, graph, ["d"])}
    assert ran[0] == "a" and ran[-1] == "d" and set(ran) == {"a", "b", "c", "d"} and done["d"].status == "made"
    assert spark.read.parquet(f"{tmp_path}/d").first()["n"] == 5 and done["d"].rows == 1 and done["d"].seconds > 0
    assert {x.status for x in tasks.run(spark, graph, ["d"])} == {"kept"} and len(ran) == 4
    (tmp_path / "c" / "_SUCCESS").unlink()  # a run that broke off
    assert {x.name for x in tasks.run(spark, graph, ["d"]) if x.status == "made"} == {"c"}
    with pytest.raises(ValueError):
        tasks.ordered([step("x", "y"), step("y", "x")])
    with pytest.raises(ValueError):
        tasks.ordered([step("x", "nowhere")])
    with pytest.raises(ZeroDivisionError):
        tasks.run(spark, [tasks.Task("bad", lambda: 1 / 0, f"{tmp_path}/bad"), step("after", "bad")])
    assert tasks.periods(dt.date(2024, 1, 30), dt.date(2024, 3, 1), monthly=True) == [dt.date(2024, 1, 31), dt.date(2024, 2, 29)]


def test_what_runs_around_a_plan(spark):
    df = spark.range(100)
    with actions.kept(df.where("id < 10")) as k:
        assert k.storageLevel.useMemory and k.count() == 10
    assert "Range" in actions.lineage(df)
    assert sum(r["n"] for r in actions.partition_sizes(df.repartition(5)).collect()) == 100
    o, seen = actions.counted(df, odd=F.count_if(F.col("id") % 2 == 1), sizes=actions.histogram(F.col("id"), [10, 50]))
    o.collect()
    assert seen.get == {"odd": 50, "sizes": [10, 40, 50]}
    with pytest.raises(ValueError):
        actions.to_pandas(df, 99)
    with pytest.raises(ValueError):
        actions.collect_map(df.withColumn("v", F.lit(1)), "id", "v", 99)
    actions.for_each(df, lambda r: None)
    assert [r[0] for r in actions.piped(spark.createDataFrame([("b",), (None,), ("a",)], "l string").coalesce(1), "l", ["sort"]).collect()] == ["a", "b"]


def test_the_outside(spark, tmp_path):
    assert [r[0] for r in outside.stdin_lines(spark, io.StringIO("a\nb\n")).collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        outside.stdin_lines(spark, io.StringIO("a\nb\n"), 1)
    file = str(tmp_path / "x.db")
    con = sqlite3.connect(file)
    con.execute("create table t (k integer, v text)")
    con.executemany("insert into t values (?, ?)", [(i, f"v{i}") for i in range(10)])
    con.commit()
    got = outside.odbc_rows(spark, lambda: sqlite3.connect(file), "select k, v from t where k between ? and ?", "k bigint, v string", [(0, 3), (4, 9)]).collect()
    assert sorted(r["k"] for r in got) == list(range(10))
    with pytest.raises(ValueError):
        outside.crawl(spark, ["a"], lambda u: "x", lambda u, h: [u + "a", u + "b"], 5)
    sent = []
    m = outside.notice(sent.append, ["a@b.example"], "done", spark.createDataFrame([(1, "x")], "n int, t string"))
    assert sent == [m] and "1\tx" in m.get_content() and m["Subject"] == "done"
    log = tmp_path / "app.log"
    log.write_text("line")
    at = outside.rotate(spark, str(log), f"{tmp_path}/old", dt.datetime(2024, 5, 6, 7, 8, 9))
    assert not log.exists() and at.endswith("20240506/app.log.070809") and spark.read.text(at).first()[0] == "line"
    for name in ("day=20240101", "2024-01-09", "day=20249999", "other"):
        (tmp_path / "kept" / name).mkdir(parents=True)
    assert outside.drop_old(spark, f"{tmp_path}/kept", dt.date(2024, 1, 10), 5) == ["day=20240101"]
    assert sorted(p.name for p in (tmp_path / "kept").iterdir()) == ["2024-01-09", "day=20249999", "other"]
    assert tables.find(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), {"$or": [{"a": {"$gt": 5}}, {"b": None}]}).count() == 1


def test_sas_files_need_a_reader(spark, tmp_path):
    (tmp_path / "x.sas7bdat").write_bytes(b"not one")
    with pytest.raises((ValueError, pd.errors.ParserError, EOFError)):
        outside.sas_table(spark, str(tmp_path / "x.sas7bdat"))


def test_nearest_neighbours_by_exact_distances(spark):
    from millrace.operators.ml import nearest_neighbours

    rng = np.random.default_rng(9)
    train, test = rng.integers(0, 4, (150, 3)).astype(float), rng.integers(0, 4, (40, 3)).astype(float)
    labels = rng.integers(0, 3, 150)
    frame = lambda m, y: spark.createDataFrame([(i, v.tolist(), int(z)) for i, (v, z) in enumerate(zip(m, y, strict=True))], "id bigint, vector array<double>, label bigint")
    got = {r["id"]: r["prediction"] for r in nearest_neighbours(frame(train, labels), frame(test, np.zeros(40))).collect()}
    for i, v in enumerate(test):
        near = sorted(range(150), key=lambda j: (((train[j] - v) ** 2).sum(), j))[:5]  # noqa: B023
        counts = np.bincount(labels[near], minlength=3)
        assert got[i] == int(np.argmax(counts))
    assert nearest_neighbours(frame(train[:0], labels[:0]), frame(test, np.zeros(40))).count() == 0


def test_upserts_come_in_batches(spark, tmp_path):
    from millrace.sources.sinks import upsert_batches

    out = str(tmp_path)

    def send(rows):
        import os
        import uuid

        with open(os.path.join(out, f"{len(rows)}-{uuid.uuid4().hex}"), "w") as f:
            f.write("\n".join(k for k, _ in rows))

    upsert_batches(spark.range(7).coalesce(1), "id", send, 3)
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["1", "3", "3"]
