import random

import pyarrow as pa
import pytest

from millrace.operators.features import entity_features, features_at, kind_report
from millrace.operators.orders import clean_orders
from millrace.operators.rolling import _all_days, rolling_totals, trailing_at


def events(n, seed=3):
    random.seed(seed)
    return [(random.choice(["hot", "hot", "m1", "m2", None]), random.choice(["k1", "k2", "k3"]), random.randint(0, 60), random.choice([5, -3, 10, None]), "extra") for _ in range(n)]


SCHEMA = "who string, what string, day int, cents bigint, total string"


def test_features_at_probes_match_brute_force(spark):
    rows = events(500)
    probes = [(w, k, d, i) for i, (w, k, d) in enumerate((w, k, d) for w in ("hot", "m1", "none") for k in ("k1", "k3") for d in (-1, 0, 17, 60, 99))]
    e, p = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(probes, "who string, what string, at int, id int")
    got = {r["payload"]["id"]: (r["span"], r["recency"], r["frequency"], r["total"]) for r in features_at(e, p.withColumnRenamed("at", "day"), "who", "what", "day", "cents", "day").collect()}
    for w, k, d, i in probes:
        own = [(x[2], x[3] or 0) for x in rows if x[0] == w and x[1] == k and x[2] <= d]
        days = [x[0] for x in own]
        assert got[i] == ((max(days) - min(days), d - max(days)) if own else (None, None)) + (len(own), sum(x[1] for x in own))


def test_wide_rows(spark):
    rows = events(300)
    e = spark.createDataFrame(rows, SCHEMA)
    got = {r["entity"]: r for r in entity_features(e, "who", "what", "day", "cents", ["k1", "k2", "k^9"], 40).collect()}
    assert set(got) == {"hot", "m1", "m2"}
    for w, r in got.items():
        own = [x for x in rows if x[0] == w and x[1] == "k2" and x[2] <= 40]
        assert (r["r_k2"], r["f_k2"], r["m_k2"]) == (40 - max(x[2] for x in own), len(own), sum(x[3] or 0 for x in own))
        assert (r["r_k_9"], r["f_k_9"], r["m_k_9"]) == (None, 0, 0.0)
    assert entity_features(e.where("false"), "who", "what", "day", "cents", ["k1"], 40).count() == 0
    own = entity_features(e, "who", "what", "day", "cents")
    assert own.columns == ["entity"] + [f"{p}_k{i}" for i in (1, 2, 3) for p in "rfm"] and {r["entity"]: r["f_k1"] for r in own.collect()} == {w: sum(x[:2] == (w, "k1") for x in rows) for w in got}
    told = {r["kind"]: (r["listed"], r["entities"], r["events"]) for r in kind_report(e, "who", "what", ["k1", "k9"]).collect()}
    assert told == {k: (k == "k1", len({x[0] for x in rows if x[1] == k and x[0]}), sum(x[1] == k for x in rows)) for k in ("k1", "k2", "k3")}
    with pytest.raises(ValueError):
        entity_features(e, "who", "what", "day", "cents", ["a", "b"], 40, max_kinds=1)


@pytest.mark.parametrize("width", [1, 7, 30])
def test_rolling_totals_match_brute_force(spark, width):
    rows = events(200, width)
    e = spark.createDataFrame(rows, SCHEMA)
    last = max(r[2] for r in rows)
    got = {(r["entity"], r["day"]): (r["total"], round(r["average"], 9), r["n"]) for r in rolling_totals(e, "who", "day", "cents", width).collect()}
    want = {}
    for w in ("hot", "m1", "m2"):
        own = [(x[2], x[3] or 0) for x in rows if x[0] == w]
        for d in range(min(x[0] for x in own), last + 1):
            inside = [a for t, a in own if d - width < t <= d]
            want[w, d] = (float(sum(inside)), round(sum(inside) / width, 9), len(inside))
    assert got == want
    points = spark.createDataFrame([("hot", last + 3), ("hot", last + 3), ("nobody", 4), (None, 1), ("m1", -50)], "who string, day int")
    some = {(r["entity"], r["day"]): r["total"] for r in rolling_totals(e, "who", "day", "cents", width, points=points).collect()}
    assert some == {("hot", last + 3): float(sum((x[3] or 0) for x in rows if x[0] == "hot" and x[2] > last + 3 - width)), ("nobody", 4): 0.0, ("m1", -50): 0.0}


def test_points_keep_what_they_bring(spark):
    rows = events(300, 11)
    points = [("hot", d, f"p{k}") for k in range(2) for d in range(-5, 90, 3)] + [("m1", 400, "far"), (None, 3, "none")]
    e, p = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(points, "who string, day int, tag string")
    got = sorted((r["payload"]["tag"], r["day"], r["total_2"], r["n_2"], r["total_9"], r["n_9"]) for r in trailing_at(e, p, "who", "day", "cents", [2, 9]).collect())
    inside = lambda w, d, k: [x[3] or 0 for x in rows if x[0] == w and d - k < x[2] <= d]
    assert got == sorted((t, d, sum(inside(w, d, 2)), len(inside(w, d, 2)), sum(inside(w, d, 9)), len(inside(w, d, 9))) for w, d, t in points if w)


@pytest.mark.parametrize("size", [1, 3, 11, 1000])
def test_streams_of_any_batches(size):
    random.seed(size)
    cells = {("abc"[k % 3], random.randint(-20, 60)): random.randint(1, 9) for k in range(90)}
    rows = [(w, d, n, 1, 62) for (w, d), n in sorted(cells.items())]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + size], strict=True)], names=["entity", "day", "total", "n", "last"]) for k in range(0, len(rows), size)]
    got = sorted(tuple(r.values()) for b in _all_days(iter(batches), [1, 7, 100], list("edwtn")) for r in b.to_pylist())
    want = []
    for who in "abc":
        own = {d: n for (w, d), n in cells.items() if w == who}
        want += [(who, d, k, sum(n for t, n in own.items() if d - k < t <= d), sum(d - k < t <= d for t in own)) for d in range(min(own), 63) for k in (1, 7, 100)]
    assert got == sorted(want)


def test_empty_events(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert rolling_totals(e, "who", "day", "cents", 7).count() == 0


def test_orders_are_read_once_and_whole(spark):
    rows = [
        (1, "s^b^c", " m1 ", "2014-01-02T00:00:00", 1.5, "x"), (1, "s^b^c ", "m1", "20140102", 1.5, "y"), (2, "s^-999", "m1", "2014-01-02", 1.0, "x"),
        (3, "s^b^c", "-999", "2014-01-02", 1.0, "x"), (4, "s^b^c", "m1", "", 1.0, "x"), (5, "s^b^c", "m1", "2014/01/03", None, "x"), (6, "s^b^c", "m1", "2014/01/03", -2.25, None), (None, "s^b^c", "m1", "2014/01/03", 1.0, None),
    ]
    got = sorted(tuple(r) for r in clean_orders(spark.createDataFrame(rows, "so_id bigint, shop_id string, member_id string, so_date string, amount double, part_date string")).collect())
    assert got == [(1, "s^b^c", "m1", 16072, 15000), (6, "s^b^c", "m1", 16073, -22500)]
