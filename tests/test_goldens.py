import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.functions import scalar as fn
from millrace.operators import crm, dtree, ml, profile, relational as rel, textir as ir, weblog, windows as win
from millrace.plans.log_queries import WEATHER_COLUMNS, weather


def one(spark, *cols):
    return list(spark.range(1).select(*cols).first())


def test_gain_ratios_of_the_weather_table(spark):
    g = {r["var"]: r for r in dtree.gain_ratios(dtree.to_long(weather(spark), WEATHER_COLUMNS[:-1], "play")).collect()}
    assert [g[v]["gain_ratio"] for v in WEATHER_COLUMNS[:-1]] == pytest.approx([0.156427562421, 0.0187726462225, 0.151835501362, 0.0488486155113], rel=1e-10)
    assert [g[v]["conditional"] for v in WEATHER_COLUMNS[:-1]] == pytest.approx([0.693536138896, 0.911063393012, 0.788450457308, 0.892158928262], rel=1e-10)
    assert round(g["outlook"]["outcome"], 11) == 0.94028595867


def test_the_weather_tree(spark):
    nodes = {n["node"]: n for n in dtree.grow(weather(spark), WEATHER_COLUMNS[:-1], "play")}
    assert nodes["root"]["var"] == "outlook" and nodes["root"]["rules"] == ["Overcast", "Rainy", "Sunny"]
    assert nodes["root/outlook=Sunny"]["var"] == "humidity" and nodes["root/outlook=Rainy"]["var"] == "windy"
    assert nodes["root/outlook=Overcast"]["gain_ratio"] == 0
    assert len(dtree.tree_json(list(nodes.values()))) == 4


def test_words(spark):
    w = spark.createDataFrame([("cat",), ("elephant",), ("rat",), ("rat",), ("cat",)], "t string")
    assert {tuple(r) for r in ir.word_counts(w, "t").collect()} == {("cat", 2), ("elephant", 1), ("rat", 2)}
    assert one(spark, fn.remove_punctuation(F.lit(" The Elephant's 4 cats. "))) == ["the elephants 4 cats"]
    assert one(spark, fn.tokens(F.lit("A quick brown fox jumps over the lazy dog.")), fn.tokens(F.lit(" "))) == ["a quick brown fox jumps over the lazy dog".split(), []]
    tf = {r["token"]: r["tf"] for r in ir.term_frequencies(spark.createDataFrame([(1, "one_ one_ two!")], "d int, t string"), "d", "t").collect()}
    assert tf == {"one_": pytest.approx(2 / 3), "two": pytest.approx(1 / 3)}
    assert [ir.stem(x) for x in ("caresses", "ponies", "relational", "hopping", "happy", "electriciti", "adjustment", "sky")] == ["caress", "poni", "relat", "hop", "happi", "electr", "adjust", "sky"]


def test_arrays(spark):
    a = F.array(*[F.lit(float(x)) for x in range(6)])
    assert one(spark, fn.block_sums(a, 3), fn.block_sums(a, 2), fn.tile_sums(a, 3)) == [[3.0, 12.0], [1.0, 5.0, 9.0], [3.0, 5.0, 7.0]]
    assert one(spark, fn.two_way_interactions(F.array(F.lit(2.0), F.lit(3.0)))) == [[2.0, 3.0, 4.0, 6.0, 6.0, 9.0]]
    assert one(spark, fn.gaussian_kernel(F.array(F.lit(1.0), F.lit(2.0), F.lit(1.0)), F.array(F.lit(0.0), F.lit(4.0), F.lit(-1.0)), 2.0))[0] == pytest.approx(0.324652, abs=1e-6)
    assert one(spark, fn.rotate_span(F.lit("abcdef"), 2, 4, 1), fn.power_bucket(F.lit(9)), fn.path_level(F.lit("a^b"), 2), fn.congruential(F.lit(7), 5, 3, 16, 3)) == ["adbcef", 16, "b", [6, 1, 8]]


def test_losses(spark):
    got = one(spark, *[fn.log_loss(F.lit(p), F.lit(y)) for p, y in ((0.5, 1), (0.99, 1), (0.01, 1), (0.0, 1), (1.0, 1), (1.0, 0))])
    assert got == pytest.approx([0.69314718056, 0.0100503358535, 4.60517018599, 25.3284360229, 1.00000008275e-11, 25.3284360229], rel=1e-6)


def test_principal_component_of_a_grid(spark):
    x = np.arange(20, dtype=float).reshape(5, 4)
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x], ["features"])
    m = ml.principal(df, 1)
    assert m.explainedVariance[0] == pytest.approx(1.0) and np.allclose(np.abs(m.pc.toArray()[:, 0]), 0.5)
    assert np.linalg.eigvalsh(np.cov(x.T, bias=True))[-1] == pytest.approx(128.0)


def test_islands_and_gaps(spark):
    d = spark.createDataFrame([("a", x) for x in (1, 2, 3, 5, 8, 12, 13, 14, 15, 15)], "k string, x int")
    assert sorted((r["low"], r["label"]) for r in win.islands(d, ["k"], "x").collect()) == [(1, "1~3"), (5, "5"), (8, "8"), (12, "12~15")]


def test_percentiles_by_nearest_rank(spark):
    d = spark.createDataFrame([("a", float(x)) for x in (5, 1, 3, 3, 9)], "k string, x double")
    got = {r["p"]: r["value"] for r in rel.percentile_table(d, ["k"], "x", [1, 50, 75, 100]).collect()}
    assert got == {1: 1.0, 50: 3.0, 75: 5.0, 100: 9.0}
    with pytest.raises(ValueError):
        rel.percentile_table(d, ["k"], "x", [0])


def test_mean_std_keeps_its_own_variance(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", None)], "k string, x double")
    got = {r["k"]: (r["n"], r["mean"], round(r["sd"], 6)) for r in rel.mean_std(d, ["k"], "x").collect()}
    assert got == {"a": (2, 2.0, round(math.sqrt(10 / 1 - 4), 6)), "b": (1, -999.0, -999.0)}


def test_profile_spec():
    assert profile.parse_spec("2:Gender:C,9:Money:N") == [(2, "Gender", "C"), (9, "Money", "N")]
    for bad in ("1:x:Z", "x:y:N", "1:x", "1:a:N,2:a:C"):
        with pytest.raises(ValueError):
            profile.parse_spec(bad)


def test_log_line(spark):
    line = '127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] "GET /images/launch-logo.gif HTTP/1.0" 200 1839'
    good, bad = rel.split_good_bad(weblog.parse_common(spark.createDataFrame([(line,), ("broken",), (None,)], "line string")), F.col("parsed"))
    r = good.first()
    assert (r["response_code"], r["content_size"], r["stamp"].day, r["host"]) == (200, 1839, 1, "127.0.0.1")
    assert bad.count() == 2
    x = weblog.parse_extended(spark.createDataFrame([(line + ' "http://a/" "Mozilla/5.0 (iPhone) Safari/1"',)], "line string")).first()
    assert (x["device"], x["browser"], x["os"], x["last_page"]) == ("mobile", "Safari", "iOS", "http://a/")


def test_day_by_day_state_equals_all_at_once(spark):
    t = spark.createDataFrame([("s", m, f"2014-01-{d:02d}", float(d)) for m in ("a", "b") for d in (1, 3, 3, 9) if (m, d) != ("b", 1)], "shop_id string, member_id string, o string, amount double").withColumn("ordate", F.to_date("o"))
    empty = t.where("false").select("shop_id", "member_id", F.col("ordate").alias("first"), F.col("ordate").alias("last"), F.lit(0).cast("bigint").alias("F"), F.col("amount").alias("M"))
    state = empty
    for d in (1, 3, 9):
        state = crm.merge_lrfm(state, t.where(F.dayofmonth("ordate") == d))
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, crm.merge_lrfm(empty, t).collect()))


def test_survival(spark):
    d = spark.createDataFrame([(1.0, 1), (2.0, 1), (2.0, 0), (3.0, 1), (4.0, 0)], "t double, e int")
    c = ml.kaplan_meier(d, "t", "e")
    assert [(r["time"], r["at_risk"], round(r["survival"], 6)) for r in c.orderBy("time").collect()] == [(1.0, 5, 0.8), (2.0, 4, 0.6), (3.0, 2, 0.3)]
    assert ml.median_survival(c).first()["median"] == 3.0
    assert ml.t_p_value(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)


def test_gradient_descent_goes_down(spark):
    d = spark.createDataFrame([(x / 10, 1.0, 2 * x / 10 + 1) for x in range(10)], "x double, one double, y double")
    w, e = ml.gradient_descent(d, ["x", "one"], "y", 500, 1.0)
    assert e[-1] < 0.1 * e[0] and w == pytest.approx([2, 1], abs=0.5)


def test_one_hot_and_hashing(spark):
    d = spark.createDataFrame([("mouse", "black", None), ("cat", "tabby", "mouse"), ("bear", "black", "salmon")], "a string, b string, c string")
    got = {(r["feature"], r["value"]): r["index"] for r in ml.one_hot_dictionary(d, ["a", "b", "c"]).collect()}
    assert len(got) == 7 and sorted(got.values()) == list(range(7))
    import pandas as pd

    assert ml.md5_buckets(pd.Series(["mouse\t0", "black\t1"]), 4).between(0, 3).all()
