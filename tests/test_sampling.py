from millrace.operators import sampling as sm


def test_splits_make_up_the_table_and_stay(spark):
    d = spark.range(1000)
    parts = [sorted(r[0] for r in p.collect()) for p in sm.split(d, ["id"], [8, 1, 1])]
    assert sorted(sum(parts, [])) == list(range(1000)) and 740 < len(parts[0]) < 860
    assert parts == [sorted(r[0] for r in p.collect()) for p in sm.split(d.repartition(7), ["id"], [8, 1, 1])]


def test_samples(spark):
    d = spark.createDataFrame([(i % 9, i) for i in range(90)] + [(None, 1)], "k int, v int")
    assert sm.sample_keys(d, "k", 3).count() == 30 and sm.exactly(d.dropna(), ["k", "v"], 7).count() == 7
    assert sm.stratified(d, "k", {1: 1.0}).count() == 10
    assert sm.with_replacement(d, 2.0).count() > 91
    assert {tuple(r) for r in sm.repeated(d, ["v"]).collect()} == {(1, 2)}
    assert sm.modes(d, "k").count() == 9


def test_price_steps(spark):
    assert all(r["jump"] >= 2 for r in sm.price_steps(spark, 26.3, 5).collect())
