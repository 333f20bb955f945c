import gzip
import sqlite3

from pyspark.sql import functions as F

from millrace.sources import readers, sinks
from millrace.streaming import flows


def test_text_and_delimited(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1::x::2.5\n2::y::oops\n")
    with gzip.open(tmp_path / "b.txt.gz", "wt") as f:
        f.write("3::z::1\n")
    assert readers.text_lines(spark, str(tmp_path / "*.txt*")).count() == 3
    d = readers.delimited(spark, str(tmp_path / "a.txt"), "::", "id int, name string, v double, bad string", bad_column="bad").cache()
    assert [(r["id"], r["v"], r["bad"] is None) for r in d.orderBy("id").collect()] == [(1, 2.5, True), (2, None, False)]


def test_json_sqlite_lookup_nested(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": [1, 2]}, {"a": 2, "b": []}]')
    assert readers.json_array(spark, str(tmp_path / "a.json"), "a int, b array<int>").count() == 2
    con = sqlite3.connect(tmp_path / "x.db")
    con.executescript("create table t (k text, v int); insert into t values ('a', 1), ('b', null)")
    con.commit()
    assert sorted(map(tuple, readers.sqlite(spark, str(tmp_path / "x.db"), "select * from t", "k string, v int").collect()), key=str) == [("a", 1), ("b", None)]
    assert readers.lookup_json(spark, '[{"k": "a"}]', "k string").first()["k"] == "a"
    n = readers.nested_tuples(spark.createDataFrame([("{(p),(q)}", "[a#1,b#2]")], "bag string, m string"), "bag", "m").first()
    assert n["bag"] == ["p", "q"] and n["m"] == {"a": "1", "b": "2"}
    c = spark.createDataFrame([("r", "f", "q", 1, "old"), ("r", "f", "q", 2, "new")], "row string, cf string, qualifier string, ts int, value string")
    assert readers.cells(c, "row").first()["value"] == "new"


def test_round_trips(spark, tmp_path):
    d = spark.createDataFrame([(1, "a", "2014-01-01"), (2, "b", "2014-01-02"), (3, None, "2014-01-09")], "id int, s string, dt string")
    sinks.write_parquet(d, str(tmp_path / "p"), ["dt"])
    sinks.write_parquet(d.where("id = 1").withColumn("s", F.lit("z")), str(tmp_path / "p"), ["dt"])
    assert sorted((r["id"], r["s"]) for r in readers.parquet(spark, str(tmp_path / "p")).collect()) == [(1, "z"), (2, "b"), (3, None)]
    some = readers.partitions_of_days(spark, str(tmp_path / "p"), "dt", "2014-01-02", 2)
    assert some.count() == 2
    sinks.write_json(d, str(tmp_path / "j"))
    sinks.write_json(d, str(tmp_path / "j"), "append")
    assert readers.json_lines(spark, str(tmp_path / "j"), "id int, s string, dt string").count() == 6
    sinks.write_csv(d, str(tmp_path / "c"))
    assert readers.delimited_inferred(spark, str(tmp_path / "c")).count() == 3
    sinks.write_text(d, str(tmp_path / "t"), "s")
    sinks.write_single(d, str(tmp_path / "one"))
    sinks.write_per_group(d.na.fill("none"), str(tmp_path / "g"), "s", "id")
    assert sorted(p.name for p in (tmp_path / "g").glob("s=*")) == ["s=a", "s=b", "s=none"]
    sinks.save_table(d, "kept", bucket_by=["id"], buckets=2)
    sinks.insert(d, "kept")
    assert spark.table("kept").count() == 6
    assert '"id": 1' in sinks.pretty_json(d)
    u = sinks.update_document(d.withColumn("tags", F.array(F.lit("x"))), {"n": 1}, {"s": "name"}, {"tags": "y"}).first()
    assert u["n"] == 1 and u["name"] == "a" and u["tags"] == ["x", "y"]
    assert sinks.expired(d, "dt", "2014-01-10", 7).count() == 2


def test_streams(spark, tmp_path):
    e = spark.createDataFrame([(1, "2024-01-01 00:10:00"), (1, "2024-01-01 00:20:00"), (1, "2024-01-01 05:00:00"), (2, "2024-01-02 00:00:00"), (9, "2024-02-01 00:00:00")], "k int, t string").select("k", F.to_timestamp("t").alias("ts"), F.lit(1.0).alias("v"))
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = flows.read_folder(spark, str(tmp_path / "in"), e.schema)
    q = flows.windowed_counts(s, "ts", "k", "v").writeStream.format("memory").queryName("w").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["k"], r["n"]) for r in spark.sql("select * from w").collect()) == [(1, 3), (2, 1)]
    q = flows.session_counts(flows.read_folder(spark, str(tmp_path / "in"), e.schema), "ts", "k").writeStream.format("memory").queryName("s").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["k"], r["n"]) for r in spark.sql("select * from s").collect()) == [(1, 1), (1, 2), (2, 1)]
    seen = []
    flows.alerts(flows.read_folder(spark, str(tmp_path / "in"), e.schema), "k = 9", lambda df, _: seen.extend(df.collect()), str(tmp_path / "ck")).awaitTermination()
    assert len(seen) == 1
    flows.land(flows.read_folder(spark, str(tmp_path / "in"), e.schema), str(tmp_path / "out"), str(tmp_path / "ck2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
