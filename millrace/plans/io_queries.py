"""Sources and sinks as queries: a table is written, read back, and must be what it was."""

from __future__ import annotations

import datetime as dt
import sqlite3
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import tasks
from millrace.plans.tables import table
from millrace.session import ensure_checkpoint_dir
from millrace.sources import outside, readers, sinks, tables


def _folder(s: SparkSession) -> str:
    """A folder of its own beside the checkpoints, which all executors see."""
    return f"{ensure_checkpoint_dir(s)}/io-{uuid.uuid4().hex}"


def _nations(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("bigint").alias("n_regionkey"))


_SCHEMA = "n_nationkey bigint, n_name string, n_regionkey bigint"


def io_text(s, d):
    f = _folder(s)
    sinks.write_text(_nations(s, d), f, "n_name")
    return readers.text_lines(s, f).withColumnRenamed("value", "n_name")


def io_gzip_glob(s, d):
    """Gzipped lines in several folders, read by one pattern."""
    f = _folder(s)
    for k in range(2):
        _nations(s, d).where(F.col("n_regionkey") % 2 == k).select("n_name").write.option("compression", "gzip").text(f"{f}/part{k}")
    return readers.text_lines(s, f"{f}/part*").withColumnRenamed("value", "n_name")


def io_delimited(s, d):
    f = _folder(s)
    sinks.write_csv(_nations(s, d), f, sep="\t", header=False)
    return readers.delimited(s, f, "\t", _SCHEMA)


def io_csv_inferred(s, d):
    f = _folder(s)
    sinks.write_csv(_nations(s, d), f)
    return readers.delimited_inferred(s, f).select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("bigint").alias("n_regionkey"))


def io_json(s, d):
    f = _folder(s)
    sinks.write_json(_nations(s, d), f)
    sinks.write_json(_nations(s, d).where("n_nationkey = 0"), f, "append")
    return readers.json_lines(s, f, _SCHEMA)


def io_json_array(s, d):
    f = _folder(s)
    s.createDataFrame([(sinks.pretty_json(_nations(s, d)),)], "t string").coalesce(1).write.text(f)
    return readers.json_array(s, f, _SCHEMA)


def io_parquet_partitions(s, d):
    """Partitioned by region; one partition is written again and replaced alone."""
    f = _folder(s)
    sinks.write_parquet(_nations(s, d), f, ["n_regionkey"])
    sinks.write_parquet(_nations(s, d).where("n_regionkey = 1").withColumn("n_name", F.lower("n_name")), f, ["n_regionkey"])
    return readers.parquet(s, f).select("n_nationkey", "n_name", F.col("n_regionkey").cast("bigint").alias("n_regionkey"))


def io_days(s, d):
    """Orders partitioned by day, the last seven days of one read again."""
    f = _folder(s)
    o = table(s, d, "orders").select(F.col("o_orderkey"), F.to_date("o_orderdate").alias("day")).where("day between date '1997-03-01' and date '1997-03-31'")
    sinks.write_parquet(o, f, ["day"])
    return readers.partitions_of_days(s, f, "day", "1997-03-20", 7).select("o_orderkey", F.to_date("day").alias("day"))


def io_external_table(s, d):
    """A table over folders, its partitions added one by one."""
    f, name = _folder(s), f"ext_{uuid.uuid4().hex}"
    for k in range(5):
        _nations(s, d).where(F.col("n_regionkey") == k).select("n_nationkey", "n_name").write.parquet(f"{f}/any{k}")
    tables.create_external(s, name, f"{f}/table", "n_nationkey bigint, n_name string, n_regionkey bigint", ["n_regionkey"])
    for k in range(5):
        tables.add_partition(s, name, {"n_regionkey": str(k)}, f"{f}/any{k}")
    return s.table(name)


def io_load_data(s, d):
    """Files loaded into a table, a second time over the first."""
    f, name = _folder(s), f"load_{uuid.uuid4().hex}"
    sinks.write_csv(_nations(s, d), f"{f}/in", header=False)
    tables.create_external(s, name, f"{f}/table", _SCHEMA)
    for _ in range(2):
        tables.load_data(s, name, f"{f}/in", "csv", overwrite=True)
    tables.load_data(s, name, f"{f}/in", "csv")
    return s.table(name)


def io_bucketed(s, d):
    """Bucketed and partitioned inserts; one partition replaced alone, then joined on the buckets."""
    f, name = _folder(s), f"bucket_{uuid.uuid4().hex}"
    o = table(s, d, "orders").select(F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderkey", "o_orderstatus")
    tables.create_bucketed(s, name, o, f, ["o_custkey"], 4, ["o_orderstatus"])
    tables.insert_bucketed(o, name)
    tables.insert_bucketed(o.where("o_orderstatus = 'P'"), name, overwrite=True)
    return s.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


def io_insert(s, d):
    """Rows inserted twice, then all replaced by half of them."""
    f, name = _folder(s), f"ins_{uuid.uuid4().hex}"
    tables.create_external(s, name, f, _SCHEMA)
    for _ in range(2):
        sinks.insert(_nations(s, d), name)
    sinks.insert(_nations(s, d).where("n_nationkey < 12"), name, overwrite=True)
    return s.table(name)


def io_single_file(s, d):
    f = _folder(s)
    sinks.write_single(_nations(s, d), f)
    files = s.read.format("binaryFile").load(f"{f}/*.csv").count()
    return readers.delimited(s, f, "\t", _SCHEMA).withColumn("files", F.lit(files).cast("bigint"))


def io_per_group(s, d):
    f = _folder(s)
    sinks.write_per_group(_nations(s, d), f, "n_regionkey", "n_name")
    return s.read.text(f).select(F.col("n_regionkey").cast("bigint").alias("n_regionkey"), F.col("value").alias("n_name"))


def io_sqlite(s, d):
    """Regions through a local database: read on the driver, and by one task a part."""
    import tempfile

    file = f"{tempfile.mkdtemp()}/lookup.db"  # a local lookup file; only rows read on this machine use it
    con = sqlite3.connect(file)
    con.execute("create table region (k integer, name text)")
    con.executemany("insert into region values (?, ?)", [tuple(r) for r in table(s, d, "region").select("r_regionkey", "r_name").collect()])  # five rows
    con.commit()
    con.close()
    return readers.sqlite(s, file, "select k, name from region", "k bigint, name string")


def io_nested(s, d):
    """Bags and maps written as text, read as arrays and maps."""
    t = table(s, d, "region").select("r_regionkey", F.concat(F.lit("{("), "r_name", F.lit("),(x)}")).alias("bag"), F.concat(F.lit("[name#"), "r_name", F.lit(",k#1]")).alias("m"))
    n = readers.nested_tuples(t, "bag", "m")
    return n.select(F.col("r_regionkey").cast("bigint").alias("r_regionkey"), F.col("bag")[0].alias("first"), F.size("bag").cast("bigint").alias("n"), F.col("m")["name"].alias("name"))


def io_cells(s, d):
    """Versions of cells put, then the latest two of a range of rows."""
    f = _folder(s)
    c = table(s, d, "orders").where("o_orderstatus = 'P'").select(F.format_string("%05d", F.col("o_custkey").cast("bigint")).alias("row"), F.lit("o").alias("family"), F.lit("key").alias("qualifier"), F.col("o_orderkey").cast("bigint").alias("ts"), F.col("o_orderpriority").alias("value"))
    tables.put_cells(c, f)
    return tables.get_cells(s, f, low="00100", high="00800", versions=2).select("row", "ts", "value", F.col("version").cast("bigint").alias("version"))


def io_find(s, d):
    return tables.find(table(s, d, "part"), {"p_size": {"$gte": 10, "$lt": 20}, "$or": [{"p_brand": "Brand#11"}, {"p_brand": {"$in": ["Brand#12", "Brand#13"]}}], "p_name": {"$exists": True}}).select("p_partkey", "p_brand")


def io_update(s, d):
    """Documents with a field set, one renamed and one pushed to."""
    n = _nations(s, d).withColumn("tags", F.array("n_name"))
    u = sinks.update_document(n, sets={"seen": 1}, renames={"n_name": "name"}, pushes={"tags": F.lit("new")})
    return u.select("n_nationkey", "name", F.col("seen").cast("bigint").alias("seen"), F.array_join("tags", ";").alias("tags"))


def io_lookup(s, d):
    """A service's replies to each region asked for by customers' nations; it knows all but one."""
    n = _nations(s, d).withColumn("key", F.col("n_regionkey").cast("string"))
    reply = lambda keys: [None if k == "3" else f'{{"code": "R{k}", "n": {k}}}' for k in keys]
    return outside.lookup(n, "key", reply, "code string, n bigint", batch=2).select("n_nationkey", "found.code", "found.n")


def io_crawl(s, d):
    """Pages that link to the next two, fetched level by level and their headings read."""
    ensure_checkpoint_dir(s)
    pages = outside.crawl(s, ["p1"], lambda u: f"<h1>Page {u[1:]}</h1>" if int(u[1:]) <= 20 else None, lambda u, h: [f"p{2 * int(u[1:])}", f"p{2 * int(u[1:]) + 1}"], 100)
    return pages.select("url", F.col("depth").cast("bigint").alias("depth"), F.regexp_extract("html", "<h1>(.*)</h1>", 1).alias("heading"))


def io_retention(s, d):
    """Folders of days, the old ones dropped, the rest read."""
    f = _folder(s)
    o = table(s, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")).where("day between date '1997-03-01' and date '1997-03-31'")
    sinks.write_parquet(o, f, ["day"])
    outside.drop_old(s, f, dt.date(1997, 3, 31), 10)
    return s.read.parquet(f).select("o_orderkey", F.to_date("day").alias("day"))


def io_task_graph(s, d):
    """Monthly steps that carry a state from month to month, run twice: the second run makes nothing."""
    f = _folder(s)
    o = table(s, d, "orders").select(F.last_day(F.to_date("o_orderdate")).alias("month"), "o_totalprice")

    def build(day: dt.date) -> list[tasks.Task]:
        before = (day.replace(day=1) - dt.timedelta(1)).isoformat()
        first = day.isoformat() == "1996-01-31"
        month = tasks.Task(f"month {day}", lambda: o.where(F.col("month") == F.lit(day)).agg(F.lit(day.isoformat()).alias("month"), F.count(F.lit(1)).alias("n")), f"{f}/month/{day}")
        total = lambda m, *past: m.withColumn("so_far", F.col("n") + F.lit(past[0].first()["so_far"] if past else 0))
        return [month, tasks.Task(f"total {day}", total, f"{f}/total/{day}", (month.name, *([] if first else [f"total {before}"])))]

    steps = tasks.for_periods(build, dt.date(1996, 1, 1), dt.date(1996, 4, 30), monthly=True)
    made = tasks.run(s, steps)
    again = tasks.run(s, steps)
    left = s.read.parquet(f"{f}/total/*")
    return left.withColumn("made", F.lit(sum(x.status == "made" for x in made)).cast("bigint")).withColumn("made_again", F.lit(sum(x.status == "made" for x in again)).cast("bigint"))


QUERIES = {f.__name__: f for f in (io_text, io_gzip_glob, io_delimited, io_csv_inferred, io_json, io_json_array, io_parquet_partitions, io_days, io_external_table, io_load_data, io_bucketed, io_insert, io_single_file, io_per_group, io_sqlite, io_nested, io_cells, io_find, io_update, io_lookup, io_crawl, io_retention, io_task_graph)}

_NATION = "select n_nationkey::bigint as n_nationkey, n_name, n_regionkey::bigint as n_regionkey from nation"
SQL = {
    "io_text": "select n_name from nation", "io_gzip_glob": "select n_name from nation",
    **dict.fromkeys(("io_delimited", "io_csv_inferred", "io_json_array", "io_external_table"), _NATION),
    "io_json": f"{_NATION} union all {_NATION} where n_nationkey = 0",
    "io_parquet_partitions": "select n_nationkey::bigint as n_nationkey, case when n_regionkey = 1 then lower(n_name) else n_name end as n_name, n_regionkey::bigint as n_regionkey from nation",
    "io_days": "select o_orderkey, o_orderdate::date as day from orders where o_orderdate::date between date '1997-03-14' and date '1997-03-20'",
    "io_load_data": f"{_NATION} union all {_NATION}",
    "io_bucketed": "select o_custkey::bigint as o_custkey, count(*)::bigint as n from orders group by 1",
    "io_insert": f"{_NATION} where n_nationkey < 12",
    "io_single_file": "select n_nationkey::bigint as n_nationkey, n_name, n_regionkey::bigint as n_regionkey, 1::bigint as files from nation",
    "io_per_group": "select n_regionkey::bigint as n_regionkey, n_name from nation",
    "io_sqlite": "select r_regionkey::bigint as k, r_name as name from region",
    "io_nested": "select r_regionkey::bigint as r_regionkey, r_name as first, 2::bigint as n, r_name as name from region",
    "io_cells": "with c as (select printf('%05d', o_custkey) as row, o_orderkey::bigint as ts, o_orderpriority as value, row_number() over (partition by o_custkey order by o_orderkey desc) as version from orders where o_orderstatus = 'P') select row, ts, value, version::bigint as version from c where version <= 2 and row >= '00100' and row < '00800'",
    "io_find": "select p_partkey, p_brand from part where p_size >= 10 and p_size < 20 and p_brand in ('Brand#11', 'Brand#12', 'Brand#13') and p_name is not null",
    "io_update": "select n_nationkey::bigint as n_nationkey, n_name as name, 1::bigint as seen, concat(n_name, ';new') as tags from nation",
    "io_lookup": "select n_nationkey::bigint as n_nationkey, case when n_regionkey <> 3 then concat('R', n_regionkey) end as code, case when n_regionkey <> 3 then n_regionkey::bigint end as n from nation",
    "io_crawl": "select concat('p', k) as url, floor(log2(k))::bigint as depth, case when k <= 20 then concat('Page ', k) end as heading from range(1, 42) t(k)",
    "io_retention": "select o_orderkey, o_orderdate::date as day from orders where o_orderdate::date between date '1997-03-21' and date '1997-03-31'",
    "io_task_graph": "with m as (select strftime(last_day(o_orderdate::date), '%Y-%m-%d') as month, count(*)::bigint as n from orders where o_orderdate::date between date '1996-01-01' and date '1996-04-30' group by 1) select month, n, (sum(n) over (order by month))::bigint as so_far, 8::bigint as made, 0::bigint as made_again from m",
}
