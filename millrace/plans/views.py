"""Canonical relations over the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.plans.tables import table

T_SQL = "t as (select concat('seg^', c_mktsegment) as shop_id, o_custkey as member_id, o_orderdate::date as ordate, o_totalprice as amount from orders join customer on o_custkey = c_custkey)"
ITEMS_SQL = "items as (select l_suppkey as shop_id, l_partkey as item_id, sum(l_quantity)::bigint as item_qt, round(sum(l_extendedprice), 2) as item_amt from lineitem group by all)"
CLICKS_SQL = "clicks as (select user_id as eruid, event_type as act, ts, value, props from events)"
STORE_SQL = "store as (select r_name as region, n_name as nation, c_mktsegment as segment, o_totalprice as amount from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"
LOG_SQL = "raw as (select event_id, concat('host', user_id, '.example - - [', strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' -0400] \"GET /', event_type, '/', user_id % 20, ' HTTP/1.0\" ', case when event_type = 'error' then '404' when event_type = 'signup' then '302' else '200' end, ' ', case when event_type = 'login' then '-' else cast(floor(value)::bigint as varchar) end) as line from events)"


def transactions(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(F.concat(F.lit("seg^"), "c_mktsegment").alias("shop_id"), F.col("o_custkey").alias("member_id"), F.to_date("o_orderdate").alias("ordate"), F.col("o_totalprice").alias("amount"))


def item_revenue(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("shop_id"), F.col("l_partkey").alias("item_id")).agg(F.sum("l_quantity").cast("bigint").alias("item_qt"), F.round(F.sum("l_extendedprice"), 2).alias("item_amt"))


def clicks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("eruid"), F.col("event_type").alias("act"), "ts", "value", "props")


def store_paths(spark: SparkSession, d: str) -> DataFrame:
    o, c, n, r = (table(spark, d, x) for x in ("orders", "customer", "nation", "region"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("o_totalprice").alias("amount"))


def raw_log(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "404").when(F.col("event_type") == "signup", "302").otherwise("200")
    size = F.when(F.col("event_type") == "login", "-").otherwise(F.floor("value").cast("bigint").cast("string"))
    line = F.concat(F.lit("host"), "user_id", F.lit(".example - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /'), "event_type", F.lit("/"), (F.col("user_id") % 20), F.lit(' HTTP/1.0" '), status, F.lit(" "), size)
    return table(spark, d, "events").select("event_id", line.alias("line"))
