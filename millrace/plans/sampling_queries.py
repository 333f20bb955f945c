"""Queries of samples, modes and join forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import sampling as sm
from millrace.plans.tables import table


def split_counts(s, d):
    """Sizes of a split into 8, 1 and 1 tenths; the parts make up the table."""
    parts = sm.split(table(s, d, "orders"), ["o_orderkey"], [0.8, 0.1, 0.1])
    out = None
    for i, p in enumerate(parts):
        one = p.agg(F.lit(i).alias("part"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def split_whole(s, d):
    """The parts of a split together: all rows, none twice, and each part near its share."""
    o = table(s, d, "orders")
    parts = sm.split(o, ["o_orderkey"], [0.8, 0.1, 0.1])
    whole = parts[0].withColumn("part", F.lit(0)).unionByName(parts[1].withColumn("part", F.lit(1))).unionByName(parts[2].withColumn("part", F.lit(2)))
    near = F.abs(F.count_if(F.col("part") == 0) / F.count(F.lit(1)) - 0.8) < 0.05
    return whole.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("different"), near.alias("near"))


def sampled_whole(s, d):
    """Ten users sampled: how many they are, and if every one of them keeps all rows."""
    e = table(s, d, "events")
    own = sm.sample_keys(e, "user_id", 10).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    every = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("m"))
    return own.join(every, "user_id").agg(F.count(F.lit(1)).alias("users"), F.min(F.col("n") == F.col("m")).alias("whole"))


def strata(s, d):
    """Sampled orders by status: if each stratum's share is near what was asked for."""
    o = table(s, d, "orders")
    shares = {"F": 0.5, "O": 0.2}
    got = sm.stratified(o, "o_orderstatus", shares).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    of = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("m"))
    want = F.when(F.col("o_orderstatus") == "F", 0.5).otherwise(0.2)
    return of.join(got, "o_orderstatus").select("o_orderstatus", (F.abs(F.col("n") / F.col("m") - want) < 0.1).alias("near"))


def sampled_users(s, d):
    return sm.sample_keys(table(s, d, "events"), "user_id", 10).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def lucky_draw(s, d):
    return sm.exactly(table(s, d, "customer").select("c_custkey"), ["c_custkey"], 1)


def mode_of_priority(s, d):
    return sm.modes(table(s, d, "orders"), "o_orderpriority")


def repeated_rows(s, d):
    return sm.repeated(table(s, d, "userlog"), ["log_id"])


def joined_counts(s, d):
    return sm.joined_counts(table(s, d, "orders"), "o_orderpriority", "o_orderstatus")


def right_join_parts(s, d):
    """Every part with the number of its order lines, by a right join."""
    n = table(s, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return n.join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"), "right").select("p_partkey", F.coalesce("n", F.lit(0)).alias("n"))


def place_in_group(s, d):
    return sm.running_rank(table(s, d, "part").select("p_brand", "p_partkey", "p_retailprice"), "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")]).withColumns({c: F.col(c).cast("bigint") for c in ("place", "of")})


QUERIES = {f.__name__: f for f in (split_counts, split_whole, sampled_whole, strata, sampled_users, lucky_draw, mode_of_priority, repeated_rows, joined_counts, right_join_parts, place_in_group)}

SQL = {
    "split_whole": "select count(*)::bigint as n, count(distinct o_orderkey)::bigint as different, true as near from orders",
    "sampled_whole": "select least(10, count(distinct user_id))::bigint as users, true as whole from events",
    "strata": "select distinct o_orderstatus, true as near from orders where o_orderstatus in ('F', 'O')",
    "mode_of_priority": "with g as (select o_orderpriority, count(*)::bigint as n from orders group by 1) select * from g where n = (select max(n) from g)",
    "repeated_rows": "select log_id, count(*)::bigint as n from userlog group by 1 having count(*) > 1",
    "joined_counts": "with c as (select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2) select o_orderpriority, string_agg(concat(o_orderstatus, ';', n), ',' order by o_orderstatus) as counts from c group by 1",
    "right_join_parts": "select p_partkey, count(l_orderkey)::bigint as n from lineitem right join part on l_partkey = p_partkey group by 1",
    "place_in_group": "select p_brand, p_partkey, p_retailprice, (row_number() over (partition by p_brand order by p_retailprice desc, p_partkey))::bigint as place, (count(*) over (partition by p_brand))::bigint as of from part",
}
