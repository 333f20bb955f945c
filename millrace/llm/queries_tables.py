"""Queries over event and item tables: runs of actions, best items of each shop and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.parse import clean_text, epoch_millis, iso_millis
from millrace.functions.scalar import row_hashes
from millrace.llm.runs import collapse_runs
from millrace.llm.topn import top_n
from millrace.plans.bounds import broadcast_if_small
from millrace.plans.tables import table

TOP = 10


def action_key(action: Column) -> Column:
    """An action's name without spelling and what is attached to it (``?a=b``, ``#c1``, ``:12`` and the like)."""
    bare = F.regexp_replace(F.lower(F.trim(action)), r"[?#:;&=@(\[,].*$", "")
    return F.trim(F.regexp_replace(bare, r"[^a-z0-9]+", "."), F.lit("."))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """The log's lines with their author, instant and action's key.

    Copies of a line that are equal stay in: they share author, instant and id, by which the runs count them once. If
    copies of some line differ (which a combined hash of each line tells), lines are taken by id and the least copy counts.
    """
    raw = table(spark, d, "userlog").where("log_id is not null")
    told = row_hashes(["author", "op_at", "op_date", "action"])[0]
    differ = not raw.groupBy("log_id").agg(F.min(told).alias("least"), F.max(told).alias("most")).where("least <> most").isEmpty()
    log = raw.select("log_id", clean_text(F.col("author")).alias("author"), F.coalesce(epoch_millis(F.col("op_at")), iso_millis(F.col("op_date"))).alias("at"), action_key(clean_text(F.col("action"))).alias("key")).where("author is not null and at is not null")
    return log.groupBy("log_id").agg(F.min(F.struct("author", "at", "key")).alias("x")).select("log_id", "x.*") if differ else log


def _action_runs(spark: SparkSession, d: str, min_rows: int) -> tuple[DataFrame, DataFrame]:
    names = table(spark, d, "action_names").select(action_key(F.col("action_name")).alias("key"), "action_id", "action_name").where("key is not null").groupBy("key").agg(F.min(F.struct("action_id", "action_name")).alias("named"))
    log = _lines(spark, d).join(broadcast_if_small(names.select("key", "named.action_id")), "key", "left")
    return collapse_runs(log, "author", "at", "log_id", "action_id", min_rows), names.select("named.*")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _action_runs(spark, d, 2)[0].select(F.col("entity").alias("author"), F.col("first_id").alias("first_log_id"), F.col("last_id").alias("last_log_id"))


def p1_runs(spark: SparkSession, d: str) -> DataFrame:
    """Every run, those of one row too, with its length and its duration in milliseconds."""
    runs, names = _action_runs(spark, d, 1)
    runs = runs.join(broadcast_if_small(names), F.col("value") == F.col("action_id"))
    return runs.select(F.col("entity").alias("author"), F.col("action_name").alias("action"), F.col("first_id").alias("first_log_id"), F.col("last_id").alias("last_log_id"), "duration", F.col("n").cast("bigint").alias("n"))


def _best_items(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "itemrevenue").select("cal_date", "shop_id", "item_id", "item_qt", "item_amt")
    return top_n(rows, ["cal_date", "shop_id"], "item_qt", [F.col("item_amt").desc_nulls_last(), F.col("item_id").asc_nulls_last()], TOP, distinct=True)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _best_items(spark, d).select("cal_date", "shop_id", "item_id").distinct()


def p6_ranked(spark: SparkSession, d: str) -> DataFrame:
    """The best items with their rank and measures."""
    return _best_items(spark, d).select("cal_date", "shop_id", "item_id", F.col("item_qt").cast("bigint").alias("item_qt"), "item_amt", F.col("rank").cast("bigint").alias("rank"))


QUERIES = {"p1_found": p1_found, "p1_runs": p1_runs, "p6_found": p6_found, "p6_ranked": p6_ranked}

_KEY = "trim(regexp_replace(regexp_replace(lower(trim({c})), '[?#:;&=@(\\[,].*$', ''), '[^a-z0-9]+', '.', 'g'), '.')"
_RUNS = f"""with names as (select {_KEY.format(c='action_name')} as key, min((action_id, action_name)) as named from action_names group by 1),
 logs as (select log_id, trim(author) as author, coalesce(case when abs(op_at) >= 100000000000000 then op_at // 1000 when abs(op_at) >= 100000000000 then op_at else op_at * 1000 end, epoch_ms(try_cast(trim(op_date) as timestamptz))) as ms, {_KEY.format(c='action')} as key from userlog where lower(trim(author)) not in ('', '-', '-999', 'null')),
 once as (select log_id, min((author, ms, key)) as x from logs where ms is not null group by 1),
 a as (select log_id, x[1] as author, x[2] as ms, named[1] as id, named[2] as action from once left join names on names.key = x[3]),
 b as (select *, case when lag(id) over w is distinct from id or row_number() over w = 1 then 1 else 0 end as fresh from a window w as (partition by author order by ms, log_id)),
 c as (select *, sum(fresh) over (partition by author order by ms, log_id rows unbounded preceding) as nr from b)"""
_TOP = f"""with r as (select distinct * from itemrevenue where item_qt is not null), k as (select *, row_number() over (partition by cal_date, shop_id order by item_qt desc, item_amt desc nulls last, item_id) as rank from r), t as (select * from k where rank <= {TOP})"""

SQL = {
    "p1_found": f"{_RUNS} select author, min_by(log_id, (ms, log_id)) as first_log_id, max_by(log_id, (ms, log_id)) as last_log_id from c where id is not null group by author, nr having count(*) >= 2",
    "p1_runs": f"{_RUNS} select author, min(action) as action, min_by(log_id, (ms, log_id)) as first_log_id, max_by(log_id, (ms, log_id)) as last_log_id, (max(ms) - min(ms))::bigint as duration, count(*)::bigint as n from c where id is not null group by author, nr",
    "p6_found": f"{_TOP} select distinct cal_date, shop_id, item_id from t",
    "p6_ranked": f"{_TOP} select cal_date, shop_id, item_id, item_qt::bigint as item_qt, item_amt, rank::bigint as rank from t",
}
