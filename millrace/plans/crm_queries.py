"""Queries over shop members' orders, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import crm, relational as rel, windows as win
from millrace.plans.views import ITEMS_SQL, STORE_SQL, T_SQL, item_revenue, store_paths, transactions

#: The day and calendar the reports are made for.
CAL, START, END, PERIOD = "1998-06-30", "1998-06-01", "1998-06-30", 30
BEFORE = "1998-05-31"


def _r(df: DataFrame, *cols: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


def lrfm_snapshot(s: SparkSession, d: str) -> DataFrame:
    return _r(crm.lrfm_snapshot(transactions(s, d), CAL), "M", places=2)


def _span(t: DataFrame) -> tuple[str, str]:
    """The first and the last day of the orders."""
    low, high = t.agg(F.min("ordate"), F.max("ordate")).first()
    return str(low), str(high)


def lrfm_daily(s: SparkSession, d: str) -> DataFrame:
    t = transactions(s, d)
    return _r(crm.lrfm_daily(t, _span(t)[1]), "M", places=2)


def lrfm_daily_summary(s: SparkSession, d: str) -> DataFrame:
    """The daily rows of all members added up by day."""
    return lrfm_daily(s, d).groupBy("cal_date").agg(F.count(F.lit(1)).alias("members"), *[F.sum(c).cast("bigint").alias(c.lower()) for c in "LRF"], F.round(F.sum("M"), 2).alias("m"))


def individual_interval_summary(s: SparkSession, d: str) -> DataFrame:
    """The daily rows of all members by shop and day: members, those with gaps, gaps and their days, first and last order."""
    t = transactions(s, d)
    some = F.when(F.col("n_interval") > 0, F.col("n_interval"))
    g = crm.individual_interval(t, _span(t)[1]).groupBy("shop_id", "cal_date")
    return g.agg(F.count(F.lit(1)).alias("members"), F.count(some).alias("with_gaps"), F.sum(some).alias("gaps"), F.round(F.sum(some * F.col("mean_interval"))).cast("bigint").alias("days"), F.min("first_order").alias("first_order"), F.max("last_order").alias("last_order"))


def missing_days_summary(s: SparkSession, d: str) -> DataFrame:
    """How many members of a shop lack an order on each day between their orders."""
    return missing_days(s, d).groupBy("shop_id", "missing").agg(F.count(F.lit(1)).alias("members"))


def member_gap_stats(s: SparkSession, d: str) -> DataFrame:
    g = crm.member_gaps(transactions(s, d)).groupBy("shop_id", "member_id").agg(F.count("gap").alias("n"), F.sum("gap").cast("bigint").alias("days"), F.round(F.stddev_pop("gap"), 4).alias("sd"))
    return g


def mu2_interval_daily(s: SparkSession, d: str) -> DataFrame:
    t = transactions(s, d)
    return _r(crm.mu2_interval(t, *_span(t)), "mean", "sd")


def individual_interval_daily(s: SparkSession, d: str) -> DataFrame:
    t = transactions(s, d)
    return _r(crm.individual_interval(t, _span(t)[1]), "mean_interval")


def mu_mean_std(s: SparkSession, d: str) -> DataFrame:
    return _r(crm.mu_mean_std(crm.individual_interval(transactions(s, d), END, START)), "mean", "sd")


def _adjusted(t: DataFrame, day: str) -> DataFrame:
    own = crm.individual_interval(t, day, day)
    return crm.adjusted_interval(own, crm.mu2_interval(t, day, day), crm.mu_mean_std(own))


def adjusted_interval(s: SparkSession, d: str) -> DataFrame:
    return _r(_adjusted(transactions(s, d), CAL), "gap_mean_adj")


def _tags(t: DataFrame, day: str) -> DataFrame:
    return crm.nes_tag(crm.lrfm_snapshot(t, day), _adjusted(t, day), PERIOD)


def nes_tag(s: SparkSession, d: str) -> DataFrame:
    return _tags(transactions(s, d), CAL)


def nes_distribution(s: SparkSession, d: str) -> DataFrame:
    return nes_tag(s, d).groupBy("shop_id", "NES_Tag").agg(F.count(F.lit(1)).alias("members"))


def arpu_by_tag(s: SparkSession, d: str) -> DataFrame:
    t = transactions(s, d)
    return _r(crm.arpu(t, _tags(t, CAL), CAL, PERIOD), "arpu", places=2)


def conversion_rate(s: SparkSession, d: str) -> DataFrame:
    return _r(crm.conversion(nes_tag(s, d)), "conversion", places=6)


def conversion_members(s: SparkSession, d: str) -> DataFrame:
    return crm.conversion_members(nes_tag(s, d))


def wakeup_rate(s: SparkSession, d: str) -> DataFrame:
    t = transactions(s, d)
    return _r(crm.wakeup(_tags(t, CAL), _tags(t, BEFORE)), "rate", places=6)


def store_report(s: SparkSession, d: str) -> DataFrame:
    t = transactions(s, d)
    tags = _tags(t, CAL)
    shops = t.select("shop_id").distinct()
    valid = shops.select("shop_id", F.explode(F.array(F.lit(4096), F.lit(8192))).alias("TA_Tag")).withColumn("rate", F.length("shop_id") / F.col("TA_Tag"))
    active = shops.select("shop_id", (F.length("shop_id") / 100).alias("active"))
    out = crm.store_report(tags, crm.conversion(tags), crm.wakeup(tags, _tags(t, BEFORE)), crm.arpu(t, tags, CAL, PERIOD), valid, active)
    return _r(out, *crm.REPORT_TAGS, places=4)


def store_report_json(s: SparkSession, d: str) -> DataFrame:
    return crm.report_json(store_report(s, d))


def top_sale_rank(s: SparkSession, d: str) -> DataFrame:
    r = crm.top_sale(item_revenue(s, d), 10)
    return r.withColumns({c: F.col(c).cast("bigint") for c in ("rank_qt", "rank_amt")})


def pareto_tag(s: SparkSession, d: str) -> DataFrame:
    t = transactions(s, d).groupBy("shop_id", "member_id").agg(F.round(F.sum("amount"), 2).alias("amount"))
    return rel.pareto_tags(t, ["shop_id"], "amount", "P").select("shop_id", "member_id", "tag")


def high_mean(s: SparkSession, d: str) -> DataFrame:
    return _r(rel.high_mean(transactions(s, d), ["shop_id"], "amount"), "mean", "high_mean", places=3)


def percentile_all(s: SparkSession, d: str) -> DataFrame:
    return rel.percentile_table(transactions(s, d), ["shop_id"], "amount", list(range(1, 101)))


def percentile_distinct(s: SparkSession, d: str) -> DataFrame:
    return rel.percentile_table(transactions(s, d).withColumn("k", F.floor(F.col("amount") / 10000)), ["shop_id"], "k", mode="distinct")


def mean_std_by_key(s: SparkSession, d: str) -> DataFrame:
    return _r(rel.mean_std(transactions(s, d), ["shop_id"], "amount"), "mean", "sd", places=3)


def prefix_rollup(s: SparkSession, d: str) -> DataFrame:
    paths = store_paths(s, d).withColumn("path", F.concat_ws("^", "region", "nation", "segment")).groupBy("path").agg(F.count(F.lit(1)).alias("c"), F.sum("amount").alias("a"))
    return rel.prefix_rollup(paths, "path", [F.sum("c").alias("n"), F.round(F.sum("a"), 0).alias("amount")])


def powerset_rollup(s: SparkSession, d: str) -> DataFrame:
    return rel.powerset_rollup(store_paths(s, d), ["region", "nation", "segment"], [F.count(F.lit(1)).alias("n")])


def combination_counts(s: SparkSession, d: str) -> DataFrame:
    return rel.combination_counts(store_paths(s, d), ["region", "nation", "segment"], 2)


def member_query(s: SparkSession, d: str) -> DataFrame:
    """Members by a dict of rules, empty ones skipped, the first 12 by id, with their row as JSON."""
    from millrace.functions.scalar import all_of

    rules = {"shop_id": "seg^BUILDING", "F": 10, "tag": "NULL", "note": ""}
    m = crm.lrfm_snapshot(transactions(s, d), CAL).where(all_of(rules)).orderBy("member_id").limit(12)
    return m.select("member_id", F.to_json(F.struct("shop_id", "L", "R", "F")).alias("json"))


def incremental_lrfm(s: SparkSession, d: str) -> DataFrame:
    """State built from two parts of the orders, one after the other."""
    t = transactions(s, d)
    cut = F.to_date(F.lit(BEFORE))
    empty = t.where("false").select("shop_id", "member_id", F.col("ordate").alias("first"), F.col("ordate").alias("last"), F.lit(0).cast("bigint").alias("F"), F.col("amount").alias("M"))
    state = crm.merge_lrfm(crm.merge_lrfm(empty, t.where(F.col("ordate") <= cut)), t.where(F.col("ordate") > cut))
    return _r(state, "M", places=2)


def period_totals(s: SparkSession, d: str) -> DataFrame:
    """Orders and amount of the last 7 and 30 days per shop."""
    t = transactions(s, d)
    part = lambda n: crm.within_period(t, "ordate", CAL, n).groupBy("shop_id").agg(F.lit(f"L{n}D").alias("period"), F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))
    return part(7).unionByName(part(30))


def running_totals(s: SparkSession, d: str) -> DataFrame:
    return _r(win.running_totals(transactions(s, d), ["shop_id", "member_id"], "ordate", "amount"), "monetary", places=2)


def latest_order(s: SparkSession, d: str) -> DataFrame:
    return win.latest(transactions(s, d), ["member_id"], [F.desc("ordate"), F.desc("amount")]).select("member_id", "ordate", "amount")


def islands_active_days(s: SparkSession, d: str) -> DataFrame:
    t = transactions(s, d).select("shop_id", F.unix_date("ordate").cast("bigint").alias("day"))
    return win.islands(t, ["shop_id"], "day")


def missing_days(s: SparkSession, d: str) -> DataFrame:
    return win.missing_days(transactions(s, d), ["shop_id", "member_id"], "ordate")


def row_index(s: SparkSession, d: str) -> DataFrame:
    o = transactions(s, d).groupBy("member_id").agg(F.count(F.lit(1)).alias("n"))
    return win.row_numbers(o, [F.desc("n"), F.col("member_id")]).select("member_id", "n", F.col("row").cast("bigint").alias("row"))


QUERIES = {f.__name__: f for f in (lrfm_snapshot, lrfm_daily, lrfm_daily_summary, individual_interval_summary, missing_days_summary, member_gap_stats, mu2_interval_daily, individual_interval_daily, mu_mean_std, adjusted_interval, nes_tag, nes_distribution, arpu_by_tag, conversion_rate, conversion_members, wakeup_rate, store_report, store_report_json, top_sale_rank, pareto_tag, high_mean, percentile_all, percentile_distinct, mean_std_by_key, prefix_rollup, powerset_rollup, combination_counts, member_query, incremental_lrfm, period_totals, running_totals, latest_order, islands_active_days, missing_days, row_index)}


def _snap(day: str, name: str) -> str:
    return f"{name} as (select shop_id, member_id, (max(ordate) - min(ordate))::bigint as L, (date '{day}' - max(ordate))::bigint as R, count(*)::bigint as F, sum(amount) as M from t where ordate <= date '{day}' group by 1, 2 having sum(amount) > 0)"


def _own(day: str, p: str) -> str:
    """Members' gaps, shop summaries, adjusted gaps and tags as of a day, names ending in ``p``."""
    return f"""gap{p} as (select shop_id, member_id, ordate, ordate - lag(ordate) over (partition by shop_id, member_id order by ordate) as gap from t),
 own{p} as (select shop_id, member_id, count(gap) as n, avg(gap) as mean, min(ordate) as first_order, max(ordate) as last_order from gap{p} where ordate <= date '{day}' group by 1, 2),
 m2{p} as (select shop_id, avg(gap) as mu2, stddev_pop(gap) as sd2 from gap{p} where ordate <= date '{day}' and gap is not null group by 1),
 m1{p} as (select shop_id, case when count(mean) > 1 then avg(mean) else -999 end as mu1, case when count(mean) > 1 then sqrt(greatest(sum(mean * mean) / nullif(count(mean) - 1, 0) - avg(mean) * avg(mean), 0)) else -999 end as sd1 from own{p} where mean is not null group by 1),
 k{p} as (select own{p}.*, mu1, sd1, mu1 * mu1 / (sd1 * sd1) + 2 as al, sd1 * sd1 / (mu1 * (mu1 * mu1 + sd1 * sd1)) as th, mu2 * mu2 / (sd2 * sd2) as k, coalesce(sd1 > 0 and sd2 > 0, false) as ok from own{p} left join m2{p} using (shop_id) left join m1{p} using (shop_id)),
 adj{p} as (select shop_id, member_id, first_order, last_order, case when not ok then -999 when n = 0 then k / ((al - 1) * th) else k * (n / (k * n + al - 1) * mean + 1 / ((k * n + al - 1) * th)) end as g from k{p}),
 {_snap(day, f'snap{p}')},
 tag{p} as (select s.shop_id, s.member_id, case when L = 0 and R <= {PERIOD} then 'N' when R <= {PERIOD} and F > 1 then 'EB' when R > g * 2.9154 then 'S3' when R > g * 2.5515 then 'S2' when R > g * 2.0389 then 'S1' else 'E0' end as NES_Tag from snap{p} s join adj{p} a using (shop_id, member_id))"""


_TAGS = f"with {T_SQL}, {_own(CAL, '1')}"
_TWO = f"{_TAGS}, {_own(BEFORE, '0')}"
_ARPU = f"select shop_id, case when NES_Tag = 'N' then 'N0' else 'E0S1S2' end as NES_Tagging, sum(amount) / count(*) as arpu from t join tag1 using (shop_id, member_id) where ordate >= date '{CAL}' - {PERIOD} and ordate < date '{CAL}' and NES_Tag in ('N', 'E0', 'S1', 'S2') group by 1, 2"
_CONV = "select shop_id, case when count(*) filter (NES_Tag = 'EB') > 0 then count(*) filter (NES_Tag = 'EB') / (count(*) filter (NES_Tag in ('N', 'EB')))::double else -999 end as conversion from tag1 group by 1"
_WAKE = "select shop_id, tag0.NES_Tag, (count(*) filter (tag1.NES_Tag = 'E0')) / count(*)::double as rate from tag1 join tag0 using (shop_id, member_id) where tag0.NES_Tag in ('S1', 'S2', 'S3') group by 1, 2"
_DAYS = f"cal as (select shop_id, unnest(generate_series(date '{START}', date '{END}', interval 1 day))::date as cal_date from (select distinct shop_id from t))"
_IND = f"""g as (select shop_id, member_id, ordate, ordate - lag(ordate) over (partition by shop_id, member_id order by ordate) as gap from t),
 days as (select unnest(generate_series(date '{START}', date '{END}', interval 1 day))::date as cal_date),
 ind as (select cal_date, shop_id, member_id, avg(gap) as mean, count(gap)::bigint as n, min(ordate) as first_order, max(ordate) as last_order from days join g on ordate <= cal_date group by 1, 2, 3)"""


def _report_sql() -> str:
    cell = lambda where, v, fill="-999": f"coalesce(max(case when {where} then {v} end), {fill})" if fill else f"max(case when {where} then {v} end)"
    tags = ("N", "E", "S1", "S2", "S3")

    def block(name: str, source: str, tag: str, v: str, fill: str | None = "-999") -> str:
        return f"select shop_id, '{name}' as category, " + ", ".join(f"round(({cell(f'{tag} = {chr(39)}{t}{chr(39)}', v, fill)})::double, 4) as {t}" for t in tags) + f" from {source} group by shop_id"

    cnt = "(select shop_id, case when NES_Tag in ('E0', 'EB') then 'E' else NES_Tag end as tag, count(*) as c from tag1 group by 1, 2)"
    share = f"(select *, c / sum(c) over (partition by shop_id) as share from {cnt})"
    shops = "(select distinct shop_id from t)"
    return f"{_TWO} " + " union all ".join(
        [
            block("members", cnt, "tag", "c"),
            block("share", share, "tag", "share"),
            block("conversion", f"({_CONV})", "'N'", "conversion"),
            block("wakeup", f"({_WAKE})", "NES_Tag", "rate"),
            block("arpu", f"({_ARPU})", "case when NES_Tagging = 'N0' then 'N' else 'E' end", "arpu"),
            block("addedrate", f"(select shop_id, unnest(['N', 'S1']) as tag, length(shop_id) / unnest([4096, 8192])::double as rate from {shops})", "tag", "rate", None),
            block("activerate", f"(select shop_id, length(shop_id) / 100.0::double as active from {shops})", "'E'", "active", None),
        ]
    )


#: Every member's days from the first order to the last day of the table.
_EVERY = "own as (select shop_id, member_id, unnest(generate_series(min(ordate), (select max(ordate) from t), interval 1 day))::date as cal_date from t group by 1, 2)"
SQL = {
    "lrfm_snapshot": f"with {T_SQL}, {_snap(CAL, 's')} select shop_id, member_id, L, R, F, round(M, 2) as M from s",
    "member_gap_stats": f"with {T_SQL}, g as (select shop_id, member_id, ordate - lag(ordate) over (partition by shop_id, member_id order by ordate) as gap from t) select shop_id, member_id, count(gap)::bigint as n, sum(gap)::bigint as days, round(stddev_pop(gap), 4) as sd from g where gap is not null group by 1, 2",
    "lrfm_daily_summary": f"with {T_SQL}, {_EVERY}, x as (select cal_date, member_id, max(ordate) - min(ordate) as l, cal_date - max(ordate) as r, count(*) as f, sum(amount) as m from own join t using (shop_id, member_id) where ordate <= cal_date group by cal_date, shop_id, member_id) select cal_date, count(*)::bigint as members, sum(l)::bigint as l, sum(r)::bigint as r, sum(f)::bigint as f, round(sum(round(m, 2)), 2) as m from x group by 1",
    "individual_interval_summary": f"with {T_SQL}, g as (select *, ordate - lag(ordate) over (partition by shop_id, member_id order by ordate) as gap from t), {_EVERY}, x as (select cal_date, shop_id, member_id, count(gap) as n, sum(gap) as g, min(ordate) as a, max(ordate) as b from own join g using (shop_id, member_id) where ordate <= cal_date group by 1, 2, 3) select shop_id, cal_date, count(*)::bigint as members, (count(*) filter (n > 0))::bigint as with_gaps, (sum(n) filter (n > 0))::bigint as gaps, (sum(g) filter (n > 0))::bigint as days, min(a) as first_order, max(b) as last_order from x group by 1, 2",
    "missing_days_summary": f"with {T_SQL}, u as (select distinct shop_id, member_id, ordate from t), g as (select *, lag(ordate) over (partition by shop_id, member_id order by ordate) as p from u), m as (select shop_id, unnest(generate_series(p + 1, ordate - 1, interval 1 day))::date as missing from g where ordate - p > 1) select shop_id, missing, count(*)::bigint as members from m group by 1, 2",
    "mu2_interval_daily": f"with {T_SQL}, g as (select shop_id, ordate, ordate - lag(ordate) over (partition by shop_id, member_id order by ordate) as gap from t), span as (select unnest(generate_series((select min(ordate) from t), (select max(ordate) from t), interval 1 day))::date as cal_date), cal as (select shop_id, cal_date from (select distinct shop_id from t), span), a as (select shop_id, ordate as cal_date, count(gap) as n, sum(gap) as s, sum(gap * gap) as q from g group by 1, 2), x as (select shop_id, cal_date, coalesce(sum(n) over w, 0) as n, (sum(s) over w)::double as s, (sum(q) over w)::double as q from cal left join a using (shop_id, cal_date) window w as (partition by shop_id order by cal_date)) select shop_id, cal_date, n::bigint as n, round(case when n > 0 then s / n else -999 end, 4) as mean, round(case when n > 0 then sqrt(greatest(q / n - (s / n) * (s / n), 0)) else -999 end, 4) as sd from x",
    "mu_mean_std": f"with {T_SQL}, {_IND} select cal_date, shop_id, count(mean)::bigint as n, round(case when count(mean) > 1 then avg(mean) else -999 end, 4) as mean, round(case when count(mean) > 1 then sqrt(greatest(sum(mean * mean) / nullif(count(mean) - 1, 0) - avg(mean) * avg(mean), 0)) else -999 end, 4) as sd from ind where mean is not null group by 1, 2",
    "adjusted_interval": f"{_TAGS} select shop_id, member_id, round(g, 4) as gap_mean_adj, first_order, last_order from adj1",
    "nes_tag": f"{_TAGS} select * from tag1",
    "nes_distribution": f"{_TAGS} select shop_id, NES_Tag, count(*)::bigint as members from tag1 group by 1, 2",
    "arpu_by_tag": f"{_TAGS} select shop_id, NES_Tagging, round(arpu, 2) as arpu from ({_ARPU})",
    "conversion_rate": f"{_TAGS} select shop_id, round(conversion, 6) as conversion from ({_CONV})",
    "conversion_members": f"{_TAGS} select shop_id, member_id from tag1 where NES_Tag = 'EB'",
    "wakeup_rate": f"{_TWO} select shop_id, NES_Tag, round(rate, 6) as rate from ({_WAKE})",
    "store_report": _report_sql(),
    "top_sale_rank": f"with {ITEMS_SQL}, r as (select *, rank() over (partition by shop_id order by item_qt desc)::bigint as rank_qt, rank() over (partition by shop_id order by item_amt desc)::bigint as rank_amt from items) select * from r where rank_qt <= 10 or rank_amt <= 10",
    "pareto_tag": f"with {T_SQL}, a as (select shop_id, member_id, round(sum(amount), 2) as amount from t group by 1, 2), m as (select shop_id, round(avg(amount), 6) as mean from a group by 1), h as (select shop_id, mean, avg(amount) filter (amount >= mean) as hi from a join m using (shop_id) group by 1, 2) select shop_id, member_id, 'P' || case when amount >= hi then 'H' when amount >= mean then 'M' else 'L' end as tag from a join h using (shop_id)",
    "high_mean": f"with {T_SQL}, m as (select shop_id, round(avg(amount), 6) as mean from t group by 1) select shop_id, round(mean, 3) as mean, round(avg(amount) filter (amount >= mean), 3) as high_mean from t join m using (shop_id) group by 1, mean",
    "percentile_all": f"with {T_SQL}, v as (select shop_id, round(amount, 4) as value, row_number() over (partition by shop_id order by amount) as rn, count(*) over (partition by shop_id) as n from t), p as (select unnest(range(1, 101))::bigint as p) select shop_id, p, value from v join p on rn = floor(p * (n - 1) / 100.0) + 1",
    "percentile_distinct": f"with {T_SQL}, u as (select distinct shop_id, floor(amount / 10000)::double as value from t), v as (select *, row_number() over (partition by shop_id order by value) as rn, count(*) over (partition by shop_id) as n from u), p as (select unnest(range(1, 100))::bigint as p) select shop_id, max(p)::bigint as p, value from v join p on rn = floor(p * (n - 1) / 100.0) + 1 group by shop_id, value",
    "mean_std_by_key": f"with {T_SQL} select shop_id, count(*)::bigint as n, round(avg(amount), 3) as mean, round(sqrt(sum(amount * amount) / (count(*) - 1) - avg(amount) * avg(amount)), 3) as sd from t group by 1",
    "prefix_rollup": f"with {STORE_SQL}, p as (select unnest([region, region || '^' || nation, region || '^' || nation || '^' || segment]) as prefix, amount from store) select prefix, count(*)::bigint as n, round(sum(amount), 0) as amount from p group by 1",
    "powerset_rollup": f"with {STORE_SQL} select region, nation, segment, concat_ws('+', case when grouping(region) = 0 then 'region' end, case when grouping(nation) = 0 then 'nation' end, case when grouping(segment) = 0 then 'segment' end) as subset, count(*)::bigint as n from store group by cube (region, nation, segment) having not (grouping(region) = 1 and grouping(nation) = 1 and grouping(segment) = 1)",
    "combination_counts": f"with {STORE_SQL} select region, nation, segment, concat_ws('+', case when grouping(region) = 0 then 'region' end, case when grouping(nation) = 0 then 'nation' end, case when grouping(segment) = 0 then 'segment' end) as keys, count(*)::bigint as n from store group by grouping sets ((region, nation), (region, segment), (nation, segment))",
    "member_query": f"""with {T_SQL}, {_snap(CAL, 's')} select member_id, concat('{{"shop_id":"', shop_id, '","L":', L, ',"R":', R, ',"F":', F, '}}') as json from s where shop_id = 'seg^BUILDING' and F = 10 order by member_id limit 12""",
    "incremental_lrfm": f"with {T_SQL} select shop_id, member_id, min(ordate) as first, max(ordate) as last, count(*)::bigint as F, round(sum(amount), 2) as M from t group by 1, 2",
    "period_totals": f"with {T_SQL} " + " union all ".join(f"select shop_id, 'L{n}D' as period, count(*)::bigint as n, round(sum(amount), 2) as amount from t where ordate > date '{CAL}' - {n} and ordate <= date '{CAL}' group by 1" for n in (7, 30)),
    "running_totals": f"with {T_SQL}, y as (select shop_id, member_id, ordate, count(*) as n, sum(amount) as a from t group by 1, 2, 3) select shop_id, member_id, ordate, (sum(n) over w)::bigint as frequency, round(sum(a) over w, 2) as monetary from y window w as (partition by shop_id, member_id order by ordate)",
    "latest_order": f"with {T_SQL}, r as (select *, row_number() over (partition by member_id order by ordate desc, amount desc) as rn from t) select member_id, ordate, amount from r where rn = 1",
    "islands_active_days": f"with {T_SQL}, u as (select distinct shop_id, (ordate - date '1970-01-01')::bigint as day from t), g as (select *, day - row_number() over (partition by shop_id order by day) as g from u) select shop_id, min(day) as low, max(day) as high, count(*)::bigint as n, case when min(day) = max(day) then cast(min(day) as varchar) else concat(min(day), '~', max(day)) end as label from g group by shop_id, g",
    "row_index": f"with {T_SQL}, n as (select member_id, count(*)::bigint as n from t group by 1) select member_id, n, (row_number() over (order by n desc, member_id) - 1)::bigint as row from n",
}
