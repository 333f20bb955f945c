"""Queries over logs and clickstreams, the profiler, the tree, and plain relational operators; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.functions import scalar as fn
from millrace.functions.parse import clean_text, epoch_millis
from millrace.operators import dtree, profile, relational as rel, weblog, windows as win
from millrace.plans.tables import table
from millrace.plans.views import CLICKS_SQL, LOG_SQL, T_SQL, clicks, item_revenue, raw_log, store_paths, transactions


#: Rules for the agents of the test tables besides the common ones.
DEVICES = (*fn.DEVICE_RULES, ("pc", r"(?i)desk/|macrosys"))
BROWSERS = (*fn.BROWSER_RULES, ("Quill", r"Quill/"), ("MiniView", r"MiniView/"))
SYSTEMS = (*fn.OS_RULES, ("Macrosys", r"Macrosys"), ("Lumo", r"Lumo"))


def _log(s: SparkSession, d: str) -> DataFrame:
    return weblog.parse_common(raw_log(s, d)).where("parsed")


def log_parse(s, d):
    return weblog.parse_common(raw_log(s, d)).select("event_id", "host", "stamp", "method", "endpoint", "protocol", F.col("response_code").cast("bigint").alias("response_code"), "content_size", "parsed")


def log_failures(s, d):
    """Lines in another form than expected, every seventh broken on purpose."""
    lines = raw_log(s, d).withColumn("line", F.when(F.col("event_id") % 7 == 0, F.regexp_replace("line", '"', "")).otherwise(F.col("line")))
    good, bad = rel.split_good_bad(weblog.parse_common(lines), F.col("parsed"))
    return good.agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("n")).unionByName(bad.agg(F.lit("bad").alias("kind"), F.count(F.lit(1)).alias("n")))


def log_content_size(s, d):
    return weblog.content_sizes(_log(s, d))


def log_status_share(s, d):
    return weblog.shares(_log(s, d), "response_code").select(F.col("response_code").cast("bigint").alias("response_code"), "n", F.round("share", 6).alias("share"))


def log_busy_hosts(s, d):
    return _log(s, d).groupBy("host").agg(F.count(F.lit(1)).alias("n")).where("n > 10")


def log_top_endpoints(s, d):
    return weblog.top(_log(s, d), ["endpoint"], 10)


def log_top_failed_endpoints(s, d):
    return weblog.top(_log(s, d).where("response_code <> 200"), ["endpoint"], 10)


def log_daily_hosts(s, d):
    return weblog.daily_hosts(_log(s, d))


def log_404_by_day(s, d):
    return _log(s, d).where("response_code = 404").groupBy(F.to_date("stamp").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def log_404_by_hour(s, d):
    return _log(s, d).where("response_code = 404").groupBy(F.hour("stamp").cast("bigint").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def log_404_summary(s, d):
    return _log(s, d).where("response_code = 404").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("endpoint").alias("endpoints"), F.countDistinct("host").alias("hosts"))


def log_404_top_hosts(s, d):
    return weblog.top(_log(s, d).where("response_code = 404"), ["host"], 25)


def extended_log(s, d):
    """Shop clicks written as extended log lines and read again, with agent families."""
    line = F.concat(F.col("ip"), F.lit(' - - [01/Jan/2013:00:00:01 +0000] "GET /'), F.coalesce("act", F.lit("")), F.lit('/x HTTP/1.1" 200 '), F.length("hostname"), F.lit(' "http://'), F.col("hostname"), F.lit('/" "'), F.col("agent"), F.lit('"'))
    rows = table(s, d, "userlog_ec").where("ip is not null and hostname is not null and agent is not null").select(line.alias("line"))
    return weblog.parse_extended(rows, devices=DEVICES, browsers=BROWSERS, systems=SYSTEMS).where("parsed").groupBy("device", "browser", "os", "last_page").agg(F.count(F.lit(1)).alias("n"))


def cart_actions(s, d):
    q = F.concat_ws(";", F.concat(F.lit("act="), "act"), F.concat(F.lit("pid="), "pid"), F.concat(F.lit("uid="), "uid"))
    e = table(s, d, "userlog_ec").withColumn("q", q)
    return e.where(F.col("q").contains("act=cart")).select("ip", weblog.key_value(F.col("q"), "pid").alias("pid"), "dates_int").where("pid is not null").groupBy("ip", "pid", F.col("dates_int").cast("bigint").alias("dates_int")).agg(F.count(F.lit(1)).alias("n"))


def order_list_revenue(s, d):
    """The 20 items of most revenue from ``item,qty,amt`` lists of each order."""
    li = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.concat_ws(",", F.collect_list(F.concat_ws(",", F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string"), F.col("l_linenumber").cast("string")))).alias("plist"))
    return weblog.order_items(li).select("item", F.col("revenue").cast("bigint").alias("revenue")).orderBy(F.desc("revenue"), "item").limit(20)


def distinct_profile(s, d):
    return weblog.distinct_profile(table(s, d, "userlog_ec").withColumn("who", F.lower(F.trim("eruid"))).where("who is not null"), "who", ["ip", "uid", "ssid", "pid", "hostname"])


def multi_agent_users(s, d):
    return weblog.multi_agent_users(table(s, d, "userlog_ec").withColumn("who", F.lower(F.trim("eruid"))), "who", "agent", DEVICES, BROWSERS, SYSTEMS)


def hour_pivot(s, d):
    return rel.hour_pivot(clicks(s, d), "eruid", F.hour("ts"))


def author_features(s, d):
    """Behaviour of each author, with the author's spam label."""
    log = table(s, d, "userlog").select(clean_text(F.col("author")).alias("author"), F.floor(epoch_millis(F.col("op_at")) / 1000).alias("at"), "action")
    spam = table(s, d, "articles_half_a").groupBy("author").agg(F.max("is_spam").cast("bigint").alias("is_spam"))
    f = weblog.author_features(log, "author", "at", "action").join(spam, "author", "left")
    return f.withColumns({c: F.round(c, 6) for c in ("mean_actions", "mean_distinct")})


def having_distinct(s, d):
    return clicks(s, d).groupBy("eruid").agg(F.countDistinct("act").alias("acts")).where("acts > 4")


def freq_of_freq(s, d):
    return clicks(s, d).groupBy("eruid").agg(F.count(F.lit(1)).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))


def mean_of_group_counts(s, d):
    return clicks(s, d).groupBy("eruid", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("c")).groupBy("eruid").agg(F.round(F.avg("c"), 6).alias("mean"))


def json_prop_extract(s, d):
    return clicks(s, d).withColumn("k", F.get_json_object("props", "$.k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def event_alerts(s, d):
    """Per day and type, rows over two standard deviations of the type's values."""
    st = clicks(s, d).groupBy("act").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("sd"))
    return clicks(s, d).join(st, "act").where(F.abs(F.col("value") - F.col("m")) > 2 * F.col("sd")).groupBy("act", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


# profiler and tree


def profile_numeric(s, d):
    p = profile.profile_numeric(table(s, d, "part"), ["p_size", "p_retailprice"])
    return p.withColumns({c: F.round(c, 4) for c in ("total", "mean", "sd", "low", "high")})


def profile_spec(s, d):
    """The same through a spec by position."""
    p = profile.select_spec(table(s, d, "customer"), "3:balance:N,4:segment:C,2:nation:N")
    return profile.profile_numeric(p, ["balance", "nation"]).withColumns({c: F.round(c, 3) for c in ("total", "mean", "sd", "low", "high")})


def profile_categorical(s, d):
    return profile.profile_categorical(table(s, d, "part"), ["p_brand", "p_type"])


def profile_2d(s, d):
    return profile.profile_2d(table(s, d, "part"), "p_brand", "p_type")


def profile_3d(s, d):
    p = profile.profile_3d(table(s, d, "part"), "p_brand", "p_type", "p_retailprice")
    return p.withColumns({c: F.round(c, 4) for c in ("total", "mean", "sd", "low", "high")})


def profile_3d_json(s, d):
    return profile.nested_json(profile_3d(s, d), "p_brand", "p_type", ["n", "low", "high"])


_WEATHER = [
    ("Sunny", "Hot", "High", "False", "No"), ("Sunny", "Hot", "High", "True", "No"), ("Overcast", "Hot", "High", "False", "Yes"), ("Rainy", "Mild", "High", "False", "Yes"),
    ("Rainy", "Cool", "Normal", "False", "Yes"), ("Rainy", "Cool", "Normal", "True", "No"), ("Overcast", "Cool", "Normal", "True", "Yes"), ("Sunny", "Mild", "High", "False", "No"),
    ("Sunny", "Cool", "Normal", "False", "Yes"), ("Rainy", "Mild", "Normal", "False", "Yes"), ("Sunny", "Mild", "Normal", "True", "Yes"), ("Overcast", "Mild", "High", "True", "Yes"),
    ("Overcast", "Hot", "Normal", "False", "Yes"), ("Rainy", "Mild", "High", "True", "No"),
]
WEATHER_COLUMNS = ["outlook", "temperature", "humidity", "windy", "play"]


def weather(s: SparkSession) -> DataFrame:
    return s.createDataFrame(_WEATHER, WEATHER_COLUMNS)


_ORDER_FEATURES = ["o_orderpriority", "year", "month"]


def _dated_orders(s, d) -> DataFrame:
    return table(s, d, "orders").withColumn("year", F.year("o_orderdate").cast("string")).withColumn("month", F.month("o_orderdate").cast("string"))


def c45_gain_ratio(s, d):
    """Gain ratios of order columns for the order's status at the root."""
    g = dtree.gain_ratios(dtree.to_long(_dated_orders(s, d), _ORDER_FEATURES, "o_orderstatus"))
    return g.select("var", "n", *[F.round(c, 8).alias(c) for c in ("outcome", "conditional", "split_info", "gain_ratio")])


def c45_counts(s, d):
    o = table(s, d, "orders").withColumn("year", F.year("o_orderdate").cast("string"))
    return dtree.to_long(o, ["o_orderpriority", "year"], "o_orderstatus").groupBy("var", "value", "label").agg(F.count(F.lit(1)).alias("n"))


def c45_tree(s, d):
    """The tree of the order's status over all orders."""
    nodes = dtree.grow(_dated_orders(s, d), _ORDER_FEATURES, "o_orderstatus")
    return s.createDataFrame([(n["level"], n["node"], n["var"], round(n["gain_ratio"], 10), n["n"], ",".join(n["rules"])) for n in nodes], "level bigint, node string, var string, gain_ratio double, n bigint, rules string")


# plain relational operators


def semi_join_active(s, d):
    big = table(s, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v")).where("v > 1000000")
    return table(s, d, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


def anti_join_inactive(s, d):
    """Customers without an urgent order in the last year of the orders."""
    o = table(s, d, "orders").where("o_orderpriority = '1-URGENT' and to_date(o_orderdate) >= date '2000-08-01'")
    return table(s, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_mktsegment")


def left_join_zero_fill(s, d):
    n = table(s, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return table(s, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


def full_outer_status(s, d):
    o = table(s, d, "orders")
    a, b = (o.where(F.col("o_orderstatus") == x).groupBy("o_custkey").agg(F.count(F.lit(1)).alias(x.lower())) for x in ("F", "O"))
    return a.join(b, "o_custkey", "full").na.fill(0)


def calendar_shops(s, d):
    """Every shop and day of a month with its orders, none included."""
    t = transactions(s, d)
    cal = t.select("shop_id").distinct().select("shop_id", F.explode(F.expr("sequence(date '1998-06-01', date '1998-06-30', interval 1 day)")).alias("ordate"))
    n = t.groupBy("shop_id", "ordate").agg(F.count(F.lit(1)).alias("n"))
    return cal.join(n, ["shop_id", "ordate"], "left").na.fill(0)


def self_join_period(s, d):
    m = transactions(s, d).groupBy("shop_id", F.trunc("ordate", "month").alias("month")).agg(F.round(F.sum("amount"), 2).alias("amount"))
    prev = m.select("shop_id", F.add_months("month", 12).alias("month"), F.col("amount").alias("year_ago"))
    return m.join(prev, ["shop_id", "month"])


def union_all(s, d):
    n, r = table(s, d, "nation"), table(s, d, "region")
    return rel.union_all([n.select(F.col("n_name").alias("name")), r.select(F.col("r_name").alias("name")), r.select(F.col("r_name").alias("name"))])


def intersect_users(s, d):
    c = clicks(s, d)
    return c.where("act = 'purchase'").select("eruid").intersect(c.where("act = 'click'").select("eruid"))


def except_users(s, d):
    """Users and days with a click but no error."""
    c = clicks(s, d).withColumn("day", F.to_date("ts"))
    return c.where("act = 'click'").select("eruid", "day").subtract(c.where("act = 'error'").select("eruid", "day"))


def distinct_brands(s, d):
    return table(s, d, "part").select("p_brand", "p_size").distinct()


def topk_revenue_tiebreak(s, d):
    return item_revenue(s, d).groupBy("item_id").agg(F.sum("item_qt").alias("qt")).orderBy(F.desc("qt"), "item_id").limit(21)


def crosstab_priority_status(s, d):
    return table(s, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0).withColumnsRenamed({"F": "f", "O": "o", "P": "p"})


def grouping_sets(s, d):
    o = table(s, d, "orders")
    return o.rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("bigint").alias("level"))


def predicate_mix(s, d):
    p = table(s, d, "part")
    return p.where(F.col("p_size").between(5, 20) & F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#13") & ~F.col("p_type").contains("X") & F.col("p_name").isNotNull() & F.col("p_brand").rlike(r"^Brand#\d+$")).select("p_partkey", F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 15, "middle").otherwise("large").alias("size"))


def null_handling(s, d):
    """Rows with any null, and figures after filling, per action."""
    e = table(s, d, "userlog_ec").withColumn("nulls", F.col("qty").isNull() | F.col("unit_price").isNull())
    return e.na.fill({"qty": 0}).groupBy(clean_text(F.col("act")).alias("act")).agg(F.sum(F.col("nulls").cast("bigint")).alias("with_null"), F.sum("qty").cast("bigint").alias("qty"), F.count("unit_price").alias("priced"))


def mean_above(s, d):
    return rel.argmax(transactions(s, d).select("shop_id", "member_id", "amount"), ["shop_id"], "member_id", "amount")


def pearson_by_key(s, d):
    return rel.pearson(table(s, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice").withColumn("r", F.round("r", 6))


def pearson_pairwise_complete(s, d):
    return rel.pearson(table(s, d, "userlog_ec"), [], "qty", "unit_price").withColumn("r", F.round("r", 6))


def corr_pairs(s, d):
    c = rel.correlation_pairs(table(s, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return c.select("x", "y", F.round("r", 5).alias("r"), "n")


def variance_columns(s, d):
    return rel.near_zero_variance(table(s, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"]).withColumn("variance", F.round("variance", 6))


def entropy_priority(s, d):
    return rel.entropy(table(s, d, "orders"), "o_orderpriority").withColumn("entropy", F.round("entropy", 8))


def share_of_total(s, d):
    return weblog.shares(table(s, d, "orders"), "o_orderpriority").withColumn("share", F.round("share", 6))


def describe_amount(s, d):
    return transactions(s, d).groupBy("shop_id").agg(F.count("amount").alias("n"), F.round(F.avg("amount"), 3).alias("mean"), F.round(F.stddev_samp("amount"), 3).alias("sd"), F.min("amount").alias("low"), F.max("amount").alias("high"))


def latest_per_user(s, d):
    return win.latest(table(s, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


def forward_fill_days(s, d):
    """Each user's last event type on every day from the first event to the last day of the table."""
    e = table(s, d, "events").withColumn("day", F.to_date("ts"))
    last = win.latest(e, ["user_id", "day"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "day", "event_type")
    return win.fill_forward(last, ["user_id"], "day", F.lit(e.agg(F.max("day")).first()[0])).select("user_id", "cal_date", "event_type")


def roc_points(s, d):
    o = table(s, d, "orders").select(F.round(F.col("o_totalprice") / 500000, 2).alias("score"), (F.col("o_orderstatus") == "F").cast("bigint").alias("label"))
    return win.roc_points(o, "score", "label").withColumns({c: F.round(c, 8) for c in ("tpr", "fpr")})


def log_loss(s, d):
    o = table(s, d, "orders").select(F.least(F.round(F.col("o_totalprice") / 500000, 2), F.lit(1.0)).alias("p"), (F.col("o_orderstatus") == "F").cast("int").alias("y"), "o_orderpriority")
    return o.groupBy("o_orderpriority").agg(F.round(F.avg(fn.log_loss(F.col("p"), F.col("y"))), 6).alias("loss"))


def haversine_pairs(s, d):
    """Distances between the nations of one region, at places made of their keys."""
    n = table(s, d, "nation").select("n_regionkey", "n_nationkey", (F.col("n_nationkey") * 7 % 180 - 90.0).alias("lat"), (F.col("n_nationkey") * 29 % 360 - 180.0).alias("lon"))
    a, b = n.alias("a"), n.alias("b")
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_nationkey").cast("bigint").alias("one"), F.col("b.n_nationkey").cast("bigint").alias("two"), F.round(fn.haversine_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")), 4).alias("km"))


def date_parts(s, d):
    o = table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return o.select("day", F.year("day").cast("bigint").alias("y"), F.month("day").cast("bigint").alias("m"), F.dayofmonth("day").cast("bigint").alias("dom"), F.weekday("day").cast("bigint").alias("dow"), F.weekofyear("day").cast("bigint").alias("week"), F.date_format("day", "yyyyMMdd").alias("text"))


def promo_month(s, d):
    o = table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return o.select("day", fn.months_since(F.year("day"), F.month("day"), F.lit(1996), F.lit(5)).cast("bigint").alias("months"), fn.promo_months(F.year("day"), F.weekofyear("day"), F.lit(1997), F.lit(10)).alias("promo"), fn.in_month_list(F.col("day"), F.lit("Jan,Apr,Jul,Sept")).alias("in_list"))


def ip_ranges(s, d):
    """Country of each address by a range table: addresses meet ranges on their first byte, then the bounds decide."""
    ip = F.split("ip", r"\.")
    num = F.aggregate(ip, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x.try_cast("bigint"))
    e = table(s, d, "userlog_ec").where(F.col("ip").rlike(r"^\d+\.\d+\.\d+\.\d+$")).select("ip").distinct().withColumn("num", num).withColumn("byte", F.floor(F.col("num") / 2**16))
    ranges = s.range(0, 256).select((F.lit(10 * 2**24) + F.col("id") * 2**16).alias("low"), (F.lit(10 * 2**24) + (F.col("id") + 1) * 2**16 - 1).alias("high"), F.concat(F.lit("c"), F.col("id") % 5).alias("country")).withColumn("byte", F.floor(F.col("low") / 2**16))
    return e.join(ranges, "byte").where("num between low and high").groupBy("country").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (log_parse, log_failures, log_content_size, log_status_share, log_busy_hosts, log_top_endpoints, log_top_failed_endpoints, log_daily_hosts, log_404_by_day, log_404_by_hour, log_404_summary, log_404_top_hosts, extended_log, cart_actions, order_list_revenue, distinct_profile, multi_agent_users, hour_pivot, author_features, having_distinct, freq_of_freq, mean_of_group_counts, json_prop_extract, event_alerts, profile_numeric, profile_spec, profile_categorical, profile_2d, profile_3d, profile_3d_json, c45_gain_ratio, c45_counts, c45_tree, semi_join_active, anti_join_inactive, left_join_zero_fill, full_outer_status, calendar_shops, self_join_period, union_all, intersect_users, except_users, distinct_brands, topk_revenue_tiebreak, crosstab_priority_status, grouping_sets, predicate_mix, null_handling, mean_above, pearson_by_key, pearson_pairwise_complete, corr_pairs, variance_columns, entropy_priority, share_of_total, describe_amount, latest_per_user, forward_fill_days, roc_points, log_loss, haversine_pairs, date_parts, promo_month, ip_ranges)}

_WORDS_SQL = "list_filter(string_split(trim({x}), ' '), lambda v: v <> '')"
_L = f"""{LOG_SQL}, q as (select event_id, line, string_split(line, '"') as q from raw),
 c as (select event_id, line, {_WORDS_SQL.format(x="split_part(q[1], '[', 1)")} as who, try_strptime(split_part(split_part(q[1], '[', 2), ']', 1)[1:20], '%d/%b/%Y:%H:%M:%S') as stamp, {_WORDS_SQL.format(x='q[2]')} as request, {_WORDS_SQL.format(x='q[3]')} as reply from q),
 x as (select *, coalesce(len(who) = 3 and len(request) between 2 and 3 and stamp is not null and len(reply) >= 2 and regexp_full_match(reply[1], '[0-9]+') and len(reply[1]) = 3, false) as parsed from c),
 lg as (select event_id, who[1] as host, stamp, request[1] as method, request[2] as endpoint, coalesce(request[3], '') as protocol, cast(reply[1] as bigint) as response_code, coalesce(try_cast(reply[2] as bigint), 0) as content_size, parsed from x where parsed)"""
_E = f"with {_L}"
_AGENT = lambda rules: "coalesce(" + ", ".join(f"case when regexp_matches(agent, '{p}') then '{n}' end" for n, p in rules) + ", 'Others')"
_UA = f"{_AGENT(DEVICES)} as device, {_AGENT(BROWSERS)} as browser, {_AGENT(SYSTEMS)} as os"
_TOP = lambda where, k, n: f"{_E} select {k}, count(*)::bigint as n from lg {where} group by 1 order by n desc, {k} limit {n}"
_EC = "coalesce(case when lower(trim(act)) not in ('', '-', '-999', 'null') then trim(act) end, null)"
_GAIN = """o as (select o_orderstatus as label, unnest(['o_orderpriority', 'year', 'month']) as var, unnest([o_orderpriority, year(o_orderdate)::varchar, month(o_orderdate)::varchar]) as value from orders),
 c as (select var, value, label, count(*)::double as c from o group by all), v as (select var, value, sum(c) as n, -sum(c * log2(c)) / sum(c) + log2(sum(c)) as h from c group by all),
 cond as (select var, sum(n * h) / sum(n) as conditional, sum(n)::bigint as n, log2(sum(n)) - sum(n * log2(n)) / sum(n) as split_info from v group by all),
 lab as (select var, label, sum(c) as c from c group by all), oc as (select var, log2(sum(c)) - sum(c * log2(c)) / sum(c) as outcome from lab group by all)"""
_HOURS = ", ".join(f"count(*) filter (hour(ts) = {h})::bigint as h{h:02d}" for h in range(24))
_PROFILE = lambda t, cols, p: " union all ".join(f"select '{n}' as \"column\", count({c})::bigint as n, round(sum({c}::double), {p}) as total, round(avg({c}), {p}) as mean, round(stddev_pop({c}), {p}) as sd, round(min({c})::double, {p}) as low, round(max({c})::double, {p}) as high from {t}" for c, n in cols)

SQL = {
    "log_parse": f"{_E} select * from lg",
    "log_failures": f"{_E} select case when event_id % 7 = 0 then 'bad' else 'good' end as kind, count(*)::bigint as n from lg group by 1",
    "log_content_size": f"{_E} select floor(sum(content_size) / count(*))::bigint as avg_size, min(content_size) as min_size, max(content_size) as max_size from lg",
    "log_status_share": f"{_E} select response_code, count(*)::bigint as n, round(count(*) / (select count(*) from lg)::double, 6) as share from lg group by 1",
    "log_busy_hosts": f"{_E} select host, count(*)::bigint as n from lg group by 1 having count(*) > 10",
    "log_top_endpoints": _TOP("", "endpoint", 10),
    "log_top_failed_endpoints": _TOP("where response_code <> 200", "endpoint", 10),
    "log_daily_hosts": f"{_E} select stamp::date as day, count(distinct host)::bigint as hosts, count(*)::bigint as requests, floor(count(*) / count(distinct host))::bigint as per_host from lg group by 1",
    "log_404_by_day": f"{_E} select stamp::date as day, count(*)::bigint as n from lg where response_code = 404 group by 1",
    "log_404_by_hour": f"{_E} select hour(stamp)::bigint as hour, count(*)::bigint as n from lg where response_code = 404 group by 1",
    "log_404_summary": f"{_E} select count(*)::bigint as n, count(distinct endpoint)::bigint as endpoints, count(distinct host)::bigint as hosts from lg where response_code = 404",
    "log_404_top_hosts": _TOP("where response_code = 404", "host", 25),
    "extended_log": f"select {_UA}, concat('http://', hostname, '/') as last_page, count(*)::bigint as n from userlog_ec where ip is not null and hostname is not null and agent is not null and coalesce(act, '') not like '% %' group by all",
    "cart_actions": "select ip, pid, dates_int::bigint as dates_int, count(*)::bigint as n from userlog_ec where act like 'cart%' and pid <> '' group by all",
    "order_list_revenue": "select l_partkey::varchar as item, sum(l_quantity::bigint * l_linenumber)::bigint as revenue from lineitem group by 1 order by revenue desc, item limit 20",
    "distinct_profile": "select lower(trim(eruid)) as who, " + ", ".join(f"count(distinct {c})::bigint as n_{c}" for c in ("ip", "uid", "ssid", "pid", "hostname")) + ", count(*)::bigint as n from userlog_ec where eruid is not null group by 1",
    "multi_agent_users": "select lower(trim(eruid)) as who, count(distinct agent)::bigint as n from userlog_ec where eruid is not null and agent is not null group by 1 having count(distinct agent) > 1",
    "hour_pivot": f"with {CLICKS_SQL} select eruid, {_HOURS} from clicks group by 1",
    "author_features": "with l as (select trim(author) as author, case when abs(op_at) >= 100000000000 then op_at // 1000 else op_at end as t, action from userlog where lower(trim(author)) not in ('', '-', '-999', 'null') and op_at is not null), d as (select author, t // 86400 as day, count(*) as n, count(distinct action) as k from l group by 1, 2), a as (select author, count(*)::bigint as active_days, round(avg(n), 6) as mean_actions, round(avg(k), 6) as mean_distinct from d group by 1), sec as (select author, t, count(*) as n from l group by 1, 2), b as (select author, count(*) filter (n > 1)::bigint as double_seconds, " + ", ".join(f"coalesce(sum(n) filter ((t % 86400) // 3600 = {h}), 0)::bigint as h{h:02d}" for h in range(24)) + " from sec group by 1), sp as (select author, max(is_spam)::bigint as is_spam from articles_half_a group by 1) select * from a join b using (author) left join sp using (author)",
    "having_distinct": f"with {CLICKS_SQL} select eruid, count(distinct act)::bigint as acts from clicks group by 1 having count(distinct act) > 4",
    "freq_of_freq": f"with {CLICKS_SQL} select c::bigint as c, count(*)::bigint as n from (select eruid, count(*) as c from clicks group by 1) group by 1",
    "mean_of_group_counts": f"with {CLICKS_SQL} select eruid, round(avg(c), 6) as mean from (select eruid, ts::date as day, count(*) as c from clicks group by 1, 2) group by 1",
    "json_prop_extract": f"with {CLICKS_SQL} select json_extract_string(props, '$.k') as k, count(*)::bigint as n from clicks group by 1",
    "event_alerts": f"with {CLICKS_SQL}, st as (select act, avg(value) as m, stddev_pop(value) as sd from clicks group by 1) select act, ts::date as day, count(*)::bigint as n from clicks join st using (act) where abs(value - m) > 2 * sd group by 1, 2",
    "profile_numeric": _PROFILE("part", [("p_size", "p_size"), ("p_retailprice", "p_retailprice")], 4),
    "profile_spec": _PROFILE("customer", [("c_acctbal", "balance"), ("c_nationkey", "nation")], 3),
    "profile_categorical": "select 'p_brand' as \"column\", p_brand as value, count(*)::bigint as n from part group by 2 union all select 'p_type', p_type, count(*)::bigint from part group by 2",
    "profile_2d": "select p_brand, p_type, count(*)::bigint as n from part group by 1, 2",
    "profile_3d": "select p_brand, p_type, count(p_retailprice)::bigint as n, round(sum(p_retailprice), 4) as total, round(avg(p_retailprice), 4) as mean, round(stddev_pop(p_retailprice), 4) as sd, round(min(p_retailprice), 4) as low, round(max(p_retailprice), 4) as high from part group by 1, 2",
    "c45_gain_ratio": f"with {_GAIN} select var, n, round(outcome, 8) as outcome, round(conditional, 8) as conditional, round(split_info, 8) as split_info, round(case when split_info > 0 then (outcome - conditional) / split_info else 0 end, 8) as gain_ratio from cond join oc using (var)",
    "c45_counts": "select unnest(['o_orderpriority', 'year']) as var, unnest([o_orderpriority, year(o_orderdate)::varchar]) as value, o_orderstatus as label, 1 as one from orders",
    "semi_join_active": "select c_custkey, c_mktsegment from customer where c_custkey in (select o_custkey from orders group by 1 having sum(o_totalprice) > 1000000)",
    "anti_join_inactive": "select c_custkey, c_mktsegment from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderdate::date >= date '2000-08-01')",
    "left_join_zero_fill": "select c_custkey, count(o_orderkey)::bigint as n from customer left join orders on c_custkey = o_custkey group by 1",
    "full_outer_status": "select o_custkey, count(*) filter (o_orderstatus = 'F')::bigint as f, count(*) filter (o_orderstatus = 'O')::bigint as o from orders group by 1 having count(*) filter (o_orderstatus in ('F', 'O')) > 0",
    "calendar_shops": f"with {T_SQL}, cal as (select shop_id, unnest(generate_series(date '1998-06-01', date '1998-06-30', interval 1 day))::date as ordate from (select distinct shop_id from t)) select cal.shop_id, cal.ordate, count(t.member_id)::bigint as n from cal left join t using (shop_id, ordate) group by 1, 2",
    "self_join_period": f"with {T_SQL}, m as (select shop_id, date_trunc('month', ordate)::date as month, round(sum(amount), 2) as amount from t group by 1, 2) select a.shop_id, a.month, a.amount, b.amount as year_ago from m a join m b on a.shop_id = b.shop_id and a.month = b.month + interval 12 month",
    "union_all": "select n_name as name from nation union all select r_name from region union all select r_name from region",
    "intersect_users": f"with {CLICKS_SQL} select eruid from clicks where act = 'purchase' intersect select eruid from clicks where act = 'click'",
    "except_users": f"with {CLICKS_SQL} select eruid, ts::date as day from clicks where act = 'click' except select eruid, ts::date from clicks where act = 'error'",
    "distinct_brands": "select distinct p_brand, p_size from part",
    "topk_revenue_tiebreak": "select l_partkey as item_id, sum(l_quantity)::bigint as qt from lineitem group by 1 order by qt desc, item_id limit 21",
    "crosstab_priority_status": "select o_orderpriority, count(*) filter (o_orderstatus = 'F')::bigint as f, count(*) filter (o_orderstatus = 'O')::bigint as o, count(*) filter (o_orderstatus = 'P')::bigint as p from orders group by 1",
    "grouping_sets": "select o_orderstatus, o_orderpriority, count(*)::bigint as n, grouping(o_orderstatus, o_orderpriority)::bigint as level from orders group by rollup (o_orderstatus, o_orderpriority)",
    "predicate_mix": "select p_partkey, case when p_size < 10 then 'small' when p_size < 15 then 'middle' else 'large' end as size from part where p_size between 5 and 20 and p_brand in ('Brand#11', 'Brand#12', 'Brand#13') and p_type not like '%X%' and p_name is not null and regexp_matches(p_brand, '^Brand#\\d+$')",
    "null_handling": f"select {_EC} as act, sum(case when qty is null or unit_price is null then 1 else 0 end)::bigint as with_null, sum(coalesce(qty, 0))::bigint as qty, count(unit_price)::bigint as priced from userlog_ec group by 1",
    "mean_above": f"with {T_SQL}, m as (select shop_id, member_id, max(amount) as amount from t group by 1, 2), r as (select *, row_number() over (partition by shop_id order by amount desc, member_id) as rn from m) select shop_id, member_id, amount from r where rn = 1",
    "pearson_by_key": "select l_returnflag, count(*)::bigint as n, round(corr(l_quantity, l_extendedprice), 6) as r from lineitem group by 1",
    "pearson_pairwise_complete": "select count(*)::bigint as n, round(corr(qty, unit_price), 6) as r from userlog_ec where qty is not null and unit_price is not null",
    "corr_pairs": " union all ".join(f"select '{a}' as x, '{b}' as y, round(corr({a}, {b}), 5) as r, count(*)::bigint as n from lineitem" for a, b in (("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_quantity", "l_tax"), ("l_extendedprice", "l_discount"), ("l_extendedprice", "l_tax"), ("l_discount", "l_tax"))),
    "variance_columns": " union all ".join(f"select '{c}' as \"column\", round(var_samp({c}), 6) as variance from lineitem" for c in ("l_quantity", "l_discount", "l_tax")),
    "entropy_priority": "with c as (select o_orderpriority, count(*)::double as c from orders group by 1) select round(log2(sum(c)) - sum(c * log2(c)) / sum(c), 8) as entropy from c",
    "share_of_total": "select o_orderpriority, count(*)::bigint as n, round(count(*) / (select count(*) from orders)::double, 6) as share from orders group by 1",
    "describe_amount": f"with {T_SQL} select shop_id, count(amount)::bigint as n, round(avg(amount), 3) as mean, round(stddev_samp(amount), 3) as sd, min(amount) as low, max(amount) as high from t group by 1",
    "latest_per_user": "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1",
    "forward_fill_days": "with l as (select user_id, ts::date as day, event_type, row_number() over (partition by user_id, ts::date order by ts desc, event_id desc) as rn from events), u as (select user_id, day, event_type, lead(day) over (partition by user_id order by day) as nxt from l where rn = 1) select user_id, unnest(generate_series(day, coalesce(nxt - 1, (select max(ts::date) from events)), interval 1 day))::date as cal_date, event_type from u",
    "roc_points": "with o as (select round(o_totalprice / 500000, 2) as score, case when o_orderstatus = 'F' then 1 else 0 end as label from orders), g as (select score, sum(label) as p, sum(1 - label) as n from o group by 1) select score, round(sum(p) over w / (select sum(p) from g)::double, 8) as tpr, round(sum(n) over w / (select sum(n) from g)::double, 8) as fpr from g window w as (order by score desc)",
    "log_loss": "with o as (select least(round(o_totalprice / 500000, 2), 1.0) as p, o_orderstatus = 'F' as y, o_orderpriority from orders), q as (select *, case when p = 0 then 10e-12 when p = 1 then 1 - 10e-12 else p end as q from o) select o_orderpriority, round(avg(case when y then -ln(q) else -ln(1 - q) end), 6) as loss from q group by 1",
    "haversine_pairs": "with n as (select n_regionkey, n_nationkey, n_nationkey * 7 % 180 - 90.0::double as lat, n_nationkey * 29 % 360 - 180.0::double as lon from nation) select a.n_nationkey::bigint as one, b.n_nationkey::bigint as two, round(2 * 6378.137 * asin(sqrt(least(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2), 1.0))), 4) as km from n a join n b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey",
    "date_parts": "select distinct o_orderdate::date as day, year(o_orderdate)::bigint as y, month(o_orderdate)::bigint as m, day(o_orderdate)::bigint as dom, (isodow(o_orderdate) - 1)::bigint as dow, week(o_orderdate)::bigint as week, strftime(o_orderdate, '%Y%m%d') as text from orders",
    "promo_month": "select distinct o_orderdate::date as day, greatest((year(o_orderdate) - 1996) * 12 + month(o_orderdate) - 5, 0)::bigint as months, greatest((year(o_orderdate) - 1997) * 12 + (week(o_orderdate) - 10) / 4.0::double, 0.0::double) as promo, month(o_orderdate) in (1, 4, 7, 9) as in_list from orders",
    "ip_ranges": "with a as (select distinct ip from userlog_ec where regexp_matches(ip, '^\\d+\\.\\d+\\.\\d+\\.\\d+$')) select concat('c', split_part(ip, '.', 2)::int % 5) as country, count(*)::bigint as n from a where ip like '10.%' group by 1",
}
SQL["c45_counts"] = "select var, value, label, count(*)::bigint as n from (" + SQL["c45_counts"] + ") group by 1, 2, 3"
