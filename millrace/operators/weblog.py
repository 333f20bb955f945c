"""Web-server logs and clickstreams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalar import BROWSER_RULES, DEVICE_RULES, OS_RULES, apache_time, first_rule, triples



def _words(c: Column) -> Column:
    return F.filter(F.split(F.trim(c), " +"), lambda x: x != "")


def _fields(line: Column) -> dict[str, Column]:
    """What stands where in a line: the quotes cut it into who and when, the request, the reply, and further quoted texts."""
    quoted = F.split(line, '"')
    piece = lambda i: F.get(quoted, F.lit(i))
    when = F.split_part(F.split_part(piece(0), F.lit("["), F.lit(2)), F.lit("]"), F.lit(1))
    return {"who": _words(F.split_part(piece(0), F.lit("["), F.lit(1))), "when": when, "request": _words(piece(1)), "reply": _words(piece(2)), "last_page": piece(3), "agent": piece(5)}


def _parse(df: DataFrame, line: str, extended: bool) -> DataFrame:
    """Cuts each line once, then reads the fields from the pieces; a line fits if every piece has the form it should."""
    cut = df.withColumn("_cut", F.struct(*[c.alias(n) for n, c in _fields(F.col(line)).items()]))
    at = lambda name, i: F.get(F.col(f"_cut.{name}"), F.lit(i))
    stamp = apache_time(F.col("_cut.when"))
    code = F.when(F.translate(at("reply", 0), "123456789", "000000000") == "000", at("reply", 0).try_cast("int"))
    fits = (F.size("_cut.who") == 3) & F.size("_cut.request").between(2, 3) & stamp.isNotNull() & code.isNotNull() & (F.size("_cut.reply") >= 2)
    if extended:
        fits &= F.col("_cut.last_page").isNotNull() & F.col("_cut.agent").isNotNull()
    ok = F.coalesce(fits, F.lit(False))
    values = {"host": at("who", 0), "client_identd": at("who", 1), "user_id": at("who", 2), "stamp": stamp, "method": at("request", 0), "endpoint": at("request", 1), "protocol": F.coalesce(at("request", 2), F.lit("")), "response_code": code, "content_size": F.coalesce(at("reply", 1).try_cast("bigint"), F.lit(0))}
    if extended:
        values |= {"last_page": F.col("_cut.last_page"), "agent": F.col("_cut.agent")}
    return cut.withColumns({**{n: F.when(ok, v) for n, v in values.items()}, "parsed": ok}).drop("_cut")


def parse_common(df: DataFrame, line: str = "line") -> DataFrame:
    """Host, identity, user, time, request, code and size of each line; ``parsed`` false and fields null where it has another form. A size of ``-`` is 0."""
    return _parse(df, line, extended=False)


def parse_extended(df: DataFrame, line: str = "line", devices: tuple = DEVICE_RULES, browsers: tuple = BROWSER_RULES, systems: tuple = OS_RULES) -> DataFrame:
    """The same with referrer and agent, and the agent's ``device``, ``browser`` and ``os`` by rules."""
    got = _parse(df, line, extended=True)
    return got.withColumns({"device": first_rule(F.col("agent"), devices), "browser": first_rule(F.col("agent"), browsers), "os": first_rule(F.col("agent"), systems)})


def content_sizes(log: DataFrame) -> DataFrame:
    """Whole-number average, least and most bytes."""
    return log.agg(F.floor(F.sum("content_size") / F.count("content_size")).cast("bigint").alias("avg_size"), F.min("content_size").alias("min_size"), F.max("content_size").alias("max_size"))


def shares(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their share of all; keys are first combined, so the total is over few rows."""
    from pyspark.sql import Window

    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def top(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` commonest keys, ties by key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *keys).limit(n)


def daily_hosts(log: DataFrame) -> DataFrame:
    """Per day: distinct hosts, requests, and the whole-number average of requests per host."""
    g = log.groupBy(F.to_date("stamp").alias("day")).agg(F.countDistinct("host").alias("hosts"), F.count(F.lit(1)).alias("requests"))
    return g.withColumn("per_host", F.floor(F.col("requests") / F.col("hosts")).cast("bigint"))


def order_items(df: DataFrame, plist: str = "plist") -> DataFrame:
    """Revenue per item of ``item,qty,amt,...`` lists: ``item, revenue`` with revenue ``qty * amt``."""
    return df.select(F.explode(triples(F.col(plist))).alias("x")).groupBy("x.item").agg(F.sum(F.col("x.qty") * F.col("x.amt")).alias("revenue"))


def key_value(c: Column, key: str, sep: str = ";") -> Column:
    """The value of ``key=`` in a list of pairs; null if it isn't there."""
    found = F.regexp_extract(c, rf"(?:^|{sep}){key}=([^{sep}]*)", 1)
    return F.when(found != "", found)


def distinct_profile(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Distinct values of each column per key."""
    return df.groupBy(key).agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns], F.count(F.lit(1)).alias("n"))


def multi_agent_users(df: DataFrame, key: str, agent: str, devices: tuple = DEVICE_RULES, browsers: tuple = BROWSER_RULES, systems: tuple = OS_RULES) -> DataFrame:
    """Keys with more than one combination of device, browser, system and agent text."""
    d = df.select(F.col(key), first_rule(F.col(agent), devices).alias("device"), first_rule(F.col(agent), browsers).alias("browser"), first_rule(F.col(agent), systems).alias("os"), F.col(agent)).where(F.col(key).isNotNull() & F.col(agent).isNotNull()).distinct()
    return d.groupBy(key).agg(F.count("device").alias("n")).where("n > 1")


def author_features(log: DataFrame, author: str, at: str, action: str) -> DataFrame:
    """Per author: active days, mean actions and mean distinct actions per active day, seconds with two actions or more, hourly counts ``h00..h23``.

    ``at`` is an epoch in seconds. Rows are combined by author, second and action before the wider groups.
    """
    d = log.select(F.col(author).alias("author"), F.col(at).cast("bigint").alias("t"), F.col(action).alias("action")).where("author is not null and t is not null")
    day = F.floor(F.col("t") / 86_400)
    sec = d.groupBy("author", "t").agg(F.count(F.lit(1)).alias("n"))
    by_day = d.groupBy("author", day.alias("day")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("action").alias("k"))
    a = by_day.groupBy("author").agg(F.count(F.lit(1)).alias("active_days"), F.avg("n").alias("mean_actions"), F.avg("k").alias("mean_distinct"))
    hours = [F.sum(F.when(F.floor(F.pmod("t", F.lit(86_400)) / 3600) == h, F.col("n")).otherwise(0)).alias(f"h{h:02d}") for h in range(24)]
    b = sec.groupBy("author").agg(F.sum((F.col("n") > 1).cast("bigint")).alias("double_seconds"), *hours)
    return a.join(b, "author")
