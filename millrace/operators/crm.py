"""Shop and member analytics. Input is ``transactions(shop_id, member_id, ordate date, amount)`` unless said otherwise.

Sentinels are -999 only in output columns that are documented so. Days are dates; ``cal_date`` is an ISO text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.windows import fill_forward, order_gaps, running_totals

NONE = -999.0
#: Thresholds of the lifecycle tags as multiples of the adjusted interval.
GAMMAS = (2.0389, 2.5515, 2.9154)
MEMBER = ["shop_id", "member_id"]


def _day(text: str) -> Column:
    return F.to_date(F.lit(text))


def member_gaps(t: DataFrame) -> DataFrame:
    """Days between each member's consecutive orders, 0 for orders of one day."""
    return order_gaps(t, MEMBER, "ordate").where("gap is not null")


def mu2_interval(t: DataFrame, start: str, end: str) -> DataFrame:
    """Per shop and day of ``start..end``: ``n, mean, sd`` (population) of all gaps whose later order is not after the day; -999 without any.

    Gaps are added up per shop and day (earlier ones on ``start``) and accumulated over the calendar, so no gap meets
    more than one day.
    """
    g = member_gaps(t).where(F.col("ordate") <= _day(end)).groupBy("shop_id", F.greatest("ordate", _day(start)).alias("cal_date")).agg(F.count("gap").alias("n"), F.sum("gap").alias("s"), F.sum(F.col("gap").cast("bigint") * F.col("gap")).alias("q"))
    days = t.select("shop_id").distinct().select("shop_id", F.explode(F.sequence(_day(start), _day(end), F.expr("interval 1 day"))).alias("cal_date"))
    w = Window.partitionBy("shop_id").orderBy("cal_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = days.join(g, ["shop_id", "cal_date"], "left")
    so_far = {c: F.coalesce(F.sum(c).over(w), F.lit(0)) for c in ("n", "s", "q")}
    d = d.select("shop_id", "cal_date", *[e.alias(c) for c, e in so_far.items()])
    mean = F.try_divide(F.col("s"), F.col("n"))
    return d.select("shop_id", "cal_date", "n", F.coalesce(mean, F.lit(NONE)).alias("mean"), F.when(F.col("n") > 0, F.sqrt(F.greatest(F.try_divide(F.col("q"), F.col("n")) - mean * mean, F.lit(0.0)))).otherwise(NONE).alias("sd"))


def individual_interval(t: DataFrame, end: str, start: str | None = None) -> DataFrame:
    """Per member one row for every day from the first order (or ``start``) to ``end``: mean gap and number of gaps so far (-999 without any), first and last order so far."""
    w = Window.partitionBy(*MEMBER).orderBy("ordate").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = order_gaps(t, MEMBER, "ordate").groupBy(*MEMBER, "ordate").agg(F.sum("gap").alias("g"), F.count("gap").alias("k"))
    state = daily.select(*MEMBER, "ordate", F.sum("k").over(w).alias("k"), F.sum("g").over(w).alias("g"), F.min("ordate").over(w).alias("first_order"))
    filled = fill_forward(state, MEMBER, "ordate", _day(end))
    if start:
        filled = filled.where(F.col("cal_date") >= _day(start))
    return filled.select("cal_date", *MEMBER, F.when(F.col("k") > 0, F.col("g") / F.col("k")).otherwise(NONE).alias("mean_interval"), F.when(F.col("k") > 0, F.col("k")).otherwise(int(NONE)).cast("bigint").alias("n_interval"), "first_order", F.col("ordate").alias("last_order"))


def mu_mean_std(individual: DataFrame) -> DataFrame:
    """Per day and shop: ``n, mean, sd`` of members' mean gaps (-999 ignored), variance ``sum(x^2)/(n-1) - mean^2``; -999 for fewer than two."""
    from millrace.operators.relational import mean_std

    return mean_std(individual.where(F.col("mean_interval") != NONE), ["cal_date", "shop_id"], "mean_interval")


def adjusted_interval(individual: DataFrame, mu2: DataFrame, mu: DataFrame) -> DataFrame:
    """Members' mean gaps shrunk to their shop's, as of one day (``individual`` and both summaries hold that day only).

    With shop mean and sd of members' means (mu, sigma) and of all gaps (mu2, sigma2): ``alpha = mu^2/sigma^2 + 2``,
    ``theta = sigma^2 / (mu (mu^2 + sigma^2))``, ``k = mu2^2/sigma2^2``, ``d = k n + alpha - 1``; the adjusted gap is
    ``k (n/d mean + 1/(d theta))``, for members without gaps ``k / ((alpha-1) theta)``; -999 where a sd is missing or 0.
    """
    m2 = mu2.select("shop_id", F.col("mean").alias("mu2"), F.col("sd").alias("sd2"))
    m1 = mu.select("shop_id", F.col("mean").alias("mu1"), F.col("sd").alias("sd1"))
    d = individual.join(m2, "shop_id", "left").join(m1, "shop_id", "left")
    ok = (F.col("sd1") > 0) & (F.col("sd2") > 0)
    v1, mu1, n = F.col("sd1") * F.col("sd1"), F.col("mu1"), F.col("n_interval")
    alpha, theta, k = mu1 * mu1 / v1 + 2, v1 / (mu1 * (mu1 * mu1 + v1)), F.col("mu2") * F.col("mu2") / (F.col("sd2") * F.col("sd2"))
    dd = k * n + alpha - 1
    adj = F.when(~F.coalesce(ok, F.lit(False)), NONE).when(n == int(NONE), k / ((alpha - 1) * theta)).otherwise(k * (n / dd * F.col("mean_interval") + 1 / (dd * theta)))
    return d.select(*MEMBER, adj.alias("gap_mean_adj"), "first_order", "last_order")


def lrfm_snapshot(t: DataFrame, cal_date: str) -> DataFrame:
    """Per member as of a day: ``L`` last minus first order, ``R`` day minus last order, ``F`` orders, ``M`` amount; only members with ``M > 0``."""
    g = t.where(F.col("ordate") <= _day(cal_date)).groupBy(*MEMBER).agg(F.min("ordate").alias("a"), F.max("ordate").alias("b"), F.count(F.lit(1)).alias("F"), F.sum("amount").alias("M"))
    return g.where("M > 0").select(*MEMBER, F.datediff("b", "a").cast("bigint").alias("L"), F.datediff(_day(cal_date), F.col("b")).cast("bigint").alias("R"), "F", "M")


def lrfm_daily(t: DataFrame, end: str, start: str | None = None) -> DataFrame:
    """The same for every day from a member's first order (or ``start``) to ``end``, in one pass; members with ``M <= 0`` too."""
    w = Window.partitionBy(*MEMBER).orderBy("ordate").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = running_totals(t, MEMBER, "ordate", "amount").withColumn("first", F.min("ordate").over(w))
    d = fill_forward(state, MEMBER, "ordate", _day(end))
    if start:
        d = d.where(F.col("cal_date") >= _day(start))
    return d.select("cal_date", *MEMBER, F.datediff("ordate", "first").cast("bigint").alias("L"), F.datediff("cal_date", "ordate").cast("bigint").alias("R"), F.col("frequency").alias("F"), F.col("monetary").alias("M"))


def nes_tag(lrfm: DataFrame, adjusted: DataFrame, window: int = 30, unknown_as: str | None = None) -> DataFrame:
    """Lifecycle tag of each member.

    N: ``L = 0 and R <= window``; EB: ``R <= window and F > 1``; else S3, S2, S1 where R exceeds the adjusted gap
    times 2.9154, 2.5515, 2.0389; else E0. A gap of -999 makes everyone else S3 unless ``unknown_as`` names a tag.
    """
    g = F.col("gap_mean_adj")
    tag = F.when((F.col("L") == 0) & (F.col("R") <= window), "N").when((F.col("R") <= window) & (F.col("F") > 1), "EB")
    if unknown_as:
        tag = tag.when(g == NONE, unknown_as)
    for name, gamma in zip(("S3", "S2", "S1"), reversed(GAMMAS), strict=True):
        tag = tag.when(F.col("R") > g * gamma, name)
    return lrfm.join(adjusted.select(*MEMBER, "gap_mean_adj"), MEMBER).select(*MEMBER, tag.otherwise("E0").alias("NES_Tag"))


def arpu(t: DataFrame, tags: DataFrame, cal_date: str, period: int) -> DataFrame:
    """Amount per order over the ``period`` days before ``cal_date``, of N (``N0``) and of E0, S1, S2 (``E0S1S2``)."""
    recent = t.where((F.col("ordate") >= F.date_sub(_day(cal_date), period)) & (F.col("ordate") < _day(cal_date)))
    group = F.when(F.col("NES_Tag") == "N", "N0").when(F.col("NES_Tag").isin("E0", "S1", "S2"), "E0S1S2")
    return recent.join(tags, MEMBER).withColumn("NES_Tagging", group).where("NES_Tagging is not null").groupBy("shop_id", "NES_Tagging").agg((F.sum("amount") / F.count(F.lit(1))).alias("arpu"))


def conversion(tags: DataFrame) -> DataFrame:
    """EB / (N + EB) per shop, -999 without EB."""
    eb, n = (F.sum((F.col("NES_Tag") == x).cast("int")) for x in ("EB", "N"))
    return tags.groupBy("shop_id").agg(F.when(eb > 0, eb / (n + eb)).otherwise(NONE).alias("conversion"))


def conversion_members(tags: DataFrame) -> DataFrame:
    return tags.where(F.col("NES_Tag") == "EB").select(*MEMBER)


def wakeup(now: DataFrame, before: DataFrame) -> DataFrame:
    """Share of members that were S1, S2 or S3 a period ago and are E0 now, per shop and earlier tag."""
    old = before.where(F.col("NES_Tag").isin("S1", "S2", "S3")).select(*MEMBER, F.col("NES_Tag").alias("original"))
    return now.join(old, MEMBER).groupBy("shop_id", F.col("original").alias("NES_Tag")).agg((F.sum((F.col("NES_Tag") == "E0").cast("int")) / F.count(F.lit(1))).alias("rate"))


REPORT_TAGS = ("N", "E", "S1", "S2", "S3")


def _report_block(df: DataFrame, category: str, tag: Column, value: Column, fill: float | None = NONE) -> DataFrame:
    """One KPI block: a column for each tag from one conditional aggregate."""
    cells = [F.max(F.when(tag == t, value)).alias(t) for t in REPORT_TAGS]
    g = df.groupBy("shop_id").agg(*cells)
    return g.select("shop_id", F.lit(category).alias("category"), *[(F.coalesce(F.col(t), F.lit(fill)) if fill is not None else F.col(t)).cast("double").alias(t) for t in REPORT_TAGS])


def store_report(tags: DataFrame, conv: DataFrame, wake: DataFrame, arpus: DataFrame, valid: DataFrame, active: DataFrame) -> DataFrame:
    """Seven KPI blocks ``(shop_id, category, N, E, S1, S2, S3)``: members, share, conversion, wakeup, arpu, addedrate (``valid``: TA_Tag 4096 N, 8192 S1), activerate (``active``)."""
    group = F.when(F.col("NES_Tag").isin("E0", "EB"), "E").otherwise(F.col("NES_Tag"))
    count = tags.groupBy("shop_id", group.alias("tag")).agg(F.count(F.lit(1)).alias("c"))
    share = count.withColumn("share", F.col("c") / F.sum("c").over(Window.partitionBy("shop_id")))
    blocks = [
        _report_block(count, "members", F.col("tag"), F.col("c").cast("double")),
        _report_block(share, "share", F.col("tag"), F.col("share")),
        _report_block(conv, "conversion", F.lit("N"), F.col("conversion")),
        _report_block(wake, "wakeup", F.col("NES_Tag"), F.col("rate")),
        _report_block(arpus, "arpu", F.when(F.col("NES_Tagging") == "N0", "N").otherwise("E"), F.col("arpu")),
        _report_block(valid, "addedrate", F.when(F.col("TA_Tag") == 4096, "N").when(F.col("TA_Tag") == 8192, "S1"), F.col("rate"), None),
        _report_block(active, "activerate", F.lit("E"), F.col("active"), None),
    ]
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out


def report_json(report: DataFrame) -> DataFrame:
    """One JSON document per shop: category to its cells."""
    cells = F.struct(*[F.col(t) for t in REPORT_TAGS])
    return report.groupBy("shop_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("category").alias("key"), cells.alias("value")))))).alias("report"))


def top_sale(items: DataFrame, n: int = 40) -> DataFrame:
    """Ranks (ties share one) of each shop's items by quantity and by amount; rows within ``n`` in either."""
    q = Window.partitionBy("shop_id").orderBy(F.desc("item_qt"))
    a = Window.partitionBy("shop_id").orderBy(F.desc("item_amt"))
    ranked = items.withColumns({"rank_qt": F.rank().over(q), "rank_amt": F.rank().over(a)})
    return ranked.where((F.col("rank_qt") <= n) | (F.col("rank_amt") <= n))


def merge_lrfm(state: DataFrame, delta: DataFrame) -> DataFrame:
    """State ``(shop_id, member_id, first, last, F, M)`` after the new transactions ``delta``; equals the state of all transactions, in whatever parts they come."""
    new = delta.groupBy(*MEMBER).agg(F.min("ordate").alias("first"), F.max("ordate").alias("last"), F.count(F.lit(1)).alias("F"), F.sum("amount").alias("M"))
    return state.unionByName(new).groupBy(*MEMBER).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("F").alias("F"), F.sum("M").alias("M"))


def within_period(t: DataFrame, day: str, cal_date: str, days: int) -> DataFrame:
    """Rows of the ``days`` days up to ``cal_date``."""
    return t.where((F.col(day) > F.date_sub(_day(cal_date), days)) & (F.col(day) <= _day(cal_date)))
