"""Queries of column functions, matrices, merges and what runs around a plan; with their SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import scalar as fn
from millrace.operators import actions, fits, relational as rel
from millrace.plans.tables import table


def record_lines(s: SparkSession, d: str) -> DataFrame:
    """Parts written as quoted records, with a header and some broken lines, and read again."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    good = table(s, d, "part").select(F.concat_ws(",", F.col("p_partkey").cast("string"), q(F.col("p_name")), q(F.concat("p_brand", F.lit(", "), "p_type")), F.col("p_size").cast("string")).alias("line"))
    other = s.createDataFrame([("id,name,kind,size",), ("1,two",), ("1,2,3,4,5",)], "line string")
    r = good.unionByName(other).select(fn.parse_record(F.col("line"), ["id", "name", "kind", "size"]).alias("r")).select("r.*")
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("kind").alias("kinds"), F.sum(F.col("size").try_cast("bigint")).alias("size"))


def text_forms(s, d):
    """Plurals, quotes taken away, letters and digits kept, lengths of lists, dashes and blanks aside."""
    p = table(s, d, "part")
    return p.select("p_partkey", fn.pluralise(F.col("p_name")).alias("many"), fn.remove_quotes(F.concat(F.lit("'"), "p_brand", F.lit('"'))).alias("bare"), fn.keep_alphanumeric(F.col("p_type"), "-").alias("kept"), fn.list_length(F.concat_ws(",", "p_brand", "p_type")).cast("bigint").alias("items"), F.translate("p_brand", "#-", "").alias("dashless"), F.ltrim(F.rtrim(F.concat(F.lit("  "), "p_brand", F.lit(" ")))).alias("trimmed"))


def unicode_forms(s, d):
    """Article titles escaped to ASCII and back: all are ASCII on the way, all come back."""
    t = table(s, d, "articles_half_a").where("title is not null").select("article_id", "title", fn.escape_unicode(F.col("title")).alias("e"))
    return t.select("article_id", F.col("e").rlike(r"^[\x00-\x7f]*$").alias("ascii"), (fn.unescape_unicode(F.col("e")) == F.col("title")).alias("same"))


def number_forms(s, d):
    """Safe division, sigmoid of a clipped value, hash buckets, labels."""
    o = table(s, d, "orders")
    labels = {"F": 0, "O": 1}
    return o.select("o_orderkey", F.round(fn.safe_divide(F.col("o_totalprice"), F.col("o_orderkey") % 3), 4).alias("ratio"), F.round(fn.sigmoid(F.col("o_orderkey") % 50 - 25), 8).alias("squashed"), fn.md5_bucket(F.col("o_orderkey").cast("string"), 97).alias("bucket"), fn.labelled(F.col("o_orderstatus"), labels, -1).cast("bigint").alias("label"))


def polar_points(s, d):
    p = table(s, d, "part").select("p_partkey", fn.polar((F.col("p_size") - 25).cast("double"), (F.col("p_partkey") % 21 - 10).cast("double")).alias("p"))
    return p.select("p_partkey", F.round("p.length", 6).alias("length"), F.round("p.angle", 6).alias("angle"), F.round("p.red", 6).alias("red"))


def kernel_values(s, d):
    """Gaussian kernel of each part against a fixed point, and products of pairs of columns."""
    x = F.array((F.col("p_size") / 10).cast("double"), (F.col("p_retailprice") / 1000).cast("double"))
    at = F.array(F.lit(2.0), F.lit(1.0))
    return table(s, d, "part").select("p_partkey", F.round(fn.gaussian_kernel(x, at, 1.5), 8).alias("kernel"), F.round(F.aggregate(fn.two_way_interactions(x), F.lit(0.0), lambda a, v: a + v), 6).alias("products"))


def covariance_pairs(s, d):
    c = rel.covariances(table(s, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return c.select("x", "y", F.round("covariance", 6).alias("covariance"))


def standard_columns(s, d):
    z = rel.standardised(table(s, d, "part").select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return z.select("p_partkey", F.round("p_size", 6).alias("p_size"), F.round("p_retailprice", 6).alias("p_retailprice"))


def gaussian_full(s, d):
    """Log density of order lines under a normal distribution with full covariance."""
    g = fits.gaussian_density(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    return g.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.round("log_density", 4).alias("log_density"))


def _cells(s, d) -> DataFrame:
    return table(s, d, "lineitem").groupBy((F.col("l_suppkey") % 40).cast("bigint").alias("i"), (F.col("l_partkey") % 30).cast("bigint").alias("j")).agg(F.sum("l_linenumber").cast("bigint").alias("v"))


def matrix_square(s, d):
    """A matrix of order lines by supplier and part, times its transpose."""
    return rel.matrix_product(_cells(s, d), rel.transposed(_cells(s, d)))


def rows_beside(s, d):
    """Nations and regions side by side by their places in order of name."""
    n, r = table(s, d, "nation").select("n_name"), table(s, d, "region").select("r_name")
    return rel.beside(n, r, [F.col("n_name")], [F.col("r_name")]).select(F.col("place").cast("bigint").alias("place"), "n_name", "r_name")


def merged_folders(s, d):
    """Lines of customers and orders merged by their key fields."""
    c = table(s, d, "customer").select(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("line"))
    o = table(s, d, "orders").select(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus").alias("line"))
    return rel.merged_lines(c, o, "line", ([1], [2]), ([3], [1, 3]), "|")


def registered_sql(s, d):
    """Functions registered by name and called from SQL, one per row and one by batches."""
    actions.register(s, "initials", lambda t: None if t is None else "".join(w[0] for w in t.split()), "string")
    actions.register(s, "doubled", lambda x: x * 2, "double", batched=True)
    table(s, d, "part").createOrReplaceTempView("part_of_registered_sql")
    return s.sql("select p_partkey, initials(p_name) as initials, doubled(p_retailprice) as doubled from part_of_registered_sql")


def _tail(part, frames):
    n, low = 0, None
    for f in frames:
        n, low = n + len(f), f["o_orderkey"].min() if low is None else min(low, f["o_orderkey"].min())
    if n:
        yield pd.DataFrame({"rows": [n], "low": [low]})


def per_partition_sums(s, d):
    """Each partition's rows and least key, made one by SQL's own measure: their sum and least."""
    p = actions.per_partition(table(s, d, "orders").select("o_orderkey"), _tail, "rows bigint, low bigint")
    return p.agg(F.sum("rows").alias("n"), F.min("low").alias("low"))


def observed_counts(s, d):
    """Counters and a histogram filled while the table was read for something else."""
    o, seen = actions.counted(table(s, d, "orders"), open=F.count_if(F.col("o_orderstatus") == "O"), sizes=actions.histogram(F.col("o_totalprice"), [50_000, 100_000, 200_000]))
    o.groupBy("o_custkey").agg(F.max("o_totalprice")).write.format("noop").mode("overwrite").save()
    got = seen.get
    return s.createDataFrame([("open", got["open"]), *[(f"size{i}", n) for i, n in enumerate(got["sizes"])]], "what string, n bigint")


def small_map(s, d):
    """Nations as a map on the driver, its use as a lookup."""
    names = actions.collect_map(table(s, d, "nation"), "n_nationkey", "n_name")
    return table(s, d, "customer").groupBy(fn.labelled(F.col("c_nationkey"), names, "none").alias("nation")).agg(F.count(F.lit(1)).alias("n"))


def kept_twice(s, d):
    """A result kept over two uses."""
    with actions.kept(table(s, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))) as g:
        most = g.agg(F.max("n")).first()[0]
        return s.createDataFrame([(most, g.where(F.col("n") == most).count())], "most bigint, customers bigint")


def piped_lines(s, d):
    """Lines through an outside program, batch by batch."""
    return actions.piped(table(s, d, "nation").select("n_name"), "n_name", ["tr", "A-Z", "a-z"])


def shifted_labels(s, d):
    """Order years from 0 on, as regression labels."""
    y = table(s, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    return y.select("o_orderkey", (F.col("y") - F.lit(y.agg(F.min("y")).first()[0])).cast("bigint").alias("label"))


def one_variable_fit(s, d):
    """Slope and intercept of price on quantity, where gradients end."""
    rows = table(s, d, "lineitem").select(F.array(F.lit(1.0), (F.col("l_quantity") / 50).cast("double")).alias("x"), (F.col("l_extendedprice") / 100_000).cast("double").alias("label"))
    w, _ = fits.conjugate_gradient(fits.quadratic_loss(rows, size=2), np.zeros(2), 500, 1e-12)
    return s.createDataFrame([(round(float(w[1]) * 2000, 2), round(float(w[0]) * 100_000, 1))], "slope double, intercept double")


def chi_square_counts(s, d):
    """Pearson's statistic of line number against return, from the contingency table."""
    hit = (F.col("l_returnflag") == "R").cast("bigint")
    c = table(s, d, "lineitem").groupBy("l_linenumber").agg(F.sum(hit).alias("o1"), F.sum(1 - hit).alias("o0"))
    b1, b0 = (float(x or 0) for x in c.agg(F.sum("o1"), F.sum("o0")).first())
    part = lambda o, b: F.try_divide(F.pow(F.col(o) - (F.col("o1") + F.col("o0")) * F.lit(b / max(b1 + b0, 1)), 2), (F.col("o1") + F.col("o0")) * F.lit(b / max(b1 + b0, 1)))
    return c.agg(F.round(F.sum(part("o1", b1) + part("o0", b0)), 6).alias("statistic"))


def _best_two(frames):
    """The first two rows of each brand, as they come sorted; only the brand and its count are kept from frame to frame."""
    brand, seen = None, 0
    for f in frames:
        take = []
        for b, k, size in f.itertuples(index=False):
            seen = seen + 1 if b == brand else 1
            brand = b
            if seen <= 2:
                take.append((b, k, size, seen))
        yield pd.DataFrame(take, columns=["p_brand", "p_partkey", "p_size", "place"])


def secondary_sort(s, d):
    """The two largest parts of each brand from a stream sorted by brand and size."""
    p = table(s, d, "part").select("p_brand", F.col("p_partkey").cast("bigint").alias("p_partkey"), F.col("p_size").cast("bigint").alias("p_size"))
    return rel.streamed_sorted(p, ["p_brand"], [F.desc("p_size"), F.col("p_partkey")], _best_two, "p_brand string, p_partkey bigint, p_size bigint, place bigint")


def spread_by_udaf(s, d):
    """Interquartile range of monthly order totals by priority, by an aggregate function of one's own."""
    from pyspark.sql import types as T

    @F.pandas_udf(T.DoubleType())
    def middle_range(x: pd.Series) -> float:
        return float(x.quantile(0.75) - x.quantile(0.25))

    monthly = table(s, d, "orders").groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("month")).agg(F.sum("o_totalprice").alias("v"))  # one row a month: groups stay small
    return monthly.groupBy("o_orderpriority").agg(F.round(middle_range("v"), 2).alias("spread"))


QUERIES = {f.__name__: f for f in (record_lines, text_forms, unicode_forms, number_forms, polar_points, kernel_values, covariance_pairs, standard_columns, gaussian_full, matrix_square, rows_beside, merged_folders, registered_sql, per_partition_sums, observed_counts, small_map, kept_twice, piped_lines, shifted_labels, one_variable_fit, chi_square_counts, secondary_sort, spread_by_udaf)}

_CELLS = "c as (select (l_suppkey % 40)::bigint as i, (l_partkey % 30)::bigint as j, sum(l_linenumber)::bigint as v from lineitem group by 1, 2)"
SQL = {
    "record_lines": "select 1 as status, count(*)::bigint as n, count(distinct (p_brand, p_type))::bigint as kinds, sum(p_size)::bigint as size from part union all select 0, 1, 0, null union all select -1, 2, 0, null",
    "text_forms": "select p_partkey, concat(p_name, 's') as many, replace(replace(concat('''', p_brand, '\"'), '''', ''), '\"', '') as bare, regexp_replace(p_type, '[^A-Za-z0-9]+', '-', 'g') as kept, len(string_split(concat(p_brand, ',', p_type), ','))::bigint as items, replace(replace(p_brand, '#', ''), '-', '') as dashless, trim(concat('  ', p_brand, ' ')) as trimmed from part",
    "unicode_forms": "select article_id, true as ascii, true as same from articles_half_a where title is not null",
    "number_forms": "select o_orderkey, round(case when o_orderkey % 3 = 0 then 0 else o_totalprice / (o_orderkey % 3) end, 4) as ratio, round(1 / (1 + exp(-greatest(-20, least(20, o_orderkey % 50 - 25)))), 8) as squashed, ('0x' || substr(md5(o_orderkey::varchar), 1, 15))::bigint % 97 as bucket, (case o_orderstatus when 'F' then 0 when 'O' then 1 else -1 end)::bigint as label from orders",
    "polar_points": "with p as (select p_partkey, (p_size - 25)::double as x, (p_partkey % 21 - 10)::double as y from part), a as (select *, case when degrees(atan2(y, x)) < 0 then degrees(atan2(y, x)) + 360 else degrees(atan2(y, x)) end as angle from p) select p_partkey, round(sqrt(x * x + y * y), 6) as length, round(angle, 6) as angle, round(greatest(0, least(1, abs(angle / 60 - 3) - 1)), 6) as red from a",
    "kernel_values": "select p_partkey, round(exp(-(pow(p_size / 10 - 2, 2) + pow(p_retailprice / 1000 - 1, 2)) / (2 * 1.5 * 1.5)), 8) as kernel, round(p_size / 10 + p_retailprice / 1000 + p_size / 10 * p_size / 10 + 2 * (p_size / 10) * (p_retailprice / 1000) + pow(p_retailprice / 1000, 2), 6) as products from part",
    "covariance_pairs": " union all ".join(f"select '{a}' as x, '{b}' as y, round(covar_pop({a}, {b}), 6) as covariance from lineitem" for a, b in (("l_quantity", "l_quantity"), ("l_quantity", "l_discount"), ("l_quantity", "l_tax"), ("l_discount", "l_discount"), ("l_discount", "l_tax"), ("l_tax", "l_tax"))),
    "standard_columns": "with m as (select avg(p_size) as ms, stddev_pop(p_size) as ss, avg(p_retailprice) as mp, stddev_pop(p_retailprice) as sp from part) select p_partkey, round((p_size - ms) / ss, 6) as p_size, round((p_retailprice - mp) / sp, 6) as p_retailprice from part, m",
    "gaussian_full": "with m as (select avg(l_quantity) as mx, avg(l_extendedprice) as my, var_pop(l_quantity) as a, var_pop(l_extendedprice) as c, covar_pop(l_quantity, l_extendedprice) as b from lineitem) select l_orderkey, l_linenumber::bigint as l_linenumber, round(-0.5 * (c * pow(l_quantity - mx, 2) - 2 * b * (l_quantity - mx) * (l_extendedprice - my) + a * pow(l_extendedprice - my, 2)) / (a * c - b * b) - ln(2 * pi()) - 0.5 * ln(a * c - b * b), 4) as log_density from lineitem, m",
    "matrix_square": f"with {_CELLS} select a.i as i, b.i as j, sum(a.v * b.v)::bigint as v from c a join c b on a.j = b.j group by 1, 2",
    "rows_beside": "with n as (select n_name, row_number() over (order by n_name) - 1 as place from nation), r as (select r_name, row_number() over (order by r_name) - 1 as place from region) select coalesce(n.place, r.place)::bigint as place, n_name, r_name from n full join r on n.place = r.place",
    "merged_folders": "select concat_ws('|', c_custkey, c_mktsegment, o_orderkey, o_orderstatus) as line from customer join orders on c_custkey = o_custkey",
    "registered_sql": "select p_partkey, array_to_string(list_transform(list_filter(string_split(p_name, ' '), lambda w: w <> ''), lambda w: w[1]), '') as initials, p_retailprice * 2 as doubled from part",
    "per_partition_sums": "select count(*)::bigint as n, min(o_orderkey)::bigint as low from orders",
    "observed_counts": "select 'open' as what, (count(*) filter (o_orderstatus = 'O'))::bigint as n from orders union all select 'size0', count(*) filter (o_totalprice < 50000) from orders union all select 'size1', count(*) filter (o_totalprice >= 50000 and o_totalprice < 100000) from orders union all select 'size2', count(*) filter (o_totalprice >= 100000 and o_totalprice < 200000) from orders union all select 'size3', count(*) filter (o_totalprice >= 200000) from orders",
    "small_map": "select n_name as nation, count(*)::bigint as n from customer join nation on c_nationkey = n_nationkey group by 1",
    "kept_twice": "with g as (select o_custkey, count(*) as n from orders group by 1) select max(n)::bigint as most, (select count(*) from g where n = (select max(n) from g))::bigint as customers from g",
    "secondary_sort": "select * from (select p_brand, p_partkey::bigint as p_partkey, p_size::bigint as p_size, (row_number() over (partition by p_brand order by p_size desc, p_partkey))::bigint as place from part) where place <= 2",
    "spread_by_udaf": "with m as (select o_orderpriority, date_trunc('month', o_orderdate) as month, sum(o_totalprice) as v from orders group by 1, 2) select o_orderpriority, round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 2) as spread from m group by 1",
    "piped_lines": "select lower(n_name) as line from nation",
    "shifted_labels": "select o_orderkey, (year(o_orderdate) - (select min(year(o_orderdate)) from orders))::bigint as label from orders",
    "one_variable_fit": "select round(regr_slope(l_extendedprice, l_quantity), 2) as slope, round(regr_intercept(l_extendedprice, l_quantity), 1) as intercept from lineitem",
    "chi_square_counts": "with c as (select l_linenumber, l_returnflag = 'R' as r, count(*) as o from lineitem group by 1, 2), a as (select l_linenumber, sum(o) as a from c group by 1), b as (select r, sum(o) as b from c group by 1), n as (select sum(o)::double as n from c) select round(sum(pow(coalesce(o, 0) - a * b / n, 2) / (a * b / n)), 6) as statistic from a, b, n left join c on c.l_linenumber = a.l_linenumber and c.r = b.r",
}
