"""Queries of models and statistics. Those with a closed form have SQL; the others are held by tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import scalar as fn
from millrace.operators import fits, ml
from millrace.plans.tables import table


def _points(s: SparkSession, d: str) -> DataFrame:
    return ml.with_vector(table(s, d, "embeddings"), "embedding").withColumn("label", F.col("label").cast("double"))


def _halves(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    h = F.pmod(F.xxhash64(key), F.lit(10))
    return df.where(h < 8), df.where(h >= 8)


def _ratings(s, d) -> DataFrame:
    return table(s, d, "lineitem").groupBy(F.col("l_suppkey").cast("int").alias("item"), (F.col("l_orderkey") % 997).cast("int").alias("user")).agg(F.avg(F.col("l_quantity") / 10).alias("rating"))


def _sales(s, d) -> DataFrame:
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("label"), F.month("o_orderdate").alias("month"), F.dayofweek("o_orderdate").alias("dow"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), F.year("o_orderdate").alias("year"))
    return ml.assembled(o, ["month", "dow", "priority", "year"])


def _frame(s, rows, schema) -> DataFrame:
    return s.createDataFrame(rows, schema)


def km_survival(s, d):
    """Time from an order to its customer's next, per priority; last orders count as censored at 2001-08-01."""
    from pyspark.sql import Window

    o = table(s, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_orderkey")
    w = Window.partitionBy("o_custkey").orderBy("day", "o_orderkey")
    nxt = F.lead("day").over(w)
    t = o.select("o_orderpriority", F.datediff(F.coalesce(nxt, F.to_date(F.lit("2001-08-01"))), "day").alias("time"), nxt.isNotNull().cast("int").alias("event"))
    return ml.kaplan_meier(t, "time", "event", "o_orderpriority").withColumn("survival", F.round("survival", 6))


def gaussian_anomaly(s, d):
    g = ml.gaussian_anomaly(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"), ["l_quantity", "l_discount"])
    return g.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.round("log_density", 5).alias("log_density"))


def baseline_rmse(s, d):
    return ml.baseline_rmse(table(s, d, "orders"), "o_totalprice").select(F.round("mean", 2).alias("mean"), F.round("rmse", 2).alias("rmse"))


def average_ratings(s, d):
    r = ml.average_ratings(table(s, d, "lineitem"), "l_suppkey", "l_quantity", 20, 20)
    return r


def centred_ratings(s, d):
    c = ml.centred_ratings(table(s, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity"), "l_suppkey", "l_quantity")
    return c.groupBy("l_suppkey").agg(F.round(F.sum(F.abs("centred")), 3).alias("spread"))


def one_hot_dictionary(s, d):
    return ml.one_hot_dictionary(table(s, d, "part"), ["p_brand", "p_type"]).select(F.col("feature").cast("bigint").alias("feature"), "value", F.col("index").cast("bigint").alias("index"))


def linear_regression(s, d):
    """The normal equations' weights of price on quantity and discount."""
    train, test = _halves(ml.assembled(table(s, d, "lineitem").withColumnRenamed("l_extendedprice", "label"), ["l_quantity", "l_discount"]), "l_orderkey")
    return _frame(s, [tuple(map(float, r)) for r in ml.linear_grid(train, test, [0.0, 0.1, 1.0])], "reg double, train_rmse double, test_rmse double")


def gradient_descent(s, d):
    li = table(s, d, "lineitem").select((F.col("l_quantity") / 50).alias("q"), F.lit(1.0).alias("one"), (F.col("l_extendedprice") / 100000).alias("y"))
    w, e = ml.gradient_descent(li, ["q", "one"], "y")
    return _frame(s, [(i, x) for i, x in enumerate(e)], "step bigint, rmse double").withColumn("rmse", F.round("rmse", 8))


def logreg_eval(s, d):
    p = _points(s, d).withColumn("label", (F.col("label") > 4).cast("double"))
    return _frame(s, [tuple(ml.logistic_report(p, reg=0.01).values())], "loss double, error double, auc double")


def hashed_ctr(s, d):
    """Clicks against purchases from hashed features."""
    e = table(s, d, "events").where("event_type in ('click', 'purchase')").withColumn("label", (F.col("event_type") == "purchase").cast("double")).withColumn("hour", F.hour("ts").cast("string")).withColumn("who", F.col("user_id").cast("string"))
    return _frame(s, [tuple(ml.logistic_report(ml.hashed_features(e, ["hour", "who"], 256), reg=0.01).values())], "loss double, error double, auc double")


def one_hot_vectors(s, d):
    p = ml.one_hot(table(s, d, "part"), ["p_brand", "p_type"])
    return p.select("p_partkey", F.aggregate(ml.vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("ones"))


def kmeans_clusters(s, d):
    m = ml.kmeans(_points(s, d), 4)
    return m.transform(_points(s, d)).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


def silhouette(s, d):
    return _frame(s, ml.silhouettes(_points(s, d), [2, 3, 4]), "k bigint, silhouette double")


def pca_scores(s, d):
    p = _points(s, d)
    return ml.principal(p, 3).transform(p).select("vec_id", ml.vector_to_array("scores").alias("scores"))


def als_rmse(s, d):
    train, test = _halves(_ratings(s, d), "user")
    train = train.unionByName(test.where(F.pmod(F.xxhash64("item", "user"), F.lit(2)) == 0))
    return _frame(s, ml.als_errors(train, test.where(F.pmod(F.xxhash64("item", "user"), F.lit(2)) == 1), [4, 8]), "rank bigint, rmse double")


def als_recommend(s, d):
    """Three items for every user."""
    return ml.als(_ratings(s, d), 4).recommendForAllUsers(3).select("user", F.explode("recommendations").alias("x")).select("user", "x.item", "x.rating")


def classifiers(s, d):
    p = _points(s, d)
    two = p.withColumn("label", (F.col("label") > 4).cast("double"))
    size = len(p.first()["embedding"])
    train, test = _halves(two, "vec_id")
    mtrain, mtest = _halves(p, "vec_id")
    rows = [(k, *ml.classify(train, test, k).values()) for k in ("logistic", "svm", "forest", "boosted")]
    rows += [("one_vs_rest", *ml.classify(mtrain, mtest, "one_vs_rest").values()), ("network", *ml.classify(mtrain, mtest, "network", layers=[size, 16, 10]).values())]
    return _frame(s, rows, "model string, accuracy double, f1 double")


def knn_predictions(s, d):
    p = _points(s, d).select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"), F.col("label").cast("bigint").alias("label"))
    train, test = _halves(p, "id")
    return ml.nearest_neighbours(train, test)


def cross_validation(s, d):
    p = _points(s, d).withColumn("label", (F.col("label") > 4).cast("double"))
    return _frame(s, [tuple(map(float, x)) for x in ml.cross_validated(p, [0.01, 0.1], 3)], "reg double, auc double")


def gbt_eval(s, d):
    train, test = _halves(_sales(s, d), "id")
    e, imp = ml.boosted_regression(train, test)
    return _frame(s, [("rmspe", float(e)), *[(c, float(x)) for c, x in zip(("month", "dow", "priority", "year"), imp, strict=True)]], "what string, value double")


def feature_elimination(s, d):
    li = table(s, d, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("double"))
    return _frame(s, [(c,) for c in ml.eliminated(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 2)], "feature string")


def chi_square(s, d):
    li = ml.assembled(table(s, d, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("double")), ["l_linenumber"])
    st, p = ml.chi_square(li, "features", "label")
    return _frame(s, [(float(st[0]), float(p[0]))], "statistic double, p double")


def log_rank(s, d):
    o = table(s, d, "lineitem").select(F.col("l_quantity").alias("t"), (F.col("l_linestatus") == "F").cast("int").alias("e"), "l_returnflag")
    chi, p = ml.log_rank(o.where("l_returnflag in ('A', 'R')"), "t", "e", "l_returnflag", "A")
    return _frame(s, [(float(chi), float(p))], "chi_square double, p double")


def _rows_of(p: DataFrame, label) -> DataFrame:
    return p.select("vec_id", F.concat(F.array(F.lit(1.0)), F.transform("embedding", lambda x: x.cast("double"))).alias("x"), label.cast("double").alias("label"))


def _two(s, d) -> tuple[DataFrame, DataFrame, int]:
    e = table(s, d, "embeddings")
    rows = _rows_of(e, F.col("label") > 4)
    return (*_halves(rows, "vec_id"), len(rows.first()["x"]))


def sgd_logistic_grid(s, d):
    """Log loss of logistic fits by gradient steps over samples, by step and penalty."""
    train, test, k = _two(s, d)
    return _frame(s, fits.grid(train, test, "logistic", k, [1.0, 4.0], [0.0, 0.01], iterations=6, fraction=0.5), "alpha double, reg double, train_loss double, test_loss double")


def sgd_linear_grid(s, d):
    """The same for the label as a number: half the mean squared error."""
    e = table(s, d, "embeddings")
    train, test = _halves(_rows_of(e, F.col("label")), "vec_id")
    return _frame(s, fits.grid(train, test, "linear", len(train.first()["x"]), [0.5], [0.0, 0.1], iterations=6), "alpha double, reg double, train_loss double, test_loss double")


def learning_curve(s, d):
    """Log loss on the training rows and on held-out ones, by share of the training rows used."""
    train, test, k = _two(s, d)
    return _frame(s, fits.learning_curve(train, test, "logistic", k, "vec_id", [0.1, 0.5, 1.0], alpha=4.0, iterations=6), "share double, train_loss double, test_loss double")


def kernel_svm(s, d):
    """Accuracy of support vector machines with a Gaussian kernel, by penalty and width."""
    p = table(s, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"), (F.col("label") > 4).cast("double").alias("label"))
    train, test = _halves(p, "vec_id")
    return _frame(s, fits.kernel_svm_grid(train, test, "x", "vec_id", [1.0, 10.0], [1.0], 50), "c double, sigma double, accuracy double")


def tree_importance(s, d):
    """Columns of order lines by their weight for the return flag in strongly randomised trees."""
    li = table(s, d, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("double"))
    return _frame(s, fits.importances(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], trees=10), "feature string, importance double")


def pca_recovered(s, d):
    """Embeddings from three centred scores: how much of the variance is kept, by the axes and by the rebuilt vectors."""
    p = table(s, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    scores, axes, centre, shares = fits.centred_scores(p, 3)
    back = fits.from_scores(scores, axes, centre)
    square = lambda a: F.aggregate(a, F.lit(0.0), lambda t, v: t + v * v)
    mean = F.lit([float(c) for c in centre])
    lost, whole = back.agg(F.sum(square(F.zip_with("x", "recovered", lambda a, b: a - b))), F.sum(square(F.zip_with("x", mean, lambda a, b: a - b)))).first()
    return _frame(s, [(float(sum(shares)), float(1 - lost / whole))], "by_axes double, by_vectors double")


def tile_pca(s, d):
    """Sums over tiles and blocks of each embedding, then their main axes."""
    e = table(s, d, "embeddings").withColumn("e", F.transform("embedding", lambda x: x.cast("double")))
    x = e.select("vec_id", F.concat(fn.tile_sums(F.col("e"), 4), fn.block_sums(F.col("e"), 4)).alias("x"))
    scores, _, _, _ = fits.centred_scores(x, 2)
    return scores.select("vec_id", "scores")


def colour_table(s, d):
    """Embeddings as one of eight vectors: how many each stands for, and its first figures."""
    p = table(s, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    rows, colours = fits.compressed(p, 8)
    of = rows.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))
    return of.join(_frame(s, [(i, c[:3]) for i, c in enumerate(colours)], "prediction int, head array<double>"), "prediction")


def anomaly_threshold(s, d):
    """The density below which order lines are called odd, by the best F against a label."""
    g = ml.gaussian_anomaly(table(s, d, "lineitem").select("l_quantity", "l_discount", (F.col("l_quantity") > 48).cast("int").alias("y")), ["l_quantity", "l_discount"])
    return _frame(s, [ml.best_threshold(g, "log_density", "y")], "threshold double, f1 double")


def correlation_tests(s, d):
    """Pairs of columns with t values and their p values."""
    from millrace.operators.relational import correlation_pairs

    rows = correlation_pairs(table(s, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).collect()  # six rows
    return _frame(s, [(r["x"], r["y"], r["r"], r["t"], ml.t_p_value(r["t"], r["n"] - 2)) for r in rows], "x string, y string, r double, t double, p double")


def hashed_sparsity(s, d):
    """Share of non-zero places in one-hot and in hashed vectors of the events."""
    e = table(s, d, "events").select(F.hour("ts").cast("string").alias("hour"), F.col("user_id").cast("string").alias("who"))
    size = e.agg(F.countDistinct("hour"), F.countDistinct("who")).first()
    hashed = e.select(F.explode(F.map_keys(ml.hashed_buckets(F.array("hour", "who"), 256))).alias("b")).agg(F.countDistinct("b")).first()[0]
    return _frame(s, [("one_hot", 2.0 / max(sum(size), 1)), ("hashed", 2.0 / 256), ("buckets_used", hashed / 256)], "vectors string, share double")


def rating_baseline(s, d):
    """Items of at least 500 ratings, the best 20, and the error of guessing the mean of all."""
    li = table(s, d, "lineitem")
    top = ml.average_ratings(li, "l_suppkey", "l_quantity", 500, 20)
    rmse = li.agg(F.avg("l_quantity").alias("mean"), F.stddev_pop("l_quantity").alias("rmse"))
    return top.select(F.lit("item").alias("kind"), F.col("l_suppkey").cast("bigint").alias("id"), "n", "average").unionByName(rmse.select(F.lit("mean guess").alias("kind"), F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("n"), F.round("rmse", 3).alias("average")))


def log_rank_chi(s, d):
    """The log-rank statistic alone."""
    return log_rank(s, d).select(F.round("chi_square", 6).alias("chi_square"))


QUERIES = {f.__name__: f for f in (km_survival, gaussian_anomaly, baseline_rmse, average_ratings, centred_ratings, one_hot_dictionary, linear_regression, gradient_descent, logreg_eval, hashed_ctr, one_hot_vectors, kmeans_clusters, silhouette, pca_scores, als_rmse, als_recommend, classifiers, knn_predictions, cross_validation, gbt_eval, feature_elimination, chi_square, log_rank, sgd_logistic_grid, sgd_linear_grid, learning_curve, kernel_svm, tree_importance, pca_recovered, tile_pca, colour_table, anomaly_threshold, correlation_tests, hashed_sparsity, rating_baseline, log_rank_chi)}

SQL = {
    "km_survival": "with n as (select o_orderpriority, o_orderdate::date as day, lead(o_orderdate::date) over (partition by o_custkey order by o_orderdate::date, o_orderkey) as nxt from orders), t as (select o_orderpriority, (coalesce(nxt, date '2001-08-01') - day)::double as time, case when nxt is not null then 1 else 0 end as event from n), g as (select o_orderpriority, time, sum(event)::bigint as deaths, count(*) as leave from t group by 1, 2), r as (select *, (sum(leave) over (partition by o_orderpriority) - coalesce(sum(leave) over (partition by o_orderpriority order by time rows between unbounded preceding and 1 preceding), 0))::bigint as at_risk from g), s as (select *, max(case when deaths = at_risk then 1 else 0 end) over w as gone, sum(case when deaths < at_risk then ln(1 - deaths / at_risk::double) else 0 end) over w as l from r window w as (partition by o_orderpriority order by time)) select o_orderpriority, time, at_risk, deaths, round(case when gone = 1 then 0 else exp(l) end, 6) as survival from s where deaths > 0",
    "gaussian_anomaly": "with m as (select avg(l_quantity) as mq, var_pop(l_quantity) as vq, avg(l_discount) as md, var_pop(l_discount) as vd from lineitem) select l_orderkey, l_linenumber::bigint as l_linenumber, round(-pow(l_quantity - mq, 2) / (2 * vq) - 0.5 * ln(2 * pi() * vq) - pow(l_discount - md, 2) / (2 * vd) - 0.5 * ln(2 * pi() * vd), 5) as log_density from lineitem, m",
    "rating_baseline": "with g as (select l_suppkey, count(l_quantity) as n, round(avg(l_quantity), 3) as average from lineitem group by 1 having count(l_quantity) > 500 order by average desc, l_suppkey desc limit 20) select 'item' as kind, l_suppkey::bigint as id, n::bigint as n, average from g union all select 'mean guess', null, null, round(stddev_pop(l_quantity), 3) from lineitem",
    "one_hot_vectors": "select p_partkey, 2.0::double as ones from part",
    "gradient_descent": "with recursive g as (select sum(l_quantity / 50 * l_quantity / 50) as a, sum(l_quantity / 50) as b, count(*)::double as n, sum(l_quantity / 50 * l_extendedprice / 100000) as c, sum(l_extendedprice / 100000) as d, sum(pow(l_extendedprice / 100000, 2)) as e from lineitem), r(i, u, v) as (select 0, 0::double, 0::double union all select i + 1, u - (a * u + b * v - c) / (n * sqrt(i + 1)), v - (b * u + n * v - d) / (n * sqrt(i + 1)) from r, g where i < 49) select i::bigint as step, round(sqrt(greatest((a * u * u + 2 * b * u * v + n * v * v - 2 * (u * c + v * d) + e) / n, 0)), 8) as rmse from r, g",
    "log_rank_chi": "with x as (select l_quantity as t, case when l_linestatus = 'F' then 1 else 0 end as e, l_returnflag = 'A' as a from lineitem where l_returnflag in ('A', 'R')), g as (select t, sum(e) as d, count(*) as n, sum(case when a then e else 0 end) as d1, (count(*) filter (a)) as n1 from x group by t), r as (select t, d, d1, sum(n) over w as r, sum(n1) over w as r1 from g window w as (order by t desc)), v as (select sum(d1) as o, sum(d * r1 / r::double) as e, sum(case when r > 1 then d * r1 / r::double * (1 - r1 / r::double) * (r - d) / (r - 1) else 0 end) as var from r) select round(case when var > 0 then (o - e) * (o - e) / var else 0 end, 6) as chi_square from v",
    "baseline_rmse": "select round(avg(o_totalprice), 2) as mean, round(stddev_pop(o_totalprice), 2) as rmse from orders",
    "average_ratings": "select l_suppkey, count(l_quantity)::bigint as n, round(avg(l_quantity), 3) as average from lineitem group by 1 having count(l_quantity) > 20 order by average desc, l_suppkey desc limit 20",
    "centred_ratings": "with m as (select l_suppkey, avg(l_quantity) as m from lineitem group by 1) select l_suppkey, round(sum(abs(l_quantity - m)), 3) as spread from lineitem join m using (l_suppkey) group by 1",
    "one_hot_dictionary": "with p as (select distinct unnest([0, 1])::bigint as feature, unnest([p_brand, p_type]) as value from part) select feature, value, (row_number() over (order by feature, value) - 1)::bigint as index from p",
}
