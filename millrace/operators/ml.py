"""Models and statistics on MLlib, and what it lacks. Every fit is deterministic for a given seed."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, FeatureHasher, OneHotEncoder, PolynomialExpansion, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import ChiSquareTest, Correlation, Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window, functions as F

SEED = 42


def with_vector(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(array, lambda x: x.cast("double"))))


def assembled(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns as one vector; rows with a null among them are left out."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="skip").transform(df)


def baseline_rmse(df: DataFrame, label: str) -> DataFrame:
    """The mean label and the error of guessing it."""
    return df.agg(F.avg(label).alias("mean"), F.stddev_pop(label).alias("rmse"))


def gradient_descent(df: DataFrame, features: Sequence[str], label: str, iterations: int = 50, alpha: float = 1.0) -> tuple[list[float], list[float]]:
    """Full-batch linear regression with step ``alpha / (n sqrt(i))``: weights, and the error before each step.

    One aggregate of the table serves all iterations: the normal sums hold everything that a gradient needs.
    """
    x = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    sums = [F.sum(a * b) for i, a in enumerate(x) for b in x[i:]] + [F.sum(a * y) for a in x] + [F.sum(y * y), F.count(y)]
    r = [float(v or 0) for v in df.dropna(subset=[*features, label]).agg(*sums).first()]
    k = len(x)
    gram = np.zeros((k, k))
    it = iter(r)
    for i in range(k):
        for j in range(i, k):
            gram[i, j] = gram[j, i] = next(it)
    xy = np.array([next(it) for _ in range(k)])
    yy, n = next(it), next(it)
    w, errors = np.zeros(k), []
    for i in range(1, iterations + 1):
        errors.append(math.sqrt(max((w @ gram @ w - 2 * w @ xy + yy) / max(n, 1), 0)))
        w = w - alpha / (n * math.sqrt(i)) * (gram @ w - xy)
    return w.tolist(), errors


def linear_grid(train: DataFrame, test: DataFrame, regs: Sequence[float], label: str = "label") -> list[tuple[float, float, float]]:
    """(regularisation, error on train, error on test) of each."""
    e = RegressionEvaluator(labelCol=label, metricName="rmse")
    fits = [(r, LinearRegression(labelCol=label, regParam=r, solver="normal").fit(train)) for r in regs]
    return [(r, e.evaluate(m.transform(train)), e.evaluate(m.transform(test))) for r, m in fits]


def one_hot(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Categories as one sparse vector; values not seen count as none."""
    idx = [f"_{c}_i" for c in columns]
    stages = [StringIndexer(inputCols=list(columns), outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc"), OneHotEncoder(inputCols=idx, outputCols=[f"_{c}_v" for c in columns]), VectorAssembler(inputCols=[f"_{c}_v" for c in columns], outputCol=out)]
    return Pipeline(stages=stages).fit(df).transform(df).drop(*idx, *[f"_{c}_v" for c in columns])


def one_hot_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, index``: every (feature, value) pair with its place in the vector, by feature and value."""
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    p = df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").distinct()
    w = Window.partitionBy("feature").orderBy("value")
    sizes = p.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("off", F.coalesce(F.sum("n").over(Window.orderBy("feature").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("feature", "off")  # a row a feature
    return p.join(before, "feature").select("feature", "value", (F.col("off") + F.row_number().over(w) - 1).alias("index"))


def hashed_buckets(values: Column, buckets: int) -> Column:
    """Feature hashing in the JVM: counts per bucket of ``index:value`` texts (a map)."""
    keys = F.transform(values, lambda v, i: F.pmod(F.xxhash64(F.concat_ws(":", i.cast("string"), v)), F.lit(buckets)))
    ks = F.array_distinct(keys)
    return F.map_from_arrays(ks, F.transform(ks, lambda k: F.size(F.filter(keys, lambda x: x == k))))


def md5_buckets(texts: pd.Series, buckets: int) -> pd.Series:
    """``md5(value + str(index)) mod buckets`` of ``value<TAB>index`` texts."""
    import hashlib

    return texts.map(lambda t: int(hashlib.md5(t.replace("\t", "").encode()).hexdigest(), 16) % buckets)


def logistic(df: DataFrame, label: str = "label", reg: float = 0.0, iterations: int = 50):
    return LogisticRegression(labelCol=label, regParam=reg, maxIter=iterations).fit(df)


def logistic_report(df: DataFrame, label: str = "label", reg: float = 0.0) -> dict[str, float]:
    """Log loss, training error and area under the curve of a fit on ``df``."""
    from millrace.functions.scalar import log_loss

    m = logistic(df, label, reg)
    p = m.transform(df).withColumn("p", vector_to_array("probability")[1])
    r = p.agg(F.avg(log_loss(F.col("p"), F.col(label))).alias("loss"), F.avg((F.col("prediction") != F.col(label)).cast("double")).alias("error")).first()
    return {"loss": r["loss"], "error": r["error"], "auc": BinaryClassificationEvaluator(labelCol=label).evaluate(p)}


def principal(df: DataFrame, k: int, features: str = "features"):
    """PCA model; its projection is of the vectors as they are, not centred."""
    return PCA(k=k, inputCol=features, outputCol="scores").fit(df)


def recovered(scores: np.ndarray, components: np.ndarray) -> np.ndarray:
    """Vectors back from their scores."""
    return scores @ components.T


def kmeans(df: DataFrame, k: int, features: str = "features", init: str = "k-means||"):
    return KMeans(k=k, seed=SEED, featuresCol=features, initMode=init).fit(df)


def silhouettes(df: DataFrame, ks: Sequence[int], features: str = "features") -> list[tuple[int, float]]:
    e = ClusteringEvaluator(featuresCol=features)
    return [(k, e.evaluate(kmeans(df, k, features).transform(df))) for k in ks]


def gaussian_anomaly(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``log_density``: the sum of the columns' log normal densities with their own mean and population variance; columns without spread add nothing."""
    stats = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("v", F.var_pop))]).first()
    parts = [-(F.pow(F.col(c) - F.lit(stats[f"m_{c}"]), 2) / F.lit(2 * stats[f"v_{c}"])) - F.lit(0.5 * math.log(2 * math.pi * stats[f"v_{c}"])) for c in columns if stats[f"v_{c}"]]
    total = F.lit(0.0)
    for p in parts:
        total = total + p
    return df.withColumn("log_density", total)


def best_threshold(df: DataFrame, score: str, label: str, steps: int = 1000) -> tuple[float, float]:
    """(threshold, F1) of the best of ``steps`` thresholds; rows with a score below it are called positive. One histogram decides."""
    lo, hi = df.agg(F.min(score), F.max(score)).first()
    if lo is None or hi == lo:
        return (lo or 0.0), 0.0
    width = (hi - lo) / steps
    h = df.groupBy(F.least(F.floor((F.col(score) - lo) / width), F.lit(steps - 1)).alias("b")).agg(F.sum(F.col(label).cast("bigint")).alias("p"), F.count(F.lit(1)).alias("n")).orderBy("b").collect()  # at most `steps` rows
    positives = sum(r["p"] for r in h)
    best, tp, n = (lo, 0.0), 0, 0
    for r in h:
        tp, n = tp + r["p"], n + r["n"]
        f1 = 2 * tp / (n + positives) if n + positives else 0.0
        if f1 > best[1]:
            best = (lo + (r["b"] + 1) * width, f1)
    return best


def als(ratings: DataFrame, rank: int, user: str = "user", item: str = "item", rating: str = "rating", reg: float = 0.1, iterations: int = 5):
    return ALS(rank=rank, maxIter=iterations, regParam=reg, userCol=user, itemCol=item, ratingCol=rating, seed=SEED, coldStartStrategy="drop").fit(ratings)


def als_errors(train: DataFrame, test: DataFrame, ranks: Sequence[int], **cols: str) -> list[tuple[int, float]]:
    e = RegressionEvaluator(labelCol=cols.get("rating", "rating"), metricName="rmse")
    return [(r, e.evaluate(als(train, r, **cols).transform(test))) for r in ranks]


def average_ratings(ratings: DataFrame, item: str, rating: str, least: int, n: int) -> DataFrame:
    """The ``n`` best rated items with more than ``least`` ratings, by average to 3 places, then item, both descending."""
    g = ratings.groupBy(item).agg(F.count(rating).alias("n"), F.round(F.avg(rating), 3).alias("average")).where(F.col("n") > least)
    return g.orderBy(F.desc("average"), F.desc(item)).limit(n)


def centred_ratings(ratings: DataFrame, item: str, rating: str) -> DataFrame:
    """Ratings less their item's mean."""
    m = ratings.groupBy(item).agg(F.avg(rating).alias("_m"))
    return ratings.join(m, item).withColumn("centred", F.col(rating) - F.col("_m")).drop("_m")


def classify(train: DataFrame, test: DataFrame, kind: str, label: str = "label", layers: Sequence[int] = ()) -> dict[str, float]:
    """Accuracy and F1 on ``test`` of a model: ``logistic, svm, forest, boosted, one_vs_rest, network``."""
    models = {
        "logistic": lambda: LogisticRegression(labelCol=label),
        "svm": lambda: LinearSVC(labelCol=label),
        "forest": lambda: RandomForestClassifier(labelCol=label, seed=SEED, numTrees=20),
        "boosted": lambda: GBTClassifier(labelCol=label, seed=SEED, maxIter=10),
        "one_vs_rest": lambda: OneVsRest(classifier=LogisticRegression(labelCol=label), labelCol=label),
        "network": lambda: MultilayerPerceptronClassifier(labelCol=label, layers=list(layers), seed=SEED, maxIter=50),
    }
    p = models[kind]().fit(train).transform(test)
    return {m: MulticlassClassificationEvaluator(labelCol=label, metricName=m).evaluate(p) for m in ("accuracy", "f1")}


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def cross_validated(df: DataFrame, regs: Sequence[float], folds: int = 5, label: str = "label") -> list[tuple[float, float]]:
    """(regularisation, mean area under the curve over the folds) of logistic models."""
    lr = LogisticRegression(labelCol=label)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(regs)).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=label), numFolds=folds, seed=SEED)
    return list(zip(regs, cv.fit(df).avgMetrics, strict=True))


def boosted_regression(train: DataFrame, test: DataFrame, label: str = "label") -> tuple[float, list[float]]:
    """(root mean square percentage error on ``test``, importances); fitted on ``log1p`` of the label, zero labels aside."""
    m = GBTRegressor(labelCol="_log", seed=SEED, maxIter=10).fit(train.where(F.col(label) > 0).withColumn("_log", F.log1p(label)))
    p = m.transform(test.where(F.col(label) > 0)).withColumn("_e", (F.expm1("prediction") - F.col(label)) / F.col(label))
    return p.agg(F.sqrt(F.avg(F.col("_e") * F.col("_e")))).first()[0], m.featureImportances.toArray().tolist()


def eliminated(df: DataFrame, columns: Sequence[str], keep: int, label: str = "label") -> list[str]:
    """The ``keep`` columns left after dropping, again and again, the one of least weight in a standardised logistic fit."""
    left = list(columns)
    while len(left) > keep:
        d = StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(a := assembled(df, left)).transform(a)
        w = LogisticRegression(labelCol=label, featuresCol="scaled").fit(d).coefficients.toArray()
        left.pop(int(np.argmin(np.abs(w))))
    return left


def nearest_neighbours(train: DataFrame, test: DataFrame, k: int = 5, train_block: int = 2048) -> DataFrame:
    """``id, prediction`` by the labels of the ``k`` nearest of a bounded training set (``id, vector array, label``).

    The training set goes to every task and must have at most 100,000 rows; test rows stay where they are. Rough distances
    pick the candidates, exact ones rank them, whatever the size; ties go to the least ids, then to the least label. An
    empty training set gives no rows.
    """
    from millrace.plans.bounds import collect_bounded

    rows = collect_bounded(train.select("id", "vector", "label").orderBy("id"), 100_000, "training set")
    m = np.array([r["vector"] for r in rows], float)
    ids, labels = np.array([r["id"] for r in rows]), np.array([r["label"] for r in rows])
    if not rows:
        return test.select("id", F.lit(None).cast("bigint").alias("prediction")).where("false")
    squares = (m**2).sum(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.vstack(b["vector"].to_numpy()).astype(float)
            out = []
            for lo in range(0, len(x), train_block):
                part = x[lo : lo + train_block]
                rough = (part**2).sum(1)[:, None] + squares[None] - 2 * part @ m.T
                last = np.partition(rough, min(k, len(m)) - 1, axis=1)[:, min(k, len(m)) - 1]
                slack = 1e-9 * (1 + squares.max() + (part**2).sum(1))  # more than the rough distances can be off by
                for v, r, t in zip(part, rough, last + slack, strict=True):
                    near = np.flatnonzero(r <= t)
                    exact = np.round(((m[near] - v) ** 2).sum(1), 9)
                    own = near[np.lexsort((ids[near], exact))[:k]]
                    value, count = np.unique(labels[own], return_counts=True)
                    out.append(int(value[np.argmax(count)]))
            yield pd.DataFrame({"id": b["id"], "prediction": out})

    return test.select("id", "vector").mapInPandas(run, "id bigint, prediction bigint")


def kaplan_meier(df: DataFrame, duration: str, event: str, group: str | None = None) -> DataFrame:
    """``[group,] time, at_risk, deaths, survival`` at each time of an event; 0 once everyone at risk is gone.

    Rows are combined by time first, so a group's windows hold its distinct times.
    """
    keys = [group] if group else []
    g = df.where(F.col(duration).isNotNull() & F.col(event).isNotNull()).groupBy(*keys, F.col(duration).cast("double").alias("time")).agg(F.sum(F.col(event).cast("bigint")).alias("deaths"), F.count(F.lit(1)).alias("leave"))
    part = Window.partitionBy(*keys)
    w = part.orderBy("time")
    g = g.withColumn("at_risk", F.sum("leave").over(part) - F.coalesce(F.sum("leave").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    gone = F.max((F.col("deaths") == F.col("at_risk")).cast("int")).over(w)
    step = F.when(F.col("deaths") < F.col("at_risk"), F.log(1 - F.col("deaths") / F.col("at_risk"))).otherwise(0.0)
    g = g.withColumn("survival", F.when(gone == 1, 0.0).otherwise(F.exp(F.sum(step).over(w))))
    return g.where("deaths > 0").select(*keys, "time", "at_risk", "deaths", "survival")


def median_survival(curve: DataFrame, group: str | None = None) -> DataFrame:
    """The first time at which no more than half survive."""
    g = curve.where("survival <= 0.5 + 1e-12")
    return (g.groupBy(group) if group else g.groupBy()).agg(F.min("time").alias("median"))


def log_rank(df: DataFrame, duration: str, event: str, group: str, first: object) -> tuple[float, float]:
    """(chi square, p value) of two groups, ``first`` against the rest."""
    d = df.where(F.col(duration).isNotNull() & F.col(event).isNotNull() & F.col(group).isNotNull()).withColumn("_a", (F.col(group) == first).cast("bigint"))
    g = d.groupBy(F.col(duration).alias("t")).agg(F.sum(F.col(event).cast("bigint")).alias("d"), F.sum(F.col(event).cast("bigint") * F.col("_a")).alias("d1"), F.count(F.lit(1)).alias("n"), F.sum("_a").alias("n1"))
    left = Window.orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row a time
    r = g.withColumns({"r": F.sum("n").over(left), "r1": F.sum("n1").over(left)}).where("d > 0")
    e1 = F.col("d") * F.col("r1") / F.col("r")
    v = F.when(F.col("r") > 1, e1 * (1 - F.col("r1") / F.col("r")) * (F.col("r") - F.col("d")) / (F.col("r") - 1)).otherwise(0.0)
    o, e, var = r.agg(F.sum("d1"), F.sum(e1), F.sum(v)).first()
    chi = (o - e) ** 2 / var if var else 0.0
    return chi, math.erfc(math.sqrt(chi / 2))


def correlation_matrix(df: DataFrame, features: str = "features") -> np.ndarray:
    return Correlation.corr(df, features).first()[0].toArray()


def chi_square(df: DataFrame, features: str, label: str) -> tuple[list[float], list[float]]:
    """(statistics, p values) of each feature's independence of the label."""
    r = ChiSquareTest.test(df, features, label).first()
    return r["statistics"].toArray().tolist(), r["pValues"].toArray().tolist()


def summary(df: DataFrame, features: str = "features") -> DataFrame:
    return df.select(Summarizer.metrics("count", "mean", "variance", "min", "max").summary(F.col(features)).alias("s")).select("s.*")


def polynomial(df: DataFrame, degree: int, features: str = "features") -> DataFrame:
    return PolynomialExpansion(degree=degree, inputCol=features, outputCol="expanded").transform(df)


def hashed_features(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    return FeatureHasher(inputCols=list(columns), outputCol="features", numFeatures=buckets).transform(df)


def random_rows(spark, n: int, seed: int = SEED) -> DataFrame:
    """``id, uniform, normal``: seeded random columns."""
    return spark.range(n).select("id", F.rand(seed).alias("uniform"), F.randn(seed).alias("normal"))


def t_p_value(t: float, df: int) -> float:
    """Two-sided p value of Student's t by the incomplete beta function's continued fraction."""
    x = df / (df + t * t)
    a, b = df / 2, 0.5
    if x <= 0 or x >= 1:
        return 1.0 if x >= 1 else 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x))

    def fraction(a: float, b: float, x: float) -> float:
        tiny = 1e-300
        c, d = 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 300):
            for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 + k * d
                d = 1 / (d if abs(d) > tiny else tiny)
                c = 1 + k / (c if abs(c) > tiny else tiny)
                h *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        return h

    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b
