"""Fits by gradients over the whole table, kernels over landmarks, and what follows from a fit."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

SEED = 42


def _sums(batches: Iterator[pa.RecordBatch], w: np.ndarray, kind: str) -> Iterator[pa.RecordBatch]:
    grad, loss, n = np.zeros(w.shape), np.zeros(len(w)), 0
    for b in batches:
        if not b.num_rows:
            continue
        x = np.stack(b.column(0).to_numpy(zero_copy_only=False))
        y = b.column(1).to_numpy(zero_copy_only=False)[:, None]
        z = x @ w.T
        if kind == "linear":
            off = z - y
            loss += (off**2).sum(axis=0) / 2
        else:
            off = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            loss += (np.logaddexp(0, z) - y * z).sum(axis=0)
        grad += off.T @ x
        n += len(y)
    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate((loss, grad.ravel())).tolist()]), pa.array([n], pa.int64())], names=["sums", "n"])


def losses_and_gradients(df: DataFrame, w: np.ndarray, kind: str, array: str = "x", label: str = "label") -> tuple[np.ndarray, np.ndarray]:
    """Mean loss (``linear``: half the squared error, ``logistic``: the log loss) and its gradient for each row of weights, in one pass; a partition gives one row of sums."""
    rows = df.select(array, F.col(label).cast("double")).mapInArrow(lambda b: _sums(b, w, kind), "sums array<double>, n bigint")
    got = rows.select("n", F.posexplode("sums")).groupBy("pos").agg(F.sum("col"), F.sum("n")).orderBy("pos").collect()  # a row for each sum
    if not got:
        return np.zeros(len(w)), np.zeros(w.shape)
    flat = np.array([r[1] for r in got]) / max(got[0][2], 1)
    return flat[: len(w)], flat[len(w) :].reshape(w.shape)


def loss_and_gradient(df: DataFrame, w: np.ndarray, kind: str, reg: float = 0.0, array: str = "x", label: str = "label") -> tuple[float, np.ndarray]:
    """The same for one vector of weights, plus ``reg / 2 |w|^2``."""
    loss, grad = losses_and_gradients(df, w[None], kind, array, label)
    return float(loss[0]) + reg / 2 * float(w @ w), grad[0] + reg * w


def quadratic_loss(df: DataFrame, array: str = "x", label: str = "label", size: int = 1) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    """Half the mean squared error of a linear fit and its gradient, as a function of the weights: the table is read once, its sums serve every call."""
    x, y = [F.col(array)[i].cast("double") for i in range(size)], F.col(label).cast("double")
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    got = df.agg(F.count(y), F.sum(y * y), *[F.sum(a * y) for a in x], *[F.sum(x[i] * x[j]) for i, j in pairs]).first()
    n, yy = max(got[0] or 0, 1), got[1] or 0.0
    xy, gram = np.array([v or 0.0 for v in got[2 : 2 + size]]), np.zeros((size, size))
    for (i, j), v in zip(pairs, got[2 + size :], strict=True):
        gram[i, j] = gram[j, i] = v or 0.0
    return lambda w: (float(w @ gram @ w - 2 * w @ xy + yy) / 2 / n, (gram @ w - xy) / n)


def descend(df: DataFrame, kind: str, size: int, alpha: float = 1.0, reg: float = 0.0, iterations: int = 30, fraction: float = 1.0, array: str = "x", label: str = "label") -> tuple[np.ndarray, list[float]]:
    """Gradient descent with step ``alpha / sqrt(i)``, each over a sample of ``fraction`` of the rows (of all at 1): weights and losses."""
    w, losses = np.zeros(size), []
    for i in range(1, iterations + 1):
        rows = df if fraction >= 1 else df.sample(fraction, SEED + i)
        loss, grad = loss_and_gradient(rows, w, kind, reg, array, label)
        losses.append(loss)
        w = w - alpha / math.sqrt(i) * grad
    return w, losses


def grid(train: DataFrame, test: DataFrame, kind: str, size: int, alphas: Sequence[float], regs: Sequence[float], iterations: int = 30, fraction: float = 1.0, array: str = "x", label: str = "label") -> list[tuple[float, float, float, float]]:
    """(alpha, reg, loss on train, loss on test) of a descent for each pair, the losses without the penalty. All pairs take each step in the same pass."""
    pairs = [(a, r) for a in alphas for r in regs]
    alpha, reg = (np.array(x)[:, None] for x in zip(*pairs, strict=True))
    w = np.zeros((len(pairs), size))
    for i in range(1, iterations + 1):
        rows = train if fraction >= 1 else train.sample(fraction, SEED + i)
        w = w - alpha / math.sqrt(i) * (losses_and_gradients(rows, w, kind, array, label)[1] + reg * w)
    ends = [losses_and_gradients(d, w, kind, array, label)[0] for d in (train, test)]
    return [(a, r, float(x), float(y)) for (a, r), x, y in zip(pairs, *ends, strict=True)]


def learning_curve(train: DataFrame, test: DataFrame, kind: str, size: int, key: str, shares: Sequence[float], **how: object) -> list[tuple[float, float, float]]:
    """(share of the training rows, loss on them, loss on test); shares are nested by the hash of ``key``."""
    out = []
    for s in shares:
        part = train.where(F.pmod(F.xxhash64(key), F.lit(10_000)) < int(s * 10_000))
        w, _ = descend(part, kind, size, **how)
        out.append((s, loss_and_gradient(part, w, kind)[0], loss_and_gradient(test, w, kind)[0]))
    return out


def conjugate_gradient(f: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, iterations: int = 50, tolerance: float = 1e-8) -> tuple[np.ndarray, list[float]]:
    """Least value of a smooth function by conjugate gradients with a backtracking line search: where it is, and the values on the way. ``f`` gives value and gradient (of a whole table, say)."""
    x = np.asarray(start, float)
    value, grad = f(x)
    way, values, step = -grad, [value], 1.0
    for _ in range(iterations):
        slope = float(grad @ way)
        if slope >= 0:
            way, slope = -grad, -float(grad @ grad)
        if -slope < tolerance**2:
            break
        step = min(step * 2, 1e6)
        while True:
            nxt, g = f(x + step * way)
            if nxt <= value + 1e-4 * step * slope:
                break
            step /= 2
            if step < 1e-16:
                return x, values
        x = x + step * way
        beta = max(0.0, float(g @ (g - grad)) / max(float(grad @ grad), 1e-300))
        value, grad, way = nxt, g, -g + beta * way
        values.append(value)
    return x, values


def numeric_gradient(f: Callable[[np.ndarray], float], x: np.ndarray, eps: float = 1e-4) -> np.ndarray:
    """The gradient by differences, to check one that is computed."""
    return np.array([(f(x + eps * e) - f(x - eps * e)) / (2 * eps) for e in np.eye(len(x))])


def network_cost(x: np.ndarray, y: np.ndarray, layers: Sequence[np.ndarray], reg: float = 0.0) -> tuple[float, list[np.ndarray]]:
    """Log loss of a network of sigmoid layers (weights with a bias column first) and its gradients by backpropagation; ``y`` has a column a class."""
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    acts, n = [x], len(x)
    for w in layers:
        acts.append(sig(np.hstack([np.ones((n, 1)), acts[-1]]) @ w.T))
    h = np.clip(acts[-1], 1e-15, 1 - 1e-15)
    cost = -float(np.sum(y * np.log(h) + (1 - y) * np.log(1 - h))) / n + reg / (2 * n) * sum(float(np.sum(w[:, 1:] ** 2)) for w in layers)
    grads, delta = [], acts[-1] - y
    for w, a in zip(reversed(layers), reversed(acts[:-1]), strict=True):
        g = delta.T @ np.hstack([np.ones((n, 1)), a]) / n
        g[:, 1:] += reg / n * w[:, 1:]
        grads.append(g)
        delta = (delta @ w[:, 1:]) * a * (1 - a)
    return cost, grads[::-1]


def factor_cost(ratings: DataFrame, users: DataFrame, items: DataFrame, reg: float = 0.0) -> float:
    """Half the squared error of ``ratings`` (user, item, rating) by the factors (``id, features``) of both sides, plus ``reg / 2`` times their squares."""
    u, i = users.toDF("user", "fu"), items.toDF("item", "fi")
    dot = F.aggregate(F.zip_with("fu", "fi", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    off = ratings.join(u, "user").join(i, "item").agg(F.sum(F.pow(dot - F.col("rating"), 2))).first()[0] or 0.0
    square = lambda df, c: df.agg(F.sum(F.aggregate(c, F.lit(0.0), lambda s, v: s + v.cast("double") * v))).first()[0] or 0.0
    return off / 2 + reg / 2 * (square(u, "fu") + square(i, "fi"))


def landmarks(df: DataFrame, key: str, array: str, count: int) -> np.ndarray:
    """``count`` rows' vectors, those with the least hashes of their keys."""
    rows = df.select(F.xxhash64(key).alias("h"), array).orderBy("h").limit(count).collect()
    return np.array([r[1] for r in rows])


def kernel_features(df: DataFrame, array: str, marks: np.ndarray, sigma: float, out: str = "features") -> DataFrame:
    """Vectors whose dot products approach the Gaussian kernel's values, from its values at the landmarks (Nystroem's method)."""
    near = lambda x: np.exp(-((x[:, None, :] - marks[None]) ** 2).sum(axis=2) / (2 * sigma**2))
    value, vector = np.linalg.eigh(near(marks))
    half = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-9))) @ vector.T

    @F.pandas_udf("array<double>")
    def mapped(x: pd.Series) -> pd.Series:
        return pd.Series(list(near(np.stack(x.to_numpy())) @ half))

    return df.withColumn(out, array_to_vector(mapped(F.col(array))))


def kernel_svm_grid(train: DataFrame, test: DataFrame, array: str, key: str, penalties: Sequence[float], sigmas: Sequence[float], count: int = 100, label: str = "label") -> list[tuple[float, float, float]]:
    """(C, sigma, accuracy on test) of a support vector machine with a Gaussian kernel for each pair."""
    e = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    marks = landmarks(train, key, array, count)
    out = []
    for s in sigmas:
        a, b = (kernel_features(d, array, marks, s) for d in (train, test))
        for c in penalties:
            m = LinearSVC(labelCol=label, regParam=1 / c / max(train.count(), 1), maxIter=50).fit(a)
            out.append((c, s, float(e.evaluate(m.transform(b)))))
    return out


def importances(df: DataFrame, columns: Sequence[str], label: str = "label", trees: int = 50) -> list[tuple[str, float]]:
    """Columns by their weight in a forest of strongly randomised trees (one random column a split, no resampling)."""
    from millrace.operators.ml import assembled

    m = RandomForestClassifier(labelCol=label, numTrees=trees, featureSubsetStrategy="1", bootstrap=False, seed=SEED).fit(assembled(df, columns))
    return sorted(zip(columns, m.featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def centred_scores(df: DataFrame, k: int, array: str = "x") -> tuple[DataFrame, np.ndarray, np.ndarray, list[float]]:
    """``df`` with ``scores`` on the ``k`` main axes of the centred vectors; the axes, the centre, and the share of variance of each."""
    v = df.withColumn("_v", array_to_vector(array))
    centre = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(v)
    c = centre.transform(v)
    m = PCA(k=k, inputCol="_c", outputCol="_s").fit(c)
    return m.transform(c).withColumn("scores", vector_to_array("_s")).drop("_v", "_c", "_s"), m.pc.toArray(), centre.mean.toArray(), m.explainedVariance.toArray().tolist()


def from_scores(df: DataFrame, axes: np.ndarray, centre: np.ndarray, out: str = "recovered") -> DataFrame:
    """Vectors back from their scores, as near as the axes allow."""
    row = lambda w, m: F.aggregate(F.zip_with("scores", F.lit([float(x) for x in w]), lambda a, b: a * b), F.lit(float(m)), lambda s, x: s + x)
    return df.withColumn(out, F.array(*[row(w, m) for w, m in zip(axes, centre, strict=True)]))


def compressed(df: DataFrame, k: int, array: str = "x", iterations: int = 20) -> tuple[DataFrame, list[list[float]]]:
    """Each vector (a pixel, say) as the number of one of ``k`` vectors (colours), and those vectors."""
    from millrace.operators.ml import kmeans, with_vector

    v = with_vector(df, array)
    m = kmeans(v, k)
    return m.transform(v).drop("features"), [c.tolist() for c in m.clusterCenters()]


def gaussian_density(df: DataFrame, columns: Sequence[str], out: str = "log_density") -> DataFrame:
    """Log density of each row under the normal distribution with the columns' means and full covariance; null where the covariance has no inverse."""
    from millrace.operators.relational import covariances

    rows = {(r["x"], r["y"]): r["covariance"] for r in covariances(df, columns).collect()}  # one row a pair of columns
    cov = np.array([[rows.get((a, b), rows.get((b, a))) or 0.0 for b in columns] for a in columns])
    mean = [float(x or 0) for x in df.dropna(subset=list(columns)).agg(*[F.avg(c) for c in columns]).first()]
    sign, logdet = np.linalg.slogdet(cov)
    if sign <= 0 or np.linalg.matrix_rank(cov, hermitian=True) < len(cov):
        return df.withColumn(out, F.lit(None).cast("double"))
    inv = np.linalg.inv(cov)
    d = [F.col(c) - F.lit(m) for c, m in zip(columns, mean, strict=True)]
    form = F.lit(0.0)
    for i in range(len(d)):
        for j in range(len(d)):
            form = form + d[i] * d[j] * F.lit(float(inv[i, j]))
    return df.withColumn(out, -0.5 * form - F.lit(0.5 * (len(d) * math.log(2 * math.pi) + logdet)))
