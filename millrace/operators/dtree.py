"""Decision trees by gain ratio: one aggregate of the table a level, keyed by node."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame, Window, functions as F


#: Entropies below this are 0 but for rounding.
_ZERO = 1e-12


def to_long(df: DataFrame, features: Sequence[str], label: str, node: str = "node") -> DataFrame:
    """``node, var, value, label``: a row per row and feature."""
    keep = [node] if node in df.columns else []
    pairs = F.array(*[F.struct(F.lit(c).alias("var"), F.col(c).cast("string").alias("value")) for c in features])
    return df.select(*keep, F.col(label).cast("string").alias("label"), F.explode(pairs).alias("p")).select(*(keep or [F.lit("root").alias(node)]), "p.var", "p.value", "label")


def _entropy(df: DataFrame, keys: Sequence[str], count: str, name: str) -> DataFrame:
    """``log2(n) - sum(c log2 c) / n`` per key, with ``n``."""
    c = F.col(count).cast("double")
    g = df.groupBy(*keys).agg(F.sum(count).alias("_n"), F.sum(c * F.log2(c)).alias("_w"))
    return g.select(*keys, F.col("_n").alias(f"n_{name}"), F.greatest(F.log2(F.col("_n").cast("double")) - F.col("_w") / F.col("_n"), F.lit(0.0)).alias(name))


def gain_ratios(long: DataFrame) -> DataFrame:
    """``node, var, n, outcome, conditional, split_info, gain_ratio`` (0 where the split information is 0 but for rounding)."""
    counts = long.groupBy("node", "var", "value", "label").agg(F.count(F.lit(1)).alias("c"))
    by_value = _entropy(counts, ["node", "var", "value"], "c", "h")
    conditional = by_value.groupBy("node", "var").agg(F.sum(F.col("n_h") * F.col("h")).alias("_s"), F.sum("n_h").alias("_t")).select("node", "var", (F.col("_s") / F.col("_t")).alias("conditional"))
    split = _entropy(by_value, ["node", "var"], "n_h", "split_info").withColumnRenamed("n_split_info", "n")
    outcome = _entropy(counts.groupBy("node", "var", "label").agg(F.sum("c").alias("c")), ["node", "var"], "c", "outcome").drop("n_outcome")
    d = split.join(conditional, ["node", "var"]).join(outcome, ["node", "var"])
    return d.withColumn("gain_ratio", F.when(F.col("split_info") > _ZERO, (F.col("outcome") - F.col("conditional")) / F.col("split_info")).otherwise(0.0))


def best_split(ratios: DataFrame) -> DataFrame:
    """Each node's variable of the largest gain ratio; of ties the first by name."""
    w = Window.partitionBy("node").orderBy(F.desc(F.round("gain_ratio", 12)), "var")
    return ratios.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def grow(df: DataFrame, features: Sequence[str], label: str, max_depth: int | None = None, max_nodes: int = 10_000) -> list[dict]:
    """The tree's nodes ``level, node, var, gain_ratio, n, rules``, from the root down.

    A node splits while its best gain ratio is above 0 and below 1 and, if ``max_depth`` is given, its depth below that; a
    node with ratio 1 splits into pure leaves; ``rules`` are the values of its variable. Each level reads the table once; of
    it only the best splits come to the driver. A level of more than ``max_nodes`` nodes is a ValueError, none is left
    out. Paths are kept whole, so branches don't mix.
    """
    rows = df.select(*features, label).withColumn("node", F.lit("root"))
    out: list[dict] = []
    for level in count() if max_depth is None else range(max_depth + 1):
        long = to_long(rows, features, label)
        best = best_split(gain_ratios(long))
        values = long.join(best.select("node", "var"), ["node", "var"]).groupBy("node", "var").agg(F.array_sort(F.collect_set("value")).alias("rules"))
        found = best.join(values, ["node", "var"]).orderBy("node").limit(max_nodes + 1).collect()
        if len(found) > max_nodes:
            raise ValueError(f"level {level} of the tree has more than {max_nodes} nodes; raise max_nodes or lower max_depth")
        if not found:
            break
        grows = []
        for r in found:
            out.append({"level": level, "node": r["node"], "var": r["var"], "gain_ratio": r["gain_ratio"], "n": r["n"], "rules": list(r["rules"])})
            if r["gain_ratio"] > _ZERO and abs(r["gain_ratio"] - 1) > _ZERO:
                grows.append((r["node"], r["var"]))
        if not grows:
            break
        splits = df.sparkSession.createDataFrame(grows, "node string, _var string")
        value = F.coalesce(*[F.when(F.col("_var") == c, F.col(c).cast("string")) for c in features], F.lit("null"))
        rows = rows.join(F.broadcast(splits), "node").withColumn("node", F.concat("node", F.lit("/"), "_var", F.lit("="), value)).drop("_var")
    return out


def tree_json(nodes: list[dict]) -> list[str]:
    """A JSON line per node: name, parent, level, rules."""
    import json

    return [json.dumps({"name": n["var"], "parent": n["node"].rpartition("/")[0] or "root", "level": n["level"], "rules": ",".join(n["rules"])}) for n in nodes]
