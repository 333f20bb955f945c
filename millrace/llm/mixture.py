"""Mixtures of sources with target shares, by entropy balancing."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.plans.bounds import collect_bounded
from millrace.session import ensure_checkpoint_dir

_BINS = 4096
_MOST = 8.0


class NotSolved(RuntimeError):
    """The dual did not come within its tolerance."""


@dataclass
class Source:
    """What is to come from a source: ``goal`` tokens; the multiplier ``b`` gives a document of ``t`` tokens the rate ``min(cap, exp(b * t / mean))``."""

    share: float
    cap: int
    docs: int = 0
    tokens: int = 0
    goal: float = 0.0
    full: bool = False
    b: float = 0.0
    low: float = -math.inf
    high: float = math.inf
    steps: int = 0

    @property
    def mean(self) -> float:
        return self.tokens / self.docs if self.docs else 1.0


def set_goals(sources: dict[str, Source], total: float) -> None:
    """Gives each source its share of ``total``; what sources at their cap can't give goes to the others by their shares."""
    for s in sources.values():
        s.full = not s.tokens or s.cap <= 0 or s.share <= 0
        s.goal = 0.0
    while True:
        given = sum(s.goal for s in sources.values() if s.full)
        open_share = sum(s.share for s in sources.values() if not s.full)
        over = False
        for s in sources.values():
            if not s.full:
                s.goal = (total - given) * s.share / open_share
                if s.goal >= s.cap * s.tokens:
                    over = True
        if not over:
            return
        for s in sources.values():
            if not s.full and s.goal >= s.cap * s.tokens:
                s.goal, s.full = float(s.cap * s.tokens), True


def _pick(values: dict[str, float], key: str) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col(key)]


def balance(histogram: DataFrame, sources: dict[str, Source], tolerance: float = 1e-9, max_steps: int = 100) -> None:
    """Newton steps on the convex dual of entropy balancing, the multipliers of all sources together.

    ``histogram`` has ``source, n_tokens, n``, which is all that the dual needs of the documents. Rates ``w`` have the
    least relative entropy to 1 (each document once) of all with ``sum w t = goal`` for every source and never lie
    above its cap, so they tilt exponentially with a document's tokens. A token constraint touches no other source's
    documents: the dual's Hessian is diagonal, and one distributed aggregate a step gives it and the gradient whole.
    A step that leaves the interval in which the gradient changes its sign is replaced by the interval's middle, so
    steps always come nearer. Raises ``NotSolved`` if a source is still off by more than ``tolerance`` in the end.
    """
    open_ = {k: s for k, s in sources.items() if not s.full}
    for _ in range(max_steps):
        if not open_:
            return
        pick = lambda name: _pick({k: float(getattr(s, name)) for k, s in open_.items()}, "source")  # noqa: E731, B023
        t = F.col("n_tokens") / pick("mean")
        x, top = pick("b") * t, F.log(pick("cap"))
        w = F.exp(F.least(x, top))
        bend = F.when(x <= top, w).otherwise(0.0)
        n = F.col("n")
        rows = histogram.where(F.col("source").isin(*open_)).groupBy("source").agg(F.sum(n * w * t), F.sum(n * bend * t * t)).collect()  # one row a source
        for name, given, slope in rows:
            s = open_[name]
            want = s.goal / s.mean
            off = given - want
            s.steps += 1
            if abs(off) <= tolerance * want:
                del open_[name]
                continue
            if off > 0:
                s.high = s.b
            else:
                s.low = s.b
            step = s.b - off / slope if slope > 0 else math.copysign(math.inf, -off)
            if not s.low < step < s.high:
                wide = 2 * abs(s.b) + 1
                step = (max(s.low, s.b - wide) + min(s.high, s.b + wide)) / 2
            s.b = max(s.b - 4 * (abs(s.b) + 1), min(s.b + 4 * (abs(s.b) + 1), step))
    if open_:
        raise NotSolved(f"no rates after {max_steps} steps for {', '.join(f'{k} ({s.goal:.0f} of {s.tokens} tokens, at most {s.cap} times)' for k, s in sorted(open_.items()))}")


def draw(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 7, max_sources: int = 1000) -> tuple[DataFrame, dict[str, Source]]:
    """``id, source, n_tokens, copies`` of the documents drawn (``copies`` at least 1), and what was solved for each source.

    ``docs`` has ``id, source, n_tokens``; ``targets`` has ``source, target_share, max_repeat`` (unique sources).
    ``total`` is the mixture's size in tokens; None stands for all tokens of the listed sources. A source that can't
    reach its share with ``max_repeat`` copies of everything gives just that; the rest is shared out among the
    others by their targets. Documents without source, of unlisted sources, of no tokens or with null counts are
    never drawn; repeated rows are documents of their own; empty tables give an empty mixture.

    Rates become whole copies: the whole part, and one more where the document's hashed number falls below its
    fraction times a factor, which two histograms a source set so that the source's tokens come to its goal.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    sources = {r["source"]: Source(float(r["target_share"] or 0), int(r["max_repeat"] or 0)) for r in collect_bounded(targets.select("source", "target_share", "max_repeat").where("source is not null"), max_sources, "targets")}
    # The counts are the costly part and are needed again and again: they are written once to the shared folder.
    d = docs.select("id", "source", "n_tokens").where("source is not null and n_tokens > 0").where(F.col("source").isin(*sources)).checkpoint()
    histogram = d.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n"))
    for name, n, tokens in histogram.groupBy("source").agg(F.sum("n"), F.sum(F.col("n") * F.col("n_tokens"))).collect():  # one row a source
        sources[name].docs, sources[name].tokens = n, tokens
    set_goals(sources, float(total) if total is not None else float(sum(s.tokens for s in sources.values() if s.share > 0)))
    histogram = histogram.checkpoint()
    balance(histogram, sources)
    used = {k: s for k, s in sources.items() if s.goal > 0}
    if not used:
        return d.where("false").select("*", F.lit(0).cast("bigint").alias("copies")), sources
    value = lambda f: _pick({k: float(f(s)) for k, s in used.items()}, "source")
    rate = F.when(value(lambda s: s.full) == 1.0, value(lambda s: s.cap)).otherwise(F.least(value(lambda s: s.cap), F.exp(F.least(value(lambda s: s.b) * F.col("n_tokens") / value(lambda s: s.mean), F.log(value(lambda s: s.cap))))))
    d = d.where(F.col("source").isin(*used)).withColumn("rate", rate).withColumn("whole", F.floor(F.col("rate") + 1e-9).cast("bigint"))
    part = F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0))
    u = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    d = d.withColumn("r", F.when(part > 1e-9, F.least(u / part, F.lit(_MOST))))
    width = _MOST / _BINS
    need = {r[0]: used[r[0]].goal - r[1] for r in d.groupBy("source").agg(F.sum(F.col("whole") * F.col("n_tokens"))).collect()}
    low = dict.fromkeys(used, 0.0)
    cut = dict(low)
    for level in (1, 2):
        step = width if level == 1 else width / _BINS
        inside = d.where(F.col("r").isNotNull())
        base = _pick(low, "source")
        at = F.floor((F.col("r") - base) / step).cast("int")
        w = Window.partitionBy("source").orderBy("bin")
        sums = inside.withColumn("bin", at).where((F.col("bin") >= 0) & (F.col("bin") < _BINS)).groupBy("source", "bin").agg(F.sum("n_tokens").alias("t")).withColumn("sum", F.sum("t").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        for name, best, before, after in sums.where(F.col("sum") >= _pick(need, "source")).groupBy("source").agg(F.min("bin"), F.min(F.col("sum") - F.col("t")), F.min("sum")).collect():  # one row a source
            low[name] += best * step
            if level == 1:
                need[name] -= before
            cut[name] = low[name] + (step if level == 2 and after - need[name] < need[name] - before else 0.0)
        reached = {r[0] for r in sums.where(F.col("sum") >= _pick(need, "source")).select("source").distinct().collect()} if level == 1 else set()
        if level == 1:
            for name in used:
                if name not in reached:
                    cut[name] = low[name] = _MOST + 1 if need.get(name, 0) > 0 else -1.0
    copies = F.col("whole") + F.coalesce((F.col("r") < _pick(cut, "source")).cast("bigint"), F.lit(0))
    return d.withColumn("copies", F.least(copies, value(lambda s: s.cap).cast("bigint"))).where("copies > 0").select("id", "source", "n_tokens", "copies"), sources


def shares(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """What came of each target: ``source, target_share, actual_share, n_docs, n_copies, n_tokens, most_copies``."""
    got = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("copies").alias("n_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("n_tokens"), F.max("copies").alias("most_copies"))
    out = targets.select("source", "target_share").join(got, "source", "left").na.fill(0, ["n_docs", "n_copies", "n_tokens", "most_copies"])
    whole = out.agg(F.sum("n_tokens")).first()[0] or 0
    return out.withColumn("actual_share", F.col("n_tokens") / F.lit(float(whole or 1)))
