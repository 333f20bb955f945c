"""Graphs of steps with outputs: run in order, side by side where they may, and only what isn't there yet."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Task:
    """A step that makes a table at ``output`` from the tables of the steps it ``requires`` (by name)."""

    name: str
    make: Callable[..., DataFrame]
    output: str
    requires: tuple[str, ...] = ()


@dataclass(frozen=True)
class Done:
    name: str
    status: str  # made, kept
    rows: int
    seconds: float


def _exists(spark: SparkSession, path: str) -> bool:
    """If a step's output is whole: the writer leaves its mark last, so a broken run counts as none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ordered(tasks: Iterable[Task], wanted: Sequence[str] | None = None) -> list[Task]:
    """The steps that ``wanted`` (all, if None) need, each after what it requires; a ValueError for unknown names and circles."""
    known = {t.name: t for t in tasks}
    out: list[Task] = []
    state: dict[str, int] = {}

    def visit(name: str) -> None:
        if name not in known:
            raise ValueError(f"no step {name}")
        if state.get(name) == 1:
            raise ValueError(f"step {name} requires itself")
        if name not in state:
            state[name] = 1
            for r in known[name].requires:
                visit(r)
            state[name] = 2
            out.append(known[name])

    for name in known if wanted is None else wanted:
        visit(name)
    return out


def run(spark: SparkSession, tasks: Iterable[Task], wanted: Sequence[str] | None = None, again: bool = False, at_once: int = 4) -> list[Done]:
    """Makes the outputs that aren't there, up to ``at_once`` steps side by side; with ``again`` all of them.

    An output is replaced as a whole and counts only when it is whole, so a run that broke off is simply run again. The
    first failure stops what hasn't begun and is raised.
    """
    todo = ordered(tasks, wanted)
    made: dict[str, Done] = {}

    def step(t: Task) -> Done:
        began = time.monotonic()
        status = "kept"
        if again or not _exists(spark, t.output):
            t.make(*[spark.read.parquet(outputs[r]) for r in t.requires]).write.mode("overwrite").parquet(t.output)
            status = "made"
        return Done(t.name, status, spark.read.parquet(t.output).count(), time.monotonic() - began)

    outputs = {t.name: t.output for t in todo}
    with ThreadPoolExecutor(at_once) as pool:
        running: dict = {}
        while todo or running:
            ready = [t for t in todo if all(r in made for r in t.requires)]
            for t in ready:
                todo.remove(t)
                running[pool.submit(step, t)] = t.name
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for f in finished:
                name = running.pop(f)
                try:
                    made[name] = f.result()
                except (Exception, AnalysisException):
                    for other in running:
                        other.cancel()
                    raise
    return list(made.values())


def periods(first: dt.date, last: dt.date, monthly: bool = False) -> list[dt.date]:
    """The days, or the last days of the months, of a span: what a daily or a monthly run goes through."""
    days = [first + dt.timedelta(k) for k in range((last - first).days + 1)]
    return [d for d in days if (d + dt.timedelta(1)).day == 1] if monthly else days


def for_periods(build: Callable[[dt.date], Sequence[Task]], first: dt.date, last: dt.date, monthly: bool = False) -> list[Task]:
    """The steps of every period. Names carry the day, and a step may require one of an earlier period."""
    return [t for day in periods(first, last, monthly) for t in build(day)]
