"""Sources and sinks beyond the cluster's storage. What talks to the outside is handed in, so nothing here opens a connection of its own."""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable, Iterable, Iterator
from email.message import EmailMessage
from typing import TextIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def stdin_lines(spark: SparkSession, stream: TextIO | None = None, max_lines: int = 1_000_000) -> DataFrame:
    """``line`` of each line of a stream (standard input); a driver's stream is small, more than ``max_lines`` are an error."""
    lines = []
    for line in stream or sys.stdin:
        if len(lines) == max_lines:
            raise ValueError(f"more than {max_lines} lines")
        lines.append((line.rstrip("\n"),))
    return spark.createDataFrame(lines, "line string")


def sas_table(spark: SparkSession, path: str, fmt: str = "sas7bdat", chunk: int = 100_000) -> DataFrame:
    """A SAS dataset or transport file, read in chunks on the driver (the format has no splits); texts are decoded as UTF-8."""
    out = None
    for frame in pd.read_sas(path, format=fmt, encoding="utf-8", chunksize=chunk):
        part = spark.createDataFrame(frame)
        out = part if out is None else out.unionByName(part)
    return out


def odbc_rows(spark: SparkSession, connect: Callable[[], object], query: str, schema: str | T.StructType, parts: list[tuple]) -> DataFrame:
    """Rows of a DB-API query, once for each of ``parts`` (the query's parameters), each in a task of its own that opens its connection by ``connect``."""
    names = T._parse_datatype_string(schema).fieldNames() if isinstance(schema, str) else schema.fieldNames()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p in f["part"]:
                con = connect()
                cur = con.cursor()
                cur.execute(query, tuple(p))
                while rows := cur.fetchmany(10_000):
                    yield pd.DataFrame(rows, columns=names)
                con.close()

    return spark.createDataFrame([([str(x) for x in p],) for p in parts], "part array<string>").repartition(max(1, len(parts))).mapInPandas(read, schema)


def lookup(df: DataFrame, key: str, fetch: Callable[[list[str]], list[str | None]], schema: str, batch: int = 100) -> DataFrame:
    """``df`` with ``found``: what a service replies (JSON) to each distinct key, asked ``batch`` keys at a time; null where it knows none."""
    names = f"{key} {dict(df.dtypes)[key]}, reply string"

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for lo in range(0, len(f), batch):
                part = f.iloc[lo : lo + batch]
                yield part.assign(reply=fetch(part[key].astype(str).tolist()))

    replies = df.select(key).where(F.col(key).isNotNull()).distinct().mapInPandas(ask, names)
    return df.join(replies.select(key, F.from_json("reply", schema).alias("found")), key, "left")


def crawl(spark: SparkSession, starts: Iterable[str], fetch: Callable[[str], str | None], follow: Callable[[str, str], list[str]], max_pages: int) -> DataFrame:
    """``url, depth, html`` of the pages reached from ``starts`` by ``follow(url, html)``, level by level, each fetched once in a task.

    Pages of a level are fetched on the executors. The links found are brought back to make the next level, so
    ``max_pages`` bounds the walk; reaching it with links left is an error, not a cut.
    """
    seen = dict.fromkeys(starts, 0)
    level, depth, out = list(seen), 0, None
    schema = "url string, depth int, html string, links array<string>"
    while level:
        if len(seen) > max_pages:
            raise ValueError(f"more than {max_pages} pages")

        def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                html = [fetch(u) for u in f["url"]]
                yield f.assign(html=html, links=[follow(u, h) if h else [] for u, h in zip(f["url"], html, strict=True)])

        pages = spark.createDataFrame([(u, depth) for u in level], "url string, depth int").repartition("url").mapInPandas(visit, schema).checkpoint()
        out = pages if out is None else out.unionByName(pages)
        found = [r[0] for r in pages.select(F.explode("links")).distinct().limit(max_pages + 1).collect()]
        level = sorted({u for u in found if u not in seen})
        depth += 1
        seen.update(dict.fromkeys(level, depth))
    return out.drop("links") if out is not None else spark.createDataFrame([], "url string, depth int, html string")


def notice(send: Callable[[EmailMessage], None], to: list[str], subject: str, report: DataFrame, max_rows: int = 200) -> EmailMessage:
    """Hands a mail with a small report to ``send``; more than ``max_rows`` rows are an error."""
    from millrace.plans.bounds import collect_bounded

    rows = collect_bounded(report, max_rows, "report")
    m = EmailMessage()
    m["To"], m["Subject"] = ", ".join(to), subject
    m.set_content("\n".join(["\t".join(report.columns), *("\t".join(map(str, r)) for r in rows)]))
    send(m)
    return m


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def rotate(spark: SparkSession, log: str, archive: str, stamp: dt.datetime) -> str:
    """Moves a log into the archive's folder of its day, under its time; what writes it begins a new one."""
    fs, source = _fs(spark, log)
    _, folder = _fs(spark, f"{archive}/{stamp:%Y%m%d}")
    fs.mkdirs(folder)
    target = f"{folder.toString()}/{source.getName()}.{stamp:%H%M%S}"
    if not fs.rename(source, _fs(spark, target)[1]):
        raise OSError(f"cannot move {log} to {target}")
    return target


def drop_old(spark: SparkSession, path: str, today: dt.date, keep_days: int) -> list[str]:
    """Deletes the folders named by a day (``yyyymmdd``, ``yyyy-mm-dd``, with ``name=`` before or not) more than ``keep_days`` before ``today``; others stay. Gives back what went."""
    fs, root = _fs(spark, path)
    gone = []
    for st in fs.listStatus(root):
        digits = st.getPath().getName().rpartition("=")[2].replace("-", "")
        if st.isDirectory() and len(digits) == 8 and digits.isdigit():
            try:
                day = dt.datetime.strptime(digits, "%Y%m%d").date()
            except ValueError:
                continue
            if (today - day).days > keep_days:
                fs.delete(st.getPath(), True)
                gone.append(st.getPath().getName())
    return sorted(gone)
