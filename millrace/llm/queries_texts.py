"""Queries over documents: leaked test items, languages. SQL cannot express them; tests hold them against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.language import document_languages, fit_languages, label_language, label_missing, sample_labelled, segment_languages
from millrace.llm.leak import find_leaks
from millrace.llm.mixture import draw, shares
from millrace.llm.tokens import count_tokens
from millrace.plans.tables import table


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", "lang", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """The items that leaked, with the number of documents and the longest passage in windows."""
    return _leaks(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("n_windows").alias("most_windows"))


def _model(docs: DataFrame):
    return fit_languages(sample_labelled(docs, label_language(F.col("lang")), "text", "doc_id"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    got = document_languages(docs.select(F.struct("doc_id", "lang").alias("row"), "text"), "row", "text", _model(docs)).select(F.col("doc_id.doc_id"), F.col("doc_id.lang"), "langs")
    named = label_language(F.col("lang"))
    wrong = label_missing(F.col("lang")) | (F.size("langs") > 1) | named.isNull() | ~F.array_contains("langs", F.coalesce(named, F.lit("")))
    return got.where((F.size("langs") > 0) & wrong).select("doc_id", F.explode("langs").alias("lang_found"))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every sentence's language with its confidence."""
    docs = table(spark, d, "documents")
    return segment_languages(docs, "doc_id", "text", _model(docs)).withColumn("confidence", F.round("confidence", 6))


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    source = F.translate(F.lower(F.trim("source")), "- ", "__")
    docs = count_tokens(table(spark, d, "documents").select(F.col("doc_id").alias("id"), source.alias("source"), "text"), ["id", "source"], "text")
    targets = table(spark, d, "mix_targets")
    return draw(docs, targets)[0], targets


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents drawn, with their copies."""
    return _mixture(spark, d)[0].withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of each source."""
    return shares(*_mixture(spark, d))


QUERIES = {"p9_mixture": p9_mixture, "p9_shares": p9_shares, "p8_found": p8_found, "p8_items": p8_items, "p10_found": p10_found, "p10_segments": p10_segments}
SQL: dict[str, str] = {}
