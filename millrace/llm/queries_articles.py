"""Queries over articles: stuffed pages, markup. SQL cannot express them; tests hold them against labelled fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.markup import clean_markup, fit_costs, sample_texts
from millrace.llm.stuffing import fit_classes, judge_pages, sample_pages, stuffed_pages
from millrace.plans.tables import table


def _classes(pages: DataFrame):
    return fit_classes(sample_pages(pages, "article_id", "content", "is_spam"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "articles_half_a")
    return stuffed_pages(pages, "article_id", "content", classes=_classes(pages)).select(F.col("page_id").alias("article_id"))


def p3_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every article's share of keywords, links and tags, by author too."""
    pages = table(spark, d, "articles_half_a")
    got = judge_pages(pages.select(F.struct("article_id", "author").alias("key"), "content"), "key", "content", _classes(pages))
    return got.select(F.col("page_id.article_id"), F.col("page_id.author"), "n_chars", F.round("stuffed_share", 6).alias("stuffed_share"), "n_shapes", "kind")


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "articles_half_a")
    return clean_markup(pages, "article_id", "content", fit_costs(sample_texts(pages, "article_id", "content")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _cleaned(spark, d).select(F.col("doc_id").alias("article_id"), F.explode("kinds").alias("kind"))


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every article's clean text, what was cut off, and its notations."""
    return _cleaned(spark, d).withColumnRenamed("doc_id", "article_id").withColumn("kinds", F.concat_ws(",", "kinds"))


QUERIES = {"p3_found": p3_found, "p3_pages": p3_pages, "p5_found": p5_found, "p5_clean": p5_clean}
SQL: dict[str, str] = {}
