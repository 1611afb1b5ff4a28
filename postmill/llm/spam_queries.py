"""Queries on spam pages (p8_...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.page_spam import spam_scores
from postmill.sources.tables import table


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam_scores(table(spark, sf_dir, "documents")).where("is_spam").select("doc_id")


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam_scores(table(spark, sf_dir, "documents")).select("doc_id", F.round("spam_share", 4).alias("spam_share"), "n_units", "is_spam")


QUERIES = {"p8_found": p8_found, "p8_scores": p8_scores}
SQL: dict[str, str] = {}
