"""Queries on personal information in postings (p3_...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.pii import decide, redact, train, voted_candidates
from postmill.sources.tables import table


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "job_postings").select(F.col("job_id").alias("id"), F.col("raw_text").alias("text"))
    return t.where("id is not null and text is not null")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = voted_candidates(_texts(spark, sf_dir))
    return decide(found, train(found)).select(F.col("id").alias("job_id"), "kind", "start_pos").distinct()


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(spark, sf_dir)
    found, lexicon = voted_candidates(texts)
    return redact(texts, train(found), lexicon).select(F.col("id").alias("job_id"), "text", "n_found").distinct()


QUERIES = {"p3_found": p3_found, "p3_redacted": p3_redacted}
SQL: dict[str, str] = {}
