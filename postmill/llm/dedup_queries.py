"""Queries on copies among postings (p2_...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postmill.llm.history_dedup import dedup_in_batches
from postmill.sources.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_in_batches(table(spark, sf_dir, "job_postings").select("job_id", "first_seen", "raw_text")).pairs()


QUERIES = {"p2_found": p2_found}
SQL: dict[str, str] = {}
