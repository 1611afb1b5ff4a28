"""Queries on typed skills (p4_...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.value_mapping import map_values
from postmill.sources.tables import table


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows (job_id, skill) to be mapped, mapping of their values)."""
    ref = table(spark, sf_dir, "skill_reference")
    typed = table(spark, sf_dir, "posting_skills").select("job_id", "skill").where("skill is not null and trim(regexp_replace(skill, '\\\\s+', ' ')) <> ''").distinct()
    typed = typed.join(ref.select(F.col("canonical_name").alias("skill")).where("skill is not null").distinct(), "skill", "left_anti")
    names = ref.select(F.col("skill_id").alias("entry_id"), F.explode(F.array("canonical_name", "short_form")).alias("name"))
    return typed, map_values(typed.select(F.col("skill").alias("value")), names)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed, mapping = _parts(spark, sf_dir)
    return typed.join(mapping.withColumnRenamed("value", "skill"), "skill").select("job_id", "skill", F.coalesce("entry_id", F.lit(0)).alias("skill_id"))


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without an entry, with the number of postings that have them."""
    typed, mapping = _parts(spark, sf_dir)
    return typed.join(mapping.where("entry_id is null").select(F.col("value").alias("skill")), "skill").groupBy("skill").agg(F.countDistinct("job_id").alias("n_postings"))


QUERIES = {"p4_found": p4_found, "p4_unmatched": p4_unmatched}
SQL: dict[str, str] = {}
