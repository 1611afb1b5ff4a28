"""Queries on the languages of postings (p5_...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.language import detect, label_code, train
from postmill.sources.tables import table


def declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, code): the label declared last; between equal times the greatest."""
    last = F.max(F.struct("declared_at", "declared_lang")).getField("declared_lang").alias("label")
    d = table(spark, sf_dir, "posting_lang").where("job_id is not null").groupBy(F.col("job_id").alias("id")).agg(last)
    return d.withColumn("code", label_code(F.col("label")))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, passages, label, code, issue) of each posting with a text."""
    posts = table(spark, sf_dir, "job_postings").select(F.col("job_id").alias("id"), F.col("raw_text").alias("text")).where("id is not null and text is not null")
    labels = declared(spark, sf_dir)
    model = train(posts, labels.select("id", "code"))
    found = detect(posts, model).where("size(passages) > 0").dropDuplicates(["id"]).join(labels, "id", "left")
    mixed = F.size("passages") > 1
    issue = (
        F.when(F.col("label").isNull() | (F.trim("label") == ""), "missing")
        .when(F.col("code").isNull(), "unclear")
        .when(~mixed & (F.col("code") != F.col("passages")[0]["lang"]), "wrong")
        .when(mixed, "mixed")
    )
    return found.withColumn("issue", issue).withColumnRenamed("id", "job_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = judged(spark, sf_dir).where("issue is not null")
    return j.select("job_id", F.explode("passages").alias("p")).select("job_id", "p.seg_no", "p.lang")


def p5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = judged(spark, sf_dir)
    return j.select("job_id", "label", "issue", F.explode("passages").alias("p")).select("job_id", "label", "issue", "p.seg_no", "p.lang", F.round("p.confidence", 3).alias("confidence"), "p.n_lines")


QUERIES = {"p5_found": p5_found, "p5_passages": p5_passages}
SQL: dict[str, str] = {}
