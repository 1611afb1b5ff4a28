"""Predictions of several models against gold labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_names(names: DataFrame, aliases: DataFrame, key: list[str], column: str = "skill") -> DataFrame:
    """(key, name): the names of each key in lower case, known spellings replaced by the canonical one, each once; blank ones don't count.

    `aliases` has (alias, canonical); spellings are compared without case and
    with single spaces.
    """
    tidy = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    known = aliases.select(tidy(F.col("alias")).alias("name"), tidy(F.col("canonical")).alias("canonical")).where("name <> ''").groupBy("name").agg(F.min("canonical").alias("canonical"))
    x = names.where(F.col(column).isNotNull()).select(*key, tidy(F.col(column)).alias("name")).where("name <> ''")
    return x.join(known, "name", "left").select(*key, F.coalesce("canonical", "name").alias("name")).distinct()


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0.0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def evaluate(gold: DataFrame, predictions: DataFrame, gold_skills: DataFrame, predicted_skills: DataFrame) -> DataFrame:
    """One row for each (model, version) of `predictions`.

    gold: (job_id, seniority, role_family, salary_min, salary_max), one row a
    posting; predictions: the same with model and version; the skills are
    (job_id, name) and (model, version, job_id, name), canonical and distinct.
    Gold postings without a prediction of the model are counted (n_missing)
    and left out of all other figures. Skills count over all postings
    together; precision, recall and F1 are 0.0 where nothing is there to
    divide by, accuracies null without postings. A salary is stated if either
    bound is; its value is right only if both bounds are equal.
    """
    models = predictions.select("model", "version").distinct()
    n_gold = gold.agg(F.count(F.lit(1)).alias("n_gold"))
    stated = lambda p: F.col(f"{p}salary_min").isNotNull() | F.col(f"{p}salary_max").isNotNull()
    g = gold.select("job_id", *[F.col(c).alias(f"g_{c}") for c in ("seniority", "role_family", "salary_min", "salary_max")])
    both = predictions.join(g, "job_id")
    same = lambda c: F.count_if(F.col(c).eqNullSafe(F.col(f"g_{c}")))
    exact = F.col("salary_min").eqNullSafe(F.col("g_salary_min")) & F.col("salary_max").eqNullSafe(F.col("g_salary_max"))
    per = both.groupBy("model", "version").agg(
        F.count(F.lit(1)).alias("n_postings"), same("seniority").alias("seniority_right"), same("role_family").alias("role_right"), F.count_if(stated("") == stated("g_")).alias("stated_right"),
        F.count_if(stated("g_")).alias("n_stated"), F.count_if(stated("g_") & exact).alias("value_right"),
    )
    judged = both.select("model", "version", "job_id")
    left = judged.join(gold_skills.withColumn("in_gold", F.lit(1)), "job_id")
    right = predicted_skills.join(judged, ["model", "version", "job_id"], "left_semi").withColumn("in_pred", F.lit(1))
    cells = left.join(right, ["model", "version", "job_id", "name"], "full")
    counts = cells.groupBy("model", "version").agg(F.count_if((F.col("in_gold") == 1) & (F.col("in_pred") == 1)).alias("tp"), F.count_if(F.col("in_gold").isNull()).alias("fp"), F.count_if(F.col("in_pred").isNull()).alias("fn"))
    one = F.lit(1).alias("one")
    x = models.join(per, ["model", "version"], "left").join(counts, ["model", "version"], "left").na.fill(0).select("*", one).join(n_gold.select("n_gold", one), "one").drop("one")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return x.select(
        "model", "version", "n_postings", (F.col("n_gold") - F.col("n_postings")).alias("n_missing"), "tp", "fp", "fn", _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide("seniority_right", "n_postings").alias("seniority_accuracy"), F.try_divide("role_right", "n_postings").alias("role_accuracy"), F.try_divide("stated_right", "n_postings").alias("stated_accuracy"), "value_right", "n_stated",
    )
