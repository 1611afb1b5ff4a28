"""All marts from daily canonical postings and extractions, as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import extraction, rules
from postmill.sources.files import publish
from postmill.sources.tables import replace_folder

EXTRACTION = "seq long, job_id string, model string, version string, role_family string, seniority string, salary_min double, salary_max double, salary_currency string, salary_period string, salary_text string, skills array<string>"
RULES = "rules"


def best_extractions(extractions: DataFrame, model: tuple[str, str], rules_version: str) -> DataFrame:
    """One extraction a posting: the last one of the current model and prompt, else the first one of the current rules; outdated ones don't count."""
    e = extractions.where("job_id is not null")
    by_model = (F.col("model") == model[0]) & (F.col("version") == model[1])
    by_rules = (F.col("model") == RULES) & (F.col("version") == rules_version)
    rest = [c for c in e.columns if c not in ("job_id", "seq")]
    # the greatest: the model's by ascending place, before the rules' by descending place
    order = F.struct(by_model.alias("m"), F.when(by_model, F.col("seq")).otherwise(-F.col("seq")).alias("s"))
    return e.where(by_model | by_rules).groupBy("job_id").agg(F.max_by(F.struct(*rest), order).alias("r")).select("job_id", "r.*")


def build(days: DataFrame, extractions: DataFrame, model: tuple[str, str], rules_version: str) -> dict[str, DataFrame]:
    """The mart tables from `days` (seen_date, job_id, source, company, title, location, th_primary, url, posted_date, raw_text, n_duplicates) and all extractions.

    A posting has the values of the last day it was seen on (between rows of
    one day the greatest), and is open if that is the last day of all.
    Postings without a current extraction get the rules' at once; extractions
    of unknown postings are left out. A null job_id is dropped.
    """
    d = days.where("job_id is not null and seen_date is not null")
    values = [c for c in d.columns if c not in ("job_id", "seen_date")]
    per = d.groupBy("job_id").agg(F.min("seen_date").alias("first_seen"), F.max(F.struct("seen_date", *values)).alias("r"))
    last = d.agg(F.max("seen_date").alias("latest"))
    posts = per.join(last, F.col("r.seen_date") == F.col("latest"), "left").select("job_id", *[F.col("r")[c].alias(c) for c in values], "first_seen", F.col("r.seen_date").alias("last_seen"), F.col("latest").isNotNull().alias("is_open"))
    best = best_extractions(extractions, model, rules_version)
    todo = posts.join(best.select("job_id"), "job_id", "left_anti")
    blank = {c: F.lit(None).cast(extractions.schema[c].dataType) for c in extractions.columns if c not in ("seq", "job_id")}
    made = blank | {"model": F.lit(RULES), "version": F.lit(rules_version), "role_family": rules.role_family(F.col("title")), "seniority": rules.level(F.col("title"), F.coalesce("raw_text", F.lit("")))}
    computed = todo.select("job_id", *[v.alias(c) for c, v in made.items()])
    both = best.join(posts.select("job_id"), "job_id", "left_semi").select("job_id", *made).unionByName(computed)
    kept = extraction.clean(both.join(posts.select("job_id", "raw_text"), "job_id"))
    attributes = kept.select("job_id", "role_family", "seniority", "salary_stated", *extraction.PAY, F.col("model").alias("extraction_method"))
    skills = both.select("job_id", F.explode(extraction.first_spellings(F.col("skills"))).alias("skill"))
    return {"job_postings": posts, "posting_attributes": attributes, "posting_skills": skills, "daily_active": d.select("seen_date", "job_id").distinct()}


def build_and_publish(days: DataFrame, extractions: DataFrame, model: tuple[str, str], rules_version: str, path: str) -> dict[str, int]:
    """Build all marts beside `path`, with redacted texts, and put them in its place when all are written; rows of each table."""
    counts = publish(build(days, extractions, model, rules_version), f"{path}.new")
    replace_folder(days.sparkSession, f"{path}.new", path)
    return counts
