"""Queries that build the marts: intervals, merged extractions, daily rows, joins and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.functions import rules
from postmill.operators.snapshot_diff import latest_delivery
from postmill.plans.snapshots import FIELDS
from postmill.sources.tables import table


def current_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per posting: the one seen last, between equal days the greatest."""
    cols = ["last_seen", "is_open", "source", "company", "title", "location", "th_primary", "posted_date", "first_seen", "n_duplicates"]
    p = table(spark, sf_dir, "job_postings").where("job_id is not null")
    return p.groupBy("job_id").agg(F.max(F.struct(*cols)).alias("r")).select("job_id", "r.*")


def posting_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last day seen, and whether that is the last day of all."""
    d = table(spark, sf_dir, "daily_active").where("job_id is not null")
    last = d.agg(F.max("seen_date").alias("latest"))
    per = d.groupBy("job_id").agg(F.min("seen_date").alias("first_seen"), F.max("seen_date").alias("last_seen"), F.countDistinct("seen_date").alias("n_days"))
    return per.join(last, per["last_seen"] == last["latest"], "left").select("job_id", "first_seen", "last_seen", "n_days", F.col("latest").isNotNull().alias("is_open"))


def daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "daily_active").where("job_id is not null")
    return d.groupBy("seen_date").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("job_id").alias("n_active"))


def latest_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of each posting in the last snapshot that has it."""
    held = latest_delivery(table(spark, sf_dir, "posting_snapshots"), "snapshot_no", "job_id", "delivered_at", FIELDS)
    return held.groupBy(F.col("k").alias("job_id")).agg(F.max(F.struct("n", *FIELDS)).alias("r")).select("job_id", F.col("r.n").alias("snapshot_no"), F.col("r.title").alias("title"), F.col("r.last_seen").alias("last_seen"), F.col("r.is_open").alias("is_open"))


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an id, postings, postings at home and open ones of each snapshot; where no row has an id the number of rows is null."""
    s = table(spark, sf_dir, "posting_snapshots").where("snapshot_no is not null")
    rows = s.groupBy("snapshot_no").agg(F.nullif(F.count("job_id"), F.lit(0)).alias("raw_total"))
    held = latest_delivery(s, "snapshot_no", "job_id", "delivered_at", FIELDS)
    per = held.groupBy(F.col("n").alias("snapshot_no")).agg(F.count(F.lit(1)).alias("n_postings"), F.count_if("th_primary").alias("n_home"), F.count_if("is_open").alias("n_open"))
    return rows.join(per, "snapshot_no", "left")


def funnel_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of the funnel; the limit is the feature."""
    return funnel(spark, sf_dir).orderBy(F.desc("snapshot_no")).limit(1)


def best_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extraction per posting: a model's before the rules', newer rules before older."""
    a = table(spark, sf_dir, "posting_attributes").where("job_id is not null")
    rank = F.when(F.col("extraction_method").startswith("llm"), 2).when(F.col("extraction_method") == "baseline-2", 1).otherwise(0)
    order = F.struct(rank, "extraction_method", "role_family", "seniority", "salary_min")
    return a.groupBy("job_id").agg(F.max(order).alias("b")).select("job_id", F.col("b.extraction_method").alias("extraction_method"), F.col("b.role_family").alias("role_family"), F.col("b.seniority").alias("seniority"))


def filled_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every posting's role family: the extraction's, or the rules' where there is none."""
    have = best_extraction(spark, sf_dir).select("job_id", F.coalesce("role_family", F.lit("Other tech")).alias("role_family"), F.lit(False).alias("computed"))
    todo = current_postings(spark, sf_dir).join(have.select("job_id"), "job_id", "left_anti")
    made = todo.select("job_id", rules.role_family(F.col("title")).alias("role_family"), F.lit(True).alias("computed"))
    return have.join(current_postings(spark, sf_dir).select("job_id"), "job_id", "left_semi").unionByName(made)


def todo_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 120 postings without an extraction, newest first; the limit is the run's budget."""
    done = table(spark, sf_dir, "posting_attributes").where("job_id is not null").select("job_id").distinct()
    p = current_postings(spark, sf_dir).join(done, "job_id", "left_anti")
    return p.select("job_id", "first_seen").orderBy(F.desc_nulls_last("first_seen"), "job_id").limit(120)


def mart_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "job_postings")
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("job_id").alias("n_postings"), F.countDistinct("company").alias("n_companies"), F.min("first_seen").alias("first_day"), F.max("last_seen").alias("last_day"), F.count_if("is_open").alias("n_open"))


def by_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "posting_attributes").groupBy("extraction_method").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("job_id").alias("n_postings"))


def postings_with_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_postings(spark, sf_dir).join(best_extraction(spark, sf_dir), "job_id").select("job_id", "company", "is_open", "role_family", "seniority")


def known_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills of open postings only."""
    open_ = current_postings(spark, sf_dir).where("is_open").select("job_id")
    return table(spark, sf_dir, "posting_skills").where("skill is not null").join(open_, "job_id", "left_semi").select("job_id", "skill").distinct()


def skill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of distinct skills of every posting, 0 where it has none."""
    n = table(spark, sf_dir, "posting_skills").where("skill is not null").groupBy("job_id").agg(F.countDistinct("skill").alias("n"))
    return current_postings(spark, sf_dir).join(n, "job_id", "left").select("job_id", F.coalesce("n", F.lit(0)).alias("n_skills"))


def seen_the_day_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the postings of each day: seen on the collection day before or not."""
    d = table(spark, sf_dir, "daily_active").where("job_id is not null and seen_date is not null").distinct()
    days = d.select("seen_date").distinct()
    days = days.withColumn("prev", F.lag("seen_date").over(Window.orderBy("seen_date")))  # one row a collection day
    old = d.select(F.col("seen_date").alias("prev"), "job_id", F.lit(True).alias("seen"))
    x = d.join(days, "seen_date").join(old, ["prev", "job_id"], "left")
    return x.groupBy("seen_date").agg(F.count_if("seen").alias("n_stayed"), F.count_if(F.col("seen").isNull()).alias("n_new"))


_CUR = """cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY last_seen DESC NULLS LAST, is_open DESC NULLS LAST, source DESC NULLS LAST, company DESC NULLS LAST, title DESC NULLS LAST, location DESC NULLS LAST,
 th_primary DESC NULLS LAST, posted_date DESC NULLS LAST, first_seen DESC NULLS LAST, n_duplicates DESC NULLS LAST) AS rn FROM job_postings WHERE job_id IS NOT NULL) WHERE rn = 1)"""
_HELD = """held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_no, job_id ORDER BY delivered_at DESC NULLS LAST) AS rn FROM posting_snapshots WHERE job_id IS NOT NULL AND snapshot_no IS NOT NULL) WHERE rn = 1)"""
_BEST = """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY CASE WHEN extraction_method LIKE 'llm%' THEN 2 WHEN extraction_method = 'baseline-2' THEN 1 ELSE 0 END DESC, extraction_method DESC NULLS LAST,
 role_family DESC NULLS LAST, seniority DESC NULLS LAST) AS rn FROM posting_attributes WHERE job_id IS NOT NULL) WHERE rn = 1)"""
_FAMILY = "CASE " + " ".join(f"WHEN regexp_matches(title, '{p}', 'i') THEN '{n}'" for n, p in rules.ROLE_RULES) + " ELSE 'Other tech' END"
_FUNNEL = f"""WITH {_HELD}, r AS (SELECT snapshot_no, nullif(count(job_id), 0) AS raw_total FROM posting_snapshots WHERE snapshot_no IS NOT NULL GROUP BY 1),
h AS (SELECT snapshot_no, count(*) AS n_postings, count(*) FILTER (WHERE th_primary) AS n_home, count(*) FILTER (WHERE is_open) AS n_open FROM held GROUP BY 1)
SELECT r.snapshot_no, raw_total, n_postings, n_home, n_open FROM r LEFT JOIN h ON h.snapshot_no = r.snapshot_no"""

QUERIES = {f.__name__: f for f in (current_postings, posting_intervals, daily_rows, latest_values, funnel, funnel_last, best_extraction, filled_extraction, todo_postings, mart_summary, by_method, postings_with_attributes, known_skills, skill_counts, seen_the_day_before)}
SQL = {
    "current_postings": f"WITH {_CUR} SELECT job_id, last_seen, is_open, source, company, title, location, th_primary, posted_date, first_seen, n_duplicates FROM cur",
    "posting_intervals": "SELECT job_id, min(seen_date) AS first_seen, max(seen_date) AS last_seen, count(DISTINCT seen_date) AS n_days, max(seen_date) = (SELECT max(seen_date) FROM daily_active WHERE job_id IS NOT NULL) AS is_open FROM daily_active WHERE job_id IS NOT NULL GROUP BY job_id",
    "daily_rows": "SELECT seen_date, count(*) AS n_rows, count(DISTINCT job_id) AS n_active FROM daily_active WHERE job_id IS NOT NULL GROUP BY 1",
    "latest_values": f"WITH {_HELD}, l AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY snapshot_no DESC) AS r2 FROM held) SELECT job_id, snapshot_no, title, last_seen, is_open FROM l WHERE r2 = 1",
    "funnel": _FUNNEL,
    "funnel_last": _FUNNEL + " ORDER BY r.snapshot_no DESC LIMIT 1",
    "best_extraction": f"WITH {_BEST} SELECT job_id, extraction_method, role_family, seniority FROM best",
    "filled_extraction": f"WITH {_BEST}, {_CUR} SELECT cur.job_id, CASE WHEN best.job_id IS NULL THEN {_FAMILY.replace('title', 'cur.title')} ELSE coalesce(best.role_family, 'Other tech') END AS role_family, best.job_id IS NULL AS computed FROM cur LEFT JOIN best ON best.job_id = cur.job_id",
    "todo_postings": f"WITH {_CUR} SELECT job_id, first_seen FROM cur WHERE job_id NOT IN (SELECT job_id FROM posting_attributes WHERE job_id IS NOT NULL) ORDER BY first_seen DESC NULLS LAST, job_id LIMIT 120",
    "mart_summary": "SELECT count(*) AS n_rows, count(DISTINCT job_id) AS n_postings, count(DISTINCT company) AS n_companies, min(first_seen) AS first_day, max(last_seen) AS last_day, count(*) FILTER (WHERE is_open) AS n_open FROM job_postings",
    "by_method": "SELECT extraction_method, count(*) AS n_rows, count(DISTINCT job_id) AS n_postings FROM posting_attributes GROUP BY 1",
    "postings_with_attributes": f"WITH {_BEST}, {_CUR} SELECT cur.job_id, company, is_open, role_family, seniority FROM cur JOIN best ON best.job_id = cur.job_id",
    "known_skills": f"WITH {_CUR} SELECT DISTINCT job_id, skill FROM posting_skills WHERE skill IS NOT NULL AND job_id IN (SELECT job_id FROM cur WHERE is_open)",
    "skill_counts": f"WITH {_CUR} SELECT cur.job_id, coalesce(n, 0) AS n_skills FROM cur LEFT JOIN (SELECT job_id, count(DISTINCT skill) AS n FROM posting_skills WHERE skill IS NOT NULL GROUP BY 1) s ON s.job_id = cur.job_id",
    "seen_the_day_before": """WITH d AS (SELECT DISTINCT seen_date, job_id FROM daily_active WHERE job_id IS NOT NULL AND seen_date IS NOT NULL),
y AS (SELECT seen_date, lag(seen_date) OVER (ORDER BY seen_date) AS prev FROM (SELECT DISTINCT seen_date FROM d))
SELECT d.seen_date, count(o.job_id) AS n_stayed, count(*) - count(o.job_id) AS n_new FROM d JOIN y ON y.seen_date = d.seen_date LEFT JOIN d o ON o.seen_date = y.prev AND o.job_id = d.job_id GROUP BY 1""",
}
