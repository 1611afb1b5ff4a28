"""Queries over the weekly snapshots (p1_...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators.snapshot_diff import snapshot_diff
from postmill.sources.tables import table

FIELDS = ["source", "company", "title", "location", "th_primary", "posted_date", "first_seen", "last_seen", "n_duplicates", "is_open"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff(table(spark, sf_dir, "posting_snapshots"), FIELDS).select("snapshot_no", "job_id", "change_kind")


def p1_changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = snapshot_diff(table(spark, sf_dir, "posting_snapshots"), FIELDS).where("change_kind = 'changed'")
    return d.select("snapshot_no", "job_id", F.explode("changed_fields").alias("field"))


def p1_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = snapshot_diff(table(spark, sf_dir, "posting_snapshots"), FIELDS)
    return d.groupBy("snapshot_no", "change_kind").agg(F.count(F.lit(1)).alias("n_rows"))


_ROWS = f"""WITH held AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_no, job_id ORDER BY delivered_at DESC NULLS LAST) AS rn
                 FROM posting_snapshots WHERE job_id IS NOT NULL AND snapshot_no IS NOT NULL) WHERE rn = 1),
nums AS (SELECT snapshot_no AS n, lag(snapshot_no) OVER (ORDER BY snapshot_no) AS prev FROM (SELECT DISTINCT snapshot_no FROM held)),
cur AS (SELECT h.*, nums.prev FROM held h JOIN nums ON h.snapshot_no = nums.n WHERE nums.prev IS NOT NULL),
old AS (SELECT h.*, nums.n AS nxt FROM held h JOIN nums ON h.snapshot_no = nums.prev),
diff AS (SELECT coalesce(c.snapshot_no, o.nxt) AS snapshot_no, coalesce(c.job_id, o.job_id) AS job_id,
  CASE WHEN o.job_id IS NULL THEN 'added' WHEN c.job_id IS NULL THEN 'removed'
       WHEN {" OR ".join(f"c.{f} IS DISTINCT FROM o.{f}" for f in FIELDS)} THEN 'changed' END AS change_kind,
  {", ".join(f"(c.job_id IS NOT NULL AND o.job_id IS NOT NULL AND c.{f} IS DISTINCT FROM o.{f}) AS d_{f}" for f in FIELDS)}
  FROM cur c FULL JOIN old o ON c.job_id = o.job_id AND c.snapshot_no = o.nxt)
"""

QUERIES = {"p1_found": p1_found, "p1_changed_fields": p1_changed_fields, "p1_summary": p1_summary}
SQL = {
    "p1_found": _ROWS + "SELECT snapshot_no, job_id, change_kind FROM diff WHERE change_kind IS NOT NULL",
    "p1_changed_fields": _ROWS + " UNION ALL ".join(f"SELECT snapshot_no, job_id, '{f}' AS field FROM diff WHERE d_{f}" for f in FIELDS),
    "p1_summary": _ROWS + "SELECT snapshot_no, change_kind, count(*) AS n_rows FROM diff WHERE change_kind IS NOT NULL GROUP BY ALL",
}
