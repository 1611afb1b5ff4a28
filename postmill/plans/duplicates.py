"""Queries on near-duplicate postings of a company."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import text
from postmill.operators.ranking import numbered
from postmill.operators.similarity import near_duplicate_groups
from postmill.sources.tables import shared_dir, stored, table


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "job_postings").select("job_id", "company", "title", "raw_text")


def near_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(_posts(spark, sf_dir)).distinct()


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(near_dup_groups(spark, sf_dir), f"{shared_dir(spark)}/groups").select("job_id", "group_id").distinct()


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, posted_date, title, url) of each posting: the oldest posted date, and the values of the row that has it."""
    p = table(spark, sf_dir, "job_postings").where("job_id is not null")
    order = F.struct(F.coalesce("posted_date", F.lit("9999-12-31").cast("date")).alias("posted_date"), "title", "url")
    return p.groupBy("job_id").agg(F.min(order).alias("r")).select("job_id", "r.*")


def representatives(members: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(group_id, job_id, n_members, duplicates): the representative of each group of `members` (group_id, job_id, posted_date) and the others, joined by commas.

    First comes who represented before (job_id), then the oldest posted date, then the smallest id. A
    group is aggregated by struct minima, and its list is its result; a null posted date comes last.
    """
    m = members.withColumn("again", F.lit(1))
    if before is not None:
        m = members.join(before.select("job_id").distinct().withColumn("old", F.lit(0)), "job_id", "left").withColumn("again", F.coalesce("old", F.lit(1)))
    order = F.struct("again", F.coalesce("posted_date", F.lit("9999-12-31").cast("date")).alias("posted_date"), "job_id")
    g = m.groupBy("group_id").agg(F.array_sort(F.collect_list(order)).alias("o"))
    rest = F.transform(F.slice("o", F.lit(2), F.greatest(F.size("o") - 1, F.lit(0))), lambda x: x["job_id"])
    return g.select("group_id", F.col("o")[0]["job_id"].alias("job_id"), F.size("o").cast("long").alias("n_members"), F.array_join(rest, ",").alias("duplicates"))


def canonical_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Representatives of the groups among the postings of the last collection day; who represented on the day before stays, if still there."""
    d = table(spark, sf_dir, "daily_active").where("job_id is not null and seen_date is not null").distinct()
    days = d.select("seen_date").distinct().orderBy(F.desc("seen_date")).limit(2).agg(F.max("seen_date").alias("now"), F.min("seen_date").alias("before"))
    members = _groups(spark, sf_dir).join(_facts(spark, sf_dir).select("job_id", "posted_date"), "job_id")
    on = lambda c: members.join(d.join(days.select(F.col(c).alias("seen_date")), "seen_date").select("job_id"), "job_id", "left_semi")
    return representatives(on("now"), representatives(on("before")))


def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the groups with more than one, in the order in which they would represent."""
    groups = _groups(spark, sf_dir)
    many = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_members")).where("n_members > 1")
    m = groups.join(many, "group_id").join(_facts(spark, sf_dir), "job_id")
    return numbered(m, ["group_id"], ["posted_date", "job_id"]).select("group_id", "job_id", "place", "n_members", "title", "url", F.nullif("posted_date", F.lit("9999-12-31").cast("date")).alias("posted_date"))


_C, _N = (f"coalesce(trim(regexp_replace(regexp_replace(lower({c}), '\\b({'|'.join(n.split())})\\b', ' ', 'g'), '[^{text.KEPT_LETTERS}]+', ' ', 'g')), '')" for c, n in (("company", text.COMPANY_NOISE), ("title", text.TITLE_NOISE)))
_GROUPS = f"""WITH RECURSIVE t AS (SELECT DISTINCT job_id, {_C} AS c, {_N} AS n, coalesce(trim(regexp_replace(lower(raw_text), '[^{text.KEPT_LETTERS}]+', ' ', 'g')), '') AS t FROM job_postings WHERE job_id IS NOT NULL),
u AS (SELECT *, replace(t, ' ', '') AS d, string_split(t, ' ') AS w FROM t),
s AS (SELECT job_id, c, n, CASE WHEN t = '' THEN []
 WHEN length(regexp_replace(d, '[^{text.UNSPACED_LETTERS}]', '', 'g')) > 0.3 * length(d) THEN CASE WHEN length(d) <= 8 THEN [d] ELSE list_sort(list_distinct(list_transform(range(1, length(d) - 6), lambda i: substring(d, i, 8)))) END
 WHEN len(w) <= 5 THEN [t] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) END AS toks FROM u),
k AS (SELECT *, CASE WHEN len(toks) = 0 THEN 't:' || n ELSE md5(array_to_string(toks, '|')) END AS form FROM s),
m AS (SELECT *, min(job_id) OVER (PARTITION BY c, form) AS class_id FROM k),
r AS (SELECT c, class_id, any_value(toks) AS toks, list(DISTINCT n) AS ns FROM m GROUP BY c, class_id),
x AS (SELECT c, class_id, len(toks) AS k, unnest(toks) AS h FROM r),
p AS (SELECT a.class_id AS a, b.class_id AS b, count(*)::double / (any_value(a.k) + any_value(b.k) - count(*)) AS sim FROM x a JOIN x b ON a.c = b.c AND a.h = b.h AND a.class_id < b.class_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN r ra ON ra.class_id = a JOIN r rb ON rb.class_id = b AND ra.c = rb.c WHERE sim >= 0.95 OR (sim >= 0.8 AND list_has_any(ra.ns, rb.ns))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a AS node, a AS other FROM e UNION SELECT reach.node, e.b FROM reach JOIN e ON reach.other = e.a),
lab AS (SELECT node, min(other) AS label FROM reach GROUP BY node),
deg AS (SELECT a AS class_id, count(*) AS n_links FROM e GROUP BY a),
g AS (SELECT DISTINCT m.job_id, coalesce(lab.label, m.class_id) AS group_id, coalesce(deg.n_links, 0) AS n_links FROM m LEFT JOIN lab ON lab.node = m.class_id LEFT JOIN deg ON deg.class_id = m.class_id)
"""
_FACTS = """, q AS (SELECT DISTINCT job_id, group_id FROM g), pd AS (SELECT * EXCLUDE (rn) FROM (SELECT job_id, coalesce(posted_date, DATE '9999-12-31') AS posted_date, title, url,
 row_number() OVER (PARTITION BY job_id ORDER BY coalesce(posted_date, DATE '9999-12-31'), title NULLS FIRST, url NULLS FIRST) AS rn FROM job_postings WHERE job_id IS NOT NULL) WHERE rn = 1)"""
QUERIES = {f.__name__: f for f in (near_dup_groups, canonical_postings, duplicate_report)}
SQL = {
    "near_dup_groups": _GROUPS + "SELECT job_id, group_id, n_links FROM g",
    "canonical_postings": _GROUPS + _FACTS + """, dd AS (SELECT DISTINCT seen_date FROM daily_active WHERE job_id IS NOT NULL AND seen_date IS NOT NULL ORDER BY seen_date DESC LIMIT 2),
a1 AS (SELECT DISTINCT job_id FROM daily_active WHERE seen_date = (SELECT max(seen_date) FROM dd)), a0 AS (SELECT DISTINCT job_id FROM daily_active WHERE seen_date = (SELECT min(seen_date) FROM dd)),
r0 AS (SELECT job_id FROM (SELECT q.job_id, row_number() OVER (PARTITION BY group_id ORDER BY posted_date, q.job_id) AS rn FROM q JOIN pd ON pd.job_id = q.job_id WHERE q.job_id IN (SELECT job_id FROM a0)) WHERE rn = 1),
z AS (SELECT group_id, q.job_id, row_number() OVER (PARTITION BY group_id ORDER BY CASE WHEN q.job_id IN (SELECT job_id FROM r0) THEN 0 ELSE 1 END, posted_date, q.job_id) AS rn FROM q JOIN pd ON pd.job_id = q.job_id WHERE q.job_id IN (SELECT job_id FROM a1))
SELECT group_id, max(job_id) FILTER (WHERE rn = 1) AS job_id, count(*) AS n_members, coalesce(string_agg(job_id, ',' ORDER BY rn) FILTER (WHERE rn > 1), '') AS duplicates FROM z GROUP BY group_id""",
    "duplicate_report": _GROUPS + _FACTS + """, z AS (SELECT group_id, q.job_id, title, url, nullif(posted_date, DATE '9999-12-31') AS posted_date, row_number() OVER (PARTITION BY group_id ORDER BY pd.posted_date, q.job_id) AS place, count(*) OVER (PARTITION BY group_id) AS n_members FROM q JOIN pd ON pd.job_id = q.job_id)
SELECT * FROM z WHERE n_members > 1""",
}
