"""Queries of the dashboard: filters, key figures, shares, trends, listings, pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.functions import rules
from postmill.plans.marts import _BEST, _CUR, best_extraction, current_postings
from postmill.sources.tables import shared_dir, stored, table


def filtered(spark: SparkSession, sf_dir: str, roles: tuple[str, ...] = ("Software Eng", "DA", "DS/ML", "Product"), home_only: bool | None = None, open_only: bool = False, method: str | None = None) -> DataFrame:
    """Postings with their attributes under the panel's filters; home_only False keeps unknown places, too."""
    v = current_postings(spark, sf_dir).join(best_extraction(spark, sf_dir), "job_id").where(F.col("role_family").isin(*roles))
    if home_only is not None:
        v = v.where("th_primary") if home_only else v.where("not (th_primary <=> true)")
    if open_only:
        v = v.where("is_open")
    return v.where(F.col("extraction_method").startswith(method)) if method else v


def panel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(spark, sf_dir, home_only=False, method="llm").select("job_id", "role_family", "seniority", "th_primary")


def _skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "posting_skills").where("job_id is not null and skill is not null and trim(skill) <> ''").select("job_id", "skill").distinct()


def panel_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key figures; the median of skills counts postings without any."""
    v = filtered(spark, sf_dir)
    n = _skills(spark, sf_dir).join(v.select("job_id"), "job_id", "left_semi").groupBy("job_id").agg(F.count(F.lit(1)).alias("n"))
    return v.join(n, "job_id", "left").agg(
        F.count(F.lit(1)).alias("n_postings"), F.countDistinct("company").alias("n_companies"), F.count_if("is_open").alias("n_open"), F.try_divide(F.count_if("is_open"), F.count("is_open")).alias("open_share"),
        F.expr("percentile(coalesce(n, 0), 0.5)").cast("int").alias("median_skills"), F.count_if(F.col("seniority") == "unknown").alias("n_unknown"),
    )


def _view_and_top(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(the filtered postings (job_id, role_family), their 15 top skills): both are computed once."""
    base = shared_dir(spark)
    v = stored(filtered(spark, sf_dir).select("job_id", "role_family"), f"{base}/view")
    return v, stored(_top(_skills(spark, sf_dir), v), f"{base}/top")


def top_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 skills of most postings with their share; a top-k report, ties by name."""
    return _top(_skills(spark, sf_dir), filtered(spark, sf_dir).select("job_id"))


def _top(skills: DataFrame, v: DataFrame) -> DataFrame:
    v = v.select("job_id")
    total = v.agg(F.count(F.lit(1)).alias("n_all")).withColumn("one", F.lit(1))
    n = skills.join(v, "job_id", "left_semi").groupBy("skill").agg(F.count(F.lit(1)).alias("n_postings")).withColumn("one", F.lit(1))
    return n.join(total, "one").select("skill", "n_postings", (F.col("n_postings") / F.col("n_all")).alias("share")).orderBy(F.desc("n_postings"), "skill").limit(15)


def share_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each group's postings with each of the top skills, 0 where none: the frame is built from the group sizes."""
    v, first = _view_and_top(spark, sf_dir)
    top = first.select("skill").agg(F.collect_list("skill").alias("skills")).withColumn("one", F.lit(1))  # 15 names
    frame = v.groupBy("role_family").agg(F.count(F.lit(1)).alias("n_group")).withColumn("one", F.lit(1)).join(top, "one").select("role_family", "n_group", F.explode("skills").alias("skill"))
    n = _skills(spark, sf_dir).join(first.select("skill"), "skill", "left_semi").join(v, "job_id").groupBy("role_family", "skill").agg(F.count(F.lit(1)).alias("n"))
    return frame.join(n, ["role_family", "skill"], "left").select("role_family", "skill", F.coalesce("n", F.lit(0)).alias("n_postings"), (F.coalesce("n", F.lit(0)) / F.col("n_group")).alias("share"), (F.col("n_group") < 10).alias("few"))


def weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active postings per week (Monday) and those naming one of the three top skills, 0 where none."""
    d = table(spark, sf_dir, "daily_active").where("job_id is not null and seen_date is not null").select(F.date_trunc("week", "seen_date").cast("date").alias("week"), "job_id").distinct()
    total = d.groupBy("week").agg(F.count(F.lit(1)).alias("n_active"))
    top = _view_and_top(spark, sf_dir)[1].orderBy(F.desc("n_postings"), "skill").limit(3).select("skill")
    names = top.agg(F.collect_list("skill").alias("skills")).withColumn("one", F.lit(1))
    n = d.join(_skills(spark, sf_dir).join(top, "skill", "left_semi"), "job_id").groupBy("week", "skill").agg(F.count(F.lit(1)).alias("n"))
    frame = total.withColumn("one", F.lit(1)).join(names, "one").select("week", "n_active", F.explode("skills").alias("skill"))
    return frame.join(n, ["week", "skill"], "left").select("week", "skill", "n_active", F.coalesce("n", F.lit(0)).alias("n_postings"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with their skills as one string, in the order of the lower-cased names."""
    s = _skills(spark, sf_dir).groupBy("job_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.lower("skill").alias("k"), "skill"))), lambda x: x["skill"]), ", ").alias("skills"))
    return filtered(spark, sf_dir, open_only=True).select("job_id", "title").join(s, "job_id", "left")


def company_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = current_postings(spark, sf_dir).where("company is not null").groupBy("company").agg(F.count(F.lit(1)).alias("n_postings"))
    return p.orderBy(F.desc("n_postings"), "company").limit(10)


def pay_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest and highest stated pay by level and currency, unpivoted to one row per bound."""
    b = table(spark, sf_dir, "posting_attributes").where("salary_currency is not null").groupBy("seniority", "salary_currency").agg(F.min("salary_min").alias("lowest"), F.max("salary_max").alias("highest"))
    return b.select("seniority", "salary_currency", F.expr("stack(2, 'lowest', lowest, 'highest', highest) as (bound, amount)")).where("amount is not null")


def family_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings by role family with a column per level."""
    levels = ["intern", "junior", "mid", "senior", "lead", "manager", "unknown"]
    p = best_extraction(spark, sf_dir).groupBy("role_family").pivot("seniority", levels).agg(F.count(F.lit(1)))
    return p.select("role_family", *[F.coalesce(x, F.lit(0)).alias(f"n_{x}") for x in levels])


def languages_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "posting_attributes").where("job_id is not null").select("job_id", F.explode("spoken_languages").alias("x"))
    return a.groupBy(rules.spoken_language(F.col("x")).alias("language")).agg(F.countDistinct("job_id").alias("n_postings")).where("language is not null")


def posting_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days between posting and first sight, and whether it was found late."""
    c = current_postings(spark, sf_dir).where("posted_date is not null and first_seen is not null")
    days = F.datediff("first_seen", "posted_date")
    return c.select("job_id", days.alias("days"), (days > 14).alias("late"), F.date_trunc("week", "first_seen").cast("date").alias("week"))


def props_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n_events"))


def event_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types of each user and day in their order, as one string. The whole path is the result, so the events of a user's day must fit in one row."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("day"), F.struct("ts", "event_id", "event_type").alias("x"))
    g = e.groupBy("user_id", "day").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return g.select("user_id", "day", F.array_join(F.transform("xs", lambda x: x["event_type"]), ">").alias("path"))


def skill_set_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills that a company asks for in its open postings only, in its closed ones only, and in both."""
    c = current_postings(spark, sf_dir).where("company is not null and is_open is not null").select("job_id", "company", "is_open")
    # one row a company and skill first, so that no company's skills meet in one row
    s = _skills(spark, sf_dir).join(c, "job_id").groupBy("company", "skill").agg(F.max("is_open").alias("o"), F.min("is_open").alias("all_open"))
    return s.groupBy("company").agg(F.count_if("all_open").alias("n_new"), F.count_if(F.expr("not o")).alias("n_gone"), F.count_if(F.expr("o and not all_open")).alias("n_both"))


def order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by order priority and year: the broadcast-free join of two large tables on their key."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    x = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return x.groupBy(F.year("o_orderdate").cast("long").alias("year"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))


_S = "s AS (SELECT DISTINCT job_id, skill FROM posting_skills WHERE job_id IS NOT NULL AND skill IS NOT NULL AND trim(skill, ' ') <> '')"
_V = "v AS (SELECT cur.*, best.role_family, best.seniority, best.extraction_method FROM cur JOIN best ON best.job_id = cur.job_id WHERE best.role_family IN ('Software Eng', 'DA', 'DS/ML', 'Product'))"
_HEAD = f"WITH {_CUR}, {_BEST}, {_V}, {_S}"
_TOP = f"{_HEAD}, t AS (SELECT skill, count(*) AS n_postings, count(*)::double / (SELECT count(*) FROM v) AS share FROM s WHERE job_id IN (SELECT job_id FROM v) GROUP BY skill ORDER BY n_postings DESC, skill LIMIT 15)"
_LEVELS = ["intern", "junior", "mid", "senior", "lead", "manager", "unknown"]
QUERIES = {f.__name__: f for f in (panel_filter, panel_kpis, top_skills, share_matrix, weekly_trend, listing, company_share, pay_by_level, family_by_level, languages_asked, posting_age, props_counts, event_paths, skill_set_changes, order_revenue)}
SQL = {
    "panel_filter": f"{_HEAD} SELECT job_id, role_family, seniority, th_primary FROM v WHERE th_primary IS DISTINCT FROM true AND extraction_method LIKE 'llm%'",
    "panel_kpis": f"{_HEAD}, n AS (SELECT job_id, count(*) AS n FROM s GROUP BY 1) SELECT count(*) AS n_postings, count(DISTINCT company) AS n_companies, count(*) FILTER (WHERE is_open) AS n_open, count(*) FILTER (WHERE is_open)::double / nullif(count(is_open), 0) AS open_share, trunc(median(coalesce(n, 0)))::int AS median_skills, count(*) FILTER (WHERE seniority = 'unknown') AS n_unknown FROM v LEFT JOIN n ON n.job_id = v.job_id",
    "top_skills": f"{_TOP} SELECT skill, n_postings, share FROM t",
    "share_matrix": f"{_TOP}, g AS (SELECT role_family, count(*) AS n_group FROM v GROUP BY 1), n AS (SELECT role_family, skill, count(*) AS n FROM s JOIN v ON v.job_id = s.job_id GROUP BY 1, 2) SELECT g.role_family, t.skill, coalesce(n, 0) AS n_postings, coalesce(n, 0)::double / n_group AS share, n_group < 10 AS few FROM g CROSS JOIN t LEFT JOIN n ON n.role_family = g.role_family AND n.skill = t.skill",
    "weekly_trend": f"{_TOP}, k AS (SELECT skill FROM t ORDER BY n_postings DESC, skill LIMIT 3), d AS (SELECT DISTINCT date_trunc('week', seen_date)::date AS week, job_id FROM daily_active WHERE job_id IS NOT NULL AND seen_date IS NOT NULL), a AS (SELECT week, count(*) AS n_active FROM d GROUP BY 1), n AS (SELECT week, skill, count(*) AS n FROM d JOIN s ON s.job_id = d.job_id GROUP BY 1, 2) SELECT a.week, k.skill, n_active, coalesce(n, 0) AS n_postings FROM a CROSS JOIN k LEFT JOIN n ON n.week = a.week AND n.skill = k.skill",
    "listing": f"{_HEAD}, l AS (SELECT job_id, string_agg(skill, ', ' ORDER BY lower(skill), skill) AS skills FROM s GROUP BY 1) SELECT v.job_id, title, skills FROM v LEFT JOIN l ON l.job_id = v.job_id WHERE is_open",
    "company_share": f"WITH {_CUR} SELECT company, count(*) AS n_postings FROM cur WHERE company IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "pay_by_level": "WITH b AS (SELECT seniority, salary_currency, min(salary_min) AS lo, max(salary_max) AS hi FROM posting_attributes WHERE salary_currency IS NOT NULL GROUP BY 1, 2) SELECT seniority, salary_currency, 'lowest' AS bound, lo AS amount FROM b WHERE lo IS NOT NULL UNION ALL SELECT seniority, salary_currency, 'highest', hi FROM b WHERE hi IS NOT NULL",
    "family_by_level": f"WITH {_BEST} SELECT role_family, " + ", ".join(f"count(*) FILTER (WHERE seniority = '{x}') AS n_{x}" for x in _LEVELS) + " FROM best GROUP BY 1",
    "languages_asked": "WITH a AS (SELECT job_id, trim(unnest(spoken_languages)) AS x FROM posting_attributes WHERE job_id IS NOT NULL) SELECT CASE " + " ".join(f"WHEN lower(x) = '{k}' THEN '{v}'" for k, v in rules.LANGUAGE_ALIASES.items()) + " ELSE upper(x[1]) || lower(x[2:]) END AS language, count(DISTINCT job_id) AS n_postings FROM a WHERE x <> '' GROUP BY 1",
    "posting_age": f"WITH {_CUR} SELECT job_id, (first_seen - posted_date)::int AS days, first_seen - posted_date > 14 AS late, date_trunc('week', first_seen)::date AS week FROM cur WHERE posted_date IS NOT NULL AND first_seen IS NOT NULL",
    "props_counts": "SELECT event_type, (props::json->>'$.k')::int AS k, count(*) AS n_events FROM events GROUP BY 1, 2",
    "event_paths": "SELECT user_id, ts::date AS day, string_agg(event_type, '>' ORDER BY ts, event_id) AS path FROM events GROUP BY 1, 2",
    "skill_set_changes": f"WITH {_CUR}, {_S}, c AS (SELECT company, skill, bool_or(is_open) AS o, bool_or(NOT is_open) AS c FROM s JOIN cur ON cur.job_id = s.job_id WHERE company IS NOT NULL AND is_open IS NOT NULL GROUP BY 1, 2) SELECT company, count(*) FILTER (WHERE o AND NOT c) AS n_new, count(*) FILTER (WHERE c AND NOT o) AS n_gone, count(*) FILTER (WHERE o AND c) AS n_both FROM c GROUP BY 1",
    "order_revenue": "SELECT year(o_orderdate) AS year, o_orderpriority, count(*) AS n_lines, sum(round(l_extendedprice * 100)::bigint)::bigint AS cents FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2",
}
