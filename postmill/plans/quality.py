"""Queries that judge data: evaluation against gold rows, health rules, samples, labels, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.functions import rules
from postmill.plans.marts import _BEST, _CUR, best_extraction, current_postings
from postmill.plans.texts import SQL as TEXT_SQL
from postmill.plans.texts import lexicon_skills
from postmill.sources.tables import shared_dir, stored, table


def _gold_and_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, name, gold, found) of every skill that is in the rows kept or in the text, of postings with both."""
    ref = table(spark, sf_dir, "skill_reference").select("skill_id", F.lower("canonical_name").alias("name"))
    found = stored(lexicon_skills(spark, sf_dir).join(ref, "skill_id").select("job_id", "name").distinct(), f"{shared_dir(spark)}/found")
    gold = table(spark, sf_dir, "posting_skills").where("job_id is not null and skill is not null").select("job_id", F.lower(F.trim("skill")).alias("name")).where("name <> ''").distinct()
    judged = gold.select("job_id").distinct().join(found.select("job_id").distinct(), "job_id", "left_semi")
    g, f = gold.join(judged, "job_id", "left_semi").withColumn("gold", F.lit(1)), found.join(judged, "job_id", "left_semi").withColumn("found", F.lit(1))
    return g.join(f, ["job_id", "name"], "full").na.fill(0, ["gold", "found"])


def skill_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True and false positives and misses over all postings (micro counts), with precision and recall as exact ratios."""
    x = _gold_and_found(spark, sf_dir)
    c = x.agg(F.countDistinct("job_id").alias("n_postings"), F.count_if(F.expr("gold = 1 and found = 1")).alias("tp"), F.count_if(F.expr("gold = 0")).alias("fp"), F.count_if(F.expr("found = 0")).alias("fn"))
    return c.select("*", F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"))


def skill_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten names most often missed and most often extra; top-k, ties by name."""
    x = _gold_and_found(spark, sf_dir).where("gold <> found").groupBy("name", F.when(F.col("gold") == 1, "missed").otherwise("extra").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return x.withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "name"))).where("place <= 10").select("kind", "name", "n")


def rule_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the title rules agree with the kept attributes."""
    x = current_postings(spark, sf_dir).join(best_extraction(spark, sf_dir), "job_id").where("title is not null")
    same = lambda a, b: F.count_if(F.coalesce(a == b, F.lit(False)))
    return x.groupBy("extraction_method").agg(F.count(F.lit(1)).alias("n"), same(rules.role_family(F.col("title")), F.col("role_family")).alias("n_family"), same(rules.title_level(F.col("title")), F.col("seniority")).alias("n_level"))


def health_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per rule that a source breaks in the last snapshot: it is absent, or its rows fell below half of the one before."""
    s = table(spark, sf_dir, "posting_snapshots").where("snapshot_no is not null and source is not null and job_id is not null")
    n = s.groupBy("source", "snapshot_no").agg(F.countDistinct("job_id").alias("n"))
    last = s.select("snapshot_no").distinct().orderBy(F.desc("snapshot_no")).limit(2).agg(F.max("snapshot_no").alias("now"), F.min("snapshot_no").alias("prev"))
    sources = s.select("source").distinct().withColumn("one", F.lit(1)).join(last.withColumn("one", F.lit(1)), "one").drop("one")
    x = sources.join(n.select("source", F.col("snapshot_no").alias("now"), F.col("n").alias("n_now")), ["source", "now"], "left").join(n.select("source", F.col("snapshot_no").alias("prev"), F.col("n").alias("n_prev")), ["source", "prev"], "left")
    absent = x.where("n_now is null").select(F.lit("absent").alias("rule"), "source", F.lit(0).cast("long").alias("n_now"), F.coalesce("n_prev", F.lit(0)).alias("n_prev"))
    fell = x.where("n_now < 0.5 * n_prev").select(F.lit("fell").alias("rule"), "source", "n_now", "n_prev")
    whole = x.where("n_now is not null").select(F.lit("delivered").alias("rule"), "source", "n_now", F.coalesce("n_prev", F.lit(0)).alias("n_prev"))
    return absent.unionByName(fell).unionByName(whole)


def gold_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80 postings drawn by the hash of their id, the first 30 for development; a sampling operator."""
    h = F.md5(F.concat("job_id", F.lit(":7")))
    p = table(spark, sf_dir, "job_postings").where("job_id is not null").select("job_id").distinct().withColumn("h", h).orderBy("h").limit(80)
    return p.withColumn("r", F.row_number().over(Window.orderBy("h"))).select("job_id", F.when(F.col("r") <= 30, "dev").otherwise("test").alias("split"))


def gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled postings with what a labeller needs to see, as the last row of each has it."""
    cols = ["source", "company", "title", "url", "location", "posted_date", "raw_text"]
    s = gold_sample(spark, sf_dir)
    p = table(spark, sf_dir, "job_postings").join(s.select("job_id"), "job_id", "left_semi").groupBy("job_id").agg(F.max(F.struct("last_seen", "is_open", *cols)).alias("r"))
    return s.join(p, "job_id").select("job_id", "split", *[F.col("r")[c].alias(c) for c in cols])


def extend_sample(sample: DataFrame, pool: DataFrame, n_dev: int = 30, of: int = 80, seed: str = "7") -> DataFrame:
    """`sample` (job_id, split) and the postings of `pool` (job_id) that are not in it, in the order of a hash.

    A first sample takes n_dev for development whatever its size; later ones the share n_dev / of, rounded.
    """
    new = pool.where("job_id is not null").select("job_id").distinct().join(sample.select("job_id"), "job_id", "left_anti")
    n, first = new.count(), sample.limit(1).count() == 0
    dev = n_dev if first else max(0, round(n * n_dev / of))
    picked = new.withColumn("h", F.md5(F.concat("job_id", F.lit(f":{seed}")))).orderBy("h", "job_id").limit(dev).select("job_id", F.lit("dev").alias("split"))
    rest = new.join(picked.select("job_id"), "job_id", "left_anti").select("job_id", F.lit("test").alias("split"))
    return sample.select("job_id", "split").unionByName(picked).unionByName(rest)


def label_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label that holds for each posting, how often it was set and whether the last time changed it."""
    x = table(spark, sf_dir, "posting_lang").where("job_id is not null and declared_at is not null").distinct()
    w = Window.partitionBy("job_id").orderBy("declared_at", F.col("declared_lang").asc_nulls_first())
    r = x.withColumn("prev", F.lag("declared_lang").over(w)).withColumn("k", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("job_id")))
    return r.where("k = n").select("job_id", "declared_lang", F.col("n").alias("n_set"), ((F.col("n") > 1) & ~F.col("declared_lang").eqNullSafe(F.col("prev"))).alias("changed"))


def discovery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of each company and source, those at home, and its first eight titles by name; the limit is the report's."""
    p = table(spark, sf_dir, "job_postings").where("job_id is not null and company is not null")
    n = p.groupBy("company", "source").agg(F.countDistinct("job_id").alias("n_postings"), F.countDistinct(F.when(F.col("th_primary"), F.col("job_id"))).alias("n_home"))
    place = F.row_number().over(Window.partitionBy("company", "source").orderBy("title"))
    t = p.where("title is not null").select("company", "source", "title").distinct().withColumn("k", place).where("k <= 8")
    t = t.groupBy("company", "source").agg(F.array_join(F.array_sort(F.collect_list("title")), " | ").alias("first_titles"))
    return n.join(t.withColumnsRenamed({"company": "c", "source": "s"}), F.col("company").eqNullSafe(F.col("c")) & F.col("source").eqNullSafe(F.col("s")), "left").drop("c", "s")


def stats_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the state of the data as rows: counts in one aggregation each, and the parts of families, companies and the gold sample."""
    p = table(spark, sf_dir, "job_postings").where("job_id is not null")
    c = current_postings(spark, sf_dir)
    a = c.agg(F.count(F.lit(1)).alias("postings"), F.count_if("th_primary").alias("home"), F.count_if("is_open").alias("open"), F.countDistinct("company").alias("companies"), F.count_if(F.col("location").isNull()).alias("without_place"), F.count_if(F.col("n_duplicates") > 0).alias("groups"), F.coalesce(F.sum("n_duplicates").cast("long"), F.lit(0)).alias("merged"), F.countDistinct("source").alias("sources"))
    names = ["postings", "home", "open", "companies", "without_place", "groups", "merged", "sources"]
    out = a.select(F.expr(f"stack({len(names)}, " + ", ".join(f"'{n}', {n}" for n in names) + ") as (metric, value)"))
    thai = p.agg(F.countDistinct(F.when(F.col("raw_text").rlike("[฀-๿]"), F.col("job_id"))).alias("value")).select(F.lit("with_thai").alias("metric"), "value")
    pay = table(spark, sf_dir, "posting_attributes").where("job_id is not null").agg(F.countDistinct(F.when(F.col("salary_stated"), F.col("job_id"))).alias("value")).select(F.lit("pay_stated").alias("metric"), "value")
    part = lambda key, kind: c.groupBy(F.concat(F.lit(f"{kind}: "), key).alias("metric")).agg(F.count(F.lit(1)).alias("value")).where("metric is not null")
    done = table(spark, sf_dir, "posting_attributes").where("extraction_method like 'llm%'").select("job_id").distinct()
    gold = gold_sample(spark, sf_dir).join(done, "job_id", "left_semi").groupBy(F.concat(F.lit("gold done: "), "split").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    return out.unionByName(thai).unionByName(pay).unionByName(part(rules.role_family(F.col("title")), "family")).unionByName(part(F.col("company"), "company")).unionByName(gold)


def late_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last delivery of each snapshot against its date: days late and rows that came late."""
    s = table(spark, sf_dir, "posting_snapshots").where("snapshot_no is not null and snapshot_date is not null and delivered_at is not null")
    late = F.datediff(F.col("delivered_at").cast("date"), F.col("snapshot_date"))
    return s.groupBy("snapshot_no").agg(F.max(late).alias("most_days"), F.count_if(late > 0).alias("n_late"), F.count(F.lit(1)).alias("n_rows"))


_REF = "ref AS (SELECT skill_id, lower(canonical_name) AS name FROM skill_reference)"
_EVAL = f"""WITH {_REF}, lex AS ({TEXT_SQL["lexicon_skills"]}), found AS (SELECT DISTINCT job_id, name FROM lex JOIN ref ON ref.skill_id = lex.skill_id),
gold AS (SELECT DISTINCT job_id, lower(trim(skill, ' ')) AS name FROM posting_skills WHERE job_id IS NOT NULL AND skill IS NOT NULL AND trim(skill, ' ') <> ''),
j AS (SELECT DISTINCT job_id FROM gold WHERE job_id IN (SELECT job_id FROM found)),
x AS (SELECT coalesce(g.job_id, f.job_id) AS job_id, coalesce(g.name, f.name) AS name, g.name IS NOT NULL AS gold, f.name IS NOT NULL AS found FROM (SELECT * FROM gold WHERE job_id IN (SELECT job_id FROM j)) g FULL JOIN (SELECT * FROM found WHERE job_id IN (SELECT job_id FROM j)) f ON g.job_id = f.job_id AND g.name = f.name)"""
_FAMILY = "CASE " + " ".join(f"WHEN regexp_matches(title, '{p}', 'i') THEN '{n}'" for n, p in rules.ROLE_RULES) + " ELSE 'Other tech' END"
_LEVEL = "CASE " + " ".join(f"WHEN regexp_matches(title, '{p}', 'i') THEN '{n}'" for n, p in rules.LEVEL_RULES) + " ELSE 'unknown' END"
QUERIES = {f.__name__: f for f in (skill_evaluation, skill_errors, rule_accuracy, health_report, gold_sample, gold_rows, label_changes, discovery_counts, stats_metrics, late_postings)}
SQL = {
    "skill_evaluation": f"{_EVAL}, c AS (SELECT count(DISTINCT job_id) AS n_postings, count(*) FILTER (WHERE gold AND found) AS tp, count(*) FILTER (WHERE NOT gold) AS fp, count(*) FILTER (WHERE NOT found) AS fn FROM x) SELECT *, tp::double / nullif(tp + fp, 0) AS precision, tp::double / nullif(tp + fn, 0) AS recall FROM c",
    "skill_errors": f"{_EVAL}, e AS (SELECT name, CASE WHEN gold THEN 'missed' ELSE 'extra' END AS kind, count(*) AS n FROM x WHERE gold <> found GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, name) AS place FROM e) SELECT kind, name, n FROM r WHERE place <= 10",
    "rule_accuracy": f"WITH {_CUR}, {_BEST}, x AS (SELECT cur.title, best.* EXCLUDE (rn) FROM cur JOIN best ON best.job_id = cur.job_id WHERE cur.title IS NOT NULL) SELECT extraction_method, count(*) AS n, count(*) FILTER (WHERE {_FAMILY} = role_family) AS n_family, count(*) FILTER (WHERE {_LEVEL} = seniority) AS n_level FROM x GROUP BY 1",
    "health_report": """WITH s AS (SELECT * FROM posting_snapshots WHERE snapshot_no IS NOT NULL AND source IS NOT NULL AND job_id IS NOT NULL), n AS (SELECT source, snapshot_no, count(DISTINCT job_id) AS n FROM s GROUP BY 1, 2),
k AS (SELECT DISTINCT snapshot_no FROM s ORDER BY 1 DESC LIMIT 2), x AS (SELECT q.source, a.n AS n_now, b.n AS n_prev FROM (SELECT DISTINCT source FROM s) q LEFT JOIN n a ON a.source = q.source AND a.snapshot_no = (SELECT max(snapshot_no) FROM k) LEFT JOIN n b ON b.source = q.source AND b.snapshot_no = (SELECT min(snapshot_no) FROM k))
SELECT 'absent' AS rule, source, 0::bigint AS n_now, coalesce(n_prev, 0) AS n_prev FROM x WHERE n_now IS NULL UNION ALL SELECT 'fell', source, n_now, n_prev FROM x WHERE n_now < 0.5 * n_prev UNION ALL SELECT 'delivered', source, n_now, coalesce(n_prev, 0) FROM x WHERE n_now IS NOT NULL""",
    "gold_sample": "WITH p AS (SELECT job_id, md5(job_id || ':7') AS h FROM (SELECT DISTINCT job_id FROM job_postings WHERE job_id IS NOT NULL)), r AS (SELECT job_id, row_number() OVER (ORDER BY h) AS r FROM p) SELECT job_id, CASE WHEN r <= 30 THEN 'dev' ELSE 'test' END AS split FROM r WHERE r <= 80",
    "gold_rows": "WITH p AS (SELECT job_id, md5(job_id || ':7') AS h FROM (SELECT DISTINCT job_id FROM job_postings WHERE job_id IS NOT NULL)), r AS (SELECT job_id, row_number() OVER (ORDER BY h) AS r FROM p), l AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY last_seen DESC NULLS LAST, is_open DESC NULLS LAST, source DESC NULLS LAST, company DESC NULLS LAST, title DESC NULLS LAST, url DESC NULLS LAST, location DESC NULLS LAST, posted_date DESC NULLS LAST, raw_text DESC NULLS LAST) AS rn FROM job_postings) SELECT r.job_id, CASE WHEN r <= 30 THEN 'dev' ELSE 'test' END AS split, source, company, title, url, location, posted_date, raw_text FROM r JOIN l ON l.job_id = r.job_id AND rn = 1 WHERE r <= 80",
    "label_changes": "WITH x AS (SELECT DISTINCT * FROM posting_lang WHERE job_id IS NOT NULL AND declared_at IS NOT NULL), r AS (SELECT *, lag(declared_lang) OVER w AS prev, row_number() OVER w AS k, count(*) OVER (PARTITION BY job_id) AS n FROM x WINDOW w AS (PARTITION BY job_id ORDER BY declared_at, declared_lang NULLS FIRST)) SELECT job_id, declared_lang, n AS n_set, n > 1 AND declared_lang IS DISTINCT FROM prev AS changed FROM r WHERE k = n",
    "discovery_counts": """WITH p AS (SELECT * FROM job_postings WHERE job_id IS NOT NULL AND company IS NOT NULL), n AS (SELECT company, source, count(DISTINCT job_id) AS n_postings, count(DISTINCT job_id) FILTER (WHERE th_primary) AS n_home FROM p GROUP BY 1, 2),
t AS (SELECT company, source, string_agg(title, ' | ' ORDER BY title) AS first_titles FROM (SELECT company, source, title, row_number() OVER (PARTITION BY company, source ORDER BY title) AS k FROM (SELECT DISTINCT company, source, title FROM p WHERE title IS NOT NULL)) WHERE k <= 8 GROUP BY 1, 2)
SELECT n.*, first_titles FROM n LEFT JOIN t ON t.company = n.company AND t.source IS NOT DISTINCT FROM n.source""",
    "stats_metrics": f"WITH {_CUR}, a AS (SELECT count(*) AS postings, count(*) FILTER (WHERE th_primary) AS home, count(*) FILTER (WHERE is_open) AS open, count(DISTINCT company) AS companies, count(*) FILTER (WHERE location IS NULL) AS without_place, count(*) FILTER (WHERE n_duplicates > 0) AS groups, coalesce(sum(n_duplicates), 0)::bigint AS merged, count(DISTINCT source) AS sources FROM cur), "
    + "p AS (SELECT job_id, md5(job_id || ':7') AS h FROM (SELECT DISTINCT job_id FROM job_postings WHERE job_id IS NOT NULL)), r AS (SELECT job_id, row_number() OVER (ORDER BY h) AS r FROM p) "
    + " UNION ALL ".join(f"SELECT '{n}' AS metric, {n} AS value FROM a" for n in ("postings", "home", "open", "companies", "without_place", "groups", "merged", "sources"))
    + " UNION ALL SELECT 'with_thai', count(DISTINCT job_id) FILTER (WHERE regexp_matches(raw_text, '[฀-๿]')) FROM job_postings WHERE job_id IS NOT NULL UNION ALL SELECT 'pay_stated', count(DISTINCT job_id) FILTER (WHERE salary_stated) FROM posting_attributes WHERE job_id IS NOT NULL"
    + f" UNION ALL SELECT 'family: ' || {_FAMILY}, count(*) FROM cur GROUP BY 1 UNION ALL SELECT 'company: ' || company, count(*) FROM cur WHERE company IS NOT NULL GROUP BY 1"
    + " UNION ALL SELECT 'gold done: ' || CASE WHEN r <= 30 THEN 'dev' ELSE 'test' END, count(*) FROM r WHERE r <= 80 AND job_id IN (SELECT job_id FROM posting_attributes WHERE extraction_method LIKE 'llm%' AND job_id IS NOT NULL) GROUP BY 1",
    "late_postings": "SELECT snapshot_no, max(delivered_at::date - snapshot_date)::int AS most_days, count(*) FILTER (WHERE delivered_at::date > snapshot_date) AS n_late, count(*) AS n_rows FROM posting_snapshots WHERE snapshot_no IS NOT NULL AND snapshot_date IS NOT NULL AND delivered_at IS NOT NULL GROUP BY 1",
}
