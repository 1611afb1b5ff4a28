"""Queries over the collection itself: runs, first versions, labels, progress, evaluation by model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import extraction, rules
from postmill.operators.evaluation import canonical_names, evaluate
from postmill.operators.labels import label_state, upsert
from postmill.operators.runlog import daily_totals, health_problems
from postmill.plans.marts import _BEST, _CUR, _FAMILY, best_extraction, current_postings
from postmill.plans.quality import gold_sample
from postmill.plans.texts import SQL as TEXT_SQL
from postmill.plans.texts import lexicon_skills
from postmill.sources.tables import table


def snapshot_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries of each company as a run log: one try a snapshot, company and day of delivery; it failed if a row came without an id."""
    s = table(spark, sf_dir, "posting_snapshots").where("snapshot_date is not null and source is not null and company is not null")
    g = s.groupBy(F.col("snapshot_date").alias("run_date"), "source", F.col("company").alias("token"), F.col("delivered_at").cast("date").alias("day"))
    runs = g.agg(F.unix_date("day").cast("long").alias("seq"), F.when(F.count("job_id") == F.count(F.lit(1)), "ok").otherwise("error").alias("status"), F.countDistinct("job_id").alias("n_jobs"))
    return runs.select("seq", "run_date", "source", "token", "status", "n_jobs", F.lit(None).cast("int").alias("http_status"), F.when(F.col("status") == "error", "row without an id").alias("error"))


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of each snapshot day by the last good try of each company; null where nothing came."""
    days = table(spark, sf_dir, "posting_snapshots").where("snapshot_date is not null").select(F.col("snapshot_date").alias("run_date"))
    return daily_totals(snapshot_runs(spark, sf_dir), days)


def company_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems of the last snapshot day among the companies that have open postings."""
    active = current_postings(spark, sf_dir).where("is_open and source is not null and company is not null").select("source", F.col("company").alias("token")).distinct()
    runs = snapshot_runs(spark, sf_dir)
    totals = run_totals(spark, sf_dir).where("raw_total is not null").orderBy(F.desc("run_date")).limit(2).collect()  # the last two days
    now, before = [r["raw_total"] for r in totals] + [None] * (2 - len(totals))
    last = table(spark, sf_dir, "posting_snapshots").agg(F.max("snapshot_date")).first()[0]
    return health_problems(runs, active, last, now, before)


def first_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each posting as the first snapshot had it."""
    s = table(spark, sf_dir, "posting_snapshots").where("job_id is not null and snapshot_no is not null")
    order = F.struct("snapshot_no", F.coalesce("title", F.lit("")).alias("t"), F.coalesce("company", F.lit("")).alias("c"), F.coalesce("location", F.lit("")).alias("l"))
    return s.groupBy("job_id").agg(F.min(order).alias("r")).select("job_id", F.col("r.snapshot_no").alias("snapshot_no"), F.col("r.t").alias("title"), F.col("r.c").alias("company"), F.col("r.l").alias("location"))


def untried_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of pages that have no target, compared without case and outer spaces, and how many pages they have."""
    key = lambda c: F.lower(F.trim(c))
    d = table(spark, sf_dir, "documents").where("source is not null").groupBy(key(F.col("source")).alias("source")).agg(F.count(F.lit(1)).alias("n_pages"))
    return d.join(table(spark, sf_dir, "mix_target").select(key(F.col("source")).alias("source")).where("source is not null"), "source", "left_anti")


def _last_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "posting_lang").where("job_id is not null and declared_at is not null")
    return p.groupBy("job_id").agg(F.max(F.struct("declared_at", F.coalesce("declared_lang", F.lit("")).alias("lang"))).alias("r")).select("job_id", F.nullif(F.trim("r.lang"), F.lit("")).alias("lang"))


def _page_langs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("job_id is not null and lang is not null").groupBy("job_id").agg(F.min(F.lower("lang")).alias("lang"))


def language_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each posting as labelled last, else as its first page says, else unknown."""
    sample = table(spark, sf_dir, "job_postings").where("job_id is not null").select("job_id").distinct()
    return label_state(sample, _last_label(spark, sf_dir), _page_langs(spark, sf_dir), {"lang": "'unknown'"})


def label_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels after the declared ones are taken as changes over the pages' languages."""
    changes = table(spark, sf_dir, "posting_lang").where("declared_at is not null").select("job_id", F.col("declared_lang").alias("lang"), F.struct("declared_at", F.coalesce("declared_lang", F.lit(""))).alias("seq"))
    none = spark.createDataFrame([], "job_id string, lang string, labeler string, human_edited boolean, changed_fields array<string>")
    u = upsert(none, changes, _page_langs(spark, sf_dir), ["lang"])
    return u.select("job_id", "lang", "labeler", "human_edited", F.array_join("changed_fields", ",").alias("changed_fields"))


def gold_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of each part of the sample and how many of them a model has done."""
    done = table(spark, sf_dir, "posting_attributes").where("extraction_method like 'llm%'").select("job_id").distinct().withColumn("done", F.lit(True))
    return gold_sample(spark, sf_dir).join(done, "job_id", "left").groupBy("split").agg(F.count_if("done").alias("n_done"), F.count(F.lit(1)).alias("n_all"))


def evaluation_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title and word rules, and each kept extraction method, against the kept attributes and typed skills.

    Gold are the postings whose best extraction is a model's; the skills of the
    rules are those that the text names, other methods predict none.
    """
    gold = table(spark, sf_dir, "posting_attributes").where("job_id is not null and extraction_method like 'llm%'").groupBy("job_id").agg(F.max(F.struct("role_family", "seniority", "salary_min", "salary_max")).alias("r")).select("job_id", "r.*")
    version = extraction.rules_version("rules", rules.ROLE_RULES, rules.LEVEL_RULES)
    none = F.lit(None).cast("double")
    by_rules = current_postings(spark, sf_dir).select(F.lit("rules").alias("model"), F.lit(version).alias("version"), "job_id", rules.title_level(F.col("title")).alias("seniority"), rules.role_family(F.col("title")).alias("role_family"), none.alias("salary_min"), none.alias("salary_max"))
    kept = best_extraction(spark, sf_dir).join(table(spark, sf_dir, "posting_attributes").groupBy("job_id").agg(F.max(F.struct("salary_min", "salary_max")).alias("s")), "job_id")
    kept = kept.select(F.lit("kept").alias("model"), F.col("extraction_method").alias("version"), "job_id", "seniority", "role_family", F.col("s.salary_min").alias("salary_min"), F.col("s.salary_max").alias("salary_max"))
    ref = table(spark, sf_dir, "skill_reference")
    aliases = ref.where("short_form is not null").select(F.col("short_form").alias("alias"), F.col("canonical_name").alias("canonical"))
    typed = canonical_names(table(spark, sf_dir, "posting_skills").where("job_id is not null"), aliases, ["job_id"])
    named = lexicon_skills(spark, sf_dir).join(ref.select("skill_id", F.lower("canonical_name").alias("name")), "skill_id").select(F.lit("rules").alias("model"), F.lit(version).alias("version"), "job_id", "name").distinct()
    return evaluate(gold, by_rules.unionByName(kept.where("version is not null")), typed, named).withColumn("version", F.regexp_replace("version", "^rules-.*", "rules"))


def first_event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events of each user in the order in which the user first had them; a user has at most as many as there are kinds."""
    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("at"))
    g = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("at", "event_type"))).alias("xs"))
    return g.select("user_id", F.array_join(F.transform("xs", lambda x: x["event_type"]), ">").alias("kinds"))


_RUNS = """runs AS (SELECT snapshot_date AS run_date, source, company AS token, delivered_at::date AS day, count(job_id) = count(*) AS ok, count(DISTINCT job_id) AS n_jobs
 FROM posting_snapshots WHERE snapshot_date IS NOT NULL AND source IS NOT NULL AND company IS NOT NULL GROUP BY ALL)"""
_TOTALS = """last AS (SELECT *, row_number() OVER (PARTITION BY run_date, source, token ORDER BY day DESC NULLS LAST) AS rn FROM runs WHERE ok),
totals AS (SELECT d.run_date, nullif(sum(n_jobs), 0)::bigint AS raw_total FROM (SELECT DISTINCT snapshot_date AS run_date FROM posting_snapshots WHERE snapshot_date IS NOT NULL) d LEFT JOIN last ON last.run_date = d.run_date AND rn = 1 GROUP BY 1)"""
_LABELS = """lab AS (SELECT job_id, nullif(trim(lang, ' '), '') AS lang FROM (SELECT job_id, coalesce(declared_lang, '') AS lang, row_number() OVER (PARTITION BY job_id ORDER BY declared_at DESC, coalesce(declared_lang, '') DESC) AS rn FROM posting_lang WHERE job_id IS NOT NULL AND declared_at IS NOT NULL) WHERE rn = 1),
draft AS (SELECT job_id, min(lower(lang)) AS lang FROM documents WHERE job_id IS NOT NULL AND lang IS NOT NULL GROUP BY 1)"""
_LEVEL = "CASE " + " ".join(f"WHEN regexp_matches(title, '{p}', 'i') THEN '{n}'" for n, p in rules.LEVEL_RULES) + " ELSE 'unknown' END"
QUERIES = {f.__name__: f for f in (run_totals, company_health, first_versions, untried_sources, language_labels, label_upserts, gold_progress, evaluation_by_model, first_event_order)}
SQL = {
    "run_totals": f"WITH {_RUNS}, {_TOTALS} SELECT run_date, raw_total FROM totals",
    "company_health": f"""WITH {_CUR}, {_RUNS}, {_TOTALS}, act AS (SELECT DISTINCT source, company AS token FROM cur WHERE is_open AND source IS NOT NULL AND company IS NOT NULL),
mine AS (SELECT runs.* FROM runs JOIN act ON act.source = runs.source AND act.token = runs.token), ld AS (SELECT max(run_date) AS d FROM mine),
now AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, token ORDER BY day DESC NULLS LAST, ok DESC, n_jobs DESC) AS rn FROM mine WHERE run_date = (SELECT d FROM ld)) WHERE rn = 1),
old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, token ORDER BY day DESC NULLS LAST, run_date DESC) AS rn FROM mine WHERE run_date < (SELECT d FROM ld) AND ok) WHERE rn = 1),
x AS (SELECT act.source, act.token, now.ok, now.n_jobs, old.n_jobs AS n_old FROM act LEFT JOIN now ON now.source = act.source AND now.token = act.token LEFT JOIN old ON old.source = act.source AND old.token = act.token),
t AS (SELECT raw_total, row_number() OVER (ORDER BY run_date DESC) AS k FROM totals WHERE raw_total IS NOT NULL)
SELECT CASE WHEN ok IS NULL THEN 'absent' WHEN NOT ok THEN 'failed' ELSE 'emptied' END AS rule, source, token, CASE WHEN NOT ok THEN 'error row without an id' WHEN ok THEN 'before: ' || n_old END AS detail FROM x WHERE ok IS NULL OR NOT ok OR n_jobs = 0 AND n_old > 0
UNION ALL SELECT 'stale', NULL, NULL, d::varchar FROM ld WHERE d <> (SELECT max(snapshot_date) FROM posting_snapshots)
UNION ALL SELECT 'fell', NULL, NULL, b.raw_total || ' ' || a.raw_total FROM t a JOIN t b ON a.k = 1 AND b.k = 2 WHERE a.raw_total < 0.5 * b.raw_total""",
    "first_versions": "SELECT job_id, snapshot_no, title, company, location FROM (SELECT job_id, snapshot_no, coalesce(title, '') AS title, coalesce(company, '') AS company, coalesce(location, '') AS location, row_number() OVER (PARTITION BY job_id ORDER BY snapshot_no, coalesce(title, ''), coalesce(company, ''), coalesce(location, '')) AS rn FROM posting_snapshots WHERE job_id IS NOT NULL AND snapshot_no IS NOT NULL) WHERE rn = 1",
    "untried_sources": "SELECT lower(trim(source, ' ')) AS source, count(*) AS n_pages FROM documents WHERE source IS NOT NULL AND lower(trim(source, ' ')) NOT IN (SELECT lower(trim(source, ' ')) FROM mix_target WHERE source IS NOT NULL) GROUP BY 1",
    "language_labels": f"WITH {_LABELS} SELECT p.job_id, CASE WHEN lab.job_id IS NOT NULL THEN lab.lang WHEN draft.job_id IS NOT NULL THEN draft.lang ELSE 'unknown' END AS lang, CASE WHEN lab.job_id IS NOT NULL THEN 'label' WHEN draft.job_id IS NOT NULL THEN 'draft' ELSE 'default' END AS origin FROM (SELECT DISTINCT job_id FROM job_postings WHERE job_id IS NOT NULL) p LEFT JOIN lab ON lab.job_id = p.job_id LEFT JOIN draft ON draft.job_id = p.job_id",
    "label_upserts": f"""WITH {_LABELS}, c AS (SELECT job_id, declared_lang AS lang FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY declared_at DESC, coalesce(declared_lang, '') DESC) AS rn FROM posting_lang WHERE job_id IS NOT NULL AND declared_at IS NOT NULL) WHERE rn = 1)
SELECT c.job_id, c.lang, CASE WHEN draft.job_id IS NULL THEN 'human' ELSE 'machine+human' END AS labeler, c.lang IS DISTINCT FROM draft.lang AS human_edited, CASE WHEN c.lang IS DISTINCT FROM draft.lang THEN 'lang' ELSE '' END AS changed_fields FROM c LEFT JOIN draft ON draft.job_id = c.job_id""",
    "gold_progress": "WITH p AS (SELECT job_id, md5(job_id || ':7') AS h FROM (SELECT DISTINCT job_id FROM job_postings WHERE job_id IS NOT NULL)), r AS (SELECT job_id, row_number() OVER (ORDER BY h) AS r FROM p) SELECT CASE WHEN r <= 30 THEN 'dev' ELSE 'test' END AS split, count(*) FILTER (WHERE job_id IN (SELECT job_id FROM posting_attributes WHERE extraction_method LIKE 'llm%' AND job_id IS NOT NULL)) AS n_done, count(*) AS n_all FROM r WHERE r <= 80 GROUP BY 1",
    "evaluation_by_model": f"""WITH {_CUR}, {_BEST}, gold AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY role_family DESC NULLS LAST, seniority DESC NULLS LAST, salary_min DESC NULLS LAST, salary_max DESC NULLS LAST) AS rn FROM posting_attributes WHERE job_id IS NOT NULL AND extraction_method LIKE 'llm%') WHERE rn = 1),
pay AS (SELECT * FROM (SELECT job_id, salary_min, salary_max, row_number() OVER (PARTITION BY job_id ORDER BY salary_min DESC NULLS LAST, salary_max DESC NULLS LAST) AS rn FROM posting_attributes) WHERE rn = 1),
pred AS (SELECT 'rules' AS model, 'rules' AS version, job_id, {_LEVEL} AS seniority, {_FAMILY} AS role_family, NULL::double AS salary_min, NULL::double AS salary_max FROM cur
 UNION ALL SELECT 'kept', extraction_method, best.job_id, best.seniority, best.role_family, pay.salary_min, pay.salary_max FROM best JOIN pay ON pay.job_id = best.job_id WHERE extraction_method IS NOT NULL),
n AS (SELECT job_id, lower(trim(regexp_replace(skill, '\\s+', ' ', 'g'), ' ')) AS name FROM posting_skills WHERE job_id IS NOT NULL AND skill IS NOT NULL),
typed AS (SELECT DISTINCT n.job_id, coalesce(lower(r.canonical_name), n.name) AS name FROM n LEFT JOIN skill_reference r ON lower(r.short_form) = n.name WHERE n.name <> ''),
lex AS ({TEXT_SQL["lexicon_skills"]}), named AS (SELECT DISTINCT 'rules' AS model, 'rules' AS version, job_id, lower(canonical_name) AS name FROM lex JOIN skill_reference r ON r.skill_id = lex.skill_id),
b AS (SELECT p.*, g.seniority AS gs, g.role_family AS gr, g.salary_min AS glo, g.salary_max AS ghi FROM pred p JOIN gold g ON g.job_id = p.job_id),
per AS (SELECT model, version, count(*) AS n_postings, count(*) FILTER (WHERE seniority IS NOT DISTINCT FROM gs) AS s_ok, count(*) FILTER (WHERE role_family IS NOT DISTINCT FROM gr) AS r_ok, count(*) FILTER (WHERE (salary_min IS NOT NULL OR salary_max IS NOT NULL) = (glo IS NOT NULL OR ghi IS NOT NULL)) AS st_ok,
 count(*) FILTER (WHERE glo IS NOT NULL OR ghi IS NOT NULL) AS n_stated, count(*) FILTER (WHERE (glo IS NOT NULL OR ghi IS NOT NULL) AND salary_min IS NOT DISTINCT FROM glo AND salary_max IS NOT DISTINCT FROM ghi) AS value_right FROM b GROUP BY 1, 2),
l AS (SELECT b.model, b.version, b.job_id, typed.name FROM b JOIN typed ON typed.job_id = b.job_id), q AS (SELECT named.* FROM named JOIN b ON b.model = named.model AND b.version = named.version AND b.job_id = named.job_id),
c AS (SELECT coalesce(l.model, q.model) AS model, coalesce(l.version, q.version) AS version, count(*) FILTER (WHERE l.name IS NOT NULL AND q.name IS NOT NULL) AS tp, count(*) FILTER (WHERE l.name IS NULL) AS fp, count(*) FILTER (WHERE q.name IS NULL) AS fn FROM l FULL JOIN q ON l.model = q.model AND l.version = q.version AND l.job_id = q.job_id AND l.name = q.name GROUP BY 1, 2),
m AS (SELECT d.model, d.version, coalesce(n_postings, 0) AS n_postings, coalesce(s_ok, 0) AS s_ok, coalesce(r_ok, 0) AS r_ok, coalesce(st_ok, 0) AS st_ok, coalesce(n_stated, 0) AS n_stated, coalesce(value_right, 0) AS value_right, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn
 FROM (SELECT DISTINCT model, version FROM pred) d LEFT JOIN per ON per.model = d.model AND per.version = d.version LEFT JOIN c ON c.model = d.model AND c.version = d.version)
SELECT model, version, n_postings, (SELECT count(*) FROM gold) - n_postings AS n_missing, tp, fp, fn, coalesce(tp::double / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp::double / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2.0 * tp::double / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
 s_ok::double / nullif(n_postings, 0) AS seniority_accuracy, r_ok::double / nullif(n_postings, 0) AS role_accuracy, st_ok::double / nullif(n_postings, 0) AS stated_accuracy, value_right, n_stated FROM m""",
    "first_event_order": "WITH f AS (SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY 1, 2), g AS (SELECT f.*, (SELECT min(event_id) FROM events e WHERE e.user_id = f.user_id AND e.event_type = f.event_type AND e.ts = f.ts) AS event_id FROM f) SELECT user_id, string_agg(event_type, '>' ORDER BY ts, event_id) AS kinds FROM g GROUP BY 1",
}
