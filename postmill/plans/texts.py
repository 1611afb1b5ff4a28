"""Queries on texts, titles, places and numbers of postings and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import extraction, rules, text
from postmill.operators.lexicon import named_entries
from postmill.sources.tables import table

EMAIL, PHONE = r"[\w.+-]+@[\w-]+\.[\w.-]+", r"\+66[0-9 -]{8,12}[0-9]"


def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long English pages: filters and the three columns reach the scan."""
    return table(spark, sf_dir, "documents").where("lang = 'en' and n_chars > 2000").select("doc_id", "source", "n_chars")


def stable_job_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "job_postings").select("job_id", text.stable_id(F.col("source"), F.col("job_id")).alias("stable_id")).distinct()


def norm_company_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "job_postings")
    return p.groupBy(text.company_key(F.col("company")).alias("company_key"), text.title_key(F.col("title")).alias("title_key")).agg(F.count(F.lit(1)).alias("n_rows"))


def redact_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and international numbers replaced in whole pages (the part of redact() that the oracle's patterns can say)."""
    return table(spark, sf_dir, "job_postings").where("raw_text is not null").select("job_id", F.regexp_replace(F.regexp_replace("raw_text", EMAIL, "[email removed]"), PHONE, "[phone removed]").alias("t")).select("job_id", F.md5("t").alias("redacted_md5")).distinct()


def redacted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "job_postings").where("raw_text is not null").select("job_id", text.redact(F.col("raw_text")).alias("text")).distinct()


def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of each posting, whose texts still hold markup."""
    return table(spark, sf_dir, "job_postings").where("raw_text is not null").select("job_id", text.html_to_text(F.col("raw_text")).alias("text")).distinct()


def salary_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "posting_attributes").where("job_id is not null")
    return a.select("job_id", F.explode(text.numbers_in(F.col("salary_text"))).alias("number")).distinct()


def evidence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Are the extracted numbers stated in the quoted words? Both null counts as nothing to prove."""
    a = table(spark, sf_dir, "posting_attributes").where("job_id is not null").distinct()
    nums = text.numbers_in(F.col("salary_text"))
    ok = lambda c: F.col(c).isNull() | F.array_contains(nums, F.col(c))
    none = F.col("salary_min").isNull() & F.col("salary_max").isNull()
    verdict = F.when(none, "nothing stated").when(ok("salary_min") & ok("salary_max"), "proved").otherwise("rejected")
    return a.select(verdict.alias("verdict"), "salary_min", "salary_max").groupBy("verdict").agg(F.count(F.lit(1)).alias("n_rows"), F.count("salary_min").alias("n_min"), F.count("salary_max").alias("n_max"))


def cleaned_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted attributes with everything blanked that the posting's own text doesn't prove, or that is no known value."""
    texts = table(spark, sf_dir, "job_postings").where("job_id is not null").groupBy("job_id").agg(F.max("raw_text").alias("raw_text"))
    a = table(spark, sf_dir, "posting_attributes").where("job_id is not null").join(texts, "job_id", "left")
    cols = ["job_id", "role_family", "seniority", *extraction.PAY, "salary_rejected", "salary_stated", "extraction_method"]
    return extraction.clean(a).select(*cols).distinct()


def role_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "job_postings")
    return p.groupBy(rules.role_family(F.col("title")).alias("role_family"), rules.title_level(F.col("title")).alias("level")).agg(F.count(F.lit(1)).alias("n_rows"))


def levels_by_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "job_postings").where("job_id is not null")
    return p.select("job_id", rules.level(F.col("title"), F.coalesce("raw_text", F.lit(""))).alias("level")).distinct()


def place_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "job_postings")
    none = F.lit(None).cast("string")
    home, first = rules.at_home(none, F.col("location")), rules.home_first(F.col("location"), none, none)
    return p.groupBy("location").agg(F.count(F.lit(1)).alias("n_rows"), F.max(home).alias("home"), F.max(first).alias("home_first"))


def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each posting, by its last row, in the first gate that stops it: repeated, elsewhere, other work, kept; and blank texts among the kept."""
    p = table(spark, sf_dir, "job_postings").where("job_id is not null")
    per = p.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("last_seen", "is_open", "title", "location", "raw_text")).alias("r")).select("n", "r.*")
    bucket = F.when(~rules.at_home(F.lit(None).cast("string"), F.col("location")), "elsewhere").when(F.coalesce(rules.role_family(F.col("title")) == "Other tech", F.lit(True)), "other work").otherwise("kept")
    per = per.select("n", bucket.alias("bucket"), (F.trim(F.coalesce("raw_text", F.lit(""))) == "").alias("blank"))
    return per.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_postings"), F.sum(F.col("n") - 1).alias("n_repeated"), F.count_if("blank").alias("n_blank"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of each text, case apart; the texts themselves are not shuffled, only their digests."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.md5(F.lower("text")).alias("digest"))
    return d.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"))


def script_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    thai = F.coalesce(F.col("text").rlike("[฀-๿]"), F.lit(False))
    return d.groupBy(F.lower("lang").alias("lang")).agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(thai).alias("n_thai"))


def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "job_postings").where("job_id is not null")
    return p.select("job_id", F.size(text.shingle_hashes(F.col("raw_text"))).cast("long").alias("n_shingles")).distinct()


def lexicon_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of the reference list that a text names, by their canonical name or their short form (see rules.lexicon_names)."""
    p = table(spark, sf_dir, "job_postings").where("job_id is not null and raw_text is not null").select("job_id", F.col("raw_text").alias("text"))
    ref = table(spark, sf_dir, "skill_reference")
    names = ref.select("skill_id", F.explode(F.array("canonical_name", "short_form")).alias("name"))
    return named_entries(p, names, "job_id", "skill_id").distinct()


def spelling_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings that differ in case and spaces only, with the entry of the list they write and the first spelling."""
    key = lambda c: F.trim(F.regexp_replace(F.lower(c), "[ \t]+", " "))
    s = table(spark, sf_dir, "posting_skills").where("skill is not null").select("job_id", "skill", key(F.col("skill")).alias("k")).where("k <> ''")
    ref = table(spark, sf_dir, "skill_reference").select(key(F.col("canonical_name")).alias("k"), "canonical_name")
    g = s.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("job_id").alias("n_postings"), F.min("skill").alias("least_spelling"))
    return g.join(ref, "k", "left").select(F.coalesce("canonical_name", "least_spelling").alias("skill"), "k", "n_rows", "n_postings", F.col("canonical_name").isNotNull().alias("known"))


def _case(c: str, pairs: tuple[tuple[str, str], ...], default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}', 'i') THEN '{n}'" for n, p in pairs) + f" ELSE '{default}' END"


_KEY = lambda c, noise: f"trim(regexp_replace(regexp_replace(lower({c}), '\\b({'|'.join(noise.split())})\\b', ' ', 'g'), '[^{text.KEPT_LETTERS}]+', ' ', 'g'))"
_HOME = f"coalesce(regexp_matches(location, '{rules.HOME_PLACES}', 'i'), false)"
_T = f"trim(regexp_replace(lower(raw_text), '[^{text.KEPT_LETTERS}]+', ' ', 'g'))"
_WORDS = lambda c: f"trim(regexp_replace({c}, '[^0-9A-Za-z+#]+', ' ', 'g'), ' ')"
_LIST = lambda words: ", ".join(f"'{w}'" for w in words.split())
_SKEY = lambda c: f"regexp_replace(regexp_replace(lower({c}), '[ \t]+', ' ', 'g'), '^ | $', '', 'g')"
_NUM = r"(\d[\d,]*(?:\.\d+)?)\s*([kK])?"

QUERIES = {f.__name__: f for f in (scan_filter_project, stable_job_id, norm_company_title, redact_notes, redacted_texts, plain_texts, salary_numbers, evidence_gate, cleaned_extractions, role_families, levels_by_years, place_flags, gate_counts, exact_dedup, script_share, shingle_counts, lexicon_skills, spelling_merge)}
SQL = {
    "scan_filter_project": "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en' AND n_chars > 2000",
    "stable_job_id": "SELECT DISTINCT job_id, sha1(concat_ws(':', source, job_id))[1:16] AS stable_id FROM job_postings",
    "norm_company_title": f"SELECT {_KEY('company', text.COMPANY_NOISE)} AS company_key, {_KEY('title', text.TITLE_NOISE)} AS title_key, count(*) AS n_rows FROM job_postings GROUP BY ALL",
    "redact_notes": f"SELECT DISTINCT job_id, md5(regexp_replace(regexp_replace(raw_text, '{EMAIL}', '[email removed]', 'g'), '{PHONE}', '[phone removed]', 'g')) AS redacted_md5 FROM job_postings WHERE raw_text IS NOT NULL",
    "salary_numbers": f"""WITH m AS (SELECT job_id, unnest(regexp_extract_all(salary_text, '{_NUM}', 1)) AS d, unnest(regexp_extract_all(salary_text, '{_NUM}', 2)) AS k FROM posting_attributes WHERE job_id IS NOT NULL),
n AS (SELECT job_id, k, try_cast(replace(d, ',', '') AS double) AS v FROM m)
SELECT job_id, v AS number FROM n WHERE v IS NOT NULL UNION SELECT job_id, v * 1000 FROM n WHERE v IS NOT NULL AND k <> ''""",
    "evidence_gate": f"""WITH a AS (SELECT DISTINCT * FROM posting_attributes WHERE job_id IS NOT NULL),
b AS (SELECT *, list_transform(regexp_extract_all(coalesce(salary_text, ''), '{_NUM}', 1), lambda x: try_cast(replace(x, ',', '') AS double)) AS ns FROM a),
c AS (SELECT CASE WHEN salary_min IS NULL AND salary_max IS NULL THEN 'nothing stated'
 WHEN (salary_min IS NULL OR list_contains(ns, salary_min) OR list_contains(list_transform(ns, lambda x: x * 1000), salary_min) AND regexp_matches(salary_text, '[0-9]\\s*[kK]'))
  AND (salary_max IS NULL OR list_contains(ns, salary_max) OR list_contains(list_transform(ns, lambda x: x * 1000), salary_max) AND regexp_matches(salary_text, '[0-9]\\s*[kK]')) THEN 'proved' ELSE 'rejected' END AS verdict, salary_min, salary_max FROM b)
SELECT verdict, count(*) AS n_rows, count(salary_min) AS n_min, count(salary_max) AS n_max FROM c GROUP BY verdict""",
    "cleaned_extractions": f"""WITH t AS (SELECT job_id, max(raw_text) AS raw_text FROM job_postings WHERE job_id IS NOT NULL GROUP BY job_id),
a AS (SELECT a.*, trim(coalesce(salary_text, ''), ' ') AS q, lower(regexp_replace(t.raw_text, '\\s+', ' ', 'g')) AS body FROM posting_attributes a LEFT JOIN t ON t.job_id = a.job_id WHERE a.job_id IS NOT NULL),
b AS (SELECT *, list_transform(regexp_extract_all(q, '{_NUM}', 1), lambda x: try_cast(replace(x, ',', '') AS double)) AS ns, regexp_matches(q, '[0-9]\\s*[kK]') AS k FROM a),
c AS (SELECT *, (salary_min IS NOT NULL OR salary_max IS NOT NULL) AS has, q <> '' AND coalesce(contains(body, lower(regexp_replace(q, '\\s+', ' ', 'g'))), false)
 AND (salary_min IS NULL OR list_contains(ns, salary_min) OR k AND list_contains(ns, salary_min / 1000)) AND (salary_max IS NULL OR list_contains(ns, salary_max) OR k AND list_contains(ns, salary_max / 1000)) AS ok FROM b),
d AS (SELECT *, has AND ok AS kept FROM c)
SELECT DISTINCT job_id, CASE WHEN role_family IN ({", ".join(f"'{x}'" for x in extraction.FAMILIES)}) THEN role_family ELSE 'Other tech' END AS role_family, CASE WHEN seniority IN ({", ".join(f"'{x}'" for x in extraction.LEVELS)}) THEN seniority ELSE 'unknown' END AS seniority,
 CASE WHEN kept THEN CASE WHEN salary_min > salary_max THEN salary_max ELSE salary_min END END AS salary_min, CASE WHEN kept THEN CASE WHEN salary_min > salary_max THEN salary_min ELSE salary_max END END AS salary_max,
 CASE WHEN kept THEN salary_currency END AS salary_currency, CASE WHEN kept AND salary_period IN ({", ".join(f"'{x}'" for x in extraction.PERIODS)}) THEN salary_period END AS salary_period, CASE WHEN kept THEN salary_text END AS salary_text, has AND NOT ok AS salary_rejected, kept AS salary_stated, extraction_method FROM d""",
    "role_families": f"SELECT {_case('title', rules.ROLE_RULES, 'Other tech')} AS role_family, {_case('title', rules.LEVEL_RULES, 'unknown')} AS level, count(*) AS n_rows FROM job_postings GROUP BY ALL",
    "place_flags": f"SELECT location, count(*) AS n_rows, bool_or({_HOME}) AS home, bool_or({_HOME} AND NOT coalesce(regexp_matches(location, ';|\\bor\\b', 'i'), false)) AS home_first FROM job_postings GROUP BY location",
    "gate_counts": f"""WITH p AS (SELECT * FROM (SELECT job_id, title, location, raw_text, count(*) OVER (PARTITION BY job_id) AS n, row_number() OVER (PARTITION BY job_id ORDER BY last_seen DESC NULLS LAST, is_open DESC NULLS LAST, title DESC NULLS LAST, location DESC NULLS LAST, raw_text DESC NULLS LAST) AS rn FROM job_postings WHERE job_id IS NOT NULL) WHERE rn = 1)
SELECT CASE WHEN NOT {_HOME} THEN 'elsewhere' WHEN {_case('title', rules.ROLE_RULES, 'Other tech')} = 'Other tech' THEN 'other work' ELSE 'kept' END AS bucket,
 count(*) AS n_postings, sum(n - 1) AS n_repeated, count(*) FILTER (WHERE trim(coalesce(raw_text, '')) = '') AS n_blank FROM p GROUP BY 1""",
    "exact_dedup": "SELECT md5(lower(text)) AS digest, min(doc_id) AS doc_id, count(*) AS n_copies FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "script_share": "SELECT lower(lang) AS lang, count(*) AS n_pages, count(*) FILTER (WHERE regexp_matches(text, '[฀-๿]')) AS n_thai FROM documents GROUP BY 1",
    "shingle_counts": f"""WITH t AS (SELECT DISTINCT job_id, {_T} AS t FROM job_postings WHERE job_id IS NOT NULL),
u AS (SELECT job_id, t, replace(t, ' ', '') AS d, string_split(t, ' ') AS w FROM t)
SELECT job_id, CASE WHEN t IS NULL OR t = '' THEN 0
 WHEN length(regexp_replace(d, '[^{text.UNSPACED_LETTERS}]', '', 'g')) > 0.3 * length(d) THEN CASE WHEN length(d) <= 8 THEN 1 ELSE len(list_distinct(list_transform(range(1, length(d) - 6), lambda i: substring(d, i, 8)))) END
 WHEN len(w) <= 5 THEN 1 ELSE len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) END AS n_shingles FROM u""",
    "lexicon_skills": f"""WITH p AS (SELECT DISTINCT job_id, ' ' || {_WORDS('raw_text')} || ' ' AS t FROM job_postings WHERE job_id IS NOT NULL AND raw_text IS NOT NULL),
q AS (SELECT *, lower(t) AS l FROM p), r AS (SELECT skill_id, {_WORDS('name')} AS n FROM (SELECT skill_id, unnest([canonical_name, short_form]) AS name FROM skill_reference) WHERE name IS NOT NULL)
SELECT DISTINCT job_id, skill_id FROM q JOIN r ON n <> '' AND lower(n) NOT IN ({_LIST(rules.NEVER_ALONE)})
 AND CASE WHEN length(n) <= {rules.EXACT_UP_TO} THEN contains(t, ' ' || n || ' ') WHEN lower(n) IN ({_LIST(rules.CAPITAL_ONLY)}) THEN contains(t, ' ' || upper(n[1]) || n[2:] || ' ') ELSE contains(l, ' ' || lower(n) || ' ') END""",
    "spelling_merge": f"""WITH s AS (SELECT job_id, skill, {_SKEY('skill')} AS k FROM posting_skills WHERE skill IS NOT NULL),
g AS (SELECT k, count(*) AS n_rows, count(DISTINCT job_id) AS n_postings, min(skill) AS least FROM s WHERE k <> '' GROUP BY k)
SELECT coalesce(canonical_name, least) AS skill, g.k, n_rows, n_postings, canonical_name IS NOT NULL AS known FROM g LEFT JOIN (SELECT {_SKEY('canonical_name')} AS k, canonical_name FROM skill_reference) r ON g.k = r.k""",
}
