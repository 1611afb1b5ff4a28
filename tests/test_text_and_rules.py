import random
import re

import pytest
from pyspark.sql import functions as F

from postmill.functions import extraction, rules, text


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize("a, b", [("ORVANE Logistics Public Company Limited", "orvane logistics"), ("Brix & Sons Inc.", "brix   sons"), ("(Thailand) Velo Corp", "VELO")])
def test_companies_in_other_words(spark, a, b):
    assert one(spark, a, text.company_key) == one(spark, b, text.company_key)


def test_keys_keep_unspaced_scripts_and_nothing_else(spark):
    assert one(spark, "Remote: Ledger Keeper, relocation provided", text.title_key) == "ledger keeper"
    assert one(spark, "東京 Büro ๓", text.company_key) == "東京 b ro ๓"
    assert one(spark, "Привет 안녕", text.title_key) == "" and one(spark, "", text.title_key) == "" and one(spark, None, text.company_key) is None


def test_stable_id(spark):
    import hashlib

    a = spark.range(1).select(text.stable_id(F.lit("board"), F.lit("77")).alias("i")).first()["i"]
    assert a == hashlib.sha1(b"board:77").hexdigest()[:16]


def test_redact_is_idempotent_and_keeps_long_numbers(spark):
    r = one(spark, "To q.z+1@mail.lor.example, 02-555-0199 or +66 2 555 0199; parcel 5550199000111222.", text.redact)
    assert r == "To [email removed], [phone removed] or [phone removed]; parcel 5550199000111222."
    assert one(spark, r, text.redact) == r and one(spark, None, text.redact) is None


def test_numbers(spark):
    assert one(spark, "30K-45,500.25 a month", text.numbers_in) == [30.0, 30000.0, 45500.25]
    assert one(spark, None, text.numbers_in) == [] and one(spark, "a lot", text.numbers_in) == []


def test_shingles_sizes(spark):
    n = lambda t: len(one(spark, t, text.shingle_hashes))
    assert n("") == 0 and n("...") == 0 and n("alone") == 1 and one(spark, None, text.shingle_hashes) == []
    assert n(" ".join(f"t{i}" for i in range(12))) == 8 and n("กขคงจฉชซฌญฎ") == 4 and n("again " * 3000) == 1
    assert len(set(map(str, (one(spark, t, text.shingle_hashes) for t in ("a b", "b a", "ab", "a b c"))))) == 4


def test_shingles_against_sets_of_words(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(5, 40))) for _ in range(12)]
    got = [set(r["x"]) for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string").orderBy("i").select(text.shingle_hashes(F.col("c")).alias("x")).collect()]
    want = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    for a, b in zip(want, got, strict=True):
        assert len(a) == len(b)
        for c, d in zip(want, got, strict=True):
            assert len(a & c) == len(b & d)


def test_visible_texts():
    pages = [
        "<h2>Tasks</h2><UL><li class='x>y'>count&nbsp;stock <li>load\tvans</UL>", "<table><tr><td>9</td><th>10</th></tr><tr><td>11</table>", "a &lt; b <!-- <p>no</p> --> c<br/>d<style>p{x}</style>", "<p> ​ </p>\n\n<script>let a='<p>'", "2 < 3 and <i>5</i> > 4", "",
        "<title>kept</title><SCRIPT type=a>x</SCRIPT >&#3588;&eacute;",
    ]
    assert text.visible_texts(pages) == ["Tasks\ncount stock\nload vans", "9 10\n11", "a < b c\nd", "", "2 < 3 and 5 > 4", "", "keptคé"]
    assert text.visible_texts(["&lt;p&gt;cash &amp;amp; carry&lt;/p&gt;&lt;p&gt;x", "&amp;lt;br&amp;gt;deep", "plain"], True) == ["cash & carry\nx", "deep", "plain"]
    assert text.visible_texts([]) == []


def test_pages_of_a_batch_do_not_meet(spark):
    pages = ["<b", "x>y", None, "<!-- open", "still here", "<script>", "and here", "&am", "p;", "a\x00b"] * 30
    got = [r["x"] for r in spark.createDataFrame(list(enumerate(pages)), "i int, c string").repartition(3).select("i", text.html_to_text(F.col("c")).alias("x")).orderBy("i").collect()]
    assert got == [text.visible_texts([p or ""])[0] for p in pages] and got[4] == "still here" and got[6] == "and here"


def test_long_markup_takes_linear_time():
    for piece in ("<a ", "<a x='", "<!-- ", "<script ", "&lt;", "<" * 9):
        assert len(text.visible_texts([piece * 30_000])) == 1


def test_role_families_and_levels(spark):
    fam = lambda t: one(spark, t, rules.role_family)
    cases = {"IT Business Analyst": "SA", "Insights Analyst II": "BA", "Head of Data Platform": "Data Eng", "Technical Product Owner": "Product", "LLM Researcher": "DS/ML", "Site SRE": "Software Eng", "BI Developer": "DA", "Reporting Analyst": "DA", "QA": "Software Eng", "Barista": "Other tech", None: "Other tech"}
    assert {t: fam(t) for t in cases} == cases
    lev = lambda t: one(spark, t, rules.title_level)
    cases = {"Internship, Finance": "intern", "International Buyer": "unknown", "Director, Senior Accounts": "manager", "Manager": "manager", "Product Manager": "unknown", "Principal Chef": "lead", "Sr. Baker": "senior", "New Graduate Nurse": "junior", None: "unknown"}
    assert {t: lev(t) for t in cases} == cases


def near_years(body):
    """The rule in plain words: years under 30 with the whole word within 100 characters on either side."""
    got = []
    for m in re.finditer(r"(\d{1,2})(?:\s*\+|\s*-\s*\d+\+?)?\s*\+?\s*years?", body, re.I):
        if int(m[1]) < 30 and "experience" in body[max(0, m.start() - 100) : m.end() + 100].lower():
            got.append(int(m[1]))
    return "unknown" if not got else "junior" if max(got) < 2 else "mid" if max(got) < 5 else "senior"


def test_levels_by_years_against_brute_force(spark):
    rng = random.Random(5)
    words = ["experience", "Experience", "2 years", "7+ years", "1 year", "3-6 years", "45 years", "x" * 30, "y" * 45, "of", "in SQL", "\n"]
    bodies = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 9))) for _ in range(300)]
    bodies += ["experience: 1 year here, 4 years there", "6 years " + "z" * 82 + " experience", "6 years " + "z" * 92 + " experience", "experience" + "z" * 89 + " 6 years", "experience" + "z" * 90 + " 6 years"]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, b string")
    got = [r["x"] for r in df.orderBy("i").select(rules.level(F.lit("Clerk"), F.col("b")).alias("x")).collect()]
    assert got == [near_years(b) for b in bodies] and len(set(got)) == 4
    assert one(spark, "9 years of experience", lambda c: rules.level(F.lit("Junior Clerk"), c)) == "junior"


def test_places(spark):
    def first(loc, more=None, code=None):
        return spark.createDataFrame([(loc, more, code)], "l string, m string, c string").select(rules.home_first(F.col("l"), F.col("m"), F.col("c")).alias("x")).first()["x"]

    assert first("Rayong") and first("Anywhere", "Chonburi", "TH") and not first("Anywhere", "Lima; Rayong", "TH")
    assert not first("Phuket; Hanoi") and not first("Oslo or Rayong") and not first("Lima") and not first(None)


def test_extractions_keep_only_what_the_text_proves(spark):
    schema = "role_family string, seniority string, salary_min double, salary_max double, salary_currency string, salary_period string, salary_text string, raw_text string, job_id string"
    body = "We pay  40k -\n55,000 THB a month."
    rows = [
        ("BA", "mid", 40000.0, 55000.0, "THB", "month", "40K - 55,000 thb", body, "proved"), ("Chef", "boss", 55000.0, 40000.0, "THB", "fortnight", "40k - 55,000", body, "turned"), (None, None, 41000.0, None, "THB", "month", "40k - 55,000", body, "number"),
        ("BA", "mid", 60000.0, None, "THB", "month", "60,000 THB", body, "words"), ("BA", "mid", None, None, "THB", "month", "good pay", body, "empty"), ("BA", "mid", float("nan"), None, "THB", None, "x", None, "nan"), ("BA", "mid", 5.0, None, None, None, None, body, "unquoted"),
    ]
    got = {r["job_id"]: r for r in extraction.clean(spark.createDataFrame(rows, schema)).collect()}
    assert (got["proved"]["salary_min"], got["proved"]["salary_max"], got["proved"]["salary_period"]) == (40000.0, 55000.0, "month")
    assert (got["turned"]["salary_min"], got["turned"]["salary_max"], got["turned"]["salary_period"], got["turned"]["role_family"], got["turned"]["seniority"]) == (40000.0, 55000.0, None, "Other tech", "unknown")
    assert {k for k, r in got.items() if r["salary_rejected"]} == {"number", "words", "unquoted"} and {k for k, r in got.items() if r["salary_stated"]} == {"proved", "turned"}
    assert all(got[k][c] is None for k in ("number", "words", "empty", "nan", "unquoted") for c in extraction.PAY)


def test_first_spellings_and_versions(spark):
    assert one(spark, ["b", " SQL", "sql", None, " ", "Ant", "ANT"], extraction.first_spellings, "array<string>") == ["Ant", "b", "SQL"]
    assert one(spark, None, extraction.first_spellings, "array<string>") == []
    assert extraction.rules_version("r", ("a",)) == extraction.rules_version("r", ("a",)) != extraction.rules_version("r", ("b",))
