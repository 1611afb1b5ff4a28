import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.operators.components import connected_components
from postmill.operators.evaluation import canonical_names, evaluate
from postmill.operators.labels import label_state, upsert
from postmill.operators.lexicon import named_entries
from postmill.operators.mart_build import EXTRACTION, build_and_publish
from postmill.operators.ranking import numbered
from postmill.operators.runlog import daily_totals, health_problems, last_rows, log_run
from postmill.operators.similarity import class_links, near_duplicate_groups, text_classes
from postmill.operators.snapshot_diff import snapshot_diff
from postmill.plans.duplicates import representatives
from postmill.plans.quality import extend_sample

SNAP = "snapshot_no int, job_id string, a string, b int, delivered_at timestamp, k string"
T0 = datetime(2026, 1, 1)


def changes(spark, rows):
    d = snapshot_diff(spark.createDataFrame(rows, SNAP), ["a", "b"])
    return {(r["snapshot_no"], r["job_id"]): (r["change_kind"], r["changed_fields"]) for r in d.collect()}


def test_snapshot_cases(spark):
    rows = [
        (1, "x", "p", 1, T0, "clash"), (1, "y", None, 2, T0, ""), (1, "gone", "q", 1, T0, None), (1, None, "z", 1, T0, None),
        (3, "x", "p", 1, T0, ""), (3, "y", None, 5, T0, ""), (3, "new", "p", 1, T0, ""),
        (3, "x", "OLD", 1, T0 - timedelta(days=1), ""), (3, "x", "p", 1, T0, ""), (4, "x", None, 1, None, ""), (4, "y", None, 5, T0, ""), (4, "new", "p", 1, T0, ""),
    ]
    assert changes(spark, rows) == {(3, "y"): ("changed", ["b"]), (3, "gone"): ("removed", []), (3, "new"): ("added", []), (4, "x"): ("changed", ["a"])}
    assert changes(spark, []) == {}
    assert changes(spark, rows[:2]) == {}


def test_snapshots_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, 5]), rng.choice(["a", "b", "c", "d", "e", None]), rng.choice(["u", "v", None]), rng.choice([1, None]), T0 + timedelta(hours=i), "") for i in range(60)]
    held = {}
    for r in rows:
        if r[1] is not None:
            held[r[0], r[1]] = r[2:4]
    want, nums = {}, sorted({n for n, _ in held})
    for p, n in zip(nums, nums[1:], strict=False):
        for k in {k for m, k in held if m in (p, n)}:
            old, new = held.get((p, k)), held.get((n, k))
            if old != new:
                want[n, k] = "added" if old is None else "removed" if new is None else "changed"
    assert {k: v[0] for k, v in changes(spark, rows).items()} == want


def brute(edges):
    label = {}
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        x, y = label.setdefault(a, {a}), label.setdefault(b, {b})
        if x is not y:
            x |= y
            for v in y:
                label[v] = x
    return {k: min(v) for k, v in label.items()}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=25))
def test_components_random(spark, edges):
    got = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {r["node"]: r["label"] for r in got.collect()} == brute(edges)


def test_components_chain_and_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(None, 3), (7, 7), (0, 1)]
    got = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {r["node"]: r["label"] for r in got.collect()} == dict.fromkeys(range(41), 0)


POST = "job_id string, company string, title string, raw_text string, class_id string"
LONG = " ".join(f"task{i} of{i % 7} the{i % 3} day" for i in range(60))


def groups(spark, *rows):
    g = near_duplicate_groups(spark.createDataFrame([(f"{i:02}", *r, "clash") for i, r in enumerate(rows)], POST))
    return {r["job_id"]: (r["group_id"], r["n_links"]) for r in g.collect()}


def test_near_duplicates(spark):
    thai = "งานดูแลคลังสินค้าและจัดส่งพัสดุให้ลูกค้าทุกวันจันทร์ถึงศุกร์"
    got = groups(
        spark, ("Orvane Ltd", "Stock Keeper", LONG), ("ORVANE", "Stock Keeper (Remote)", LONG + " with a short end"), ("Orvane", "Van Loader", LONG), ("Brix", "Stock Keeper", LONG), ("Brix", "Cook", LONG + " and a rather longer end " + " ".join(f"more{i}" for i in range(25))),
        ("Brix", "Cook", None), ("Brix", "Cook", " !! "), ("Brix", "Baker", ""), (None, None, None), ("", "", ""), ("Velo", "Aide", "short text"), ("Velo", "Aide", "Short, text!"), ("Velo", "Clerk", thai), ("Velo", "Guard", thai),
    )
    assert {k: v[0] for k, v in got.items()} == {"00": "00", "01": "00", "02": "00", "03": "03", "04": "04", "05": "05", "06": "05", "07": "07", "08": "08", "09": "08", "10": "10", "11": "10", "12": "12", "13": "12"}
    assert got["00"][1] == got["01"][1] == got["02"][1] == 1 and got["03"][1] == 0


def test_one_id_in_two_companies_joins_no_two_groups(spark):
    df = spark.createDataFrame([("a", "Orvane", "t", LONG, ""), ("a", "Brix", "t", "other words here", ""), ("b", "Orvane", "t", LONG, ""), ("c", "Brix", "t", "other words here", ""), (None, "Brix", "t", LONG, "")], POST)
    got = {(r["job_id"], r["group_id"]) for r in near_duplicate_groups(df).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "a")}
    members, sets = text_classes(df)
    assert members.count() == 4 and sets.count() == 2 and class_links(sets).count() == 0


def test_links_lose_no_pair(spark):
    rng = random.Random(1)
    base = [[f"w{rng.randrange(60)}" for _ in range(60)] for _ in range(4)]
    texts = []
    for i in range(24):
        w = list(base[i % 4])
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(60)] = f"v{rng.randrange(1000)}"
        texts.append(" ".join(w))
    df = spark.createDataFrame([(f"{i:02}", "K", "t", t, "") for i, t in enumerate(texts)], POST)
    got = {(r["class_a"], r["class_b"]) for r in class_links(text_classes(df)[1]).collect()}
    sets = [{" ".join(t.split()[k : k + 5]) for k in range(56)} for t in texts]
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(frozenset(s), i)
    ids = sorted(first.values())
    want = {(f"{a:02}", f"{b:02}") for a in ids for b in ids if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert got == want


def test_empty_table(spark):
    assert near_duplicate_groups(spark.createDataFrame([], POST)).count() == 0
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_representatives_stay(spark):
    day = date(2026, 3, 1)
    m = spark.createDataFrame([("g", "b", day), ("g", "a", None), ("g", "c", day), ("h", "z", None)], "group_id string, job_id string, posted_date date")
    got = {r["group_id"]: (r["job_id"], r["n_members"], r["duplicates"]) for r in representatives(m).collect()}
    assert got == {"g": ("b", 3, "c,a"), "h": ("z", 1, "")}
    before = spark.createDataFrame([("a",), ("gone",)], "job_id string")
    assert {r["job_id"] for r in representatives(m, before).collect()} == {"a", "z"}
    assert representatives(m.limit(0)).count() == 0


def test_numbered_groups_of_any_size(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["big", "big", "big", "x", None]), rng.randrange(50), i) for i in range(400)]
    got = numbered(spark.createDataFrame(rows, "g string, v int, place_of int").repartition(7), ["g"], ["v", "place_of"])
    want = {}
    for g in {r[0] for r in rows}:
        want |= {r: k for k, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: r[1:]), 1)}
    assert {(r["g"], r["v"], r["place_of"]): r["place"] for r in got.collect()} == want
    assert numbered(spark.createDataFrame([], "g string, v int"), ["g"], ["v"]).count() == 0


def test_named_entries(spark):
    names = spark.createDataFrame([(1, "Q#"), (1, None), (2, "Op"), (3, "ledger keeping"), (4, "spark"), (5, "rest"), (6, "Tri Part Name"), (7, "++"), (8, " "), (9, "K8-Fleet"), (10, "Ledger")], "e int, name string")
    texts = {
        "exact": "We use Q#, Op.", "case": "q# and op and LEDGER  Keeping", "capital": "Spark jobs", "plain": "spark joy, rest api", "long": "tri part (name)", "cut": "tri part", "marks": "ไปQ#กับk8-fleetนะ ledgers", "plus": "++ Q#s", "none": None, "empty": "", "end": "ledger",
    }
    df = spark.createDataFrame([(k, v, 0) for k, v in texts.items()], "k string, text string, e int").drop("e")
    got = {}
    for r in named_entries(df, names, "k", "e").distinct().collect():
        got.setdefault(r["k"], set()).add(r["e"])
    assert got == {"exact": {1, 2}, "case": {3, 10}, "capital": {4}, "long": {6}, "marks": {1, 9}, "plus": {7}, "end": {10}}
    assert named_entries(df, names.limit(0), "k", "e").count() == 0 and named_entries(df.limit(0), names, "k", "e").count() == 0


RUNS = "seq long, run_date date, source string, token string, status string, n_jobs long, http_status int, error string"
D1, D2 = date(2026, 4, 6), date(2026, 4, 9)


def health(spark, runs, now=90, before=90, today=D2):
    rows = [(i, *r, *[None] * (7 - len(r))) for i, r in enumerate(runs)]
    active = spark.createDataFrame([("listed", "orvane"), ("bare", "brix")], "source string, token string")
    df = health_problems(spark.createDataFrame(rows, RUNS), active, today, now, before)
    return {(r["rule"], r["token"]): r["detail"] for r in df.collect()}


def test_health_rules(spark):
    good = (D2, "bare", "brix", "ok", 4)
    assert health(spark, [(D2, "listed", "orvane", "ok", 3), good]) == {}
    assert health(spark, [(D2, "listed", "orvane", "error", 0, None, "timeout"), good, (D2, "listed", "orvane", "ok", 3)]) == {}
    assert health(spark, [(D2, "listed", "orvane", "http_error", 0, 502), good]) == {("failed", "orvane"): "http_error 502"}
    assert health(spark, [(D1, "listed", "orvane", "ok", 8), (D1, "listed", "orvane", "error", 0), (D2, "listed", "orvane", "ok", 0), good], 40, 90) == {("emptied", "orvane"): "before: 8", ("fell", None): "90 40"}
    assert health(spark, [(D1, "listed", "orvane", "ok", 8), good], 45, 90) == {("absent", "orvane"): None}
    assert set(health(spark, [(D1, "listed", "orvane", "ok", 8), (D1, "bare", "brix", "ok", 1), (D2, "bare", "Brix", "ok", 1)])) == {("stale", None)}
    assert set(health(spark, [(D2, "bare", "closed", "error", 0)])) == {("no log", None)} and set(health(spark, [])) == {("no log", None)}


def test_run_windows(spark):
    rows = [(1, D1, "s", "t", "ok", 5), (2, D1, "s", "t", "ok", 7), (3, D1, "s", "t", "error", 0), (4, D1, "s", "u", "ok", 0), (5, D2, "s", "u", "ok", 0), (None, D1, "s", "t", "ok", 99)]
    runs = spark.createDataFrame([(*r, None, "e" * 500) for r in rows], RUNS)
    assert {(r["token"], r["n_jobs"]) for r in last_rows(runs, ["source", "token"]).collect()} == {("t", 0), ("u", 0)}
    days = spark.createDataFrame([(D1,), (D2,), (date(2026, 4, 13),)], "run_date date")
    assert {r["run_date"]: r["raw_total"] for r in daily_totals(runs, days).collect()} == {D1: 7, D2: None, date(2026, 4, 13): None}


def test_log_cuts_messages(spark, tmp_path):
    at = str(tmp_path / "log")
    row = spark.createDataFrame([(1, D1, "s", "t", "error", 0, None, "e" * 500)], RUNS)
    log_run(row, at)
    log_run(row, at)
    assert [len(r["error"]) for r in spark.read.parquet(at).collect()] == [200, 200]


def test_labels(spark):
    fields = "job_id string, skills array<string>, level string"
    extra = ", labeler string, human_edited boolean, changed_fields array<string>"
    labels = spark.createDataFrame([("a", ["x"], "mid", "machine", True, ["level"]), ("k", ["y"], None, "human", False, [])], fields + extra)
    drafts = spark.createDataFrame([("a", ["x"], "mid"), ("b", ["p", "q"], "lead")], fields)
    changes = spark.createDataFrame([("a", ["x"], "old", 1), ("a", ["x"], "mid", 2), ("b", ["q", "p"], "mid", 5), ("n", None, "mid", 1), (None, ["z"], "mid", 9)], fields + ", seq int")
    got = {r["job_id"]: (r["level"], r["labeler"], r["human_edited"], r["changed_fields"]) for r in upsert(labels, changes, drafts, ["skills", "level"]).collect()}
    assert got == {"a": ("mid", "machine+human", True, ["level"]), "b": ("mid", "machine+human", True, ["level"]), "n": ("mid", "human", True, ["level"]), "k": (None, "human", False, [])}
    sample = spark.createDataFrame([("a", "clash"), ("b", ""), ("k", ""), ("z", "")], "job_id string, origin_ string")
    state = label_state(sample, labels, drafts, {"level": "'unknown'"})
    assert {r["job_id"]: (r["level"], r["origin"]) for r in state.collect()} == {"a": ("mid", "label"), "b": ("lead", "draft"), "k": (None, "label"), "z": ("unknown", "default")}


def test_evaluation_by_hand(spark):
    g = "job_id string, seniority string, role_family string, salary_min double, salary_max double"
    gold = spark.createDataFrame([("a", "mid", "BA", 10.0, 20.0), ("b", "lead", "DA", None, None), ("m", "mid", "BA", None, None), ("s", "mid", "BA", 5.0, None)], g)
    pred = spark.createDataFrame([("p", "1", "a", "mid", "SA", 10.0, 20.0), ("p", "1", "b", "lead", "DA", 1.0, None), ("p", "1", "s", "junior", "BA", 5.0, 6.0), ("p", "1", "extra", "mid", "BA", None, None), ("p", "2", "zz", "mid", "BA", None, None)], "model string, version string, " + g)
    aliases = spark.createDataFrame([("js", "Jay Script"), ("", "none")], "alias string, canonical string")
    typed = canonical_names(spark.createDataFrame([("a", "JS"), ("a", "jay  script"), ("a", "Tin"), ("b", "Tin"), ("b", " "), ("b", None), ("m", "Oak")], "job_id string, skill string"), aliases, ["job_id"])
    named = spark.createDataFrame([("p", "1", "a", "jay script"), ("p", "1", "b", "tin"), ("p", "1", "b", "oak"), ("p", "1", "extra", "tin")], "model string, version string, job_id string, name string")
    r = {x["version"]: x for x in evaluate(gold, pred, typed, named).collect()}
    assert (r["1"]["tp"], r["1"]["fp"], r["1"]["fn"], r["1"]["n_postings"], r["1"]["n_missing"]) == (2, 1, 1, 3, 1)
    assert r["1"]["precision"] == r["1"]["recall"] == r["1"]["f1"] == pytest.approx(2 / 3)
    assert (r["1"]["seniority_accuracy"], r["1"]["role_accuracy"], r["1"]["stated_accuracy"], r["1"]["value_right"], r["1"]["n_stated"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3), 1, 2)
    assert (r["2"]["n_postings"], r["2"]["n_missing"], r["2"]["f1"], r["2"]["role_accuracy"]) == (0, 4, 0.0, None)


def test_marts_in_one_job(spark, tmp_path):
    cols = "seen_date date, job_id string, source string, company string, title string, location string, th_primary boolean, url string, posted_date date, raw_text string, n_duplicates int"
    day = lambda d, j, title="Data Analyst", text="Ask a@b.co. 40 THB": (d, j, "s", "c", title, "l", True, "u", None, text, 0)
    days = spark.createDataFrame([day(D1, "a", "Old"), day(D2, "a", "Senior Cook"), day(D1, "gone"), day(D2, "b"), day(D2, "b"), day(D2, None), day(D2, "c")], cols)
    ex = lambda seq, j, model, v, fam, lo=None: (seq, j, model, v, fam, "mid", lo, None, None, None, "40 THB", ["Tin", "tin", " "])
    e = spark.createDataFrame([ex(1, "a", "llm", "p2", "SA"), ex(2, "a", "llm", "p2", "BA", 40.0), ex(3, "a", "llm", "p1", "DA"), ex(4, "b", "rules", "r1", "SA", 41.0), ex(5, "b", "rules", "r1", "BA"), ex(6, "c", "rules", "r0", "BA"), ex(7, "unknown", "llm", "p2", "BA")], EXTRACTION)
    at = str(tmp_path / "marts")
    counts = build_and_publish(days, e, ("llm", "p2"), "r1", at)
    assert counts == {"job_postings": 4, "posting_attributes": 4, "posting_skills": 2, "daily_active": 5}
    p = {r["job_id"]: r for r in spark.read.parquet(f"{at}/job_postings").collect()}
    assert (p["a"]["title"], p["a"]["first_seen"], p["a"]["last_seen"], p["a"]["is_open"], p["gone"]["is_open"]) == ("Senior Cook", D1, D2, True, False)
    assert p["a"]["raw_text"] == "Ask [email removed] 40 THB"
    a = {r["job_id"]: (r["extraction_method"], r["role_family"], r["salary_min"], r["salary_stated"]) for r in spark.read.parquet(f"{at}/posting_attributes").collect()}
    assert a == {"a": ("llm", "BA", 40.0, True), "b": ("rules", "SA", None, False), "c": ("rules", "DA", None, False), "gone": ("rules", "DA", None, False)}
    assert build_and_publish(days, e, ("llm", "p2"), "r1", at) == counts and spark.read.parquet(f"{at}/job_postings").count() == 4
    assert all(v == 0 for v in build_and_publish(days.limit(0), e.limit(0), ("llm", "p2"), "r1", at).values())


def test_samples_grow_by_their_share(spark):
    ids = lambda a, b: spark.createDataFrame([(f"i{k:03}",) for k in range(a, b)] + [(None,)], "job_id string")
    none = spark.createDataFrame([], "job_id string, split string")
    first = extend_sample(none, ids(0, 50))
    parts = lambda df: {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert parts(first) == {"dev": 30, "test": 20} and parts(extend_sample(none, ids(0, 5))) == {"dev": 5}
    second = extend_sample(first, ids(0, 66))
    assert parts(second) == {"dev": 36, "test": 30} and first.exceptAll(second).count() == 0
