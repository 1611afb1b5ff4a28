import glob
import json
import os

import pytest

import __spark_entry__ as entry
from postmill.plans import registry
from postmill.sources.files import active_only, append_incremental, first_complete, land, log_metrics, publish, read_boards, read_evaluations, read_jsonl, rules_from_json, write_csv, write_jsonl
from postmill.sources.tables import remove_stored, shared_dir, stored
from tools.oracle_check import norm

SF = "/root/testdata/sf0.001"
#: Queries whose operators are compared with brute force in test_text_and_rules.
NO_SQL = {"redacted_texts", "plain_texts", "levels_by_years"}


def test_jsonl_edges(spark, tmp_path):
    p = tmp_path / "in.jsonl"
    p.write_bytes("\ufeff".encode() + '{"n": "one\u2028line", "k": 1}\r\n \n{"n": null, "k": 2, "other": []}\n{"n": "bad", "k": "x"}\n[]\nnot json\n{"n": "cut", "k": 3'.encode())
    got = [(r["n"], r["k"]) for r in read_jsonl(spark, str(p), "n string, k int").orderBy("k").collect()]
    assert got == [("one\u2028line", 1), (None, 2)]
    assert read_jsonl(spark, str(tmp_path / "none"), "n string").count() == 0


def test_jsonl_lines_stay_lines(spark, tmp_path):
    at = str(tmp_path / "out")
    rows = [("é\u2028ü\u2029\u0085\n", None), ("", 4)]
    write_jsonl(spark.createDataFrame(rows, "n string, k int").coalesce(1), at)
    text = "".join(open(f, encoding="utf-8", newline="").read() for f in glob.glob(f"{at}/part-*"))
    assert len(text.splitlines()) == 2 and "é\\u2028ü\\u2029\\u0085" in text and '"k":null' in text
    assert sorted((r["n"], r["k"]) for r in read_jsonl(spark, at, "n string, k int").collect()) == sorted(rows, key=lambda r: r[0])
    write_jsonl(spark.createDataFrame([("more", 5)], "n string, k int"), at, append=True)
    assert read_jsonl(spark, at, "n string, k int").count() == 3
    write_jsonl(spark.createDataFrame([("new", 5)], "n string, k int"), at)
    assert read_jsonl(spark, at, "n string, k int").count() == 1


def listed(*jobs):
    return json.dumps({"jobs": list(jobs), "meta": {}})


def test_boards_over_days(spark, tmp_path):
    one, two = tmp_path / "raw" / "2026-03-02", tmp_path / "raw" / "2026-03-05"
    one.mkdir(parents=True)
    two.mkdir()
    keeper = {"id": 81, "title": "  Stock Keeper", "company_name": "Orvane Ltd", "absolute_url": "https://o.example/81", "location": {"name": "Rayong"}, "first_published": "", "updated_at": "2026-03-01T23:50:00+07:00", "departments": [{"name": "Store"}, {"name": None}], "offices": [{"name": "HQ", "location": ""}, {"name": None}], "content": "&lt;p&gt;Count &amp;amp; lift&lt;/p&gt;"}
    loader = {"id": 82, "title": "Van Loader", "company_name": "", "content": None}
    (one / "listed__orvane.json").write_text(listed(keeper, loader, keeper | {"title": "second"}, {"title": "no id"}))
    (two / "listed__orvane.json").write_text(listed(loader | {"title": "Loader"}, keeper))
    (two / "listed__zz.json").write_text(listed(loader | {"title": "of a later file"}))
    (one / "bare__brix__x.json").write_text(json.dumps(indent=2, obj=[
        {"id": "q", "text": "Cook", "hostedUrl": "h", "categories": {"location": "Oslo", "allLocations": ["Oslo", "Bergen"], "department": "", "team": "Kitchen"}, "country": "NO", "createdAt": 1767225600000, "description": "<div>Boil</div>", "lists": [{"text": "Duties", "content": "<li>stir</li>"}, {"text": "Pay", "content": None}], "additionalPlain": " Bye ", "salaryRange": {"currency": "NOK", "interval": "month", "min": 1.5, "max": 2}},
        {"id": "r", "text": "Aide", "descriptionPlain": "Plain.", "description": "<b>unused</b>"},
    ]))
    (one / "bad__a.json").write_text("{")
    (one / "bad__b.json").write_text('"text"')
    (one / "bad__c.json").write_text("")
    rows = {(str(r["seen_date"]), r["source_job_id"]): r for r in read_boards(spark, str(tmp_path / "raw")).collect()}
    assert {k: r["title"] for k, r in rows.items()} == {
        ("2026-03-02", "81"): "Stock Keeper", ("2026-03-02", "82"): "Van Loader", ("2026-03-05", "81"): "Stock Keeper", ("2026-03-05", "82"): "Loader", ("2026-03-02", "q"): "Cook", ("2026-03-02", "r"): "Aide",
    }
    k = rows["2026-03-02", "81"]
    assert (k["source"], k["token"], k["company"], k["location_extra"], k["department"], k["posted_date"], k["raw_text"], k["salary"]) == ("listed", "orvane", "Orvane Ltd", "HQ", "Store; ", "2026-03-01", "Count & lift", None)
    assert rows["2026-03-02", "82"]["company"] == "orvane" and rows["2026-03-02", "82"]["raw_text"] == ""
    q = rows["2026-03-02", "q"]
    assert (q["token"], q["company"], q["location_extra"], q["department"], q["posted_date"], q["country_code"], q["salary"]["min"]) == ("brix__x", "brix__x", "Oslo; Bergen", "Kitchen", "2026-01-01", "NO", 1.5)
    assert q["raw_text"] == "Boil\n\nDuties\nstir\nPay\n\nBye" and rows["2026-03-02", "r"]["raw_text"] == "Plain."
    active = spark.createDataFrame([("listed", "orvane"), ("bare", "BRIX__X")], "source string, token string")
    assert active_only(read_boards(spark, str(tmp_path / "raw")), active).count() == 4


def test_landing_and_publishing(spark, tmp_path):
    df = spark.createDataFrame([("a", "mail x@y.co"), ("b", None), ("b", None)], "job_id string, raw_text string")
    at = str(tmp_path / "land")
    assert land(df, at, ["job_id"]) == 2 and land(df, at, ["job_id"]) == 0 and land(df.limit(0), at, ["job_id"]) == 0
    assert land(spark.createDataFrame([("a", "other"), ("c", "new")], df.schema), at, ["job_id"]) == 1
    assert {(r["job_id"], r["raw_text"]) for r in spark.read.parquet(at).collect()} == {("a", "mail x@y.co"), ("b", None), ("c", "new")}
    out = str(tmp_path / "pub")
    assert publish({"posts": df, "none": df.limit(0).select("job_id")}, out) == {"posts": 3, "none": 0}
    assert {r["raw_text"] for r in spark.read.parquet(f"{out}/posts").collect()} == {"mail [email removed]", None}
    assert {(r["name"], r["n_rows"]) for r in spark.read.parquet(f"{out}/meta").collect()} == {("posts", 3), ("none", 0)}
    assert first_complete(spark, [str(tmp_path / "nowhere"), out], ["posts", "meta"])["posts"].count() == 3 and first_complete(spark, [out], ["posts", "lost"]) is None


def test_rules_run_once_a_version(spark, tmp_path):
    at = str(tmp_path / "ex")
    rows = lambda v: spark.createDataFrame([("a", v), ("b", v)], "job_id string, version string")
    assert [append_incremental(spark, rows(v), at, ["job_id", "version"]) for v in ("1", "1", "2")] == [2, 0, 2]


def test_metric_log_is_idempotent(spark, tmp_path):
    at = str(tmp_path / "log")
    m = lambda v: spark.createDataFrame([("postings", v)], "metric string, value long")
    assert log_metrics(m(1), at, "2026-03-02") and not log_metrics(m(2), at, "2026-03-02") and log_metrics(m(3), at, "2026-03-05")
    assert log_metrics(m(9), at, "2026-03-02", force=True)
    assert {(str(r["day"]), r["value"]) for r in spark.read.parquet(at).collect()} == {("2026-03-02", 9), ("2026-03-05", 3)}


def test_last_evaluation_of_each_model(spark, tmp_path):
    for name, body in {"evaluation_1.json": '{"model": "p", "f1": 0.5}', "evaluation_2.json": '{"model": "p",\n "f1": 0.75}', "evaluation_3.json": "{", "evaluation_4.json": '{"model": "q", "f1": 0.1}', "other.json": '{"model": "p", "f1": 1.0}'}.items():
        (tmp_path / name).write_text(body)
    got = read_evaluations(spark, str(tmp_path), "model string, f1 double")
    assert {(r["model"], r["f1"]) for r in got.collect()} == {("p", 0.75), ("q", 0.1)}
    assert read_evaluations(spark, str(tmp_path / "none"), "model string, f1 double").count() == 0


def test_csv_and_rules(spark, tmp_path):
    write_csv(spark.createDataFrame([("a, \"b\"", 1)], "skill string, n int").coalesce(1), str(tmp_path / "csv"), {"skill": "ทักษะ"})
    text = open(glob.glob(str(tmp_path / "csv" / "part-*"))[0], encoding="utf-8").read()
    assert text.startswith("\ufeffทักษะ,n\n") and '"a, ""b""",1' in text
    assert rules_from_json('[{"name": "A", "patterns": ["x", "y+"]}, {"name": "B", "patterns": []}, {"name": "A", "patterns": ["z"]}]') == (("A", "x|y+"), ("A", "z"))


def test_shared_folder(spark, tmp_path):
    at = shared_dir(spark)
    stored(spark.range(3), f"{at}/x")
    assert os.path.exists(f"{at}/x") and remove_stored(spark) >= 1 and not os.path.exists(at)


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    if name not in registry.SQL:
        assert got and name in NO_SQL
        return
    cur = con.execute(registry.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
