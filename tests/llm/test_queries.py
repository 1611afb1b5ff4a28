import pytest

from postmill.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p2_found": ["job_id_a", "job_id_b"], "p3_found": ["job_id", "kind", "start_pos"], "p4_found": ["job_id", "skill", "skill_id"], "p5_found": ["job_id", "seg_no", "lang"], "p8_found": ["doc_id"],
    "p7_shares": ["source", "target_share", "max_repeats", "available_tokens", "drawn_tokens", "actual_share", "n_pages", "due_copies", "n_copies", "limited"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_on_whole_tables(spark, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows and df.columns == COLUMNS.get(name, df.columns)
    if name.endswith("_found"):
        assert len(set(rows)) == len(rows) and all(v is not None for r in rows for v in r)
    if name == "p2_found":
        assert all(r["job_id_a"] < r["job_id_b"] for r in rows)
    if name == "p7_shares":
        assert all(abs(r["n_copies"] - r["due_copies"]) < 1 for r in rows)
    assert not SQL
