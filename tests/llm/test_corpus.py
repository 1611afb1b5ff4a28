import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from postmill.llm.mixing import flight, landing, mix, rates
from postmill.llm.packing import Places, pack, plan
from postmill.llm.packing import Settings as PackSettings
from postmill.llm.token_sizes import encoder, token_sizes


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=33, max_size=33))
def test_plan_uses_up_the_histogram(counts):
    have = np.array(counts)
    have[0] = 0
    left = have.copy()
    for parts, n in plan(have, PackSettings()):
        assert sum(a * c for a, c in parts) <= 32 and n > 0
        for a, c in parts:
            left[a] -= c * n
    assert not left.any()


def test_places_are_distinct():
    layout = [([(5, 2), (3, 1)], 4), ([(3, 3)], 2)]
    p = Places.of(layout)
    assert p.n_containers == 6
    five, three = p.find(np.full(8, 5), np.arange(8)), p.find(np.full(10, 3), np.arange(10))
    assert sorted(five.tolist()) == [0, 0, 1, 1, 2, 2, 3, 3] and sorted(three.tolist()) == [0, 1, 2, 3, 4, 4, 4, 5, 5, 5]


def test_pack(spark):
    rng = np.random.default_rng(3)
    sizes = [(int(i), int(n), "clash") for i, n in enumerate(np.minimum(rng.lognormal(4.5, 1.2, 600).astype(int), 5000))] + [(600, 0, ""), (601, 512, ""), (602, 1024, ""), (603, 1025, ""), (None, 5, ""), (604, None, "")]
    sizes += [(1000 + i, 77, "") for i in range(300)]  # a third of all rows has one length
    out = pack(spark.createDataFrame(sizes, "doc_id long, n_tokens long, offset string"), {1: 512, 2: 2048}, PackSettings(slice_rows=50)).collect()
    for spec, cap in ((1, 512), (2, 2048)):
        rows = [r for r in out if r["spec_id"] == spec]
        per, by = {}, {}
        for r in rows:
            per.setdefault(r["container_id"], []).append(r)
            by.setdefault(r["doc_id"], []).append(r)
        for c in per.values():
            c.sort(key=lambda r: r["slot"])
            at = 0
            for k, r in enumerate(c):
                assert r["slot"] == k and r["offset"] == at
                at += r["n_tokens"]
            assert at <= cap
        for i, n, _ in sizes:
            if i is None or n is None:
                continue
            p = sorted(by[i], key=lambda r: r["piece_no"])
            assert len(p) == max(1, -(-n // cap)) and sum(r["n_tokens"] for r in p) == n and all(r["n_tokens"] == cap for r in p[:-1])
        total = sum(r["n_tokens"] for r in rows)
        assert total / (cap * len(per)) > 0.97
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens long"), {1: 512}).count() == 0


def test_flight_keeps_the_totals():
    rng = np.random.default_rng(1)
    p, size = rng.random(500), rng.lognormal(5, 1, 500)
    q = flight(p, size, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2 and abs(q.sum() - p.sum()) < 1e-6 and abs((q * size).sum() - (p * size).sum()) < 1e-3
    assert flight(np.array([]), np.array([]), rng).size == 0 and flight(np.array([0.5]), np.array([3.0]), rng).tolist() == [0.5]


def test_landing_keeps_pages_and_tokens():
    rng = np.random.default_rng(2)
    for n in range(1, 13):
        p, size = rng.random(n), np.ceil(rng.lognormal(5, 1, n))
        q = landing(p, size, 1e9)
        assert set(q) <= {0.0, 1.0} and abs(q.sum() - p.sum()) < 1
        best = min(abs(b @ size - p @ size) for b in np.array(np.meshgrid(*[[0, 1]] * n)).T.reshape(-1, n) if abs(b.sum() - p.sum()) < 1)
        assert abs(abs(q @ size - p @ size) - best) < 1e-9
    # a page is more than all that is due: pages change places, their number stays
    size = np.append(np.arange(10.0, 49.0), 900.0)
    q = landing(np.append(np.tile([1.0, 0.0, 0.0], 13), 0.1), size, 100.0)
    goal = np.append(np.tile([1.0, 0.0, 0.0], 13), 0.1) @ size
    assert q.sum() == 13 and abs(q @ size - goal) < 1 and q[-1] == 0


def test_rates():
    r = rates({"a": 100, "b": 50, "c": 10}, {"a": 0.5, "b": 0.3, "c": 0.2, "none": 0.1}, {"a": 3, "b": 2, "c": 1, "none": 5}, 160)
    assert r["c"] == 1 and r["none"] == 0 and abs(sum(r[k] * n for k, n in (("a", 100), ("b", 50), ("c", 10))) - 160) < 1e-6 and abs(r["a"] * 100 / (r["b"] * 50) - 5 / 3) < 1e-6


def test_mix(spark):
    rng = np.random.default_rng(5)
    pages = [(i, " A " if i % 7 == 0 else "a" if i % 3 else "B", int(rng.lognormal(5, 1)) + 1, "clash") for i in range(9000)] + [(9001, None, 50, ""), (9002, "zz", 70, ""), (9003, "a", None, "")]
    df = spark.createDataFrame(pages, "doc_id long, source string, n_tokens long, copies string")
    targets = spark.createDataFrame([("a", 0.4, 3), ("b", 0.5, 2), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixture, shares = mix(df, targets)
    rows = mixture.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and max(r["copies"] for r in rows if r["source"] == "b") <= 2 and {r["source"] for r in rows} == {"a", "b"}
    s = {r["source"]: r for r in shares.collect()}
    assert s["absent"]["drawn_tokens"] == 0 and abs(s["a"]["actual_share"] - 4 / 9) < 0.002 and abs(s["b"]["actual_share"] - 5 / 9) < 0.002
    total = sum(p[2] or 0 for p in pages)
    assert abs(sum(r["n_tokens"] * r["copies"] for r in rows) / total - 1) < 0.002
    assert all(abs(r["n_copies"] - r["due_copies"]) < 1 for r in s.values())
    # sources of a single block land beside one of many blocks, both equations kept
    many = [(i, f"s{i % 9}" if i < 450 else "big", int(rng.lognormal(6, 1.2)) + 1) for i in range(9500)]
    wide = mix(spark.createDataFrame(many, "doc_id long, source string, n_tokens long"), spark.createDataFrame([*((f"s{k}", 0.02 + 0.002 * k, 3) for k in range(9)), ("big", 0.748, 1)], "source string, target_share double, max_repeats int"))[1].collect()
    assert all(abs(r["n_copies"] - r["due_copies"]) < 1 for r in wide), wide
    assert all(abs(r["drawn_tokens"] - r["rate"] * r["available_tokens"]) < 200 for r in wide), wide
    empty, none = mix(df.limit(0), targets)
    assert empty.count() == 0 and none.count() == 3


def test_token_sizes(spark):
    texts = ["", "a", "hello world", "ทดสอบ", None, "x" * 20000, "a <|endoftext|> b"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, text_ string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_sizes(df).collect()}
    assert got == {i: len(encoder().encode_ordinary(t)) for i, t in enumerate(texts) if t is not None}
    assert "".join([encoder().decode(encoder().encode_ordinary("Grüße, 世界"))]) == "Grüße, 世界"
