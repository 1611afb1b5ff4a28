import random
from collections import Counter
from datetime import date

import numpy as np
import pytest

from postmill.llm.history_dedup import HistoryDedup, Settings, bucket_counts, dedup_in_batches, may_agree, signatures
from postmill.llm.textarrays import mix
from postmill.llm.value_mapping import Settings as MapSettings
from postmill.llm.value_mapping import distance, map_values, orders, squashed, token_set, written
from postmill.sources.tables import sifted

POST = "job_id string, first_seen date, raw_text string, tid long"


def text(seed, n=120):
    r = random.Random(seed)
    return [f"w{r.randrange(400)}" for _ in range(n)]


def altered(words, k, seed):
    r, w = random.Random(seed), list(words)
    for _ in range(k):
        w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    return " ".join(w)


def test_copies_across_batches(spark):
    a, b, c = text(1), text(2), text(3)
    rows = [
        ("j5", date(2026, 5, 4), " ".join(a)), ("j1", date(2026, 8, 1), "* " + altered(a, 4, 1).upper() + "!"), ("j2", date(2026, 8, 2), "<p>" + "&nbsp;".join(a[60:]) + "</p>\n\n" + " ".join(a[:60])),
        ("j3", date(2026, 6, 1), " ".join(b)), ("j3", date(2026, 6, 1), " ".join(b)), ("j4", None, altered(b, 3, 2)),
        ("j6", date(2026, 5, 5), " ".join(a[:60] + c[:60])), ("j7", date(2026, 5, 5), None), ("j8", date(2026, 5, 5), "  \n"), ("j9", date(2026, 9, 1), " "), (None, date(2026, 5, 5), " ".join(a)),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], POST)
    assert {tuple(r) for r in dedup_in_batches(df, batch_days=30).pairs().collect()} == {("j1", "j5"), ("j2", "j5"), ("j3", "j4")}


def test_a_hot_group_of_near_copies_stays_together(spark):
    base = text(9)
    rows = [(f"h{i:03}", date(2026, 5, 4), altered(base, 3, i)) for i in range(60)] + [(f"o{i:03}", date(2026, 5, 4), " ".join(text(100 + i))) for i in range(60)]
    got = {tuple(r) for r in dedup_in_batches(spark.createDataFrame([(*r, 1) for r in rows], POST)).pairs().collect()}
    assert got == {("h000", f"h{i:03}") for i in range(1, 60)}


def test_batches_bridge_classes_and_compact(spark):
    base = text(5, 200)
    near = [altered(base, 14, 0), altered(base, 14, 1), " ".join(base)]
    df = spark.createDataFrame([(f"b{i}", date(2026, 5, 1 + i), t, 1) for i, t in enumerate(near)], POST)
    state = HistoryDedup(spark, Settings(compact_every=2, range_rows=1))
    for i in range(3):
        state.accept(df.where(f"job_id = 'b{i}'"), df)
    state.accept(df.limit(0), df)
    assert [r.rows for r in state.runs] == [24] and state.merges == 2
    assert {tuple(r) for r in state.pairs().collect()} == {("b0", "b1"), ("b0", "b2")}


def test_copies_inside_an_oversized_group_are_found(spark):
    """600 texts share a long head, so most of their keys are equal; each copy must still meet its own original."""
    head = text(70, 160)
    rows = [(f"g{i:03}", date(2026, 5, 4), " ".join(head + text(1000 + i, 90))) for i in range(600)]
    copies = [(f"z{i:03}", date(2026, 8, 4), altered(head + text(1000 + i, 90), 8, i)) for i in range(0, 600, 10)]
    df = spark.createDataFrame([(*r, 1) for r in rows + copies], POST)
    want = {(f"g{i:03}", f"z{i:03}") for i in range(0, 600, 10)}
    for s in (Settings(), Settings(tile=50)):
        assert {tuple(r) for r in dedup_in_batches(df, settings=s).pairs().collect()} == want


def shuffled(spark):
    """Bytes written to shuffles by the session so far."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    gateway = spark.sparkContext._gateway
    stages = sc.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_texts_without_a_copy_are_not_shuffled(spark, tmp_path):
    """800 texts, ten of them with a copy, where no side of a join is small enough to be broadcast: less is shuffled than the texts have bytes."""
    rows = [(f"g{i:03}", date(2026, 5, 4), " ".join(f"{random.Random(i * 1000 + k).getrandbits(64):x}" for k in range(300))) for i in range(800)]
    copies = [(f"z{i:03}", date(2026, 5, 5), altered(rows[i][2].split(), 8, i)) for i in range(10)]
    spark.createDataFrame([(*r, 1) for r in rows + copies], POST).repartition(4).write.parquet(f"{tmp_path}/texts")
    df = spark.read.parquet(f"{tmp_path}/texts")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled(spark)
        state = HistoryDedup(spark)
        state.accept(df, df)
        assert shuffled(spark) - before < 0.5 * sum(len(r[2]) for r in rows)
        assert {tuple(r) for r in state.pairs().collect()} == {(f"g{i:03}", f"z{i:03}") for i in range(10)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


@pytest.mark.parametrize("tile", [40, 16384])
def test_candidates_of_groups_against_brute_force(spark, tile):
    """Groups of equal keys of every size, over several tasks, each new row with all others of its group; ends of tasks fall inside groups."""
    r, rows = random.Random(11), []
    for g, size in enumerate([1, 3, 9, 10, 11, 30, 300, 900] * 3):
        base = bytes(r.randrange(256) for _ in range(32))
        for i in range(size):
            sk = bytearray(base)
            for k in r.sample(range(32), r.randrange(10, 32)):
                sk[k] = r.randrange(256)
            rows.append((g % 3, g // 3, g, r.getrandbits(62), bytes(sk) + int(r.choice([100, 100, 190])).to_bytes(4, "little"), r.random() < (0.02 if g % 2 else 0.3)))
    df = spark.createDataFrame(rows, "j int, k1 int, k2 int, tid long, sk binary, new boolean")
    s = Settings(tile=tile)
    state = HistoryDedup(spark, s)
    found = [tuple(x) for x in state._candidates(df, 20_000, f"{state.path}/windows/0").collect()]
    got, want, groups = set(found), set(), {}
    for x in rows:
        groups.setdefault(x[:3], []).append(x)
    for group in groups.values():
        sk, size = np.array([list(x[4][:32]) for x in group]), np.array([int.from_bytes(x[4][32:], "little") for x in group])
        for i in np.flatnonzero([x[5] for x in group]):
            ok = ((sk == sk[i]).sum(1) >= s.sketch_min) & (2 * np.minimum(size, size[i]) >= s.agree * (size + size[i]))
            want |= {tuple(sorted((group[i][3], group[j][3]))) for j in np.flatnonzero(ok) if j != i}
    assert len(found) == len(got) and len(want) > 1000 and want <= got
    # windows reach into the next group, no further
    of, order = {x[3]: x for x in rows}, {x[3]: i for i, x in enumerate(sorted(rows))}
    assert all(of[a][0] == of[b][0] and abs(order[a] - order[b]) <= s.window for a, b in got - want)


def test_a_sieve_loses_no_row(spark):
    df, ids = spark.range(20000).selectExpr("id", "cast(id as string) as name"), spark.range(0, 20000, 100).selectExpr("cast(id as string) as name")
    for log_bits, most in ((26, 2000), (7, 20000)):
        got = sifted(df, ids, "name", log_bits)
        assert got.columns == ["id", "name"] and got.join(ids, "name").count() == 200 and got.count() <= most
    assert sifted(df, ids.limit(0), "name").count() == 0


def test_bucket_counts_never_reject_an_agreeing_pair():
    rng = np.random.default_rng(4)
    for size in (1, 40, 3000):
        a = rng.integers(0, max(2, size // 3), size).astype(np.uint64)
        b = a.copy()
        b[: size // 8] = rng.integers(10**6, 10**7, size // 8)
        common = sum((Counter(a.tolist()) & Counter(b.tolist())).values())
        c = bucket_counts(mix(np.concatenate([a, b])), np.repeat([0, 1], size), 2)
        assert may_agree(c[:1], c[1:], common / size).all()
        other = bucket_counts(mix(a + np.uint64(10**9)), np.zeros(size, int), 1)
        assert size == 3000 or not may_agree(c[:1], other, 0.83).any()


def test_sketches_and_keys_keep_pairs_with_scattered_changes():
    """Pairs that agree in 0.88: few may fall to the sketch, and few may be without an equal two-part key."""
    s, r, one, two = Settings(), random.Random(6), [], []
    for i in range(1500):
        w = [f"w{r.randrange(10**6)}" for _ in range(200)]
        v = list(w)
        for k in r.sample(range(200), 24):
            v[k] = f"x{r.randrange(10**6)}"
        one.append(" ".join(w))
        two.append(" ".join(v))
    a, b = signatures(one, s)[1], signatures(two, s)[1]
    assert ((((a ^ b) & 0xFF) == 0).sum(1) < s.sketch_min).mean() < 0.04
    same = (a == b)[:, : s.keys]
    assert (~(same & np.roll(same, -1, axis=1)).any(1)).mean() < 0.19


def test_empty_history(spark):
    assert dedup_in_batches(spark.createDataFrame([], POST)).pairs().count() == 0


@pytest.mark.parametrize("typed, name", [
    ("  Ｄａｔａ　Ｍａｓｋｉｎｇ ", "datamasking"), ("Dàtà Màskìng (advanced)", "datamasking"), ("experience with Data​ Masking - 3 yrs", "datamasking"), ("• data_masking v2", "datamasking"), ("Data Masking4", "datamasking"), ("D@", "d"),
    ("V#", "v#"), ("Om++ 2+ years", "om++"), ("Plan &amp; Act", "planandact"), ("plan + act", "planandact"), ("m0del m0nitoring", "modelmonitoring"), ("", ""), (None, ""), ("--", ""), ("strong", "strong"),
])
def test_written_forms(typed, name):
    assert squashed(written(typed)) == name


def test_distance():
    assert [distance(a, b, 3) for a, b in (("ab", "ba"), ("kitten", "sitting"), ("", "abc"), ("a" * 50, "b" * 50), ("geoastialmapping", "geospatialmapping"))] == [1, 3, 3, 4, 2]
    assert token_set("aa") == ["a", "a2", "^a", "aa", "a$"] and token_set("") == []


def test_mapping_against_brute_force(spark):
    names = ["Data Masking", "Event Sourcing", "Graph Analytics", "Velquery", "Junelbane", "Junelbane Cloud", "Qx", "Text Mining", "Survey Design"]
    entries = spark.createDataFrame([(i + 1, n, "clash") for i, n in enumerate(names)] + [(9, "SD", ""), (None, "Nothing", ""), (7, None, "")], "entry_id int, name string, value string")
    rng, values = random.Random(3), ["qx", "Q x", "design", "mining", "SD", "s.d.", None, "", "  ", "masking, data", "Cloud", "x" * 5000, "ภาษา", "Junelbane  cloud"]
    for n in names:
        for _ in range(6):
            w = list(n)
            for _ in range(rng.randrange(3) if len(w) > 3 else 0):
                i = rng.randrange(len(w) - 1)
                w[i : i + 2] = rng.choice([w[i + 1 : i + 2] + w[i : i + 1], [w[i]], [w[i], w[i], w[i + 1]], ["z", w[i + 1]]])
            values.append("".join(w))
    df = spark.createDataFrame([(v, 1) for v in values + values[:5]], "value string, entry_id int").select("value")
    got = {r["value"]: r["entry_id"] for r in map_values(df, entries).collect()}
    assert set(got) == {v for v in values if v is not None}
    keyed = [(i + 1, squashed(written(n))) for i, n in enumerate(names)] + [(9, "sd")]
    for v in got:
        best = None
        for i, n in keyed:
            most = 0 if len(n) <= 4 else 1 if len(n) <= 6 else 2
            b = set(token_set(n))
            for form in orders(written(v)):
                a = set(token_set(form))
                d = distance(form, n, most)
                if d <= most and a:
                    c = (-len(a & b) / len(a | b), d, i)
                    best = c if best is None or c < best else best
        assert got[v] == (best[2] if best else None), v


def test_edits_leave_the_least_similarity():
    s, rng = MapSettings(), random.Random(8)
    for _ in range(4000):
        name = "".join(rng.choice("abcdefg#1") for _ in range(rng.randrange(1, 26)))
        w = list(name)
        for _ in range(s.edits_of(len(name))):
            i = rng.randrange(len(w))
            w[i : i + 2] = rng.choice([w[i + 1 : i + 2] + w[i : i + 1], w[i + 1 : i + 2], [*w[i : i + 2], "q"], ["z", *w[i + 1 : i + 2]]])
            if not w:
                break
        form = "".join(w)
        if not form or distance(form, name, 2) > s.edits_of(len(name)):
            continue
        a, b = set(token_set(form)), set(token_set(name))
        assert len(a & b) / len(a | b) >= s.least(len(b)) - 1e-9
        # any order of the tokens: the looked-up parts of both meet
        for order in (sorted, lambda t: sorted(t, key=lambda x: x[::-1])):
            x, y = order(a), order(b)
            rank = {t: k for k, t in enumerate(order(a | b))}
            x, y = sorted(a, key=rank.get), sorted(b, key=rank.get)
            assert set(x[: s.prefix_of_value(len(a))]) & set(y[: s.prefix_of_name(len(b))])


def test_mapping_of_nothing(spark):
    e = spark.createDataFrame([(1, "Data Masking")], "entry_id int, name string")
    v = spark.createDataFrame([], "value string")
    assert map_values(v, e).count() == 0
    got = map_values(spark.createDataFrame([("a",), ("b",)], "value string"), e.limit(0)).collect()
    assert {(r["value"], r["entry_id"]) for r in got} == {("a", None), ("b", None)}
