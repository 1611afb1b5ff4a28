import random

import numpy as np
from pyspark.sql import functions as F

from postmill.llm import language, pii
from postmill.llm.page_spam import spam_scores
from postmill.llm.textarrays import clean, shingles, tokens

PROSE = "The role reports to the head of finance and sits in a team of five. You will review the nightly jobs with tools of your choice. Together with four colleagues you maintain the catalogue and answer questions from branch managers."
THAI = "ในแต่ละสัปดาห์คุณจะทบทวนคลังข้อมูลกลางแล้วเผยแพร่ชุดทดสอบอัตโนมัติ ผู้สมัครควรชอบวางแผนข้อมูลลูกค้าเก่าจนกว่าตัวเลขจะตรงกัน"


def test_tokens_keep_places_and_documents():
    h, doc, start, length, own = tokens(["Ab cd", "", "ab กข", "x" * 3000])
    assert doc.tolist() == [0, 0, 2, 2, 2, 3] and start.tolist() == [0, 3, 0, 3, 4, 0] and length.tolist() == [2, 2, 2, 1, 1, 3000]
    assert own.tolist() == [False, False, False, True, True, False]
    assert tokens([clean("AB")])[0][0] == tokens(["ab"])[0][0]
    assert len(tokens([])[0]) == 0 and len(tokens(["", " .,"])[0]) == 0
    s, d = shingles(h, doc, 3)
    assert d.tolist() == [0, 2, 3]


def test_clean():
    assert clean("<p>A&amp;B</p>​ ＣＤ").split() == ["a&b", "cd"]
    assert tokens([clean("𠀀𠀁 𝒜b")])[4].tolist() == [True, True, False]  # other planes
    assert clean(None) == ""


CHINESE = "我们正在寻找一位愿意在周末整理仓库地图的同事。你会和四位同事一起检查每天的账目，并在安静的月份更新报表。经验不如耐心重要，入职后会有人教你使用工具。"
JAPANESE = "静かな時期に空き倉庫の地図を見直す仕事です。三人の仲間と一緒に取引先の登録画面を移し、毎週の報告書をまとめます。経験よりも丁寧さを大切にする職場です。"


def test_repetition_in_unspaced_scripts(spark):
    """Phrases repeated at even distances among varying words are found by their autocorrelation, prose in the same script is not."""
    rng = random.Random(9)
    pages, spam = {}, set()
    for lang, prose, phrases in (("th", THAI, ["งานรายได้ดี", "สมัครด่วนวันนี้"]), ("zh", CHINESE, ["高薪招聘兼职", "日结工资工作"]), ("ja", JAPANESE, ["高収入の求人情報", "在宅の仕事探し"])):
        for i in range(8):
            chunk = lambda: prose[(k := rng.randrange(len(prose) - 6)) : k + 3]  # noqa: E731, B023
            pages[len(pages)] = prose[i:] + prose[:i]
            spam.add(len(pages))
            pages[len(pages)] = "".join(rng.choice(phrases) + (chunk() if rng.random() < 0.5 else "") for _ in range(40))
    got = {r["doc_id"] for r in spam_scores(spark.createDataFrame(list(pages.items()), "doc_id long, text string")).where("is_spam").collect()}
    assert got == spam


def test_spam(spark):
    rng = random.Random(2)
    words = ["apply now", "high pay", "urgent hiring", "remote work"]
    pages = {
        1: PROSE, 2: " ".join(rng.choice(words) for _ in range(80)), 3: "\n".join(f"https://a{i}.example/jobs/{i}" for i in range(20)), 4: None, 5: "", 6: " \n ", 7: THAI, 8: "สมัครงาน" * 60,
        9: "Why remote work? Because remote work means remote work. Cheap remote work, real remote work, daily remote work. Everyone wants remote work, so get remote work from the remote work experts.",
        10: PROSE + "\n\n" + " ".join(rng.choice(words) for _ in range(8)), 11: PROSE * 400, 12: "high pay " * 20000,
        13: " ".join(f"#{w}{i}" for i, w in enumerate(["desklamp", "phonecase", "bangkok"] * 8)),
    }
    df = spark.createDataFrame([(k, v, "clash", 1.0) for k, v in pages.items()] + [(1, PROSE, "", 0.0)], "doc_id long, text string, id string, spam_share double")
    got = {r["doc_id"]: r["is_spam"] for r in spam_scores(df).collect()}
    assert {k for k, v in got.items() if v} == {2, 3, 8, 9, 12, 13}
    assert spam_scores(df).count() == len(pages) + 1
    assert spam_scores(df.limit(0)).count() == 0


def found(text):
    s = sorted(pii.spans(text, pii.Settings()), key=lambda x: x.start)
    return [(x.kind, text[x.start : x.end]) for x in s if not any(y is not x and y.start <= x.start and x.end <= y.end for y in s)]


def test_pii_spans_keep_their_place():
    t = "<p>Contact:&nbsp;Ossian R. Tveit, tel. ０６１-５５５-２７４４ or +1 (202) 555-0153</p>\nMail oss at celmond dot co dot example or a.b+c@d.example. Papers go to 330/47 Soi Ulmfane 10, Tulom Road, Rayong; card 4-0036-96028-53-6."
    assert found(t) == [("name", "Ossian R. Tveit"), ("phone", "０６１-５５５-２７４４"), ("phone", "+1 (202) 555-0153"), ("email", "oss at celmond dot co dot example"), ("email", "a.b+c@d.example"), ("address", "330/47 Soi Ulmfane 10, Tulom Road"), ("id_number", "4-0036-96028-53-6")]
    assert ("name", "บุษบา จันทร์งาม") in found("ติดต่อฝ่ายบุคคล คุณบุษบา จันทร์งาม โทร 081-234-5678")
    assert ("name", "Tveit, Ossian") in found("Ask for Tveit, Ossian.") and ("name", "Đặng Thị") in found("Liên hệ: Đặng Thị")
    assert found("Follow @kel_life, package @kel/core at version 3.26.1, rows 28232823, IP 192.0.2.13, budget 1,200,000") == []
    assert found("") == [] and found("word " * 50_000) == []
    assert found("x" * 500 + "@host.example")[0][1] == "x" * 500 + "@host.example" and len(pii.spans("<" * 20_000 + "a@" * 20_000, pii.Settings())) < 20_001


def test_vote_aggregation_finds_the_two_sides():
    v = np.array([(1, 1, 1, 0), (1, 0, 1, 0), (-1, 0, -1, -1), (-1, 0, 0, -1)])
    p = pii.aggregate_votes(v, np.array([500, 80, 300, 60]))
    assert p[0] > 0.9 and p[1] > 0.5 and p[2] < 0.1 and p[3] < 0.5
    assert pii.aggregate_votes(np.array([(1, 1, 0, 1), (1, 1, 0, 0)]), np.array([40, 3])).min() > 0.5
    # most places without any vote, as of names: the rare class is not drowned
    v = np.array([(0, -1, 0), (0, 1, 1), (0, 1, 0), (0, 0, 0)])
    p = pii.aggregate_votes(v, np.array([50_000, 400, 60, 200]), silent=True)
    assert p[0] < 0.05 and p[1] > 0.9 and p[2] > 0.5 and p[3] < 0.5


def test_best_names_are_those_of_the_greatest_odds():
    start, end = np.array([0, 6, 12, 0]), np.array([11, 18, 20, 20])
    assert sorted(pii.best_names(start, end, np.array([0.9, 0.97, 0.9, 0.6]))) == [0, 2]
    assert pii.best_names(start, end, np.array([0.6, 0.999, 0.6, 0.6])) == [1]


def people(rng, n):
    """Persons with names that no list has, some of them used more than once."""
    syllable = lambda k: "".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(k))
    given, family = [syllable(2).title() + rng.choice("nlrs") for _ in range(n)], [syllable(3).title() + rng.choice("nlrst") for _ in range(n)]
    return given, family


def corpus(rng, n):
    """(id, text), {(id, kind, start)}: texts of made persons, with phrases of their own, and of other capitalised and numbered things."""
    given, family = people(rng, 60)
    tools = ["Open Ledger", "Crate Runner", "Blue Harbour", "Paper Mill", "Night Shift", "Cold Store", "Stock Count"]
    rows, truth = [], set()
    for i in range(n):
        g, f = rng.choice(given), rng.choice(family)
        full = rng.choice([f"{g} {f}", f"{g} {rng.choice('ABK')}. {f}", f"{f}, {g}", f"{g} {f}"])
        number, house = f"08{rng.randrange(10)}-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}", rng.randrange(2, 400)
        lines = [
            (rng.choice(["Your contact person: ", "Mr. ", "Signed, ", "Please ask for ", "Dr. ", "Recruiter: "]), "name", full, f" looks after {rng.choice(tools)} here."),
            (rng.choice(["Tel. ", "Phone: ", "Call "]), "phone", number, "."), (rng.choice(["E-mail: ", "Write to "]), "email", f"{g.lower()}{i}@firm{i % 9}.example", " please."),
            (rng.choice(["Our office is at ", "Address: "]), "address", f"{house} {rng.choice(['Linden', 'Orchard', 'Mill'])} {rng.choice(['Street', 'Road', 'Avenue'])}", ", Lowtown."),
            (rng.choice(["Passport ", "ID card no. "]), "id_number", f"{rng.randrange(1, 9)}-{rng.randrange(1000, 9999)}-{rng.randrange(10000, 99999)}-{rng.randrange(10, 99)}-{rng.randrange(9)}", " of the holder."),
            ("Last week ", "name", full, f" showed us the {rng.choice(tools)} again."),
        ]
        text, spots = f"{rng.choice(tools)} and {rng.choice(tools)} are in use. Order {rng.randrange(10**12, 10**13)} has {rng.randrange(10**8, 10**9)} rows. We count {rng.choice(tools)} weekly.\n", []
        for before, kind, value, after in rng.sample(lines, 4):
            text += before
            spots.append((kind, len(text)))
            text += value + after + rng.choice(["\n", " "])
        if i % 25 == 3:
            text = text.lower()
        rows.append((f"t{i}", text))
        truth |= {(f"t{i}", k, a + 1) for k, a in spots}
    return rows, truth


def test_pii_of_unlisted_persons(spark):
    """Recall and precision of every kind on names that are in no list, text without capitals included."""
    rows, truth = corpus(random.Random(12), 1500)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id string, text string, kind string")
    cands, lexicon = pii.voted_candidates(df)
    model = pii.train(cands)
    got = {(r["id"], r["kind"], r["start_pos"]) for r in pii.decide(cands, model).collect()}
    for kind in pii.KINDS:
        a, b = {t for t in truth if t[1] == kind}, {t for t in got if t[1] == kind}
        assert len(a & b) >= 0.9 * len(a) and len(a & b) >= 0.9 * len(b), (kind, len(a), len(b), len(a & b))
    low = {i for i, t in rows if t == t.lower()}
    a, b = {t for t in truth if t[0] in low and t[1] == "name"}, {t for t in got if t[0] in low and t[1] == "name"}
    assert len(low) == 60 and len(a & b) >= 0.9 * len(a) and len(a & b) >= 0.9 * len(b)
    words = {w for i, t in rows if i not in low for w in t.replace(",", " ").split() if w[:1].isupper()}
    assert not {w.lower() for w in words} & pii._GIVEN
    out = {r["id"]: (r["text"], r["n_found"]) for r in pii.redact(df, model, lexicon).collect()}
    assert sum(n for _, n in out.values()) == len(got) and all(f"[{k.upper()}]" in out[i][0] for i, k, _ in got)


def test_pii_of_nothing(spark):
    df = spark.createDataFrame([("n", None), ("e", ""), ("s", "[phone removed]"), ("p", "Mr. Ossian Tveit")], "id string, text string")
    cands, lexicon = pii.voted_candidates(df.limit(0))
    model = pii.train(cands)
    assert pii.decide(cands, model).count() == 0
    out = {r["id"]: (r["text"], r["n_found"]) for r in pii.redact(df, model, lexicon).collect()}
    assert out == {"n": (None, 0), "e": ("", 0), "s": ("[phone removed]", 0), "p": ("Mr. Ossian Tveit", 0)}


DE = "Wir erwarten etwa sechs Jahre Erfahrung mit dem Werkzeug. Wer die Aufgabe nicht kennt, lernt bei uns, die Speicherkosten zu planen."
FR = "Vous allez expliquer les modèles de prévision pendant les mois calmes. Le salaire dépend de votre façon de vérifier les trajets."


def test_language(spark):
    texts = {"en": PROSE, "th": THAI, "de": DE, "fr": FR}
    rows = [(f"{k}{i}", "\n".join([v.split(". ")[i % v.count(". ") if ". " in v else 0] + ".", v]), k if i % 8 else "en") for k, v in texts.items() for i in range(24)]
    rows += [("mix", PROSE + "\nStack: Velquery / Junelbane / Qx\n" + FR + "\r\n\r\n" + THAI, "en"), ("nul", None, "en"), ("blank", " \n", "de"), ("digits", "12 34", None)]
    df = spark.createDataFrame(rows, "id string, text string, label string")
    posts = df.select("id", "text")
    model = language.train(posts, df.select("id", language.label_code(F.col("label")).alias("code")))
    got = {r["id"]: [p["lang"] for p in r["passages"]] for r in language.detect(posts, model).collect()}
    assert all(got[f"{k}{i}"] == [k] for k in texts for i in range(24))
    assert got["mix"] == ["en", "fr", "th"] and got["nul"] == [] and got["blank"] == [] and got["digits"] == []
    p = model.probabilities(*model.scores([PROSE, DE])[:2])
    assert np.allclose(p.sum(1), 1) and p[0].argmax() == 0
    assert language.detect(posts.limit(0), model).count() == 0


def test_confidence_is_calibrated(spark):
    """Short lines of known languages, a tenth of them with a wrong label in training: confidence and accuracy agree."""
    rng = random.Random(4)
    words = {"en": PROSE.split(), "de": DE.split(), "fr": FR.split(), "id": "kami mencari orang yang suka bekerja dengan data setiap hari dan bisa menulis laporan untuk kantor cabang di kota lain".split()}
    make = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    rows = [(f"{k}{i}", "\n".join(make(k, 7) for _ in range(3)), k if i % 10 else "en") for k in words for i in range(120)]
    df = spark.createDataFrame(rows, "id string, text string, code string")
    model = language.train(df.select("id", "text"), df.select("id", "code"))
    new = [(k, make(k, n)) for k in words for n in (3, 4, 6, 12) for _ in range(100)]
    p = [x[0] for x in language.passages([t for _, t in new], model) if x]
    right = np.array([a[0] == k for a, (k, _) in zip(p, new, strict=True)], float)
    error = language.calibration_error(np.array([a[1] for a in p]), right)
    assert right.mean() > 0.9 and error < 0.1
    assert language.calibration_error(np.array([1.0, 1.0, 0.55]), np.array([1.0, 0.0, 1.0])) > 0.3


def test_label_codes(spark):
    cases = {"EN": "en", "en_GB": "en", "English": "en", "ไทย": "th", "th-TH": "th", "日本語": "ja", "deu": "de", "und": None, "": None, "??": None, "Bahasa Indonesia": "id", "n/a": None}
    df = spark.createDataFrame([(k,) for k in cases], "l string")
    assert {r["l"]: r["c"] for r in df.select("l", language.label_code(F.col("l")).alias("c")).collect()} == cases
