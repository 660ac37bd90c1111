"""Small fixtures and brute-force twins of the training-data operators."""

import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnlens.llm import dupes, kernels, languages, overlap, packing, pairs, passages, personal, repetition, tokens, unify

TYPE = "record_id long, split string, source string, domain string, lang string, prompt string, prompt_id string, messages array<struct<content string, role string>>, turn string, text string, rep int"
U, A = "user", "assistant"


def brute_words(t):
    out = []
    for w in t.split():
        while w and unicodedata.category(w[0])[0] in "PS":
            w = w[1:]
        while w and unicodedata.category(w[-1])[0] in "PS":
            w = w[:-1]
        if w:
            out.append(w.lower())
    return out


def dialogue(i, turns, split="train_sft", lang="en", pid="p", prompt="q"):
    return (i, split, "s", "d", lang, prompt, pid, turns, "x", "y", 1)


def make(spark, rows):
    return spark.createDataFrame(rows, TYPE)


ODD = [
    dialogue(901, None),
    dialogue(902, []),
    dialogue(903, [None, (None, U), ("", A), (None, None)]),
    dialogue(904, [("q?", U), None]),
    dialogue(905, [("\n", U), ("one", A)], pid=None, prompt=None),
    (None, None, None, None, None, None, None, None, None, None, None),
]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é.,!  \n‘-1ක්‍"), max_size=30), min_size=1, max_size=5))
def test_words_are_those_of_the_definition(texts):
    block = kernels.Block(texts)
    h, s, e, off = block.words()
    for i, t in enumerate(texts):
        assert [block.joined[a:b].lower() for a, b in zip(s[off[i] : off[i + 1]], e[off[i] : off[i + 1]])] == brute_words(t)
    flat = [block.joined[a:b].lower() for a, b in zip(s, e)]
    assert len(set(h.tolist())) == len(set(flat))


# --- repetition ---------------------------------------------------------------


def brute_share(t):
    w = brute_words(t)
    seen, hit = set(), [False] * len(w)
    for i in range(len(w) - 4):
        g = tuple(w[i : i + 5])
        if g in seen:
            hit[i : i + 5] = [True] * 5
        seen.add(g)
    return sum(hit) / len(w) if w else 0.0


def test_repetition_against_brute_force():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["", "a", "x " * 5000]
    got = repetition.text_stats(texts)["share"]
    assert np.allclose(got, [brute_share(t) for t in texts])


def test_decision_list_finds_the_repetitive_and_nothing_else(spark):
    rows = [dialogue(10, [("a b c d e f g h i j", U), ("a b c d e a b c d e", A), ("a b c d e f g h i j a b c d e x y z", A)]), *ODD]
    assert "share" not in repetition.STATS
    out = {(r["record_id"], r["turn"]): r for r in repetition.repetition(make(spark, rows)).collect()}
    assert [out[10, k]["repetitive"] for k in range(3)] == [False, True, False]
    assert out[10, 1]["share"] == 0.5 and out[903, 0]["n_words"] == 0
    assert repetition.repetition(make(spark, rows).filter("record_id < 0")).count() == 0


def test_sequential_covering_learns_a_conjunction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = (x[:, 0] >= 0.6) & (x[:, 1] <= 0.5)
    rules = repetition.learn(x, y)
    got = np.any([repetition._covers(r, x) for r in rules], axis=0)
    assert got[y].all() and y[got].mean() > 0.95 and max(map(len, rules)) > 1
    assert repetition.learn(x, np.zeros(2000, bool)) == []


def test_the_list_finds_held_out_repetition():
    x, y = repetition.labelled()
    rules = repetition.learn(x[::2], y[::2])
    got = np.any([repetition._covers(r, x[1::2]) for r in rules], axis=0)
    assert got[y[1::2]].mean() > 0.99 and y[1::2][got].mean() > 0.5


# --- unification --------------------------------------------------------------


@pytest.mark.parametrize(
    "t, plain",
    [
        ("Ｆｕｌｌ１２．", "Full12."), ("ﬁrst ﬂood", "first flood"), ("café", "café"), ("a​b﻿", "ab"), ("a b　c d", "a b c d"),
        ("рrоudly", "proudly"), ("villɑge", "village"), ("well‐known‑ly", "well-known-ly"), ("end․", "end."), ("so‚ then", "so, then"),
        ("https꞉//x", "https://x"), ("ⅴiⅼⅼage", "village"), ("𝐛old", "bold"), ("Κannst", "Kannst"), ("Kelvin", "Kelvin"),
        ("ො", "ො"), ("x‍y", "xy"),
    ],
)
def test_unify_changes(t, plain):
    assert unify.unify(t) == (plain, True)
    assert unify.suspects(kernels.Block([t])).all()
    assert unify.unify(plain) == (plain, False)


@pytest.mark.parametrize("t", ["plain text", "«слово»", "λόγος ΛΌΓΟΣ", "你好。", "你好，世界", "“quoted” — ‘it’s’ „so“", "ක්‍රමය", "👩‍💻", "naïve Straße", "café\n\tx", "❤️", ""])
def test_unify_leaves(t):
    assert unify.unify(t) == (t, False)


@pytest.mark.parametrize(
    "t",
    [
        "я и он, а у нас с отцом", "Она сама не своя, а у него все хорошо.", "То же самое: оно, сор, рот и тема.", "Το πρωί ο Νίκος και η Άννα πάνε στο χωριό.",
        "ΤΟ ΝΕΟ ΒΙΒΛΙΟ ΤΗΣ ΑΝΝΑΣ", "Слово «сор» и the word", "λόγος, ο και το", "Հայերեն օր",
    ],
)
def test_plain_paragraphs_of_other_scripts_stay(t):
    assert unify.unify(t) == (t, False)


def test_one_form_however_typed():
    for a, b in (("а у нас рот", "a y нас poт"), ("the сор said", "the cop said"), ("оно", "oнo"), ("сор", "cop"), ("ꓢꓔꓳꓑ now", "STOP now"), ("ⲟⲣ else", "op else")):
        assert unify.unify(a)[0] == unify.unify(b)[0]
    split = "\u0bae\u0bc6\u0bbe"  # a Tamil vowel in two parts
    assert unify.unify(split) == ("\u0bae\u0bca", True) and unify.suspects(kernels.Block([split])).all()
    assert unify.unify("\u1112\u1161\u11ab")[0] == "한" and unify.suspects(kernels.Block(["\u1112\u1161\u11ab"])).all()


def test_unify_turns(spark):
    rows = [dialogue(1, [("ａ", U), ("a", A), None, (None, A)]), *ODD[1:]]
    out = {(r["record_id"], r["turn"]): (r["unified"], r["affected"]) for r in unify.unify_turns(make(spark, rows)).collect()}
    assert out[1, 0] == ("a", True) and out[1, 1] == ("a", False) and out[1, 2] == (None, False)
    assert unify.unify_turns(make(spark, rows), only_affected=True).count() == 1


# --- copies -------------------------------------------------------------------


def test_copies(spark):
    base = [("Hello, World!", U), ("Straße λόγος", A)]
    rows = [
        dialogue(7, base), dialogue(3, [("hello world", U), ("STRASSE ΛΌΓΟΣ", A)]), dialogue(9, base, pid=""), dialogue(8, base, pid=None),
        dialogue(5, [("hello world again", U), ("Straße λόγος", A)]), dialogue(7, base), dialogue(11, None), dialogue(12, []),
    ]
    keyed = dupes.keys(make(spark, rows).select("record_id", "prompt_id", "prompt", "messages"))
    got = {(r["first_record_id"], r["record_id"], r["copies"]) for r in dupes.members(keyed).collect()}
    assert got == {(3, 7, 3), (3, 3, 3), (8, 9, 2), (8, 8, 2), (5, 5, 1), (11, 11, 2), (11, 12, 2)}
    assert dupes.members(keyed.filter("record_id < 0")).count() == 0


def test_hot_copies_are_counted_as_others(spark, monkeypatch):
    rows = [dialogue(i, [("same", U)]) for i in range(50, 0, -1)] + [dialogue(100 + i, [(f"t{i // 2}", U)]) for i in range(20)]
    keyed = dupes.keys(make(spark, rows).select("record_id", "prompt_id", "prompt", "messages"))
    plain = sorted(tuple(r) for r in dupes.members(keyed).collect())
    monkeypatch.setattr(dupes, "HOT_ROWS", 10)
    assert sorted(tuple(r) for r in dupes.members(keyed).collect()) == plain
    assert dupes.copies(keyed).count() == 11


def test_parsed_lines(spark):
    lines = ['{"prompt":"a","prompt_id":null,"messages":[{"content":"x","role":"user"}]}', '  {"messages":[{"role":"user","content":"x"}],"prompt_id":"","prompt":"A!"}', '{"prompt_id":"i","messages":[{"content":"x","role":"user"}]}', '{"prompt":"a","prompt_id":"i","messages":[]}', "null", "[]", "", None, '{"prompt":"a","prompt_id":"i","messages":[{"con', "not json"]
    df = spark.createDataFrame(list(enumerate(lines)), "record_id long, line string")
    got = dupes.members(dupes.keys(dupes.parsed_lines(df))).collect()
    assert {(r["first_record_id"], r["record_id"]) for r in got} == {(0, 0), (0, 1)}


# --- overlap ------------------------------------------------------------------


def test_common_words_and_bags():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 25))] for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        assert overlap.common_words(x, y) == d[-1][-1]
    assert overlap.bag_jaccard(np.array([1, 1, 2]), np.array([1, 2, 2])) == 0.5


def test_overlaps_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(5, 120))) for _ in range(30)]
    rows = []
    for i, t in enumerate(texts):
        w = t.split()
        for k in range(len(w) // 12):
            w[rng.randrange(len(w))] = "zz"
        rows += [dialogue(1000 + 2 * i, [(t, U)], split="train_sft"), dialogue(1001 + 2 * i, [(" ".join(w).upper(), U)], split="test_gen")]
    rows += [dialogue(200, [(texts[0], U)], split="test_sft"), dialogue(201, [("other " + texts[1][:40], U)], split="test_sft"), dialogue(202, [("оne twо three", U)]), dialogue(203, [("one two three", U)], split="test_sft"), *ODD]
    got = {(r["test_id"], r["train_id"]) for r in overlap.overlaps(make(spark, rows)).collect()}
    words = {r[0]: brute_words(unify.unify(" ".join(m[0] or "" for m in r[7] if m))[0]) for r in rows if r[0] is not None and r[7]}
    side = {r[0]: (r[1] or "")[:4] for r in rows}
    want = set()
    for x in words:
        for y in words:
            if side[x] == "test" and side[y] == "trai" and words[x] and words[y]:
                a, b = (np.array([hash(w) & 0xFFFFFFFF for w in words[k]], np.uint32) for k in (x, y))
                if overlap.common_words(a, b) >= 0.75 * max(a.size, b.size):
                    want.add((x, y))
    assert got == want and (200, 1000) in want and (203, 202) in want
    assert overlap.overlaps(make(spark, ODD)).count() == 0
    report = overlap.report(make(spark, rows))
    assert {r["split"] for r in report.collect()} == {"test_gen", "test_sft"}


def test_scattered_changes_are_found(spark):
    rng = random.Random(15)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for i, n in enumerate([4, 8, 12, 17, 20, 24, 28, 32, 33, 40, 60, 60, 80, 100, 150, 200, 200, 400] * 3):
        w = [rng.choice(vocab) for _ in range(n)]
        x = list(w)
        for k in rng.sample(range(n), int(n * (0.15, 0.2, 0.25)[i % 3])):
            x[k] = f"new{k}"
        if i % 2:  # the change may lengthen the dialogue as well
            x.insert(rng.randrange(len(x)), "more")
        rows += [dialogue(2 * i, [(" ".join(w), U)]), dialogue(2 * i + 1, [(" ".join(x), U)], split="test_sft")]
    got = {(r["test_id"], r["train_id"]) for r in overlap.overlaps(make(spark, rows)).collect()}
    words = {r[0]: np.array([hash(w) & 0xFFFFFFFF for w in brute_words(r[7][0][0])], np.uint32) for r in rows}
    near = lambda a, b: overlap.common_words(a, b) >= 0.75 * max(a.size, b.size)
    want = {(x, y) for x in words for y in words if x % 2 and not y % 2 and near(words[x], words[y])}
    assert got == want and len(want) > 30


def test_few_chance_candidates(spark):
    """Texts of the same few words, none near another, hardly ever come to be compared word by word."""
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(130)]
    odds = [1 / (i + 8) for i in range(len(vocab))]
    rows = [dialogue(i, [(" ".join(rng.choices(vocab, odds, k=220)), U)], split="test_sft" if i % 4 == 0 else "train_sft") for i in range(240)]
    signed = overlap.signatures(make(spark, rows).selectExpr("record_id", "IF(split LIKE 'test%', 1, 0) AS side", "messages"))
    reps = signed.selectExpr("record_id AS rep", "side AS test", "side AS train", "n", "words")
    met = overlap.candidates(overlap._prefix_rows(reps, overlap._order(signed))).count()
    assert met <= 60 * 180 // 100


@pytest.mark.parametrize("trains, dense", [(8192, 1024), (64, 4), (20, 1)])
def test_meetings_against_brute_force(monkeypatch, trains, dense):
    """Words kept as bits or as lists, in one part or in several: no overlap of the bags is lost."""
    monkeypatch.setattr(overlap, "TRAINS", trains)
    monkeypatch.setattr(overlap, "DENSE", dense)
    rng = np.random.default_rng(8)
    made = [rng.integers(0, 90, int(n)).astype(np.uint32) for n in rng.integers(1, 130, 90)]
    other = [np.where(rng.random(w.size) < rng.choice([0, 0.1, 0.2, 0.25]), rng.integers(0, 90, w.size), w).astype(np.uint32) for w in made]
    place = rng.permutation(1 << overlap.ORDER_BITS).astype(np.uint32)
    tables = []
    for side in (made, other):
        x, off, last = overlap.prefixes(np.concatenate(side), np.concatenate(([0], np.cumsum([w.size for w in side]))), place)
        tables.append(pa.table({"n": [w.size for w in side], "last": last.astype(np.int64), "prefix": pa.array([x[a:b].tobytes() for a, b in zip(off[:-1], off[1:])], pa.binary())}))
    got = set(zip(*(x.tolist() for x in overlap.meetings(*tables))))
    bags = [[np.bincount(w, minlength=90) for w in side] for side in (made, other)]
    want = {(i, j) for i, a in enumerate(bags[0]) for j, b in enumerate(bags[1]) if np.minimum(a, b).sum() >= 0.75 * max(a.sum(), b.sum())}
    assert want <= got and len(want) > 60


# --- languages ----------------------------------------------------------------

SAMPLES = {
    "en": "The ferry captain kindly returns the old modem near the bridge and thanks everyone who has helped with the work.",
    "fr": "Le capitaine du bac rend gentiment le vieux modem près du pont et remercie tous ceux qui ont aidé au travail.",
    "de": "Der Kapitän der Fähre gibt das alte Modem an der Brücke freundlich zurück und dankt allen, die geholfen haben.",
    "es": "El capitán del transbordador devuelve con amabilidad el viejo módem cerca del puente y da las gracias a todos.",
    "si": "අපේ අසල්වැසියා පාලම ළඟ පරණ මේසය සූදානම් කරයි. ඉවසිලිවන්ත ගොවියා උණුසුම් සුප් එකක් බෙදා ගනියි.",
}


@pytest.fixture(scope="module")
def model():
    return languages.fit([(k, v) for k, v in SAMPLES.items() for _ in range(3)])


def test_code_lengths_are_those_of_the_trees():
    m = languages.LanguageModel([{"ab": 3, "ac": 1}, {}, {}, {}, {}])
    # order 0 after "ab": contexts of the leading space, then of what stands before each byte
    got = m.code_lengths(["ab"])[0]
    want = -np.log2(4 / 5) - np.log2(3 / 6) - np.log2(3 / 4)
    assert abs(got[0] - want) < 1e-6 and got[1] == 24.0


def test_languages(spark, model):
    mixed = SAMPLES["de"] + " " + SAMPLES["fr"]
    rows = [
        dialogue(1, [(SAMPLES["fr"], U)], lang="EN"), dialogue(2, [(SAMPLES["fr"], U)], lang="fra_Latn"), dialogue(3, [(mixed, U)], lang="German"),
        dialogue(4, [(SAMPLES["si"], U)], lang=None), dialogue(5, [("", U)], lang=None), *ODD[1:4],
    ]
    out = {r["record_id"]: r for r in languages.assign(make(spark, rows), model).collect()}
    main = {k: {x["lang"] for x in r["languages"] if x["share"] >= 0.15} for k, r in out.items()}
    assert main[1] == {"fr"} and main[3] == {"de", "fr"} and main[4] == {"si"} and main[5] == set()
    assert out[2]["label"] == "fr" and out[4]["label"] is None and out[1]["languages"][0]["confidence"] > 0.99
    s = languages.stretches(make(spark, rows).filter("record_id = 3"), model).orderBy("start").collect()
    assert [x["lang"] for x in s] == ["de", "fr"]


def test_sampled_takes_the_smallest_hashes(spark):
    df = spark.range(5000).withColumnRenamed("id", "record_id")
    place = F.shiftrightunsigned(F.xxhash64("record_id"), 1)
    for rows in (50, 4000, 9000):
        got = {r[0] for r in languages.sampled(df, rows).collect()}
        assert got == {r[0] for r in df.orderBy(place, "record_id").limit(rows).collect()}
    assert languages.sampled(df.filter("record_id < 0"), 5).count() == 0


def test_models_fit_on_tables(spark):
    rows = [dialogue(i, [(SAMPLES[k], U), (SAMPLES[k], A)], lang=k) for i, k in enumerate(("en", "fr", "de", "es", "si") * 3)] + ODD
    df = make(spark, rows)
    assert languages.corrections(df).filter("record_id < 15").count() == 0
    assert pairs.defects(df.filter("record_id < 0")).count() == 0 and languages.corrections(df.filter("record_id < 0")).count() == 0
    assert {r["defect"] for r in pairs.defects(df).collect()} <= set(pairs.DEFECTS)


def test_held_out_accuracy(model):
    rest = {"en": "everyone has helped with the bridge", "fr": "tous ont aidé près du pont", "de": "allen an der Brücke geholfen", "es": "gracias a todos cerca del puente"}
    for lang, t in rest.items():
        block = kernels.Block([t])
        assert languages.LANGS[languages.segment(model, block)["turn_bits"].argmin(1)[0]] == lang


# --- broken pairs -------------------------------------------------------------


@pytest.fixture(scope="module")
def classifier():
    rng = random.Random(6)
    rows = []
    for i in range(400):
        lang = ("en", "fr", "de", "es")[i % 4]
        w = SAMPLES[lang].rstrip(".").split()
        sentence = lambda: " ".join(rng.sample(w, len(w))) + rng.choice(".!")
        end = "\n1. " + " ".join(rng.sample(w, 4)) + "\n2. " + " ".join(rng.sample(w, 4)) if i % 5 == 0 else ""
        rows.append((lang, [(U, "What about " + " ".join(rng.sample(w, 9)) + "?"), (A, " ".join(sentence() for _ in range(3)) + end)]))
    return pairs.train(rows)


def test_defects(spark, classifier):
    q, en = "What about the old modem near the bridge and the ferry captain?", SAMPLES["en"]
    cases = [("", "empty"), ("…", "empty"), ("N/A", "empty"), (None, "empty"), ("​", "empty"), (q, "copy"), (q.upper(), "copy"), ("Question: " + q, "copy"), (SAMPLES["fr"] * 2, "other_language"),
             (en + " The ferry captain kindly returns the old mo", "truncated"), (en + " The ferry captain kindly returns the old,", "truncated"), (en + "\n```\nx = 1", "truncated"), ("I'm sorry, but I can't help with that request.", "refusal"),
             (en + " " + en, None), (q + " " + en, None), (en + "\n1. the old modem\n2. the bridge", None),
             # no length decides: a long refusal, a long list item, a short answer in another language, a long stand-in
             ("I regret that I can offer no help here. " + "This is outside of what I may talk about, and the rules I follow do not let me say anything on it. " * 3 + "I choose not to respond.", "refusal"),
             (en + "\n1. the old modem\n2. " + "the bridge near the old modem and the ferry captain " * 100, None), ("Muchísimas gracias, señores.", "other_language"), ("No answer provided, response missing. " * 3, "empty")]
    rows = [dialogue(i, [(q, U), (a, A)]) for i, (a, _) in enumerate(cases)]
    rows.append(dialogue(90, [("Say it in French: " + q, U), (SAMPLES["fr"], A), ("", A)]))
    got = {(r["record_id"], r["turn"]): r["defect"] for r in pairs.defects(make(spark, rows + ODD[1:4]), classifier).collect()}
    want = {(i, 1): d for i, (_, d) in enumerate(cases) if d} | {(903, 2): "empty"}
    assert got == want


def test_every_dialogue_counts_in_training(spark):
    n = 4_400
    place = F.shiftrightunsigned(F.xxhash64("record_id"), 1)
    last = {r[0] for r in spark.range(n).withColumnRenamed("id", "record_id").orderBy(place.desc()).limit(2).collect()}
    # a word that only the dialogues of the largest hashes hold
    rows = [dialogue(i, [("What is it?", U), (("A quillomar stands " if i in last else "A modem stands ") + "near the bridge.", A)]) for i in range(n)]
    fitted, pairs_ = pairs.train_on(make(spark, rows))
    assert pairs_.filter("not invented").count() == n
    assert kernels.Block(["quillomar"]).words()[0][0] in fitted.known


def test_a_single_odd_pair_does_not_set_the_threshold():
    model = pairs.Classifier(None, None)
    cell = np.array([3000, 2900, 2800, -1000])
    model.calibrate(cell, np.array([1000, 1, 1000, 5000]), np.array([1000, 0, 1000, 0]), 3)
    assert -1000 < model.threshold[3] * pairs.CELLS < 2800
    model.calibrate(cell, np.array([1000, 1, 1, 5000]), np.array([1000, 0, 1, 0]), 1)
    assert -1000 < model.threshold[1] * pairs.CELLS < 2900


def test_words_leave_a_batch_once_and_strays_are_taken_away():
    rng = random.Random(11)
    turns, langs = [], []
    for i in range(1200):  # more than a block
        said, label = (("en", "fr", "de", "es")[k] for k in (i % 4, (i + (i % 10 == 0)) % 4))
        w = SAMPLES[said].split()
        turns.append([{"content": " ".join(rng.choices(w, k=100)), "role": A}])
        langs.append(None if i % 7 == 0 else label)
    assert sum(len(t[0]["content"]) for t in turns) > kernels.BLOCK
    kind = pa.list_(pa.struct([("content", pa.string()), ("role", pa.string())]))
    dialogues = lambda at: pairs.Here(list(pairs._unified(iter([pa.RecordBatch.from_arrays([pa.array(at), pa.array([langs[i] for i in at], pa.string()), pa.array([turns[i] for i in at], kind)], ["record_id", "lang", "messages"])]))))
    both = dialogues(list(range(1200)))
    (out,) = pairs._words(iter(both.batches))
    want: dict[tuple[str, int], list[int]] = {}
    for lang, ((turn,)) in zip(langs, turns):
        words = [w.strip(".,").lower() for w in turn["content"].split()]
        for k, w in enumerate(words):
            n = want.setdefault((w, pairs.LANGS.index(lang) if lang else -1), [0, 0])
            n[0] += 1
            n[1] += k < len(words) - 1
    got = list(zip(*(out.column(c).to_pylist() for c in ("word", "lang", "n", "inner"))))
    assert len(got) == len(want) and {(w, lang): [n, inner] for w, lang, n, inner in got} == want

    symbol = ("lang int, key long, n long", ["lang", "key"])
    counted = pairs.Here([out]).summed(pairs._symbols, *symbol)
    model = pairs.Classifier(pairs._trees(counted), np.zeros(0, np.uint64))
    trees = pairs._trees(counted, both.summed(pairs._strays(both.share(model)), *symbol))
    own = [i for i in range(1200) if langs[i] == ("en", "fr", "de", "es")[i % 4]]
    clean = pairs._trees(pairs.Here(list(pairs._words(iter(dialogues(own).batches)))).summed(pairs._symbols, *symbol))
    for name in ("sym", "count", "ctx", "total", "kinds"):
        assert np.array_equal(getattr(trees, name), getattr(clean, name))


def test_scores_are_the_sums_of_each_pair():
    rng = np.random.default_rng(3)
    size = np.array([0, 3, 0, 0, 5, 1, 0])
    off = np.concatenate(([0], np.cumsum(size)))
    grams = rng.integers(0, pairs.BUCKETS, off[-1]).astype(np.uint16)
    rows = pairs.Rows((grams, off), (grams[:0], np.zeros(len(off), np.int64)), [np.array([-1, 2, -1, 4, -1, -1, 7])], rng.random((7, len(pairs.DENSE)), np.float32))
    w, dense = rng.random((2 * pairs.BUCKETS, 5)), rng.random((len(pairs.DENSE), 5))
    want = rows.dense @ dense
    for i, e in enumerate(rows.ends[0]):
        want[i] += sum(w[g] for g in grams[off[i] : off[i + 1]]) / max(size[i], 1) ** 0.5 + (w[e + pairs.BUCKETS] if e >= 0 else 0)
    assert np.allclose(rows.scores(w, dense), want)


@given(st.lists(st.text(st.sampled_from("aé.-! \n…\u200b"), max_size=40), max_size=4))
def test_words_lose_the_signs_at_their_ends(texts):
    block = kernels.Block(texts)
    got = [block.joined[a:b] for a, b in zip(*(x.tolist() for x in block.spans()))]
    assert got == [w for w in (w.strip(".-!…") for t in texts for w in t.split()) if w]


# --- tokens and packing -------------------------------------------------------


def test_piece_list_is_the_best_segmentation():
    rng = random.Random(8)
    pieces = [("<unk>", 0.0)] + [(p, -rng.random() * 5) for p in ("▁", "▁a", "▁ab", "a", "b", "ab", "ba", "bab", "c")]
    counter = tokens.PieceList(pieces)
    score = dict(pieces[1:])

    def best(t):
        states = {0: (0.0, 0, False)}
        for i in range(len(t)):
            for j in range(i + 1, len(t) + 1):
                if t[i:j] in score:
                    s = (states[i][0] + score[t[i:j]], states[i][1] + 1, False)
                elif j == i + 1:
                    s = (states[i][0] + min(score.values()) - 10, states[i][1] + (not states[i][2]), True)
                else:
                    continue
                if j not in states or s[0] > states[j][0]:
                    states[j] = s
        return states[len(t)][1]

    for _ in range(100):
        w = "".join(rng.choice("abcx") for _ in range(rng.randint(1, 9)))
        assert counter.count(w) == best("▁" + w)
    assert counter.count("") == 0 and counter.count(" ab\n ab ") == 2 * counter.count("ab")
    assert not tokens.independent(["a▁b"]) and tokens.independent(["▁▁a"])


def test_public_tokenizer_counts_are_exact():
    sentencepiece = pytest.importorskip("sentencepiece")
    try:
        counter = tokens.PublicBPE(open(tokens.PUBLIC_MODEL, "rb").read())
    except OSError:
        pytest.skip("no tokenizer files here")
    sp = sentencepiece.SentencePieceProcessor(model_proto=counter.model)
    rng = random.Random(9)
    for t in ["", " ", "  ", "a  b ", "x\n\n  y", "▁a ▁", *("".join(rng.choice("ab é\nක.  ") for _ in range(60)) for _ in range(80))]:
        assert counter.count(t) == len(sp.encode(t)), repr(t)
        for size in (1, 7):
            parts = counter.bounds.chunks(t, size)
            assert "".join(x for _, x in parts) == t and sum(counter.count(x, c) for c, x in parts) == len(sp.encode(t)), repr(t)


def test_long_texts_are_counted_in_chunks(spark, monkeypatch, model):
    monkeypatch.setattr(tokens, "CHUNK", 50)
    vocab = spark.createDataFrame([("▁a", -1.0), ("▁b", -1.0), ("a", -2.0), ("<unk>", 0.0)], "piece string, score double")
    rows = [dialogue(1, [("a b " * 100, U), ("a", A)]), *ODD[1:4]]
    got = {(r["record_id"], r["role"]): r["tokens"] for r in tokens.dialogue_tokens(make(spark, rows), vocab, model).collect()}
    assert got[1, U] == 200 and got[1, A] == 1 and got[903, None] == 0
    table = tokens.budget(tokens.token_rows(make(spark, rows), vocab, model)).collect()
    assert {r["kept"] for r in table} == {",".join(k for i, k in enumerate(tokens.KEYS) if m >> i & 1) for m in range(16)}
    for kept in {r["kept"] for r in table}:
        assert sum(r["tokens"] for r in table if r["kept"] == kept) == sum(got.values())
        assert sum(r["dialogue_roles"] for r in table if r["kept"] == kept) == len(got)


def test_tokens_of_nothing_and_of_repeated_rows(spark, model):
    vocab = spark.createDataFrame([("▁a", -1.0), (None, None), ("<unk>", 0.0)], "piece string, score double")
    none = make(spark, ODD).filter("record_id < 0")
    assert tokens.dialogue_tokens(none, vocab, model).count() == 0
    assert all(r["tokens"] is None for r in tokens.budget(tokens.token_rows(none, vocab, model)).collect())
    twice = make(spark, [dialogue(1, [("a a", U)])] * 2)
    assert [(r["turns"], r["tokens"]) for r in tokens.dialogue_tokens(twice, vocab, model).collect()] == [(2, 4)]
    counter = tokens.PieceList([("▁a", -1.0)])
    texts = spark.createDataFrame([(1, "a a", "x"), (2, None, "x"), (3, "", "x"), (3, "a", "x")], "doc_id long, text string, tokens string")
    assert sorted((r["doc_id"], r["tokens"]) for r in tokens.sizes(texts, counter, "doc_id").collect()) == [(1, 2), (2, 0), (3, 0), (3, 1)]
    assert tokens.sizes(texts.filter("doc_id < 0"), counter, "doc_id").count() == 0


def test_texts_are_cut_only_where_it_is_proved():
    rng = random.Random(21)
    cases = [
        [("▁", -1.0), ("▁a", -1.2), ("a", -2.0), ("b", -2.0), ("ab", -2.5), ("▁ab", -2.0), ("c", -3.0), ("\n", -3.0)],
        [("▁", -1.0), ("a", -2.0), ("a▁b", -0.5), ("b", -2.0), ("ba", -2.5)],  # a piece spans a word's start
        [("a", -1.0), ("xy", -1.0), ("yy", -2.0)],  # unknown characters
    ]
    cut = 0
    for pieces in cases:
        counter = tokens.PieceList(pieces)
        for _ in range(150):
            t = "".join(rng.choice("aabbc x\ny ") for _ in range(rng.randint(0, 40)))
            parts = counter.bounds.chunks(t, 5)
            cut += len(parts) > 1
            assert "".join(x for _, x in parts) == t and sum(counter.count(x, c) for c, x in parts) == counter.count(t), (pieces, t)
    assert cut > 100
    assert tokens.PieceList([("ab", -1.0), ("ba", -1.0), ("a", -1.0), ("b", -1.0)]).bounds.chunks("ab" * 5000, 10) == [("", "ab" * 5000)]
    long = tokens.PieceList([("你", -1.0), ("好", -1.0), ("▁", -1.0)])  # no spaces at all
    assert len(long.bounds.chunks("你好" * 5000, 100)) == 100 and sum(long.count(x, c) for c, x in long.bounds.chunks("你好" * 5000, 100)) == long.count("你好" * 5000)


def test_plan_is_near_the_bound():
    rng = random.Random(10)
    for cap in (50, 200):
        histogram = {}
        for _ in range(3000):
            n = rng.randint(1, cap)
            histogram[n] = histogram.get(n, 0) + 1
        p = packing.plan(histogram, cap)
        bound = -(-sum(n * c for n, c in histogram.items()) // cap)
        fill: dict[int, int] = {}
        used: dict[int, int] = {}
        for length, times, base, copies in zip(p.length, p.times, p.base, p.copies):
            used[length] = used.get(length, 0) + times * copies
            for k in range(copies):
                fill[base + k] = fill.get(base + k, 0) + length * times
        assert used == histogram and max(fill.values()) <= cap and len(fill) == p.containers
        assert len(fill) <= max(1.01 * bound, sum(c for n, c in histogram.items() if 2 * n > cap) * 1.03)


@pytest.mark.parametrize("copies", [1, 40, 1000])
def test_the_program_packs_every_item_once_and_no_worse_than_best_fit(copies):
    rng = random.Random(17)
    histogram: dict[int, int] = {}
    for _ in range(1500):
        n = rng.randint(20, 1000)
        histogram[n] = histogram.get(n, 0) + copies
    met = dict.fromkeys(histogram, 0)
    plain = packing.Plan()
    packing._best_fit(histogram, 1500, plain, {})
    usage = packing.solved(histogram, 1500, plain.containers)
    for pattern, x in usage:
        assert sum(n * m for n, m in pattern.items()) <= 1500
        for n, m in pattern.items():
            met[n] += m * x
    assert met == histogram
    assert sum(x for _, x in usage) <= plain.containers and packing.plan(histogram, 1500).containers == sum(x for _, x in usage)


def test_knapsack_against_brute_force():
    rng = random.Random(18)
    for _ in range(60):
        lengths = sorted(rng.sample(range(1, 12), 4))
        worth = [rng.random() for _ in lengths]
        most = [rng.randint(1, 5) for _ in lengths]
        got = packing.best_pattern(np.array(lengths), np.array(worth), np.array(most), 20)
        options = [()]
        for m in most:
            options = [o + (k,) for o in options for k in range(m + 1)]
        best = max(sum(k * w for k, w in zip(o, worth)) for o in options if sum(k * n for k, n in zip(o, lengths)) <= 20)
        assert all(got.get(n, 0) <= m for n, m in zip(lengths, most)) and sum(n * k for n, k in got.items()) <= 20
        assert abs(sum(worth[lengths.index(n)] * k for n, k in got.items()) - best) < 1e-9


def test_pack(spark):
    rng = random.Random(11)
    sizes = [(i, rng.choice([0, 3, 7, 10, 11, 25, None])) for i in range(300)] + [(5, 7), (5, 7)]
    df = spark.createDataFrame(sizes, "doc_id long, tokens long")
    got = packing.pack(df, 10).collect()
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["container"], []).append(r)
    assert all(sum(x["tokens"] for x in c) <= 10 and sorted(x["position"] for x in c) == list(range(len(c))) for c in by.values())
    whole: dict[int, int] = {}
    for r in got:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["tokens"]
    want: dict[int, int] = {}
    for i, n in sizes:
        want[i] = want.get(i, 0) + (n or 0)
    assert whole == want
    assert packing.pack(df.filter("doc_id < 0"), 10).count() == 0
    assert packing.pack(df.filter("tokens = 0"), 10).select("container").distinct().count() == 1


# --- passages -----------------------------------------------------------------


def test_passages_against_brute_force(spark):
    rng = random.Random(12)
    vocab = ["the", "a", "of", "bridge", "quietly", "measures", "xeph", "in", "for", "days"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(40))) for i in range(12)] + [(90, None), (91, "too short"), (92, "")]
    docs = []
    for d in range(60):
        w = [rng.choice(vocab) for _ in range(30)]
        src = items[d % 12][1].split()
        k, n = rng.randrange(20), rng.randint(9, 15)
        piece = " ".join(src[k : k + n])
        docs.append((d, " ".join(w[:15]) + rng.choice([" ", ", ", "\n"]) + rng.choice([piece, piece.upper(), piece.replace(" ", " , ")]) + " " + " ".join(w[15:]), 1))
    docs += [(100, None, 1), (101, "", 1), (102, "x" * 30000, 1), (0, docs[0][1], 1)]

    def words(t):
        return [x for x in ("".join(c for c in w if c.isalnum()) for w in (t or "").lower().split()) if x]

    grams = {i: {tuple(words(t)[k : k + 12]) for k in range(len(words(t)) - 11)} for i, t in items}
    want = {(d, i) for d, t, _ in docs for i in grams for k in range(len(words(t)) - 11) if tuple(words(t)[k : k + 12]) in grams[i]}
    df, it = spark.createDataFrame(docs, "doc_id long, text string, item_id int"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in passages.leaks(df, it).filter("words >= 12").collect()}
    assert got == want and want
    assert {(r["doc_id"], r["item_id"]) for r in passages.leaks(df, it, edits=0).collect()} == want
    assert passages.leaks(df.filter("doc_id < 0"), it).count() == 0 and passages.leaks(df, it.filter("item_id < 0")).count() == 0


def test_the_longest_of_several_runs_counts(spark):
    rng = random.Random(16)
    w = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    other = " ".join(f"other{i}" for i in range(20))
    docs = [
        (1, " ".join(w[:14]) + f" {other} " + " ".join(w[20:50])),  # in two pieces
        (2, " ".join(w[5:18]) + f" {other} " + " ".join(w)),  # twice, the shorter first
        (3, " ".join(w[30:60]) + f" {other} " + " ".join(w[:13])),
    ]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(w))], "item_id long, text string")
    assert {r["doc_id"]: r["words"] for r in passages.leaks(df, it).collect()} == {1: 30, 2: 60, 3: 30}


def edit_distance_inside(pattern, text):
    """Fewest edits between ``pattern`` and any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("edits, hits", [(1, 10**6), (2, 10**6), (3, 10**6), (1, 20), (2, 300)])
def test_passages_within_the_edit_budget_against_brute_force(edits, hits, monkeypatch):
    monkeypatch.setattr(passages, "HITS", hits)  # documents are looked at in parts
    rng = random.Random(20 + edits)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    items = [" ".join(word() for _ in range(rng.randint(12, 16))) for _ in range(12)]
    docs = []
    for k in range(60):
        t = items[k % 12]
        for _ in range(rng.randint(0, edits + 1)):
            at = rng.randrange(1, len(t))
            t = rng.choice([t[:at] + rng.choice("abcdefgh") + t[at:], t[:at] + t[at + 1 :], t[: at - 1] + t[at : at + 1] + t[at - 1 : at] + t[at + 1 :]])
        docs.append(" ".join(word() for _ in range(10)) + " " + t + " " + " ".join(word() for _ in range(10)))
    index = passages.ItemIndex(list(range(12)), items, edits=edits)
    got: dict[tuple[int, int], tuple[int, int]] = {}
    for d, i, w, m in index.search(passages.reduce(docs, index.q)):
        got[d, i] = max((w, m), got.get((d, i), (0, 0)))
    want = set()
    for d, t in enumerate(docs):
        for i, item in enumerate(items):
            w = item.split()
            if any(edit_distance_inside("".join(w[k : k + 12]), t.replace(" ", "")) <= edits for k in range(len(w) - 11)):
                want.add((d, i))
    assert set(got) == want and any(w < 12 for w, _ in got.values())


def test_passages_of_repetitive_texts(spark):
    """Every Q-gram of the item stands everywhere in the document."""
    item = " ".join(["no"] * 20)
    df = spark.createDataFrame([(1, " ".join(["no"] * 3000)), (2, "no " * 11), (3, None)], "doc_id long, text string")
    it = spark.createDataFrame([(7, item), (8, item), (9, "")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"], r["words"]) for r in passages.leaks(df, it).collect()} == {(1, 7, 20), (1, 8, 20)}


def test_edited_passages(spark):
    item = "the quiet ferry captain measures an old bridge for seven days before harvest"  # 13 words
    docs = [(1, "So " + item.replace("ferry", "fery") + " now"), (2, item.replace("captain", "cpatain")), (3, item), (4, item.replace("bridge", "canal")), (5, None)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    near = lambda e: {r["doc_id"]: (r["words"], r["near_words"]) for r in passages.leaks(df, it, edits=e).collect()}
    assert near(1) == {1: (10, 13), 3: (13, 13)} and set(near(2)) == {1, 2, 3} and set(near(0)) == {3}


# --- personal -----------------------------------------------------------------


@pytest.mark.parametrize(
    "t, kind, value",
    [
        ("Write to a.b+c@mail.x-y.example.", "email", "a.b+c@mail.x-y.example"), ("(a_b (at) mail (dot) x (dot) test)", "email", "a_b (at) mail (dot) x (dot) test"), ("a [at] b.test now", "email", "a [at] b.test"),
        ("call +1-202-555-0113 now", "phone", "+1-202-555-0113"), ("(202) 555-0172", "phone", "(202) 555-0172"), ("Tel. 030/23125-256", "phone", "030/23125-256"), ("06.39.98.04.95!", "phone", "06.39.98.04.95"), ("0061491570189", "phone", "0061491570189"),
        ("id 666-51-9768.", "id_number", "666-51-9768"), ("QX-104-616-G", "id_number", "QX-104-616-G"), ("88 999 8387 X as", "id_number", "88 999 8387 X"), ("899993931V", "id_number", "899993931V"), ("192899902640", "id_number", "192899902640"),
        ("at 38B Belonwick St. now", "street_address", "38B Belonwick St."), ("in der Varimbrustraße 191 am", "street_address", "Varimbrustraße 191"), ("180 bis rue de Yorevnor .", "street_address", "180 bis rue de Yorevnor"), ("en Calle Yorimar, 219 desde", "street_address", "Calle Yorimar, 219"), ("අපි අංක 117, ටොතොට වීදිය පදිංචියි.", "street_address", "අංක 117, ටොතොට වීදිය"),
    ],
)
def test_fixed_forms(t, kind, value):
    assert [(k, t[a:b]) for k, a, b in personal.fixed_forms(t)] == [(kind, value)]


@pytest.mark.parametrize("t", ["code jarelton@13 here", "Follow @club_x", "Order no. 75130-51", "Version 4.39.17 replaced build 2017-39.", "1 375 570 coins", "28468 m high", "Score 80:33", "pages 19-119", "The 2018 report lists 33,1800 visits", "a street festival for 12 days", ""])
def test_no_fixed_forms(t):
    assert personal.fixed_forms(t) == []


def test_names(spark):
    given = ["Anna", "Bert", "Cora", "Dora"]
    family = ["Quill", "Rasp", "Stone"]
    texts = [f"Please ask Ms {g} {f} about it." for g in given for f in family + ["Newname"]]
    texts += [f"The {f} Bridge opened. Lake {f} lies east. They live at 5 {f} Drive today." for f in family + ["Newname"]]
    texts += ["According to Stone, Bert, the plan is fine.", "It was R. Quill who answered.", "Nobody Here about us", None, ""]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, value string")
    names = spark.createDataFrame([(g, "given") for g in given] + [(f, "family") for f in family] + [(None, None)], "name string, kind string")
    got = {(r["doc_id"], r["value"]) for r in personal.findings(docs, names).filter("kind = 'name'").collect()}
    want = {(i, re.search(r"Ms (\w+ \w+)", t)[1]) for i, t in enumerate(texts[:16])} | {(20, "Stone, Bert"), (21, "R. Quill")}
    assert got == want
    clean = {r["doc_id"]: r["text"] for r in personal.sanitised(docs, names).collect()}
    assert clean[0] == "Please ask Ms [NAME] about it." and clean[23] is None and clean[24] == "" and "[STREET_ADDRESS]" in clean[16]
    with pytest.MonkeyPatch.context() as m:  # beyond the bound spans are joined, with the same result
        m.setattr(personal, "BROADCAST_TERMS", 0)
        assert {r["doc_id"]: r["text"] for r in personal.sanitised(docs, names).collect()} == clean
    assert personal.findings(docs.filter("doc_id < 0"), names).count() == 0
    assert personal.findings(docs, names.filter("name = ''")).filter("kind = 'name'").count() == 0


def test_contexts_decide_what_a_form_discloses(spark):
    rng = random.Random(22)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [f"Please call {rng.choice(['me', 'us'])} on +1-{digits(3)}-{digits(3)}-{digits(4)} after lunch." for _ in range(60)]
    texts += [f"Please call {rng.choice(['me', 'us'])} on ({digits(3)}) {digits(3)}-{digits(4)} after lunch." for _ in range(60)]
    texts += [f"The batch was filed under article code {digits(4)}-{digits(6)} in spring." for _ in range(60)]
    texts += [f"The batch was filed under article code {rng.choice(['202', '303', '414'])}.{digits(3)}.{digits(4)} in spring." for _ in range(60)]
    texts += ["My passport is QX-104-616-G."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = spark.createDataFrame([], "name string, kind string")
    got = personal.findings(docs, names).collect()
    assert {r["doc_id"] for r in got if r["kind"] == "phone"} == set(range(120))  # ddd.ddd.dddd has a phone's form, but no phone's contexts
    assert {r["value"] for r in got if r["kind"] == "id_number"} == {"QX-104-616-G"}  # one alone: its form decides
    clean = {r["doc_id"]: r["text"] for r in personal.sanitised(docs, names).collect()}
    assert clean[0].endswith("on [PHONE] after lunch.") and clean[200] == texts[200]


def test_queries_are_whole_and_named():
    from turnlens.llm import queries

    names = queries.queries()
    assert {f"p{n}_found" for n in (1, 2, 3, 4, 5, 7, 9, 10)} | {"p6_budget", "p8_containers"} <= set(names)
