import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnlens.functions import conjuncts, formats, masking, patterns, segments, stats, text


@pytest.mark.parametrize(
    "given_text, masked, spans",
    [
        ("Run `pip install x` at https://a.b/c now", "Run ⟦0⟧ at ⟦1⟧ now", ["`pip install x`", "https://a.b/c"]),
        ("`see https://a.b/c`", "`see ⟦0⟧", ["https://a.b/c`"]),
        ("plain", "plain", []),
        ("```\na `b` c\n```", "⟦0⟧", ["```\na `b` c\n```"]),
        ("[t](https://x.y) me@x.org <b>z</b>", "⟦0⟧ ⟦1⟧ ⟦2⟧z⟦3⟧", ["[t](https://x.y)", "me@x.org", "<b>", "</b>"]),
        ("", "", []),
    ],
)
def test_mask(given_text, masked, spans):
    assert masking.mask(given_text) == (masked, spans)


@pytest.mark.parametrize(
    "t, spans, expected",
    [
        ("I have 0 cats", ["X"], "I have X cats"),
        ("A ⟦ 0 ⟧ b", ["X"], "A X b"),
        ("nothing here", ["X", "Y"], "nothing here X Y"),
        ("⟦7⟧ a", ["X"], "⟦7⟧ a X"),
        ("⟦1⟧ then 0", ["X", "Y"], "Y then X"),
        ("⟦12 items", ["X", "Y"], "⟦12 items X Y"),
        ("x", [], "x"),
        ("a \x000\x00 b", ["X"], "a \x00X\x00 b"),
        ("\x005\x00 ⟦0⟧", ["X"], "\x005\x00 X"),
        ("0 1 10 01", ["X", "Y"], "X Y 10 01"),
        ("⟦0⟧ and ⟦0⟧", ["0 1"], "0 1 and 0 1"),
    ],
)
def test_unmask(t, spans, expected):
    assert masking.unmask(t, spans) == expected


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_characters="⟦⟧\x00", exclude_categories=["Cs"]), max_size=80))
def test_mask_round_trip(t):
    assert masking.unmask(*masking.mask(t)) == t


@pytest.mark.parametrize(
    "t, source, expected",
    [
        ("T 0 D `a`", "See `a` now", ("T `a` D", "reconstructed")),
        ("T D `a`", "See `a` now", ("T D\n\n`a`", "partial")),
        ("T", "no spans", ("T", "no_mask")),
        ("T other", "See `a` now", ("T other", "skipped_no_tail")),
        ("one\ntwo 0 `a`", "See `a` now", ("one\ntwo 0\n\n`a`", "partial")),
    ],
)
def test_repair_leak(t, source, expected):
    assert masking.repair_leak(t, source) == expected


def test_segments():
    assert segments.cut("Hi. Bye!\n\n- x") == (["Hi.", "Bye!", "- x"], ["Hi. Bye!", "", "- x"], [2, 0, 1])
    assert segments.wrap("aaa bb cccccccc", 5) == ["aaa", "bb", "ccccc", "ccc"]
    assert segments.wrap("a  b c", 3) == ["a b", "c"]
    assert segments.cut("你好。 再见！")[0] == ["你好。", "再见！"]


@settings(max_examples=150, deadline=None)
@given(st.text("ab. !?\n", max_size=60))
def test_segments_rebuild_up_to_spaces(t):
    back = segments.rebuild(*segments.cut(t))
    assert re.sub(r"[ \t]+", " ", back).replace(" \n", "\n").split() == t.split()


# frequencies of invented corpora: common words with a joiner, one below the threshold, words that stand alone
LEXICON = {"ශ්‍රී": 60, "මිත්‍රයා": 12, "වාක්‍යය": 5, "සත්‍යවාදී": 30, "චක්‍රය": 4, "බස්": 80, "රථයක්": 80, "ගස්": 9}


@pytest.mark.parametrize(
    "t, tiers, kept",
    [
        ("ශ් රී ලංකාව", ["T1"], 0),  # a word of the lexicon
        ("මිත් රයා වාක් යය කියයි", ["T1", "T1"], 0),
        ("සත් යවාදී", ["T1"], 0),
        ("චක් රය", [], 1),  # below the threshold, and no lone consonant before it
        ("බස් රථයක්", [], 1),  # two words that only stand beside each other
        ("ගස් යට", [], 1),
        ("ක් රමය", ["T3"], 0),  # a lone consonant, its cluster attested by a rare word
        ("ග් රහයා", [], 1),  # a cluster that no word attests
        ("xශ් 12", [], 0),
        ("ශ්‍රී", [], 0),
        ("", [], 0),
    ],
)
def test_conjuncts(t, tiers, kept):
    joiner = conjuncts.Joiner(LEXICON)
    out, merges, n, _ = joiner.repair(t)
    assert [m[1] for m in merges] == tiers and n == kept and len(out) == len(t)
    assert out.replace("\u200d", " ") == t.replace("\u200d", " ") and (out != t) == bool(tiers)
    assert joiner.repair(out)[0] == out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["ශ්", "රී", "ක්", "රමය", "බස්", "යට", "x", "ශ්‍රී", ".", "මිත්", "රයා"]), max_size=8))
def test_conjunct_repair_changes_spaces_only_and_ends(parts):
    t = " ".join(parts)
    joiner = conjuncts.Joiner(LEXICON)
    out = joiner.repair(t)[0]
    assert out.replace("\u200d", " ") == t.replace("\u200d", " ") and joiner.repair(out)[0] == out


def test_conjunct_tiers():
    broken, whole = "චක් රය", "චක්‍රය"
    assert conjuncts.Joiner({whole: 5}).repair(broken)[1] == [(whole, "T1", 1)]
    assert conjuncts.Joiner({whole: 4}).repair(broken)[1] == []
    assert conjuncts.Joiner({}, frozenset([whole])).repair(broken)[1] == [(whole, "T2", 1)]
    assert conjuncts.Joiner({}).repair("ම් රට")[3] == ["ම් රට"]
    assert conjuncts.Joiner({"a": 1}, threshold=1).repair(broken)[2] == 1


POSITIVE = {
    "code_fence": "```", "inline_code": "`x`", "url": "www.é", "email": "é@ü.fr", "markdown_table": "x\n| a | b |", "bullet_list": "\x1c- item", "numbered_list": "١. y",
    "heading": "#　t", "latex_math": "\\frac{a}", "html_tag": "<a x>", "emoji": "☀", "md_link": "[t](u)", "emphasis": "_a",
}
NEAR_MISS = {
    "code_fence": "``", "inline_code": "`x\ny`", "url": "www. x", "email": "a@b", "markdown_table": "a\r| x |\rb", "bullet_list": "-x", "numbered_list": "1.x",
    "heading": "#t", "latex_math": "$E=mc^2$", "html_tag": "< b>", "emoji": "◿", "md_link": "[t] (u)", "emphasis": "* a",
}


def test_detectors(spark):
    rows = [(n, POSITIVE[n], True) for n in patterns.DETECTORS] + [(n, NEAR_MISS[n], False) for n in patterns.DETECTORS]
    rows += [("latex_math", "$x_{1}$", True), ("latex_math", "$(a^{2})$", False), ("bullet_list", " - item", True)]
    df = spark.createDataFrame(rows, "name string, t string, want boolean")
    for name in patterns.DETECTORS:
        for r in df.filter(F.col("name") == name).select("t", "want", patterns.has(name, F.col("t")).alias("got")).collect():
            assert r["got"] == r["want"], (name, r["t"])


def test_summary_and_quantiles(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "v int")
    r = df.agg(*stats.summary(F.col("v"))).first()
    assert (r["n"], r["total"], r["p50"]) == (4, 10, 2.5)
    empty = df.filter("v > 9").agg(*stats.summary(F.col("v"))).first()
    assert all(v == 0 for v in empty)


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a \n b  ", "x" * 230, "ab", "\x1c \t")], "a string, b string, c string, d string")
    r = df.select(text.snippet(F.col("a")).alias("s"), text.snippet(F.col("b")).alias("long"), text.token_estimate(F.col("c")).alias("t"), text.is_blank(F.col("d")).alias("blank"), text.is_blank(F.lit(None).cast("string")).alias("null")).first()
    assert r["s"] == "a b" and len(r["long"]) == 221 and r["t"] == 0 and r["blank"] and r["null"]


def test_formats(spark):
    df = spark.createDataFrame([(0, 0.4), (59, 59.6), (75, 75.0), (3_600, 3_661.9), (1_234_567, 90_000.0), (None, None)], "n long, s double")
    r = df.select(formats.grouped(F.col("n")).alias("g"), formats.human_time(F.col("s")).alias("t"), formats.percent_text(F.lit(1), F.col("n")).alias("p"), formats.ratio(F.lit(2), F.col("n")).alias("q")).collect()
    assert [x["g"] for x in r] == ["0", "59", "75", "3,600", "1,234,567", None]
    assert [x["t"] for x in r[:5]] == ["0s", "60s", "1m 15s", "1h 1m", "1.0 days"]
    assert r[0]["p"] == "n/a" and r[3]["p"] == "0.028%" and r[0]["q"] == 0.0
