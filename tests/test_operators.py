import json
import os

import pytest
from pyspark.sql import functions as F

from turnlens import __main__ as cli
from turnlens import schema, settings
from turnlens.functions import conjuncts, masking, segments
from turnlens.operators import curate, profile, progress, quality, tokens
from turnlens.plans import catalogue, reports
from turnlens.sources import records, sinks
from turnlens.streaming import translate

TYPE = "record_id long, split string, prompt string, prompt_id string, messages array<struct<content string, role string>>"
U, A = "user", "assistant"
ROWS = [
    (1, "train_sft", "Hi", "a", [("Hi", U), ("Hello", A)]),
    (2, "test_sft", "Hi", "a", [("Hi", U), ("Hello", A)]),
    (3, "train_sft", "x", "b", [("x", U), ("y", U)]),
    (4, "train_gen", "", "c", [("", U), (" \t", A)]),
    (5, "train_gen", None, "d", []),
    (6, "test_gen", "q", None, [("q", U), None, (None, A)]),
    (7, "test_gen", "s", "", [("s", "system"), ("u", U)]),
    (8, "odd", "e", "e", [("e", None), ("f", None)]),
    (9, "odd", "n", "f", None),
]


@pytest.fixture(scope="module")
def dialogues(spark):
    return spark.createDataFrame(ROWS, TYPE)


def test_structure(dialogues):
    r = profile.structure(dialogues).filter("is_overall").first()
    assert (r["n_records"], r["n_messages"], r["n_empty_messages"], r["n_nonalternating"], r["n_missing_prompt_id"]) == (9, 14, 2, 2, 2)


def test_repeated_pairs_and_roles(dialogues):
    assert profile.repeated_pairs(dialogues).filter("is_overall").first()["n_pairs"] == 1  # null after null is none
    first = {(r["split"], r["role"]): r["n"] for r in profile.first_roles(dialogues).collect()}
    assert first[("odd", None)] == 1 and first[("test_gen", "system")] == 1
    assert {r["role"] for r in profile.chars_by_role(dialogues).collect()} == {U, A, "_other"}


def test_profile_of_nothing(spark, dialogues):
    empty = dialogues.filter("record_id < 0")
    assert profile.features(empty).count() == 0
    assert [r["messages"] for r in profile.risk_register(empty).collect()] == [0] * 13
    assert tokens.groups(empty).count() == 0 and quality.language_quality(empty).count() == 0


def test_keep_first(spark):
    seq = [(0, "a", True), (1, "a", False), (2, None, False), (3, None, True), (4, "a", True), (5, "b", True)]
    df = spark.createDataFrame(seq, "ord int, id string, blank boolean")
    got = [r["outcome"] for r in curate.keep_first(df, "id", "ord", F.col("blank")).orderBy("ord").collect()]
    assert got == ["empty", "kept", "kept", "dup", "dup", "empty"]


def test_parts_are_round_robin_and_whole(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("k"), F.lit("x").alias("_n2"))
    got = curate.parts(df, "k", 10).orderBy("k").collect()
    assert [r["part"] for r in got] == [i % 10 for i in range(1000)]
    assert curate.parts(df.filter("k < 0"), "k", 3).count() == 0


def test_route_and_resume(spark, dialogues):
    ids = spark.createDataFrame([(" a ",), ("",), ("zz",), ("a",)], "prompt_id string")
    side = {r["record_id"]: r["side"] for r in curate.route(dialogues, ids).collect()}
    assert side[1] == side[2] == "test" and side[6] == "train" and len(side) == 9
    left = curate.not_yet_done(dialogues, spark.createDataFrame([("a",), (None,)], "prompt_id string"))
    assert sorted(r["record_id"] for r in left.collect()) == [3, 4, 5, 7, 8, 9]


def test_leaks_and_duplicates(dialogues):
    train, test = dialogues.filter("split LIKE 'train%'"), dialogues.filter("split LIKE 'test%'")
    r = curate.leaks(train, test, F.col("prompt_id"), "id").first()
    assert (r["shared_values"], r["test_rows"]) == (1, 1)
    assert curate.duplicates(dialogues, F.col("prompt_id")).first()["n_duplicates"] == 1
    assert curate.last_wins(dialogues.select("prompt_id", "split", "record_id"), "prompt_id", "record_id").count() == 8


def test_quality(spark):
    si = "ප" * 20
    rows = [(1, "s", "", "p", [(si, U), ("x" * 20, A)]), (2, "s", "", "q", [("x" * 19, U), ("ab " * 200, A)]), (3, "s", "", "r", [("ප් රධාන ප්‍රධාන", U)])]
    df = spark.createDataFrame(rows, TYPE)
    r = quality.language_quality(df).first()
    assert (r["n_judged"], r["n_low"], r["n_untranslated"], r["joiners"], r["broken_joints"], r["records_with_joiner"]) == (3, 2, 2, 1, 1, 1)
    assert quality.repetition(df).first()["n_repetitive"] == 1
    assert {x["flag"] for x in quality.flagged_examples(df).collect()} == {"low_sinhala", "untranslated"}


def test_readers_and_sinks(spark, tmp_path, dialogues):
    base = dialogues.select("prompt", "prompt_id", "messages")
    base.coalesce(1).write.parquet(str(tmp_path / "raw"))
    (tmp_path / "in").mkdir()
    part = next((tmp_path / "raw").glob("*.parquet"))
    part.rename(tmp_path / "in" / "train_sft-00000-of-00002-ab.parquet")
    df = records.read_splits(spark, str(tmp_path / "in"))
    assert df.count() == 9 and {r["split"] for r in df.select("split").distinct().collect()} == {"train_sft"}
    with pytest.raises(FileNotFoundError):
        records.read_splits(spark, str(tmp_path / "nothing"))
    lines = tmp_path / "a.jsonl"
    lines.write_text(json.dumps({"prompt": "p", "prompt_id": "i", "messages": [{"content": "a b\u0085c", "role": "user"}]}, ensure_ascii=False) + "\nnot json\n\n", encoding="utf-8")
    assert records.read_jsonl(spark, str(lines), "drop").count() == 1
    assert records.read_jsonl(spark, str(lines)).filter("_corrupt IS NOT NULL").count() == 1
    state = quality.line_states(records.read_lines(spark, str(lines)))
    assert {r["state"]: r["n"] for r in state.collect()} == {"ok": 1, "json_bad": 1, "blank": 1}
    with pytest.raises(ValueError):
        sinks.rewrite_lines(records.read_lines(spark, str(lines)).filter("line <> ''"), str(tmp_path / "out"))
    ids = tmp_path / "ids.txt"
    ids.write_text(" a \n\nb\na\n")
    assert records.read_ids(spark, str(ids)).count() == 2
    sinks.write_parts(curate.parts(dialogues, "record_id", 3), str(tmp_path / "parts"))
    assert spark.read.parquet(str(tmp_path / "parts")).groupBy("part").count().count() == 3
    assert records.line_counts(spark, str(lines)).first()["n"] == 3
    assert "_generated_at" in json.loads(sinks.artifact({"roles": profile.roles(dialogues)}))


def test_translation(spark, tmp_path, dialogues):
    out = translate.translated(dialogues, lambda: lambda ts: [t.upper() for t in ts])
    got = {r["prompt_id"]: r for r in out.filter("prompt_id IS NOT NULL").collect()}
    assert got["a"]["prompt"] == "HI" and [m["content"] for m in got["a"]["messages"]] == ["HI", "HELLO"]
    assert got["d"]["prompt"] is None and got["d"]["messages"] == [] and got["f"]["messages"] == []
    src, res, ck = (str(tmp_path / n) for n in ("src", "res", "ck"))
    dialogues.select("prompt", "prompt_id", "messages").write.parquet(src)
    for _ in range(2):  # the second run finds nothing new
        q = translate.translate_stream(spark, src, res, ck)
        q.awaitTermination()
        assert spark.read.schema(schema.RECORD).json(res).count() == 9
    translate.translate_batch(dialogues, spark.read.schema(schema.RECORD).json(res), str(tmp_path / "more"))
    assert spark.read.text(str(tmp_path / "more")).count() == 0
    assert translate.throughput(translate.identity(), ["a. b"])["segments"] == 2


def test_mask_columns_take_null(spark):
    df = spark.createDataFrame([(None,), ("`a`",)], "t string").withColumn("x", masking.masked(F.col("t")))
    assert [r["x"]["masked"] if r["x"] else None for r in df.collect()] == [None, "⟦0⟧"]


def test_reports(dialogues):
    text = reports.analysis_report(dialogues)
    for title in ("Abstract", "Methodology", "Structure", "Scripts", "Risk register", "Discussion", "Reproducibility"):
        assert f"## {title}" in text
    assert "absent" in reports.analysis_report(dialogues.filter("record_id < 0"))
    assert "absent" in reports.quality_report(dialogues) and "epochs_3" in reports.token_report(dialogues)


def test_aligned(dialogues):
    got = curate.aligned(dialogues.filter("record_id = 1"), dialogues.filter("record_id = 2"), "prompt_id", "messages").orderBy("pos").collect()
    assert [(r["left"], r["right"]) for r in got] == [("Hi", "Hi"), ("Hello", "Hello")]


def test_catalogue_has_sql_for_what_sql_can_say():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
    assert len(catalogue.oracle_sql()) >= 40


def test_long_report_tables_are_never_cut_silently(spark, tmp_path):
    forms = ", ".join(f"named_struct('form', 'f{i}', 'tier', 'lexicon', 'joints', 1)" for i in range(250))
    repaired = spark.sql(f"SELECT named_struct('merges', array({forms}), 'residual', array('x y')) AS repair")
    with pytest.raises(ValueError, match="Merged forms"):
        reports.repair_report(repaired)
    text = reports.repair_report(repaired, str(tmp_path))
    assert "50 more rows" in text and spark.read.parquet(str(tmp_path / "merged_forms")).count() == 250


def test_fail_fast_and_rewrite(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"prompt": "p", "prompt_id": "i", "messages": []}\n' * 50, encoding="utf-8")
    bad.write_text("not json\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_jsonl(spark, str(bad), "raise").collect()
    sinks.jsonl_to_parquet(spark, str(good), str(tmp_path / "pq"), group_rows=20)
    import pyarrow.parquet as pq

    (file,) = (tmp_path / "pq").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_rows == 50 and meta.num_row_groups == 3 and meta.row_group(0).column(0).compression == "ZSTD"
    assert sinks.rewrite_lines(records.read_lines(spark, str(good)), str(tmp_path / "again")) == 50
    sinks.write_sides(spark.createDataFrame([("a é", "train"), ("b", "test")], "line string, side string"), str(tmp_path / "sides"))
    assert spark.read.text(str(tmp_path / "sides")).count() == 2
    two = records.read_labelled(spark, [f"good={good}", f"bad={bad}"])
    assert {r["label"]: r["count"] for r in two.groupBy("label").count().collect()} == {"good": 50, "bad": 1}
    assert [r["line"][:1] for r in two.orderBy("ord").limit(1).collect()] == ["n"]  # by file, then row


def test_free_text_vocab_and_logs(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes(b"a\xffb\nc\n")
    assert [r["text"] for r in records.read_free_text(spark, str(tmp_path / "t.txt")).collect()] == ["ab", "c"]
    (tmp_path / "v.tsv").write_text("▁ක්‍ර\t-1\nab\t-2\n", encoding="utf-8")
    assert [r["form"] for r in records.read_joiner_pieces(spark, str(tmp_path / "v.tsv")).collect()] == ["ක්‍ර"]
    (tmp_path / "x.log").write_text("start\nDONE part_01\n")
    (tmp_path / "y.log").write_text("start\n")
    assert [r["file_name"] for r in records.finished_logs(spark, str(tmp_path / "*.log")).collect()] == ["x.log"]


def test_artifacts_are_optional(spark, tmp_path, dialogues):
    with pytest.warns(UserWarning, match="no artifact"):
        assert sinks.read_artifact(spark, str(tmp_path / "none.json")) == {}
    (tmp_path / "a.json").write_text(sinks.artifact({"roles": profile.roles(dialogues)}), encoding="utf-8")
    assert "roles" in sinks.read_artifact(spark, str(tmp_path / "a.json"))


def test_lexicon_is_kept_by_least_count(spark, tmp_path):
    texts = spark.createDataFrame([("වන වන රට",)], "content string")
    first = conjuncts.cached_lexicon(texts, "content", str(tmp_path), 2)
    assert {r["word"] for r in first.collect()} == {"වන"}
    assert {r["word"] for r in conjuncts.cached_lexicon(texts, "content", str(tmp_path), 1).collect()} == {"වන", "රට"}
    assert conjuncts.cached_lexicon(texts.filter("content = ''"), "content", str(tmp_path), 2).count() == 1  # kept


def test_repair_with_a_lexicon_too_large_to_hold(spark):
    lex = spark.createDataFrame([("ශ්‍රී", 40), ("මිත්‍රයා", 9), ("ක්‍රමය", 2), ("රථය", 70)], "word string, n long")
    texts = spark.createDataFrame([("ශ් රී මිත් රයා ක් රමය",), (None,), ("",)], "t string")
    whole = [r["repair"] for r in conjuncts.repaired(texts, lex, "t").collect()]
    assert whole == [r["repair"] for r in conjuncts.repaired(texts, lex, "t", most=0).collect()]
    assert [m["tier"] for m in whole[0]["merges"]] == ["T1", "T1", "T3"]


def test_progress(spark):
    parts = spark.createDataFrame([("a", 5, True), ("b", 3, False), ("c", 0, None), ("d", 99, False), ("e", None, False)], "part string, done long, finished boolean")
    totals = spark.createDataFrame([("c", 7), ("d", 10), ("a", 1)], "part string, total long")
    status = progress.parts_status(progress.totals_of(parts, {"a": 10, "b": 10}, totals))
    got = {r["part"]: (r["done"], r["total"], r["pct"], r["status"], r["resume_from"]) for r in status.collect()}
    assert got == {"a": (10, 10, 100.0, "done", None), "b": (3, 10, 30.0, "partial", 3), "c": (0, 7, 0.0, "queued", None), "d": (10, 10, 100.0, "partial", 10), "e": (0, 0, 0.0, "queued", None)}
    document, text = progress.summary(status, 7.0)
    assert json.loads(document)["remaining"] == 14 and "Time left : 2.00 h" in text
    assert json.loads(progress.summary(status.filter("part = 'z'"), 0.0)[0])["hours_left"] is None
    log = spark.sql("SELECT 'j' AS job, timestamp'2024-01-01' + make_dt_interval(0, h) AS ts, d AS done FROM VALUES (0, 0), (1, 500), (3, 500), (4, 600) AS t(h, d)")
    assert [r["per_hour"] for r in progress.rates(log).orderBy("ts").collect()] == [11_000.0, 500.0, 11_000.0, 100.0]


def test_segments_within_a_token_limit(spark, dialogues):
    count = lambda: lambda t: len(t)  # a token per character
    long = spark.createDataFrame([(1, "s", "word " * 200, "p", [("word " * 200, U), ("x" * 300, A)])], TYPE)
    seen = []

    def make():
        def run(texts):
            assert all(len(t) <= 50 for t in texts)
            return [t + " " for t in texts]

        return run

    out = translate.translated(long, make, count=count, most=50, mend=str.rstrip).first()
    assert out["messages"][0]["content"].split() == ["word"] * 200 and out["messages"][1]["content"].replace(" ", "") == "x" * 300
    assert segments.fit("", len, 5) == [""] and segments.fit("abc def", len, 5) == ["abc", "def"] and not seen
    with pytest.raises(ValueError):
        segments.within(["a", "b"], lambda ts: ts[:1], None, 5, None)


def test_exact_token_counts(spark, dialogues):
    path = "/opt/tokenizers/piece_bpe_32k.model"
    if not os.path.exists(path):
        pytest.skip("no tokenizer files here")
    got = {r["record_id"]: r["tokens"] for r in tokens.exact_dialogue_tokens(dialogues, path).collect()}
    count = tokens.file_counter(path)()
    assert got[1] == count("Hi") + count("Hello") and got[5] == 0 and len(got) == 9
    with pytest.warns(UserWarning, match="estimated"):
        assert tokens.exact_count(spark, "/none.model") is tokens.text.token_estimate


def test_settings_and_command_line(spark, tmp_path, dialogues, capsys):
    s = settings.load({"TURNLENS_MASK": "no", "TURNLENS_PARTS": "3", "TURNLENS_BATCH": " "})
    assert (s.mask, s.parts, s.batch) == (False, 3, 96)
    with pytest.raises(ValueError):
        settings.load({"TURNLENS_MASK": "maybe"})
    data, out = tmp_path / "data", str(tmp_path / "out")
    dialogues.select("prompt", "prompt_id", "messages").coalesce(1).write.parquet(str(data))
    run = lambda *a: cli.run(list(a), spark, s)
    assert run("splits", str(data)) == 0 and capsys.readouterr().out.endswith("9\n")
    for n in (2, 9, 9):  # resumes where it stopped
        run("translate", str(data), "--out", out, *(["--limit", "2"] if n == 2 else []))
        assert spark.read.schema(schema.RECORD).json(out).count() == n
    run("split", str(data), "--out", str(tmp_path / "parts"))
    assert sum(p["dialogues"] for p in json.loads((tmp_path / "parts" / "_manifest.json").read_text())["parts"]) == 9
    run("lexicon", str(data), "--out", str(tmp_path / "lex"))
    run("tokens", str(data), "--out", str(tmp_path / "t.md"))
    run("quality", f"all={out}/*.json", "--out", str(tmp_path / "q.md"))
    assert "| all |" in (tmp_path / "q.md").read_text() and "## Distributions" in (tmp_path / "t.md").read_text()
    run("to-parquet", f"{out}/*.json", str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 9
    (tmp_path / "ids.txt").write_text("a\n")
    run("route", f"{out}/*.json", str(tmp_path / "ids.txt"), str(tmp_path / "sides"))
    assert {r["side"]: r["count"] for r in spark.read.text(str(tmp_path / "sides")).groupBy("side").count().collect()} == {"test": 2, "train": 7}
    run("repair", f"{out}/*.json", str(tmp_path / "lex"), str(tmp_path / "fixed"))
    assert spark.read.text(str(tmp_path / "fixed")).count() == 9
    run("progress", f"{out}/*.json", str(tmp_path / "parts" / "_manifest.json"))
    assert "Remaining" in capsys.readouterr().out
    assert run("selftest") == 0
