"""Command line: ``python -m turnlens COMMAND``; settings come from the environment (settings.py)."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import settings
from .functions import conjuncts
from .operators import curate, profile, progress, quality, tokens
from .plans import reports
from .schema import messages_of
from .sources import records, sinks
from .streaming import translate


def session(s: settings.Settings) -> SparkSession:
    b = SparkSession.builder.appName("turnlens").config("spark.sql.session.timeZone", "UTC")
    if s.master:
        b = b.master(s.master)
    if s.shared_folder:
        b = b.config("spark.checkpoint.dir", s.shared_folder)
    return b.getOrCreate()


def _records(spark: SparkSession, args: argparse.Namespace):
    """Shards of the chosen splits with an id: the place in the order of files and rows."""
    return records.read_splits(spark, args.data, args.splits).withColumn("record_id", F.col("ord.row"))


def _write(text: str, out: str | None) -> None:
    if out:
        Path(out).write_text(text, encoding="utf-8")
    else:
        sys.stdout.write(text)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="turnlens")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *names: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=about)
        for n in names:
            c.add_argument(n)
        return c

    for name, about in (("profile", "report on structure, content and risks"), ("tokens", "report on tokens"), ("splits", "list the splits and their records"), ("translate", "translate what is not yet done (identity unless a module is named)"), ("split", "deal records to parts"), ("lexicon", "build the lexicon of words")):
        c = command(name, about, "data")
        c.add_argument("--splits", nargs="*")
        c.add_argument("--out", required=name in ("translate", "split", "lexicon"))
        if name == "translate":
            c.add_argument("--translator", metavar="MODULE:FUNCTION", help="makes a function from segments to translations")
            c.add_argument("--limit", type=int, help="at most so many records that are not yet done")
            c.add_argument("--no-mask", action="store_true")
        if name == "split":
            c.add_argument("--parts", type=int)
    c = command("quality", "report on JSON lines", "inputs")
    c.add_argument("--out")
    c = command("to-parquet", "JSON lines as Parquet", "lines", "out")
    c = command("repair", "join broken conjuncts of JSON lines of texts", "lines", "lexicon", "out")
    c.add_argument("--vocab")
    c = command("route", "JSON lines to the train and test side by a list of ids", "lines", "ids", "out")
    c = command("progress", "how far parts are: lines of JSON files against the manifest of parts", "lines", "manifest")
    c.add_argument("--out")
    c = command("bench", "characters a second of a translator on a text file", "text")
    c.add_argument("--translator", metavar="MODULE:FUNCTION")
    sub.add_parser("selftest", help="run every case with a written result")
    return p


def _translator(named: str | None):
    if not named:
        return translate.identity
    import importlib

    module, _, name = named.partition(":")
    return getattr(importlib.import_module(module), name)


def run(argv: list[str], spark: SparkSession | None = None, s: settings.Settings | None = None) -> int:
    args = parser().parse_args(argv)
    s = s or settings.load()
    spark = spark or session(s)
    if args.command == "splits":
        for r in _records(spark, args).groupBy("split").count().orderBy("split").collect():
            print(f"{r['split']}\t{r['count']:,}")
    elif args.command == "profile":
        _write(reports.analysis_report(_records(spark, args)), args.out)
    elif args.command == "tokens":
        _write(reports.token_report(_records(spark, args), s.tokenizer or None), args.out)
    elif args.command == "split":
        df = _records(spark, args)
        parts = curate.parts(df.select("prompt", "prompt_id", "messages", "record_id"), "record_id", args.parts or s.parts)
        sinks.write_parts(parts, args.out)
        made = spark.read.parquet(args.out)
        chars = F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(F.coalesce(m["content"], F.lit(""))))
        manifest = made.groupBy("part").agg(F.count("*").alias("dialogues"), F.sum(chars).alias("chars")).orderBy("part")
        Path(args.out.removeprefix("file://"), "_manifest.json").write_text(sinks.artifact({"parts": manifest}), encoding="utf-8")
    elif args.command == "lexicon":
        texts = messages_of(_records(spark, args)).select("content")
        sinks.write_parquet(conjuncts.lexicon(texts, "content", s.lexicon_least), args.out, s.parquet_codec)
    elif args.command == "repair":
        lines = records.read_lines(spark, args.lines)
        pieces = frozenset(r["form"] for r in records.read_joiner_pieces(spark, args.vocab).collect()) if args.vocab else frozenset()
        out = conjuncts.repaired(lines, spark.read.parquet(args.lexicon), "line", pieces, s.word_threshold)
        sinks.rewrite_lines(out.select(F.col("repair.text").alias("line")), args.out)
    elif args.command == "route":
        lines = records.read_lines(spark, args.lines).select("line", F.get_json_object("line", "$.prompt_id").alias("prompt_id"))
        sinks.write_sides(curate.route(lines, records.read_ids(spark, args.ids)), args.out)
    elif args.command == "to-parquet":
        sinks.jsonl_to_parquet(spark, args.lines, args.out, s.parquet_codec, s.parquet_rows)
    elif args.command == "translate":
        df = _records(spark, args)
        make = _translator(args.translator)
        done = translate.done_so_far(spark, args.out)
        todo = df if done is None else curate.not_yet_done(df, done)
        if args.limit is not None:
            todo = curate.first_rows(todo, "ord", args.limit)
        count = tokens.file_counter(s.tokenizer) if s.tokenizer else None
        out = translate.translated(todo, make, s.mask and not args.no_mask, s.segment_chars, s.batch, count, s.segment_tokens)
        out.write.mode("append").option("ignoreNullFields", False).json(args.out)
    elif args.command == "quality":
        _write(reports.quality_of_inputs(spark, args.inputs.split(",")), args.out)
    elif args.command == "progress":
        lines = records.line_counts(spark, args.lines).select(F.regexp_replace("file_name", r"\..*$", "").alias("part"), F.col("n").alias("done"))
        manifest = spark.createDataFrame([(str(r["part"]), int(r["dialogues"])) for r in sinks.read_artifact(spark, args.manifest).get("parts", [])], "part string, total long")
        both = progress.totals_of(manifest.select("part").join(lines, "part", "full"), {}, manifest)
        _write(progress.summary(progress.parts_status(both.withColumn("finished", F.col("done") >= F.col("total"))))[1], args.out)
    elif args.command == "bench":
        got = translate.throughput(_translator(args.translator)(), Path(args.text).read_text(encoding="utf-8").split("\n\n"), s.batch)
        print("\n".join(f"{k}\t{v:,.1f}" for k, v in got.items()))
    elif args.command == "selftest":
        return _selftest(spark)
    return 0


def _selftest(spark: SparkSession) -> int:
    """Masks, repairs and segments of a few rows against their written results."""
    from .plans import catalogue

    wrong = catalogue.wrong_cases(spark)
    print("\n".join(wrong) or "all cases as written")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(run(sys.argv[1:]))
