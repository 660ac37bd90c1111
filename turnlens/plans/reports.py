"""Markdown reports over small result tables; a missing table is named as absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import curate, profile, quality, tokens
from ..schema import RECORD
from ..sources import records
from ..sources.sinks import markdown


def _sections(parts: list[tuple[str, DataFrame | None]], beside: str | None = None) -> str:
    return "\n".join(markdown(df, title, beside=beside) if df is not None else f"## {title}\n\nabsent\n" for title, df in parts)


def _prose(title: str, text: str) -> str:
    return f"## {title}\n\n{text}\n"


def analysis_report(dialogues: DataFrame) -> str:
    """The corpus in eleven sections; a figure that the data lacks is named as absent."""
    whole = profile.structure(dialogues).filter("is_overall").first()
    register = profile.explained_register(dialogues).orderBy("rank").collect()
    met = [r for r in register if r["messages"]]
    n = f"{whole['n_records']:,} records with {whole['n_messages']:,} messages" if whole else "no records"
    worst = ", ".join(f"{r['feature']} ({r['pct']} %)" for r in met if r["severity"] == "high") or "none"
    top = ", ".join(f"{r['feature']} ({r['messages']:,})" for r in sorted(met, key=lambda r: -r["messages"])[:3]) or "none"
    parts = [
        "# Corpus profile\n",
        _prose("Abstract", f"The corpus has {n}. Features that need protection before translation: {worst}. Most frequent features: {top}."),
        _prose(
            "Methodology",
            "Every figure is of the whole corpus, from one scan and aggregations by split; nothing is sampled. Null elements are left out, null contents count as empty. "
            "Features are presence tests by pattern; tokens are a quarter of the characters, rounded half to even, unless a tokenizer is named; quantiles are interpolated.",
        ),
        _sections(
            [
                ("Structure", profile.structure(dialogues)),
                ("Roles", profile.roles(dialogues).orderBy("split", F.desc("n"))),
                ("First roles", profile.first_roles(dialogues).orderBy("split", F.desc("n"))),
                ("Message lengths", profile.message_lengths(dialogues)),
                ("Dialogue lengths", profile.dialogue_lengths(dialogues)),
                ("Characters by role", profile.chars_by_role(dialogues).orderBy("split", "role")),
                ("Features", profile.feature_percentages(dialogues).orderBy("is_overall", "split", "rank")),
                ("Unicode", profile.unicode_profile(dialogues)),
                ("Scripts", profile.top_scripts(dialogues).orderBy("split", "rank")),
                ("Messages at risk", profile.high_risk(dialogues)),
            ]
        ),
        _register(register),
        _prose("Discussion", _discussion(whole, met)),
        _prose("Reproducibility", f"Made by analysis_report on columns {', '.join(dialogues.columns)}; the same data give the same figures in the same order."),
    ]
    return "\n".join(parts)


def _register(rows: list) -> str:
    """Thirteen lines, and the first examples of the features of high severity."""
    line = lambda r: f"| {r['rank']} | {r['feature']} | {r['severity']} | {r['messages']:,} | {r['pct']} | {r['rationale']} |"
    table = "\n".join(["| rank | feature | severity | messages | pct | rationale |", "|---|---|---|---|---|---|", *map(line, rows)])
    shown = [f"\n{r['feature']}:\n" + "\n".join(f"> {x}" for x in r["examples"]) for r in rows if r["severity"] == "high" and r["examples"]]
    return _prose("Risk register", table + "\n" + "\n".join(shown))


def _discussion(whole, met: list) -> str:
    if not whole or not whole["n_messages"]:
        return "absent"
    share = 100.0 * whole["n_empty_messages"] / whole["n_messages"]
    odd = 100.0 * whole["n_nonalternating"] / whole["n_records"]
    return (
        f"{share:.3f} % of the messages are empty and {odd:.3f} % of the dialogues repeat a role. "
        f"{sum(r['severity'] == 'high' for r in met)} features of high severity occur; their spans are masked before a text is cut and restored after."
    )


def token_report(dialogues: DataFrame, tokenizer: str | None = None) -> str:
    """Volume, budget and distributions, by estimate or under a tokenizer file."""
    groups = tokens.groups(dialogues)
    epochs = groups.select("split_group", *[(F.col("tokens") * n).alias(f"epochs_{n}") for n in (1, 2, 3)])
    exact = tokens.exact_dialogue_tokens(dialogues, tokenizer) if tokenizer else None
    by_split = exact.groupBy("split").agg(F.count("*").alias("n_dialogues"), F.sum("tokens").alias("tokens"), F.max("with_overhead").alias("longest")) if exact is not None else None
    return "# Tokens\n\n" + _sections(
        [
            ("Volume", groups),
            ("Budget by epochs", epochs),
            ("Distributions", tokens.all_distributions(dialogues).orderBy("measure", "is_overall", "split")),
            ("Context overflow", tokens.overflow(dialogues)),
            ("Under the tokenizer", by_split),
        ]
    )


def quality_report(dialogues: DataFrame, lines: DataFrame | None = None) -> str:
    side = F.when(F.col("split").startswith("train"), "train").when(F.col("split").startswith("test"), "test").otherwise(F.col("split"))
    return "# Quality\n\n" + _sections(
        [
            ("Lines", quality.line_states(lines).orderBy("file_name", "state") if lines is not None else None),
            ("Language", quality.language_quality(dialogues)),
            ("Repetition", quality.repetition(dialogues)),
            ("Lengths", quality.length_quantiles(dialogues)),
            ("Duplicate ids", curate.duplicates_by_side(dialogues, F.col("prompt_id"), side).orderBy("side")),
            ("Duplicate contents", curate.duplicates_by_side(dialogues, text.dialogue_hash(F.col("messages")), side).orderBy("side")),
            ("Flagged examples", quality.flagged_examples(dialogues).orderBy("flag", "place")),
        ]
    )


def quality_of_inputs(spark: SparkSession, inputs: list[str]) -> str:
    """The quality report of JSON lines, with a row per input given as LABEL=glob."""
    lines = records.read_labelled(spark, inputs)
    parsed = lines.select(F.col("label").alias("split"), F.monotonically_increasing_id().alias("record_id"), F.from_json("line", RECORD).alias("r")).select("split", "record_id", "r.*")
    return quality_report(parsed.filter("messages IS NOT NULL"), lines.drop("file_name").withColumnRenamed("label", "file_name"))


def repair_report(repaired: DataFrame, beside: str | None = None) -> str:
    """Of conjuncts.repaired: what was merged by tier and form, and what is left; long tables whole under ``beside``."""
    merges = repaired.select(F.explode("repair.merges").alias("m")).select("m.*")
    left = repaired.select(F.explode("repair.residual").alias("pair"))
    return "# Conjunct repair\n\n" + _sections(
        [
            ("Tiers", merges.groupBy("tier").agg(F.sum("joints").alias("joints"), F.count("*").alias("forms")).orderBy("tier")),
            ("Merged forms", merges.groupBy("form", "tier").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "form")),
            ("Left", left.groupBy("pair").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pair")),
        ],
        beside,
    )
