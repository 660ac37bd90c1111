"""Queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns that are no usable answer to the user turn before them."""
    from .pairs import defects

    return defects(_read(spark, sf_dir, "dialogues")).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a test and a train record that are the same or nearly so."""
    from .overlap import overlaps

    pairs = overlaps(_read(spark, sf_dir, "dialogues"))
    return pairs.select(F.least("test_id", "train_id").alias("record_id_a"), F.greatest("test_id", "train_id").alias("record_id_b"))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affected test records per split and source."""
    from .overlap import report

    return report(_read(spark, sf_dir, "dialogues"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns holding characters for which a plain one that looks the same should stand."""
    from .unify import unify_turns

    return unify_turns(_read(spark, sf_dir, "dialogues"), only_affected=True).select("record_id", "turn").distinct()


def p3_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn in its consistent form."""
    from .unify import unify_turns

    return unify_turns(_read(spark, sf_dir, "dialogues"))


def _p4_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .dupes import keys, parsed_lines

    dialogues = keys(_read(spark, sf_dir, "dialogues").select("record_id", "prompt_id", "prompt", "messages"))
    return dialogues.unionByName(keys(parsed_lines(_read(spark, sf_dir, "raw_lines").select("record_id", "line"))))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of groups of copies, with the smallest record of their group."""
    from .dupes import members

    out = members(_p4_keys(spark, sf_dir)).filter("record_id <> first_record_id")
    return out.select("first_record_id", "record_id")


def p4_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per group with the number of its copies."""
    from .dupes import copies

    return copies(_p4_keys(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The languages of dialogues whose label is missing, wrong or names one of several."""
    from .languages import corrections

    return corrections(_read(spark, sf_dir, "dialogues")).select("record_id", "lang").distinct()


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue with its languages and their confidence."""
    from .languages import assign

    return assign(_read(spark, sf_dir, "dialogues")).select("record_id", "label", "n_words", F.explode_outer("languages").alias("l")).select(
        "record_id", "label", "n_words", "l.*"
    )


def p5_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of one language inside a turn."""
    from .languages import stretches

    return stretches(_read(spark, sf_dir, "dialogues"))


def p6_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens under the project's pieces by source, language, domain and role, and by every choice of them."""
    from .tokens import budget, token_rows

    return budget(token_rows(_read(spark, sf_dir, "dialogues"), _read(spark, sf_dir, "vocab")))


def p6_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every dialogue by role."""
    from .tokens import dialogue_tokens

    return dialogue_tokens(_read(spark, sf_dir, "dialogues"), _read(spark, sf_dir, "vocab"))


def p6_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in the budget's slices by source, domain and role, whatever the language."""
    return p6_budget(spark, sf_dir).filter("kept = 'source,domain,role'").select("source", "domain", "role", "turns", "dialogue_roles")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of which at least 40 % is repeated: suspected by the decision list, then checked exactly."""
    from .repetition import repetition

    return repetition(_read(spark, sf_dir, "dialogues")).filter("repetitive").select("record_id", "turn").distinct()


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated share of every turn."""
    from .repetition import repetition

    return repetition(_read(spark, sf_dir, "dialogues")).select("record_id", "turn", "n_words", "share", "repetitive")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in containers of each capacity of context_windows."""
    from functools import reduce

    from .packing import pack
    from .tokens import public_model, sizes

    sized = sizes(_read(spark, sf_dir, "documents").select("doc_id", "text"), public_model(spark), "doc_id")
    windows = _read(spark, sf_dir, "context_windows").filter("capacity > 0").orderBy("window_id").collect()  # a row per capacity
    parts = [pack(sized, int(w["capacity"])).select(F.lit(w["window_id"]).alias("window_id"), "*") for w in windows]
    return reduce(DataFrame.unionByName, parts)


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each capacity: documents packed, containers over it, texts split that fit and pieces whose place is taken or skipped."""
    packed = p8_containers(spark, sf_dir).join(F.broadcast(_read(spark, sf_dir, "context_windows").select("window_id", "capacity")), "window_id")
    boxes = packed.groupBy("window_id", "container").agg(
        (F.sum("tokens") > F.first("capacity")).cast("long").alias("over"),
        ((F.count("*") != F.countDistinct("position")) | (F.max("position") != F.count("*") - 1)).cast("long").alias("misplaced"),
    )
    texts = packed.groupBy("window_id", "doc_id").agg(((F.count("*") > 1) & (F.sum("tokens") <= F.first("capacity"))).cast("long").alias("split"))
    return (
        texts.groupBy("window_id")
        .agg(F.count("*").alias("documents"), F.sum("split").alias("split_needlessly"))
        .join(boxes.groupBy("window_id").agg(F.sum("over").alias("overfull"), F.sum("misplaced").alias("misplaced")), "window_id")
        .select("window_id", "documents", "overfull", "split_needlessly", "misplaced")
    )


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents holding at least twelve words in a row of a benchmark item."""
    from .passages import RUN, leaks

    return leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).filter(F.col("words") >= RUN).select("doc_id", "item_id")


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which test items leaked, into how many documents unchanged and within the edit budget, and how far."""
    from .passages import RUN, leaks

    out = leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return out.groupBy("item_id").agg(
        F.count_if(F.col("words") >= RUN).alias("documents"), F.count("*").alias("near_documents"), F.max("words").alias("longest_run"), F.max("near_words").alias("longest_near_run")
    )


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal values in documents, once per document."""
    from .personal import findings

    out = findings(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "name_list"))
    return out.select("doc_id", "kind", "value").distinct()


def p10_sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with placeholders in place of personal values."""
    from .personal import sanitised

    return sanitised(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "name_list"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    from .twins import SQL

    return dict(SQL)
