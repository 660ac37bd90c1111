"""Token accounting by split, group and context size, under a counting column."""

from __future__ import annotations

import importlib
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats, text
from ..schema import clean_messages, messages_of, split_group

#: Tokens a turn adds to its dialogue by its markers.
TURN_OVERHEAD = 4
CONTEXTS = (512, 2048, 4096, 8192)


def file_counter(path: str) -> Callable[[], Callable[[str], int]]:
    """Makes, on each worker, a counter of a text's tokens under a tokenizer file: sentencepiece (.model) or tokenizers (.json)."""
    with open(path, "rb") as f:
        data = f.read()
    return lambda: _counter(data, path.endswith(".json"))


def _counter(data: bytes, is_json: bool) -> Callable[[str], int]:
    if is_json:
        from tokenizers import Tokenizer

        model = Tokenizer.from_buffer(data)
        return lambda t: len(model.encode(t, add_special_tokens=False).ids)
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=data)
    return lambda t: len(model.encode(t))


def exact_count(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A counting column for :func:`dialogue_tokens` under a tokenizer file: sentencepiece (.model) or tokenizers (.json).

    The file is read on the driver and sent along; without the library, or the
    file, the estimate is used and a warning says so.
    """
    try:
        with open(path, "rb") as f:
            data = f.read()
        importlib.import_module("tokenizers" if path.endswith(".json") else "sentencepiece")
    except (OSError, ImportError) as e:
        warnings.warn(f"tokens are estimated: {e}", stacklevel=2)
        return text.token_estimate
    held, is_json = spark.sparkContext.broadcast(data), path.endswith(".json")

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = _counter(held.value, is_json)
        for s in batches:
            yield pd.Series([count(t or "") for t in s], dtype="int64")

    return run


def exact_dialogue_tokens(dialogues: DataFrame, path: str) -> DataFrame:
    """:func:`dialogue_tokens` with exact counts: turns are counted as rows and summed per dialogue."""
    count = exact_count(dialogues.sparkSession, path)
    turns = messages_of(dialogues, "record_id").select("record_id", count(F.col("content")).alias("n")).groupBy("record_id").agg(F.sum("n").alias("exact"))
    d = dialogue_tokens(dialogues).join(turns, "record_id", "left")
    tokens = F.coalesce("exact", F.lit(0))
    return d.select("record_id", "split", "turns", "chars", tokens.alias("tokens"), (tokens + TURN_OVERHEAD * F.col("turns")).alias("with_overhead"))


def dialogue_tokens(dialogues: DataFrame, count=text.token_estimate) -> DataFrame:
    """(record_id, split, turns, chars, tokens, with_overhead); ``count`` maps a text column to its tokens."""
    m = clean_messages(F.col("messages"))
    zero = F.lit(0).cast("long")
    return dialogues.select("record_id", "split", m.alias("m")).select(
        "record_id",
        "split",
        F.size("m").cast("long").alias("turns"),
        F.aggregate("m", zero, lambda a, x: a + F.length(x["content"])).alias("chars"),
        F.aggregate("m", zero, lambda a, x: a + count(x["content"])).alias("tokens"),
    ).withColumn("with_overhead", F.col("tokens") + TURN_OVERHEAD * F.col("turns"))


def distributions(dialogues: DataFrame) -> DataFrame:
    """Summary of tokens with overhead per split and overall."""
    d = dialogue_tokens(dialogues)
    return d.rollup("split").agg(F.grouping("split").cast("boolean").alias("is_overall"), *stats.summary(F.col("with_overhead")))


def all_distributions(dialogues: DataFrame, count=text.token_estimate) -> DataFrame:
    """Summaries of tokens by message, by dialogue and by dialogue with overhead, per split and overall."""
    d = dialogue_tokens(dialogues, count)
    m = messages_of(dialogues, "split").select("split", F.lit("message").alias("measure"), count(F.col("content")).cast("long").alias("v"))
    both = F.explode(F.array(F.struct(F.lit("dialogue").alias("measure"), F.col("tokens").alias("v")), F.struct(F.lit("with_overhead").alias("measure"), F.col("with_overhead").alias("v"))))
    rows = m.unionByName(d.select("split", both.alias("x")).select("split", "x.*"))
    return rows.groupingSets([["measure", "split"], ["measure"]], "measure", "split").agg(F.grouping("split").cast("boolean").alias("is_overall"), *stats.summary(F.col("v")))


def overflow(dialogues: DataFrame, contexts: tuple[int, ...] = CONTEXTS) -> DataFrame:
    """Dialogues longer than each context; the counts are cumulative."""
    d = dialogue_tokens(dialogues).filter("turns > 0")
    over = [F.count_if(F.col("with_overhead") > n).alias(f"over_{n}") for n in contexts]
    return d.groupBy("split").agg(F.count("*").alias("n_dialogues"), *over)


def groups(dialogues: DataFrame) -> DataFrame:
    """Dialogues, tokens and tokens per character of the split groups sft and gen."""
    d = dialogue_tokens(dialogues).withColumn("split_group", split_group(F.col("split"))).filter("split_group <> 'other'")
    ratio: Column = F.when(F.sum("chars") > 0, F.bround(F.sum("tokens") / F.sum("chars"), 4)).otherwise(0.0)
    chars = F.when(F.sum("tokens") > 0, F.bround(F.sum("chars") / F.sum("tokens"), 4)).otherwise(0.0)
    return d.groupBy("split_group").agg(F.count("*").alias("n_dialogues"), F.sum("turns").alias("n_messages"), F.sum("tokens").alias("tokens"), ratio.alias("tokens_per_char"), chars.alias("chars_per_token"))
