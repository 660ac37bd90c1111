"""Quality report of a dataset: language share, joiners, repetition, duplicates."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..schema import messages_of

MIN_LETTERS, LOW_SHARE = 20, 0.5
MIN_CHARS, LOW_RATIO = 200, 0.18


def compression_ratio(content: Column) -> Column:
    """Compressed size (deflate, level 6) over size, of texts of at least MIN_CHARS characters; null of others."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([len(zlib.compress(b, 6)) / len(b) for b in (t.encode("utf-8", "surrogatepass") for t in s)], dtype=float)

    long = F.length(content) >= MIN_CHARS
    # rows that are too short go through as an empty letter and cost nothing
    return F.when(long, run(F.when(long, content).otherwise(F.lit(" "))))


def judged(dialogues: DataFrame) -> DataFrame:
    """Every message that is not blank with its measures and flags."""
    c = F.col("content")
    m = messages_of(dialogues, "split", "record_id").filter(~text.is_blank(c))
    m = m.withColumns(
        {
            "chars": F.length(c),
            "sinhala": text.count_of(c, text.SINHALA_LETTER),
            "latin": text.count_of(c, text.LATIN_LETTER),
            "joiners": text.count_of(c, text.JOINER),
            "broken": text.count_of(c, text.BROKEN_JOINT),
        }
    )
    letters = F.col("sinhala") + F.col("latin")
    m = m.withColumn("share", F.when(letters >= MIN_LETTERS, F.col("sinhala") / letters))
    return m.withColumns({"low": F.coalesce(F.col("share") < LOW_SHARE, F.lit(False)), "untranslated": (F.col("sinhala") == 0) & (F.col("latin") >= MIN_LETTERS)})


def language_quality(dialogues: DataFrame) -> DataFrame:
    """Per split: judged messages, mean Sinhala share, low and untranslated ones, joiners and broken joints."""
    j = judged(dialogues)
    return j.groupBy("split").agg(
        F.count("*").alias("n_messages"),
        F.count("share").alias("n_judged"),
        F.round(F.coalesce(F.avg("share"), F.lit(0.0)), 6).alias("mean_share"),
        F.count_if("low").alias("n_low"),
        F.count_if("untranslated").alias("n_untranslated"),
        F.sum("joiners").alias("joiners"),
        F.sum("broken").alias("broken_joints"),
        F.countDistinct(F.when(F.col("joiners") > 0, F.col("record_id"))).alias("records_with_joiner"),
    )


def repetition(dialogues: DataFrame) -> DataFrame:
    """Per split: messages long enough to judge, and those that compress below LOW_RATIO."""
    m = messages_of(dialogues, "split").filter(~text.is_blank(F.col("content")))
    r = m.select("split", compression_ratio(F.col("content")).alias("ratio"))
    return r.groupBy("split").agg(F.count("ratio").alias("n_judged"), F.count_if(F.col("ratio") < LOW_RATIO).alias("n_repetitive"), F.round(F.avg("ratio"), 6).alias("mean_ratio"))


def length_quantiles(dialogues: DataFrame) -> DataFrame:
    """Quantiles by index of the characters of messages that are not blank.

    Lengths are counted first, so the arrays hold a length once per split.
    """
    c = F.length("content")
    lengths = messages_of(dialogues, "split").filter(~text.is_blank(F.col("content"))).groupBy("split", c.alias("c")).agg(F.count("*").alias("n"))
    by = Window.partitionBy("split").orderBy("c")
    upto = lengths.select("split", "c", F.sum("n").over(by).alias("upto"), F.sum("n").over(Window.partitionBy("split")).alias("total"))
    at = lambda q: F.min(F.when(F.col("upto") > F.least(F.col("total") - 1, F.floor(F.lit(q) * F.col("total"))), F.col("c")))
    return upto.groupBy("split").agg(F.max("total").alias("n"), at(0.5).alias("p50"), at(0.9).alias("p90"), at(0.95).alias("p95"), at(0.99).alias("p99"))


def flagged_examples(dialogues: DataFrame, each: int = 6) -> DataFrame:
    """The first ``each`` low and untranslated messages, in the order of records and turns."""
    j = judged(dialogues).select("record_id", "pos", F.substring("content", 1, 200).alias("beginning"), F.array_compact(F.array(F.when(F.col("low"), F.lit("low_sinhala")), F.when(F.col("untranslated"), F.lit("untranslated")))).alias("f"))
    long = j.select("record_id", "pos", "beginning", F.explode("f").alias("flag"))
    place = F.row_number().over(Window.partitionBy("flag").orderBy("record_id", "pos"))
    return long.withColumn("place", place).filter(F.col("place") <= each)


def line_states(lines: DataFrame) -> DataFrame:
    """Lines by state: blank, json_bad, schema_bad (no prompt or no messages) or ok."""
    keys = F.json_object_keys("line")
    n = F.size(F.from_json(F.get_json_object("line", "$.messages"), "array<struct<content:string,role:string>>"))
    parses = F.try_parse_json("line").isNotNull()
    state = (
        F.when(text.is_blank(F.col("line")), "blank")
        .when(~parses, "json_bad")
        .when(F.coalesce(F.array_contains(keys, "prompt"), F.lit(False)) & (F.coalesce(n, F.lit(0)) > 0), "ok")
        .otherwise("schema_bad")
    )
    return lines.groupBy("file_name", state.alias("state")).agg(F.count("*").alias("n"))
