"""The record model: dialogues as rows with an array of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("content", T.StringType()), T.StructField("role", T.StringType())])
RECORD = T.StructType(
    [T.StructField("prompt", T.StringType()), T.StructField("prompt_id", T.StringType()), T.StructField("messages", T.ArrayType(MESSAGE))]
)
#: Splits in their canonical order; others follow by name.
SPLITS = ("train_sft", "test_sft", "train_gen", "test_gen")


def split_order(split: Column) -> Column:
    """Sort key of a split: its canonical place, 99 for unknown ones."""
    out = F.lit(99)
    for i, name in enumerate(SPLITS):
        out = F.when(split == name, i).otherwise(out)
    return out


def split_group(split: Column) -> Column:
    """sft, gen or other."""
    return F.when(split.isin("train_sft", "test_sft"), "sft").when(split.isin("train_gen", "test_gen"), "gen").otherwise("other")


def clean_messages(messages: Column) -> Column:
    """Messages without null elements, null contents as empty texts, roles as they are; a null list has none."""
    kept = F.filter(F.coalesce(messages, F.array().cast(T.ArrayType(MESSAGE))), lambda m: m.isNotNull())
    return F.transform(kept, lambda m: F.struct(F.coalesce(m["content"], F.lit("")).alias("content"), m["role"].alias("role")))


def messages_of(records: DataFrame, *keys: str) -> DataFrame:
    """One row per message: ``keys``, pos, role, content. Records without messages give no row."""
    m = records.select(*keys, F.posexplode(clean_messages(F.col("messages"))).alias("pos", "m"))
    return m.select(*keys, "pos", F.col("m.role").alias("role"), F.col("m.content").alias("content"))
