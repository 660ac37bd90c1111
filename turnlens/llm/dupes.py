"""Problem 4: duplicates hidden by formatting differences.

A record's canonical text is its prompt id, prompt and sequence of roles and
contents without white space and punctuation (categories P and Z) and without
case; parsing makes the order of JSON fields immaterial.  128 bits of hash of
that text are its key.  Hot keys are found exactly with partial counts; their
rows are salted and aggregated in two levels, all other rows in one shuffle.
The representative of a group is its smallest identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..sources.scratch import written

RECORD = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("prompt_id", T.StringType()),
        T.StructField("messages", T.ArrayType(T.StructType([T.StructField("content", T.StringType()), T.StructField("role", T.StringType())]))),
    ]
)
#: A key is hot from this many rows, or from one row in HOT_PART if that is more:
#: no more than HOT_PART keys can be hot, so their list may be broadcast.
HOT_ROWS = 1_000
HOT_PART = 5_000
SALTS = 64

_FIELD, _TURN, _NULL = "\x01", "\x02", "\x03"
_DROPPED = r"[\p{P}\p{Z}\s\x0B\x1C-\x1F\x85]+"


def canonical(prompt_id: Column, prompt: Column, messages: Column) -> Column:
    """The text two copies share.

    Null and empty prompt ids are alike, as are null and empty message lists;
    a null prompt, content, role or element differs from an empty one.
    """
    null = F.lit(_NULL)
    turns = F.transform(
        F.coalesce(messages, F.array().cast(T.ArrayType(RECORD["messages"].dataType.elementType))),
        lambda m: F.when(m.isNull(), null).otherwise(F.concat(F.coalesce(m["role"], null), F.lit(_FIELD), F.coalesce(m["content"], null))),
    )
    whole = F.concat(
        F.coalesce(prompt_id, F.lit("")), F.lit(_FIELD), F.coalesce(prompt, null), F.lit(_TURN), F.array_join(turns, _TURN)
    )
    # upper before lower, so that letters with several lower-case forms meet; what
    # stands between keeps the optimiser from dropping the upper
    upper = F.replace(F.upper(whole), F.lit("ẞ"), F.lit("SS"))
    return F.regexp_replace(F.replace(F.lower(upper), F.lit("ς"), F.lit("σ")), _DROPPED, "")


def keys(records: DataFrame) -> DataFrame:
    """(k1, k2, record_id) of records with prompt_id, prompt and messages."""
    text = canonical(F.col("prompt_id"), F.col("prompt"), F.col("messages"))
    return records.select("record_id", text.alias("text")).select(
        F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("second"), "text").alias("k2"), "record_id"
    )


def parsed_lines(lines: DataFrame) -> DataFrame:
    """The records in JSON lines; lines that hold none are left out.

    A line counts if it is a JSON object with the keys prompt and prompt_id
    (their values may be null) and a non-empty list of messages.
    """
    names = F.json_object_keys("line")
    ok = F.array_contains(names, "prompt") & F.array_contains(names, "prompt_id")
    parsed = lines.filter(F.col("line").isNotNull() & ok).select("record_id", F.from_json("line", RECORD).alias("r"))
    return parsed.select("record_id", "r.prompt_id", "r.prompt", "r.messages").filter(F.size("messages") > 0)


def members(keyed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(k1, k2, record_id, first_record_id, copies) and ``carry`` for every keyed row.

    A null record_id is counted but never represents a group unless all are
    null; an empty input gives an empty result.
    """
    table = written(keyed.select("k1", "k2", "record_id", *carry), "copies")
    n = table.count()
    hot_from = max(HOT_ROWS, -(-n // HOT_PART))
    hot = table.groupBy("k1", "k2").count().filter(F.col("count") >= hot_from).select("k1", "k2")
    hot = written(hot, "hot").hint("broadcast")
    hot_rows = table.join(hot, ["k1", "k2"])
    salted = hot_rows.groupBy("k1", "k2", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).alias("salt")).agg(
        F.min("record_id").alias("first"), F.count("*").alias("n")
    )
    tops = salted.groupBy("k1", "k2").agg(F.min("first").alias("first_record_id"), F.sum("n").alias("copies"))
    busy = hot_rows.join(F.broadcast(tops), ["k1", "k2"])
    group = Window.partitionBy("k1", "k2")
    rest = table.join(hot, ["k1", "k2"], "left_anti").select(
        "*", F.min("record_id").over(group).alias("first_record_id"), F.count("*").over(group).alias("copies")
    )
    return rest.unionByName(busy.select(rest.columns))


def copies(keyed: DataFrame) -> DataFrame:
    """One row per group: its representative and the number of its copies."""
    out = members(keyed)
    return out.filter(F.col("record_id") == F.col("first_record_id")).select(F.col("record_id"), "copies").distinct()
