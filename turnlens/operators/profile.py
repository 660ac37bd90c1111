"""Corpus profile: structure, lengths, features, scripts and the risk register.

Every function takes dialogues (split, prompt, prompt_id, messages) and gives
one row per split and one overall row, marked by ``is_overall``; counts come
from one scan and one aggregation with grouping sets.  Empty tables give no
rows, the risk register its thirteen with 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import patterns as P
from ..functions import stats, text
from ..schema import clean_messages, messages_of

CHAR_LIMITS = (5_000, 30_000)
#: Lengths from which a message is cut into sentences before it is translated.
CHUNK_LIMITS = (5_000, 10_000, 30_000)


def _per_split(df: DataFrame, aggregates: list[Column]) -> DataFrame:
    return df.rollup("split").agg(F.grouping("split").cast("boolean").alias("is_overall"), *aggregates)


def repeats_role(roles: Column) -> Column:
    """Do two neighbouring turns have the same role (null equals null)?"""
    same = F.transform(roles, lambda r, i: (i > 0) & r.eqNullSafe(F.get(roles, i - 1)))
    return F.exists(same, lambda x: x)


def structure(dialogues: DataFrame) -> DataFrame:
    """Records, messages, empty messages, turns, alternation and missing ids."""
    m = clean_messages(F.col("messages"))
    df = dialogues.select("split", "prompt_id", m.alias("m"))
    df = df.select(
        "split",
        F.size("m").cast("long").alias("turns"),
        F.size(F.filter("m", lambda x: F.length(x["content"]) == 0)).cast("long").alias("empty"),
        repeats_role(F.transform("m", lambda x: x["role"])).alias("repeats"),
        (F.col("prompt_id").isNull() | (F.col("prompt_id") == "")).alias("no_id"),
    )
    return _per_split(
        df,
        [
            F.count("*").alias("n_records"),
            F.sum("turns").alias("n_messages"),
            F.sum("empty").alias("n_empty_messages"),
            F.count_if("repeats").alias("n_nonalternating"),
            F.count_if("no_id").alias("n_missing_prompt_id"),
            F.max("turns").alias("most_turns"),
            F.round(F.avg("turns"), 6).alias("mean_turns"),
            F.round(F.percentile("turns", F.lit(0.5)), 6).alias("p50_turns"),
        ],
    )


def missing_fields(lines: DataFrame, fields: tuple[str, ...] = ("prompt", "prompt_id", "messages")) -> DataFrame:
    """Of JSON lines that are objects, how many lack one of the fields; a null value is not lacking."""
    keys = F.json_object_keys("line")
    lacking = reduce(lambda a, b: a | b, [~F.array_contains("keys", f) for f in fields])
    objects = lines.select(keys.alias("keys")).filter(F.col("keys").isNotNull())
    return objects.agg(F.count("*").alias("n_objects"), F.count_if(lacking).alias("n_missing_fields"))


def roles(dialogues: DataFrame) -> DataFrame:
    """Messages by split and role (null role kept)."""
    return messages_of(dialogues, "split").groupBy("split", "role").agg(F.count("*").alias("n"))


def first_roles(dialogues: DataFrame) -> DataFrame:
    """Dialogues with messages by split and role of the first one."""
    m = dialogues.select("split", clean_messages(F.col("messages")).alias("m")).filter(F.size("m") > 0)
    return m.select("split", F.get("m", 0)["role"].alias("role")).groupBy("split", "role").agg(F.count("*").alias("n"))


def repeated_pairs(dialogues: DataFrame) -> DataFrame:
    """Neighbouring messages of the same role; after a message without role nothing is compared."""
    roles = F.transform(clean_messages(F.col("messages")), lambda m: m["role"])
    # side by side in the array, so nothing is shuffled but the counts
    same = F.zip_with(F.slice("r", 1, F.greatest(F.size("r") - 1, F.lit(0))), F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0))), lambda a, b: F.coalesce(a == b, F.lit(False)))
    hits = F.size(F.filter(same, lambda x: x)).cast("long")
    return _per_split(dialogues.select("split", roles.alias("r")).filter(F.size("r") > 0).select("split", hits.alias("n")), [F.sum("n").alias("n_pairs")])


def message_lengths(dialogues: DataFrame) -> DataFrame:
    return _per_split(messages_of(dialogues, "split").select("split", F.length("content").alias("c")), stats.summary(F.col("c")))


def dialogue_lengths(dialogues: DataFrame) -> DataFrame:
    """Characters per dialogue; dialogues without messages have 0."""
    total = F.aggregate(clean_messages(F.col("messages")), F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"]))
    return _per_split(dialogues.select("split", total.alias("c")), stats.summary(F.col("c")))


def chars_by_role(dialogues: DataFrame) -> DataFrame:
    """Characters and estimated tokens of user, assistant and other messages, and messages over the limits."""
    bucket = F.when(F.col("role").isin("user", "assistant"), F.col("role")).otherwise("_other")
    m = messages_of(dialogues, "split").select("split", bucket.alias("role"), F.length("content").alias("c"), text.token_estimate(F.col("content")).alias("t"))
    over = [F.count_if(F.col("c") > n).alias(f"over_{n}") for n in CHAR_LIMITS]
    return m.groupBy("split", "role").agg(F.sum("c").alias("chars"), F.sum("t").alias("tokens"), *over)


def flags(df: DataFrame, column: str = "content") -> DataFrame:
    """``df`` with one boolean column per detector."""
    return df.withColumns({f"has_{n}": P.has(n, F.col(column)) for n in P.DETECTORS})


def features(dialogues: DataFrame) -> DataFrame:
    """Messages with each feature, with any, and all."""
    f = flags(messages_of(dialogues, "split")).drop("content", "role", "pos")
    names = [f"has_{n}" for n in P.DETECTORS]
    any_of = reduce(lambda a, b: a | b, [F.col(n) for n in names])
    return _per_split(
        f, [F.count("*").alias("n_messages"), F.count_if(any_of).alias("n_any")] + [F.count_if(F.col(n)).alias(n.replace("has_", "n_")) for n in names]
    )


def feature_percentages(dialogues: DataFrame) -> DataFrame:
    """(split, is_overall, feature, n, pct), most frequent features first by ``rank``."""
    wide = features(dialogues)
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(i).alias("place"), F.col(f"n_{n}").alias("n")) for i, n in enumerate(P.DETECTORS)])
    long = wide.select("split", "is_overall", "n_messages", F.explode(pairs).alias("x")).select("split", "is_overall", "n_messages", "x.*")
    rank = F.row_number().over(Window.partitionBy("split", "is_overall").orderBy(F.desc("n"), "place"))
    return long.select("split", "is_overall", "feature", "n", stats.percent(F.col("n"), F.col("n_messages")).alias("pct"), rank.alias("rank"))


def unicode_profile(dialogues: DataFrame) -> DataFrame:
    """Non-ASCII messages and characters, cosmetic ones apart, and messages holding any listed script."""
    c = F.col("content")
    m = messages_of(dialogues, "split").select(
        "split",
        F.when(P.beyond_ascii(c), text.count_of(c, P.NON_ASCII)).otherwise(0).alias("non_ascii"),
        F.when(P.beyond_ascii(c), text.count_of(c, P.TYPOGRAPHIC)).otherwise(0).alias("typographic"),
        (P.beyond_ascii(c) & c.rlike(P.ANY_SCRIPT)).alias("script"),
    )
    return _per_split(
        m,
        [
            F.count("*").alias("n_messages"),
            F.count_if(F.col("non_ascii") > 0).alias("n_nonascii_messages"),
            F.sum("non_ascii").alias("nonascii_chars"),
            F.sum("typographic").alias("typographic_chars"),
            F.sum(F.col("non_ascii") - F.col("typographic")).alias("foreign_chars"),
            F.count_if("script").alias("n_script_messages"),
        ],
    )


def scripts(dialogues: DataFrame) -> DataFrame:
    """Messages holding each script, most frequent first; scripts that do not occur are left out."""
    c = F.col("content")
    hits = F.array(*[F.when(P.has_script(s, c), F.lit(s)) for s in P.SCRIPTS])
    m = messages_of(dialogues, "split").filter(P.beyond_ascii(c) & c.rlike(P.ANY_SCRIPT)).select("split", F.explode(F.array_compact(hits)).alias("script"))
    return m.groupBy("split", "script").agg(F.count("*").alias("n"))


def top_scripts(dialogues: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent scripts of each split; of equal ones the first in the list of scripts."""
    place = F.array_position(F.array(*map(F.lit, P.SCRIPTS)), F.col("script"))
    rank = F.row_number().over(Window.partitionBy("split").orderBy(F.desc("n"), place))
    return scripts(dialogues).withColumn("rank", rank).filter(F.col("rank") <= k)


def risk_register(dialogues: DataFrame) -> DataFrame:
    """One row per feature by severity, then messages; features that do not occur have 0."""
    one = dialogues.sparkSession.range(1).select(F.lit(True).alias("is_overall"))
    counts = one.join(features(dialogues).filter("is_overall"), "is_overall", "left").fillna(0)
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("feature"), F.lit(P.SEVERITY[n]).alias("severity"), F.lit(P.SEVERITY_RANK[P.SEVERITY[n]]).alias("level"), F.lit(i).alias("place"), F.col(f"n_{n}").alias("messages"))
            for i, n in enumerate(P.DETECTORS)
        ]
    )
    long = counts.select("n_messages", F.explode(rows).alias("r")).select("n_messages", "r.*")
    order = F.row_number().over(Window.orderBy("level", F.desc("messages"), "place"))  # thirteen rows
    return long.select(order.alias("rank"), "feature", "severity", "messages", stats.percent(F.col("messages"), F.col("n_messages")).alias("pct"))


def high_risk(dialogues: DataFrame) -> DataFrame:
    """Messages with a feature of high severity, messages over each limit, and the longest message."""
    high = [P.has(n, F.col("content")) for n, s in P.SEVERITY.items() if s == "high"]
    m = messages_of(dialogues, "split").select("split", reduce(lambda a, b: a | b, high).alias("high"), F.length("content").alias("c"))
    over = [F.count_if(F.col("c") > n).alias(f"over_{n}") for n in CHUNK_LIMITS]
    return _per_split(m, [F.count_if("high").alias("n_high"), *over, F.max("c").alias("longest")])


def examples(dialogues: DataFrame, each: int = 3) -> DataFrame:
    """The first ``each`` snippets of every feature in the order of records and turns."""
    m = flags(messages_of(dialogues, "record_id"))
    hits = F.array_compact(F.array(*[F.when(F.col(f"has_{n}"), F.lit(n)) for n in P.DETECTORS]))
    long = m.select("record_id", "pos", text.snippet(F.col("content")).alias("snippet"), F.explode(hits).alias("feature"))
    place = F.row_number().over(Window.partitionBy("feature").orderBy("record_id", "pos"))
    return long.withColumn("place", place).filter(F.col("place") <= each).select("feature", "place", "record_id", "pos", "snippet")


def explained_register(dialogues: DataFrame, each: int = 3) -> DataFrame:
    """The risk register with why each feature matters and its first examples (none: an empty list)."""
    why = F.create_map(*[F.lit(x) for pair in P.RATIONALE.items() for x in pair])
    shown = examples(dialogues, each).groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("place", "snippet"))).alias("x"))
    out = risk_register(dialogues).join(F.broadcast(shown), "feature", "left")  # thirteen rows
    snippets = F.coalesce(F.transform("x", lambda e: e["snippet"]), F.array().cast("array<string>"))
    return out.select("rank", "feature", "severity", "messages", "pct", why[F.col("feature")].alias("rationale"), snippets.alias("examples"))
