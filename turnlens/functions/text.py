"""Column helpers over texts; all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"(?U)^[\s\x{1c}-\x{1f}]*$"


def is_blank(text: Column) -> Column:
    """Null, empty or white space alone."""
    return F.coalesce(text, F.lit("")).rlike(_BLANK)


def snippet(text: Column, size: int = 220) -> Column:
    """White space collapsed, cut to ``size`` characters with an ellipsis."""
    flat = F.regexp_replace(F.regexp_replace(text, r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$", ""), r"(?U)[\s\x{1c}-\x{1f}]+", " ")
    return F.when(F.length(flat) > size, F.concat(F.substring(flat, 1, size), F.lit("…"))).otherwise(flat)


def sentences(text: Column) -> Column:
    """Sentences of each line of a text, blank ones left out."""
    parts = F.split(text, r"(?U)(?<=[.!?。！？])[\s\x{1c}-\x{1f}]+|\n", -1)
    return F.filter(parts, lambda s: ~is_blank(s))


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


SINHALA_LETTER, LATIN_LETTER = r"[\x{0D9A}-\x{0DC6}]", "[A-Za-z]"
BROKEN_JOINT = r"\x{0DCA}[ \x{A0}]+[\x{0D9A}-\x{0DC6}]"
JOINER = "‍"


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, rounded half to even."""
    return F.bround(F.length(text) / F.lit(4.0), 0).cast("long")


def dialogue_hash(messages: Column) -> Column:
    """md5 of the contents that are not blank, end to end."""
    kept = F.filter(F.coalesce(messages, F.array().cast("array<struct<content:string,role:string>>")), lambda m: ~is_blank(m["content"]))
    return F.md5(F.array_join(F.transform(kept, lambda m: m["content"]), ""))


def messages_hash(messages: Column) -> Column:
    """md5 of roles and contents in order; a null role, content or element differs from an empty one."""
    null = F.lit("\x03")
    turns = F.transform(messages, lambda m: F.when(m.isNull(), null).otherwise(F.concat(F.coalesce(m["role"], null), F.lit("\x01"), F.coalesce(m["content"], null))))
    return F.md5(F.array_join(F.coalesce(turns, F.array().cast("array<string>")), "\x02"))


def first_user_turn(messages: Column) -> Column:
    """Content of the first user turn; empty if there is none."""
    user = F.filter(messages, lambda m: m["role"] == "user")
    return F.coalesce(F.get(user, 0)["content"], F.lit(""))
