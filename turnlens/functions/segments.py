"""Texts cut into pieces a translator takes, and rebuilt with their lines."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT = 1000
#: Tokens a translation model takes.
MOST_TOKENS = 512
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+")
LAYOUT = "segments array<string>, lines array<string>, per_line array<int>"


def wrap(piece: str, limit: int = LIMIT) -> list[str]:
    """Greedy lines of at most ``limit`` characters; a longer word is cut by characters."""
    if len(piece) <= limit:
        return [piece]
    rows: list[str] = []
    row = ""
    for word in piece.split(" "):
        joined = f"{row} {word}".strip()
        if row and len(row) + 1 + len(word) > limit:
            rows.append(row)
            joined = word
        row = joined
    rows.append(row)
    return [r[i : i + limit] for r in rows for i in range(0, len(r), limit)]


def cut(text: str, limit: int = LIMIT) -> tuple[list[str], list[str], list[int]]:
    """(segments, lines, segments of each line); blank lines have none and are kept as they are."""
    lines = text.split("\n")
    of_line = [[w for s in _SENTENCE.split(line) if s.strip() for w in wrap(s, limit)] if line.strip() else [] for line in lines]
    return [s for segments in of_line for s in segments], lines, [len(segments) for segments in of_line]


def rebuild(segments: list[str], lines: list[str], per_line: list[int]) -> str:
    todo = iter(segments)
    return "\n".join(" ".join(next(todo) for _ in range(n)) if n else line for line, n in zip(lines, per_line))


Counter = Callable[[str], int]


def fit(text: str, count: Counter, most: int = MOST_TOKENS) -> list[str]:
    """Parts of at most ``most`` tokens; cut at the space nearest the middle, without a space between characters.

    Text is halved until every part fits; a single character that does not fit stays.
    """
    todo, out = [text], []
    while todo:
        t = todo.pop()
        if len(t) < 2 or count(t) <= most:
            out.append(t)
            continue
        middle = len(t) // 2
        before, after = t.rfind(" ", 1, middle), t.find(" ", middle, len(t) - 1)
        spaces = [i for i in (before, after) if i > 0]
        at = min(spaces, key=lambda i: abs(i - middle)) if spaces else middle
        todo += [t[at:].strip(" ") if spaces else t[at:], t[:at]]
    return [t for t in out if t.strip()] or [text]


def within(texts: list[str], translate: Callable[[list[str]], list[str]], count: Counter | None, most: int, mend: Callable[[str], str] | None) -> list[str]:
    """Translations of texts, of which long ones go in parts."""
    parts = [fit(t, count, most) if count else [t] for t in texts]
    flat = [p for ps in parts for p in ps]
    done = list(translate(flat))
    if len(done) != len(flat):
        raise ValueError(f"{len(flat)} segments came back as {len(done)}")
    if mend:
        done = [mend(t) for t in done]
    todo = iter(done)
    return [" ".join(next(todo) for _ in ps) for ps in parts]


def cut_to(text: Column, limit: int = LIMIT) -> Column:
    """struct(segments, lines, per_line); null counts as empty."""

    @F.pandas_udf(LAYOUT)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut(t or "", limit) for t in s], columns=["segments", "lines", "per_line"])

    return run(text)


def rebuilt(segments: Column, lines: Column, per_line: Column) -> Column:
    """The text again, segments of a line joined by a space."""

    @F.pandas_udf("string")
    def run(s: pd.Series, t: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([rebuild(list(a), list(b), list(c)) for a, b, c in zip(s, t, n)], dtype=object)

    return run(segments, lines, per_line)
