"""Sinhala conjuncts whose joiner was lost to a space.

Only a space between two Sinhala runs is ever changed, and only into the
joiner, so lengths are kept and repairing twice changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOINER, HAL = "‍", "්"
# The patterns of words, chains of runs and attested clusters.
WORD = r"[\x{0D80}-\x{0DFF}\x{200D}]+"
BASE_LETTER = r"[\x{0D9A}-\x{0DC6}]"
CLUSTER = r"[\x{0D9A}-\x{0DC6}]\x{0DCA}\x{200D}[\x{0DBB}\x{0DBA}]"
_CHAIN = re.compile("[඀-෿‍]*්(?: [඀-෿‍]*්)* [඀-෿]+")
_CLUSTER = re.compile("[ක-ෆ]්‍[රය]")
_LONE = re.compile("[ක-ෆ]්")
#: Frequency from which a word of the lexicon counts as a word.
THRESHOLD = 5
RESULT = "text string, merges array<struct<form string, tier string, joints int>>, kept int, residual array<string>"


def lexicon(texts: DataFrame, column: str = "text", least: int = 2) -> DataFrame:
    """(word, n) of Sinhala words with a base letter, seen at least ``least`` times."""
    words = texts.select(F.explode(F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(WORD), 0)).alias("word"))
    return words.filter(F.col("word").rlike(BASE_LETTER)).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def clusters(lex: DataFrame) -> DataFrame:
    """Conjunct clusters attested in the lexicon."""
    return lex.select(F.explode(F.regexp_extract_all("word", F.lit(CLUSTER), 0)).alias("cluster")).distinct()


class Joiner:
    """Decides which neighbouring runs are one word."""

    def __init__(self, words: dict[str, int], pieces: frozenset[str] = frozenset(), threshold: int = THRESHOLD):
        self.words = {w for w, n in words.items() if n >= threshold}
        self.pieces = pieces
        self.attested = {c for w in words if JOINER in w for c in _CLUSTER.findall(w)}

    def _known(self, form: str) -> str | None:
        return "T1" if form in self.words else "T2" if form in self.pieces else None

    def _lone(self, run: str) -> bool:
        return bool(_LONE.fullmatch(run.replace(JOINER, "")))

    def repair(self, text: str) -> tuple[str, list[tuple[str, str, int]], int, list[str]]:
        """The text, the merges (form, tier, joints), the spaces kept, and lone runs left before a word."""
        merges: list[tuple[str, str, int]] = []
        kept = 0
        residual: list[str] = []

        def chain(m: re.Match) -> str:
            nonlocal kept
            queue, done = m[0].split(" "), []
            while queue:
                for size in range(len(queue), 1, -1):
                    form = JOINER.join(queue[:size])
                    tier = self._known(form)
                    if tier:
                        break
                else:
                    size, tier, form = 1, None, queue[0]
                    if len(queue) > 1 and self._lone(queue[0]) and (queue[0] + JOINER + queue[1][:1]) in self.attested:
                        size, tier, form = 2, "T3", JOINER.join(queue[:2])
                if tier:
                    merges.append((form, tier, size - 1))
                elif len(queue) > 1 and queue[0].endswith(HAL):
                    kept += 1
                    if self._lone(queue[0]):
                        residual.append(f"{queue[0]} {queue[1]}")
                done.append(form)
                queue = queue[size:]
            return " ".join(done)

        return _CHAIN.sub(chain, text), merges, kept, residual


def cached_lexicon(texts: DataFrame, column: str, folder: str, least: int = 2) -> DataFrame:
    """The lexicon kept under ``folder``, made when first asked for; another least count is another table."""
    spark = texts.sparkSession
    path = f"{folder.rstrip('/')}/lexicon-{column}-{least}"
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    lexicon(texts, column, least).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _asked(texts: DataFrame, column: str) -> DataFrame:
    """Words the repair of these texts may look up: joined stretches of their chains, and first letters with a joiner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: set[str] = set()
            for t in b.column(0).to_pylist():
                for m in _CHAIN.finditer(t or ""):
                    parts = m[0].split(" ")
                    out.update(JOINER.join(parts[i:j]) for i in range(len(parts)) for j in range(i + 2, len(parts) + 1))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(out), pa.string())], ["word"])

    return texts.select(column).mapInArrow(run, "word string").distinct()


def repaired(texts: DataFrame, lex: DataFrame, column: str, pieces: frozenset[str] = frozenset(), threshold: int = THRESHOLD, most: int = 5_000_000):
    """``texts`` with a struct column ``repair``: text, merges, kept, residual.

    Every worker holds the words it may ask for and the attested clusters.  Of
    a lexicon of more than ``most`` words that could be asked for, only those
    that the broken places of these texts can form are held, which is a pass more.
    """
    attested = clusters(lex)
    needed = lex.filter(F.col("n") >= threshold)
    if needed.count() > most:
        needed = needed.join(_asked(texts, column), "word", "left_semi")
    # as many clusters as there are pairs of letters
    rare = attested.select(F.col("cluster").alias("word"), F.lit(0).cast("long").alias("n"))
    needed = needed.select("word", "n").unionByName(rare)
    joiner = Joiner({r["word"]: r["n"] for r in needed.toLocalIterator()}, pieces, threshold)
    held = texts.sparkSession.sparkContext.broadcast(joiner)

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([held.value.repair(t or "") for t in s], columns=["text", "merges", "kept", "residual"])

    return texts.withColumn("repair", run(F.col(column)))
