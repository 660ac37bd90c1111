"""Problem 6: token budget per source and language; token sizes for problem 8.

Two tokenizers are counted: the project's own piece list (the segmentation of
the highest total score, as a unigram tokenizer has it) and public BPE models.
Texts over ``CHUNK`` characters are cut, but only between two characters that
no token can hold side by side, which is proved on the piece list: at a word's
start if no piece holds the word mark after another character, and elsewhere
between characters that stand side by side in no piece.  A text in which no
such place is proved stays whole, whatever its length.  The count of a text is
then the sum over its chunks, which are salted across the workers; inside a
chunk words are counted once per distinct word and worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import kernels as K
from .languages import LANGS, LanguageModel, fit_on, segment

MARK = "▁"
#: Characters from which a text is cut, and of its chunks.
CHUNK = 100_000
#: Distinct words remembered by a worker; beyond it the memory is emptied.
REMEMBERED = 400_000
#: Where the public model lies by default.
PUBLIC_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = "<unk>"
SPECIAL = frozenset(("<unk>", "<s>", "</s>"))


def independent(pieces: list[str]) -> bool:
    """Can no token reach across the start of a word?"""
    return not any(MARK in p.lstrip(MARK) for p in pieces)


class Bounds:
    """The places at which a list of pieces lets a text be cut without changing its tokens.

    The word mark stands for ``spaces``.
    """

    def __init__(self, pieces: list[str], spaces: Callable[[str], bool]):
        self.spaces, self.words = spaces, independent(pieces)
        self.pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.single = {p for p in pieces if len(p) == 1}

    def safe(self, before: str, after: str) -> bool:
        """Is every token on one side of the place between these two characters?

        Unknown characters in a row are one token, so one of the two must be known.
        """
        if before == MARK or after == MARK or self.spaces(before):
            return False
        if self.spaces(after):
            return self.words
        return before + after not in self.pairs and (before in self.single or after in self.single)

    def chunks(self, text: str, size: int) -> list[tuple[str, str]]:
        """(character before, chunk): pieces of about ``size`` characters or up to the next proved place."""
        out, at = [], 0
        while len(text) - at > size:
            cut = at + size
            while cut < len(text) and not self.safe(text[cut - 1], text[cut]):
                cut += 1
            out.append((text[at - 1 : at], text[at:cut]))
            at = cut
        if at < len(text) or not out:
            out.append((text[at - 1 : at] if at else "", text[at:]))
        return out


class PieceList:
    """Counts under a list of scored pieces: the segmentation of the highest score.

    Words are stretches between white space.  A character that no piece covers
    costs ten less than the worst score; such characters in a row are one
    unknown token.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.score = {p: s for p, s in pieces if p not in SPECIAL}
        self.longest = max(map(len, self.score), default=1)
        self.unknown = min(self.score.values(), default=0.0) - 10
        self.bounds = Bounds(list(self.score), str.isspace)
        self.seen: dict[str, int] = {}

    def _best(self, text: str) -> int:
        n = len(text)
        best = [0.0] + [-np.inf] * n
        back = [(0, False)] * (n + 1)
        for i in range(n):
            b = best[i]
            for j in range(i + 1, min(n, i + self.longest) + 1):
                s = self.score.get(text[i:j])
                if s is not None and b + s > best[j]:
                    best[j], back[j] = b + s, (i, False)
            if text[i] not in self.score and b + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = b + self.unknown, (i, True)
        count, i, was_unknown = 0, n, False
        while i:
            i, unknown = back[i]
            count += not (unknown and was_unknown)
            was_unknown = unknown
        return count

    def count(self, text: str, before: str = "") -> int:
        """Tokens of a text, or of a chunk of one after the character ``before``."""
        words = text.split()
        inside = bool(before) and not before.isspace() and bool(text) and not text[0].isspace()
        if not self.bounds.words:
            return self._best(("" if inside else MARK) + MARK.join(words)) if words else 0
        total = 0
        for k, w in enumerate(words):
            form = w if inside and not k else MARK + w
            n = self.seen.get(form)
            if n is None:
                if len(self.seen) > REMEMBERED:
                    self.seen.clear()
                n = self._best(form)
                if len(form) < CHUNK:
                    self.seen[form] = n
            total += n
        return total


class PublicBPE:
    """Counts under a sentencepiece model, word by word."""

    _UNIT = re.compile(r" *[^ ]+| +$")

    def __init__(self, model: bytes):
        self.model = model
        self._sp = self._bounds = None
        self.seen: dict[str, int] = {}

    def __getstate__(self):
        return {"model": self.model}

    def __setstate__(self, state):
        self.__init__(state["model"])

    @property
    def sp(self):
        if self._sp is None:
            import sentencepiece

            self._sp = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        return self._sp

    @property
    def bounds(self) -> Bounds:
        if self._bounds is None:
            self._bounds = Bounds([self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())], " ".__eq__)
        return self._bounds

    def _after(self, before: str, text: str) -> int:
        """Tokens of a text after a character from which no token reaches into it."""
        return len(self.sp.encode(before + text, num_threads=1)) - len(self.sp.encode(before, num_threads=1))

    def count(self, text: str, before: str = "") -> int:
        """Tokens of a text, or of a chunk of one after the character ``before``."""
        if not text:
            return 0
        if not self.bounds.words or MARK in text or text.isspace():
            return self._after(before, text) if before else len(self.sp.encode(text, num_threads=1))
        total = 0
        seen = self.seen
        for k, unit in enumerate(self._UNIT.findall(text)):
            if not k:
                total += self._after(before, unit) if before else len(self.sp.encode(unit, num_threads=1))
                continue
            n = seen.get(unit)
            if n is None:
                if len(seen) > REMEMBERED:
                    seen.clear()
                n = self._after("a", unit)
                if len(unit) < CHUNK:
                    seen[unit] = n
            total += n
        return total


def vocabulary(vocab: DataFrame) -> PieceList:
    """The piece list of a table (piece, score); of fixed size, as every worker needs all of it."""
    return PieceList([(r["piece"], r["score"]) for r in vocab.filter("piece IS NOT NULL").select("piece", "score").collect()])


def public_model(spark: SparkSession, path: str = PUBLIC_MODEL) -> PublicBPE:
    """A public model read on the driver, so that executors need not have the file."""
    with open(path, "rb") as f:
        return PublicBPE(f.read())


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _counted_chunks(cut: DataFrame, counter: Broadcast, keys: list[str]) -> DataFrame:
    """``keys`` and ``tokens`` of rows with a chunk and the character before it, salted across the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [counter.value.count(t, c) for t, c in zip(b.column("chunk").to_pylist(), b.column("before").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(n, pa.int64())], [*keys, "tokens"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.select(*keys).schema.fields)
    return cut.select(*keys, "before", "chunk").repartition(F.xxhash64("chunk")).mapInArrow(run, f"{types}, tokens long")


def sizes(texts: DataFrame, counter: PublicBPE | PieceList, key: str) -> DataFrame:
    """``key`` and ``tokens`` of each row's text; null and empty texts have none.

    One pass counts the usual texts and cuts the oversized ones, whose chunks
    are counted apart and summed.  Keys should tell rows apart.
    """
    held = texts.sparkSession.sparkContext.broadcast(counter)
    schema = pa.schema([(key, pa.int64()), ("tokens", pa.int64()), ("part", pa.int32()), ("before", pa.string()), ("chunk", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts = held.value.bounds.chunks(t, CHUNK) if t and len(t) > CHUNK else []
                if len(parts) > 1:
                    rows += [(k, None, i, c, x) for i, (c, x) in enumerate(parts)]
                else:
                    rows.append((k, held.value.count(t or ""), 0, None, None))
            yield _columns(rows, schema)

    out = texts.select(F.col(key).cast("long").alias(key), "text").mapInArrow(run, f"`{key}` long, tokens long, part int, before string, chunk string")
    out = written(out, "sizes")
    large = _counted_chunks(out.filter("chunk IS NOT NULL"), held, [key]).groupBy(key).agg(F.sum("tokens").alias("tokens"))
    return out.filter("chunk IS NULL").select(key, "tokens").unionByName(large)


KEYS = ["source", "lang", "domain", "role"]


def token_rows(dialogues: DataFrame, vocab: DataFrame, langs: LanguageModel | None = None) -> DataFrame:
    """(record_id, source, lang, domain, role, turns, tokens): a row per dialogue and role, and one with 0 turns per chunk of an oversized turn."""
    spark = dialogues.sparkSession
    held, model = spark.sparkContext.broadcast(vocabulary(vocab)), spark.sparkContext.broadcast(langs or fit_on(dialogues))
    schema = pa.schema([("record_id", pa.int64()), *((k, pa.string()) for k in KEYS), ("turns", pa.int64()), ("tokens", pa.int64()), ("before", pa.string()), ("chunk", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, content, role = K.messages(batch.column(3))
            texts, roles = K.strings(content), role.to_pylist()
            size = K.sums(np.fromiter(map(len, texts), np.int64, len(texts)), off)
            rows: list[tuple] = []
            ids, source, domain = (batch.column(k).to_pylist() for k in (0, 1, 2))
            for lo, hi in K.blocks(size):
                if off[hi] == off[lo]:
                    continue
                g = segment(model.value, K.Block(texts[off[lo] : off[hi]]))
                words = np.zeros((hi - lo, len(LANGS)), np.int64)
                np.add.at(words, (np.searchsorted(off[lo + 1 : hi + 1] - off[lo], g["text"], "right"), g["lang"]), g["words"])
                for i in range(lo, hi):
                    lang = LANGS[int(words[i - lo].argmax())] if words[i - lo].any() else None
                    total: dict[str | None, list[int]] = {}
                    for k in range(off[i], off[i + 1]):
                        t = total.setdefault(roles[k], [0, 0])
                        t[0] += 1
                        parts = held.value.bounds.chunks(texts[k], CHUNK) if len(texts[k]) > CHUNK else []
                        if len(parts) > 1:
                            rows += [(ids[i], source[i], lang, domain[i], roles[k], 0, 0, c, x) for c, x in parts]
                        else:
                            t[1] += held.value.count(texts[k])
                    rows += [(ids[i], source[i], lang, domain[i], r, n, c, None, None) for r, (n, c) in total.items()]
            yield _columns(rows, schema)

    types = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)
    out = written(dialogues.select("record_id", "source", "domain", "messages").mapInArrow(run, types), "tokens")
    chunks = _counted_chunks(out.filter("chunk IS NOT NULL"), held, ["record_id", *KEYS, "turns"])
    return out.filter("chunk IS NULL").select("record_id", *KEYS, "turns", "tokens").unionByName(chunks)


def dialogue_tokens(dialogues: DataFrame, vocab: DataFrame, langs: LanguageModel | None = None) -> DataFrame:
    """(record_id, source, lang, domain, role, turns, tokens): exact counts per dialogue and role.

    ``lang`` is the language most words are in (null without words), whatever
    the label says.  Null elements and contents have no tokens; a null role
    stays null; dialogues without messages give no rows; rows that share an id,
    slice and role are summed.
    """
    rows = token_rows(dialogues, vocab, langs)
    return rows.groupBy("record_id", *KEYS).agg(F.sum("turns").alias("turns"), F.sum("tokens").alias("tokens"))


def budget(rows: DataFrame) -> DataFrame:
    """Totals for every choice of source, language, domain and role, each kept or rolled up.

    ``kept`` names the columns that keep their value; the others are null.
    ``dialogue_roles`` counts the roles of dialogues.
    """
    kept = F.concat_ws(",", *[F.when(F.grouping(k) == 0, k) for k in KEYS])
    return rows.cube(*KEYS).agg(
        kept.alias("kept"),
        F.sum("tokens").alias("tokens"),
        F.sum("turns").alias("turns"),
        F.count_if(F.col("turns") > 0).alias("dialogue_roles"),
    )
