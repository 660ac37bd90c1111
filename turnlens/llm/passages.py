"""Problem 9: evaluation texts leaking into training text.

Texts are reduced to their letters, digits and marks without case, so that
punctuation and spacing play no part.  By the q-gram lemma a stretch of L such
characters found in a document with at most ``edits`` edits shares at least
L + 1 - Q * (edits + 1) of its Q-grams with it, all within ``edits`` of one
diagonal (document position minus item position).  Q is as long as the items
allow: SLACK characters shorter than their shortest stretch of ``RUN`` words,
over ``edits`` + 1, so that set phrases shared by chance rarely count.  Q-grams
shared with an item are counted in overlapping bands of diagonals.  Bands that
reach the bound for the item's shortest stretch of ``RUN`` words are verified
by banded alignment: from every word of the item on every diagonal of the band
the furthest point that 0, 1, ... ``edits`` edits reach.

A pair comes out with the most words in a row that stand in the document
unchanged and the most that stand there with at most ``edits`` characters
changed, added or left out.  TESTDATA.md asks for the first.

The items are the stated query set and are held by every task, in blocks of at
most ITEM_BLOCK items and ITEM_CHARS characters; the documents are read once
per block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

RUN = 12
#: Q-grams that an item's shortest stretch must share, at the least.
SLACK = 8
#: Characters that may be changed, added or left out in a stretch.
EDITS = 1
#: Diagonals of a band; half of them overlap the next band, so EDITS is at most BAND / 2 - 1.
BAND = 16
#: Items, and their characters, held by a task at once (one longer item is a block by itself).
ITEM_BLOCK, ITEM_CHARS = 20_000, 20_000_000
#: Shared Q-grams looked at together, about, and diagonals aligned together.
HITS, DIAGONALS = 1_000_000, 64
_FILTER_BITS = 22


@dataclass
class Stream:
    """The reduced texts of a block, end to end."""

    chars: np.ndarray  # folded code points
    off: np.ndarray  # offsets by text
    starts: np.ndarray  # does a word start here?
    ends: np.ndarray  # does a word end here?
    grams: np.ndarray  # hash of the Q characters from here on
    whole: np.ndarray  # do they lie in one text?


def _stretches(s: Stream, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, beginning and length in characters of every stretch of ``run`` words."""
    start, end = np.flatnonzero(s.starts), np.flatnonzero(s.ends) + 1
    owner = np.searchsorted(s.off, start, "right") - 1
    n = max(0, start.size - run + 1)
    inside = owner[run - 1 :][:n] == owner[:n]
    return owner[:n][inside], start[:n][inside], (end[run - 1 :][:n] - start[:n])[inside]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] numbers, then the same for the others."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def reduce(texts: list[str], q: int) -> Stream:
    block = K.Block(texts)
    core = (block.cls & (K.LETTER | K.DIGIT | K.MARK)) != 0
    at = np.flatnonzero(core)
    gap = np.cumsum((block.cls & K.SPACE) != 0, dtype=np.int32)[at]
    new = np.ones(at.size, bool)
    new[1:] = gap[1:] != gap[:-1]
    last = np.ones(at.size, bool)
    last[:-1] = new[1:]
    off = np.searchsorted(at, np.append(block.start, block.cp.size))
    chars = K.folded(block.cp[at])
    n = max(0, at.size - q + 1)
    p, inv = K.powers(at.size + 1)
    prefix = np.zeros(at.size + 1, np.uint64)
    np.cumsum(K.mix(chars.astype(np.uint64)) * p[: at.size], out=prefix[1:])
    grams = K.mix((prefix[q : q + n] - prefix[:n]) * inv[:n])
    text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(off))
    whole = text[:n] == text[q - 1 : q - 1 + n]
    return Stream(chars, off, new, last, grams, whole)


class ItemIndex:
    """Sorted Q-grams of a block of items."""

    def __init__(self, ids: list[int], texts: list[str], run: int = RUN, edits: int = EDITS):
        owner, _, length = _stretches(reduce(texts, 1), run)
        self.q = max(1, (int(length.min()) - SLACK) // (edits + 1)) if length.size else 1
        s = reduce(texts, self.q)
        self.ids, self.stream, self.run, self.edits = ids, s, run, edits
        # the fewest Q-grams a stretch of ``run`` words must share, and the fewest of an item's stretches
        owner, begin, length = _stretches(s, run)
        self.begin, self.last = begin, begin + length - self.q
        self.least = np.maximum(1, length + 1 - self.q * (edits + 1))
        self.of_item = np.searchsorted(owner, np.arange(len(ids) + 1))
        self.bound = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(self.bound, owner, self.least)
        pos = np.flatnonzero(s.whole)
        order = np.argsort(s.grams[pos], kind="stable")
        self.pos = pos[order]
        self.grams = s.grams[pos][order]
        self.item = (np.searchsorted(s.off, self.pos, "right") - 1).astype(np.int32)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def search(self, docs: Stream) -> list[tuple[int, int, int, int]]:
        """(document, item, most words in a row unchanged, and within the edit budget) of pairs that reach ``run`` words so."""
        if not self.grams.size or not docs.grams.size:
            return []
        maybe = np.flatnonzero(self.filter[(docs.grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] & docs.whole)
        g = docs.grams[maybe]
        lo, hi = np.searchsorted(self.grams, g, "left"), np.searchsorted(self.grams, g, "right")
        met = hi > lo
        maybe, lo, n = maybe[met], lo[met], (hi - lo)[met]
        doc = np.searchsorted(docs.off, maybe, "right") - 1
        # some documents at a time; of one with more shared Q-grams (it and an item repeat
        # themselves) some positions and, so that every stretch is seen whole, an item's length more
        out = []
        ends = np.cumsum(n)
        at = 0
        longest = int(np.diff(self.stream.off).max()) + 2 * BAND
        while at < maybe.size:
            to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HITS, "right")), at + 1)
            first = int(np.searchsorted(doc, doc[to - 1], "left"))
            if to < maybe.size and doc[to] == doc[to - 1] and first > at:
                to = first  # the last document begins the next part
            upto = to
            if to < maybe.size and doc[to] == doc[to - 1]:
                upto = int(np.searchsorted(maybe, maybe[to - 1] + longest, "right"))
            out += self._judged(docs, maybe[at:upto], doc[at:upto], lo[at:upto], n[at:upto])
            at = to
        return out

    def _judged(self, docs: Stream, at: np.ndarray, doc_of: np.ndarray, lo: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int, int]]:
        hit = np.repeat(np.arange(at.size), n)
        entry = np.arange(hit.size) - np.repeat(np.cumsum(n) - n, n) + lo[hit]
        doc, item = doc_of[hit], self.item[entry]
        diag = (at[hit] - docs.off[doc]) - (self.pos[entry] - self.stream.off[item])
        pairs: dict[tuple[int, int], list[np.ndarray]] = {}
        # two half-shifted sets of bands: any EDITS + 1 diagonals lie in one of them
        for shift in (0, BAND // 2):
            band = (diag + shift) // BAND
            order = np.lexsort((band, item, doc))
            d, i, b = doc[order], item[order], band[order]
            cut = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1]), [True])))
            size = np.diff(cut)
            k = np.flatnonzero(size >= self.bound[i[cut[:-1]]])
            k = k[self._region(i[cut[k]], np.repeat(np.arange(k.size), size[k]), self.pos[entry[order[_ranges(cut[k], size[k])]]])]
            for x, y in zip(cut[k], cut[k + 1]):
                pairs.setdefault((int(d[x]), int(i[x])), []).append(np.unique(diag[order[x:y]]))
        out = []
        for (d, i), diagonals in pairs.items():
            x = np.unique(np.concatenate(diagonals))
            words = near = 0
            for part in np.split(x, np.flatnonzero(np.diff(x) > 2 * self.edits + 1) + 1):
                first, last = int(part[0]) - self.edits, int(part[-1]) + self.edits
                for a in range(first, last + 1, DIAGONALS):
                    # neighbouring parts overlap by what the edits may shift
                    w, m = self._align(docs, d, i, a - 2 * self.edits, min(last, a + DIAGONALS - 1) + 2 * self.edits)
                    words, near = max(words, w), max(near, m)
            if near >= self.run:
                out.append((d, i, words, near))
        return out

    def _region(self, item: np.ndarray, band: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Which bands (of ``item``, with shared Q-grams at ``pos``) hold a stretch of the item with as many as it must share?"""
        wide = self.stream.chars.size + 1
        shared = np.unique(band * wide + pos)
        size = self.of_item[item + 1] - self.of_item[item]
        k = _ranges(self.of_item[item], size)
        of = np.repeat(np.arange(item.size), size)
        n = np.searchsorted(shared, of * wide + self.last[k], "right") - np.searchsorted(shared, of * wide + self.begin[k], "left")
        return np.bincount(of, n >= self.least[k], item.size) > 0

    def _align(self, docs: Stream, d: int, i: int, low: int, high: int) -> tuple[int, int]:
        """Most words in a row on the diagonals ``low`` to ``high``: unchanged, and within the edit budget."""
        s = self.stream
        item, doc = slice(s.off[i], s.off[i + 1]), slice(docs.off[d], docs.off[d + 1])
        a, b = s.chars[item], docs.chars[doc]
        n, m = a.size, b.size
        pos = np.arange(n)
        at = pos + np.arange(low, high + 1)[:, None]
        inside = (at >= 0) & (at < m)
        at = np.clip(at, 0, m - 1)
        same = inside & (b[at] == a)
        # where the stretch of equal characters from here ends
        reach = np.full((at.shape[0], n + 1), n)
        reach[:, :n] = np.minimum.accumulate(np.where(same, n, pos)[:, ::-1], axis=1)[:, ::-1]
        begun = np.concatenate(([0], np.cumsum(s.starts[item])))
        starts = same & s.starts[item] & docs.starts[doc][at]
        ends = np.maximum.accumulate(np.where(same & s.ends[item] & docs.ends[doc][at], pos + 1, 0), axis=1)
        row, p = np.nonzero(starts)
        words = 0
        if p.size:
            last = ends[row, reach[row, p] - 1]
            words = int(np.maximum(begun[np.maximum(last, p)] - begun[p], 0).max())
        if not self.edits:
            return words, words
        # furthest item positions by diagonal, from every word's start on every diagonal
        row, p = np.nonzero(inside & s.starts[item])
        if not p.size:
            return words, words
        e = self.edits
        shift = row[:, None] + np.arange(-e, e + 1)
        line = np.clip(shift, 0, at.shape[0] - 1)
        far = np.full(line.shape, -1)
        far[:, e] = reach[row, p]
        for _ in range(e):
            more = np.where(far >= 0, far + 1, -1)
            new = np.maximum(far, more)  # a character changed
            new[:, 1:] = np.maximum(new[:, 1:], far[:, :-1])  # one added
            new[:, :-1] = np.maximum(new[:, :-1], more[:, 1:])  # one left out
            new = np.minimum(new, n)
            far = np.where((new >= 0) & (line == shift), np.maximum(new, reach[line, np.maximum(new, 0)]), -1)
        whole = np.concatenate(([0], np.maximum.accumulate(np.where(s.ends[item], pos + 1, 0))))
        last = whole[np.maximum(far.max(1), 0)]
        return words, max(words, int(np.maximum(begun[np.maximum(last, p)] - begun[p], 0).max()))


def indexes_of(items: list[tuple[int, str]], run: int = RUN, edits: int = EDITS) -> list[ItemIndex]:
    """Indexes of items of like stretch length, so that one short item does not shorten the Q-grams of all."""
    owner, _, length = _stretches(reduce([t for _, t in items], 1), run)
    least = np.zeros(len(items), np.int64)
    np.maximum.at(least, owner, np.iinfo(np.int64).max - length)
    shortest = np.where(least > 0, np.iinfo(np.int64).max - least, 0)
    kinds = np.where(shortest > 0, np.log2(np.maximum(shortest, 1)).astype(np.int64) + 1, 0)
    out = []
    for k in np.unique(kinds[kinds > 0]):
        part = [items[i] for i in np.flatnonzero(kinds == k)]
        out.append(ItemIndex([i for i, _ in part], [t for _, t in part], run, edits))
    return out


def _pages(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks; at least one, which may be empty."""
    page: list[tuple[int, str]] = []
    size, first = 0, True
    for r in items.filter("t IS NOT NULL AND i IS NOT NULL").toLocalIterator():
        if page and (len(page) == ITEM_BLOCK or size + len(r["t"]) > ITEM_CHARS):
            yield page
            page, size, first = [], 0, False
        page.append((r["i"], r["t"]))
        size += len(r["t"])
    if page or first:
        yield page


def leaks(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", edits: int = EDITS
) -> DataFrame:
    """(doc_id, item_id, words, near_words) of documents holding RUN or more words in a row of an item, up to ``edits`` characters.

    ``words`` are the most in a row without any edit.  Null texts are empty and
    hold nothing; items of fewer than RUN words are never found; equal
    documents and items are found each for itself; a row per (document id,
    item id), with the longest runs, also where ids repeat.
    """
    if not 0 <= edits < BAND // 2:
        raise ValueError(f"edits must be at least 0 and less than {BAND // 2}")
    spark = documents.sparkSession
    source = documents.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).filter("text IS NOT NULL AND doc_id IS NOT NULL")
    found: DataFrame | None = None
    for page in _pages(items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))):
        held = spark.sparkContext.broadcast(page)  # at most ITEM_CHARS

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            indexes = indexes_of(held.value, edits=edits)
            for batch in batches:
                ids, texts = np.asarray(batch.column(0)), K.strings(batch.column(1))
                lens = np.fromiter(map(len, texts), np.int64, len(texts))
                for lo, hi in K.blocks(lens):
                    hits = [(int(ids[lo + d]), x.ids[i], w, m) for x in indexes for d, i, w, m in x.search(reduce(texts[lo:hi], x.q))]
                    columns = list(zip(*hits)) or [()] * 4
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                        ["doc_id", "item_id", "words", "near_words"],
                    )

        part = source.mapInArrow(run, "doc_id long, item_id long, words int, near_words int")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(F.max("words").alias("words"), F.max("near_words").alias("near_words"))
