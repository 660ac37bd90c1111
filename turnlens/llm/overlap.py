"""Problem 2: the same or nearly the same records across splits.

Dialogues with the same words in the same order form one class, and only one
member of each is compared.  Candidates come from an exact prefix filter.  A
dialogue's words, each told apart by which occurrence it is, are put in one
order for all dialogues, rare ones first.  If two dialogues of n and m words
share at least SHARE of the longer, the rarest l of the shared words lie among
the first n - ceil(SHARE * n) + l of the one and m - ceil(SHARE * m) + l of the
other, so pairs whose prefixes share fewer are out and no pair of the
definition is lost.  l grows with the length (LEAST), as a longer prefix leaves
fewer chance candidates.  Prefixes are counted against each other in blocks of
train dialogues, past which the tests stream whose lengths allow the overlap.
A block keeps a set of bits for each frequent word, one by train dialogue, and
the sets of a test's words are added up by binary adders, 64 trains at a time.

What is left is verified on the words: the exact Jaccard similarity of the two
bags of words must reach the bound that follows from the wanted overlap, and
the longest common subsequence must reach SHARE of the longer.  The wanted
overlap is TESTDATA.md's (three quarters of the words, in order).

Where most dialogues are made of the same few thousand words the count is
quadratic in the classes: a prefix without common words does not exist there.
Tests are shuffled once per block of trains, and trains once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import kernels as K
from .dupes import members
from .unify import unify_all

SHARE = 0.75
#: Words the prefixes of two dialogues must share: one and a LEAST-th of the words.
LEAST = 3
#: Length classes in a step of 1 / SHARE.
STEPS = 2
#: Prefix words of a block of trains and of the tests that meet it at once, about (a longer dialogue makes more).
TRAIN_WORDS, TEST_WORDS = 16_000_000, 4_000_000
#: Trains that are counted at once, and the share of them from which a word's holders are kept as bits.
TRAINS, DENSE = 1 << 13, 1024
#: Bits of the rows that are added up at once, about.
ROW_BITS = 1 << 17
#: Records whose words set the order, about, and the bits of their hashes that are counted.
ORDER_ROWS, ORDER_BITS = 20_000, 18
#: Bound on the records whose ids are broadcast to fetch their texts; beyond it the ids are shuffled.
BROADCAST_IDS = 1_000_000


def _records(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row range, word hashes, word offsets) of the records of a batch, a block at a time."""
    off, content, _ = K.messages(batch.column("messages"))
    texts, _ = unify_all(K.strings(content))
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    size = K.sums(lens, off)
    for lo, hi in K.blocks(size):
        h, _, _, woff = K.Block(texts[off[lo] : off[hi]]).words() if off[hi] > off[lo] else (np.zeros(0, np.uint64), 0, 0, np.zeros(1, np.int64))
        yield np.arange(lo, hi), h, woff[off[lo : hi + 1] - off[lo]]


def _chain(h: np.ndarray, off: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each record's word sequence."""
    p, _ = K.powers(h.size + 1)
    local = np.arange(h.size) - np.repeat(off[:-1], np.diff(off))
    return K.mix(K.sums_u64(K.mix(h + np.uint64(seed)) * p[local], off) + np.diff(off).astype(np.uint64))


def signatures(df: DataFrame) -> DataFrame:
    """Class key, word count and word hashes of each record with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, side = np.asarray(batch.column("record_id")), np.asarray(batch.column("side"))
            for rows, h, off in _records(batch):
                n = np.diff(off)
                keep = np.flatnonzero(n > 0)
                small = (h >> np.uint64(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[rows][keep], pa.int64()),
                        pa.array(side[rows][keep], pa.int32()),
                        pa.array(_chain(h, off, 1)[keep].view(np.int64)),
                        pa.array(_chain(h, off, 2)[keep].view(np.int64)),
                        pa.array(n[keep], pa.int32()),
                        pa.array([small[off[i] : off[i + 1]].tobytes() for i in keep], pa.binary()),
                    ],
                    ["record_id", "side", "k1", "k2", "n", "words"],
                )

    return df.mapInArrow(run, "record_id long, side int, k1 long, k2 long, n int, words binary")


def _hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit hashes of a binary column end to end, and their offsets by row."""
    parts = [np.frombuffer(x, np.uint32) for x in col.to_pylist()]
    off = np.concatenate(([0], np.cumsum([x.size for x in parts]))).astype(np.int64)
    return np.concatenate([np.zeros(0, np.uint32), *parts]), off


def occurrences(words: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A hash of each word and how often it stood before in its record, in any order inside a record."""
    owner = np.repeat(np.arange(len(off) - 1, dtype=np.uint64), np.diff(off))
    s = np.sort(owner << np.uint64(32) | words)
    new = np.ones(s.size, bool)
    new[1:] = s[1:] != s[:-1]
    at = np.arange(s.size)
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    word = s & np.uint64(0xFFFFFFFF)
    return (K.mix((word << np.uint64(32)) + nth.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)


def needed(n: np.ndarray) -> np.ndarray:
    """Words that a dialogue of n words must share, at the least."""
    return np.ceil(SHARE * n - 1e-9).astype(np.int64)


def prefixes(words: np.ndarray, off: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each record's first words in the order of all, their offsets, and the record's last word.

    ``place`` holds the places of the first bits of a word's hash; the word
    itself is given as its place and its other bits, which is a place of its own.
    """
    n = np.diff(off)
    x = occurrences(words, off)
    low = np.uint32(32 - ORDER_BITS)
    x = place[x >> low].astype(np.uint64) << np.uint64(low) | (x & np.uint32((1 << low) - 1)).astype(np.uint64)
    owner = np.repeat(np.arange(n.size, dtype=np.uint64), n)
    x = np.sort(owner << np.uint64(32) | x).astype(np.uint32)
    size = prefix_size(n, 0)
    keep = np.arange(x.size) - np.repeat(off[:-1], n) < np.repeat(size, n)
    return x[keep], np.concatenate(([0], np.cumsum(size))), x[off[1:] - 1]


def length_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) * (STEPS / -np.log(SHARE))).astype(np.int32)


def _order(signed: DataFrame) -> np.ndarray:
    """Places of words by the first bits of their hash, rare ones first in some of the records; any order is right, this one makes few candidates."""
    share = max(1, signed.count() // ORDER_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            x = occurrences(*_hashes(batch.column(0)))
            total += np.bincount(x >> np.uint32(32 - ORDER_BITS), minlength=total.size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["at", "n"])

    # no more rows than there are counters
    t = signed.filter(F.pmod("k1", F.lit(share)) == 0).select("words").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << ORDER_BITS, np.int64)
    out[t["at"].to_numpy()] = t["n"].to_numpy()
    place = np.empty(out.size, np.uint32)
    place[np.argsort(out, kind="stable")] = np.arange(out.size, dtype=np.uint32)
    return place


def _prefix_rows(reps: DataFrame, place: np.ndarray) -> DataFrame:
    """Prefix, own length class and the classes that can hold an overlapping record, of each class of copies."""
    held = reps.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.asarray(batch.column("n")).astype(np.int64)
            x, off, last = prefixes(*_hashes(batch.column("words")), held.value)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("rep", "test", "train", "n")),
                    pa.array(np.diff(off).astype(np.int32)),
                    pa.array(last.astype(np.int64)),
                    pa.array(length_class(n)),
                    pa.array(length_class(needed(n))),
                    pa.array(length_class(np.floor(n / SHARE + 1e-9))),
                    pa.array([x[off[i] : off[i + 1]].tobytes() for i in range(n.size)], pa.binary()),
                ],
                ["rep", "test", "train", "n", "size", "last", "own", "low", "high", "prefix"],
            )

    return reps.mapInArrow(run, "rep long, test int, train int, n int, size int, last long, own int, low int, high int, prefix binary")


def prefix_size(n: np.ndarray, least: np.ndarray | int) -> np.ndarray:
    """Words of a prefix for overlaps with dialogues of ``least`` or more words."""
    return np.clip(n - needed(np.maximum(n, least)) + 1 + n // LEAST, 0, n)


class Holders:
    """The words of some train dialogues with the dialogues that hold them.

    ``words`` and ``holder`` are sorted by word, then by holder.
    """

    def __init__(self, words: np.ndarray, holder: np.ndarray, trains: int):
        new = np.ones(words.size, bool)
        new[1:] = words[1:] != words[:-1]
        start = np.flatnonzero(new)
        self.words, self.holder, self.trains = words[start], holder, trains
        self.at = np.append(start, words.size)
        df = np.diff(self.at)
        dense = df * DENSE >= trains
        #: Row of a word's bits, -1 for the words that are kept as lists.
        self.row = np.where(dense, np.cumsum(dense) - 1, -1)
        width = -(-trains // 64)
        # the last row has no holders
        self.bits = np.zeros((int(dense.sum()) + 1, width), np.uint64)
        own = np.repeat(dense, df)
        held = holder[own]
        cell = np.repeat(self.row, df)[own] * width + (held >> 6)
        if cell.size:
            first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            self.bits.reshape(-1)[cell[first]] = np.bitwise_or.reduceat(np.uint64(1) << (held & 63).astype(np.uint64), first)

    def listed(self, at: np.ndarray) -> np.ndarray:
        """How many of some words each dialogue holds, from the lists."""
        return np.bincount(np.concatenate([self.holder[self.at[i] : self.at[i + 1]] for i in at.tolist()]), minlength=self.trains)

    def sharing(self, at: np.ndarray, off: np.ndarray, fewest: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each test with words here the dialogues that hold at least ``fewest`` of its words, and how many they hold.

        ``at`` has the index of each word that is held, ``off`` its offsets by test.
        """
        row = self.row[at]
        dense = row >= 0
        doff = np.concatenate(([0], np.cumsum(dense)))[off]
        lists, row = at[~dense], row[dense]
        loff, many = off - doff, np.diff(doff)
        # what the bits must show if a dialogue holds all words that are kept as lists
        least = fewest - np.diff(loff)
        for i in np.flatnonzero((least <= 0) & (np.diff(off) >= fewest)).tolist():
            shared = self.listed(at[off[i] : off[i + 1]])
            j = np.flatnonzero(shared >= fewest[i])
            yield i, j, shared[j]
        todo = np.flatnonzero((least > 0) & (many >= least))
        todo = todo[np.argsort(many[todo], kind="stable")]
        width = self.bits.shape[1]
        step = max(1, ROW_BITS // (64 * width))
        for lo in range(0, todo.size, step):
            tests = todo[lo : lo + step]
            index = np.full((many[tests[-1]], tests.size), len(self.bits) - 1)
            for k, i in enumerate(tests.tolist()):
                index[: many[i], k] = row[doff[i] : doff[i + 1]]
            planes = [x.reshape(tests.size, width) for x in _added(self.bits.take(index, 0).reshape(len(index), -1))]
            reach = _at_least(planes, least[tests])
            k, word = np.nonzero(reach)
            if not k.size:
                continue
            place, bit = np.nonzero(np.unpackbits(reach[k, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            k, word = k[place], word[place]
            shared = np.zeros(k.size, np.int64)
            for e, plane in enumerate(planes):
                shared += (plane[k, word] >> bit.astype(np.uint64) & np.uint64(1)).astype(np.int64) << e
            j = word * 64 + bit
            cut = np.searchsorted(k, np.arange(tests.size + 1))
            for i, a, b in zip(tests.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                if b > a:
                    total = shared[a:b] + (self.listed(lists[loff[i] : loff[i + 1]])[j[a:b]] if loff[i + 1] > loff[i] else 0)
                    keep = total >= fewest[i]
                    yield i, j[a:b][keep], total[keep]


def _added(rows: np.ndarray) -> list[np.ndarray]:
    """The sum of the rows at every bit, as binary digits from the lowest on; the rows are used up."""
    planes = []
    spare, odd = np.empty((len(rows) // 2 + 1, rows.shape[1]), np.uint64), np.empty((len(rows) // 3 + 1, rows.shape[1]), np.uint64)
    n = len(rows)
    while n:
        done = 0
        while n > 1:
            k = max(1, n // 3)
            a, b, x, out = rows[:k], rows[k : 2 * k], odd[:k], spare[done : done + k]
            np.bitwise_xor(a, b, out=x)
            np.bitwise_and(a, b, out=out)
            if n == 2:
                rows = x
            else:
                c = rows[2 * k : 3 * k]
                np.bitwise_and(x, c, out=a)
                out |= a
                c ^= x
                rows = rows[2 * k : n]
            done, n = done + k, n - 2 * k if n > 2 else 1
        planes.append(rows[0].copy())
        rows, spare, n = spare, np.empty((done // 2 + 1, rows.shape[1]), np.uint64), done
    return planes


def _at_least(planes: list[np.ndarray], least: np.ndarray) -> np.ndarray:
    """Bits at which sums given by their digits reach a number, one by row."""
    more, same = np.zeros_like(planes[0]), ~np.zeros_like(planes[0])
    for k in range(len(planes) - 1, -1, -1):
        digit = np.where(least >> k & 1, ~np.uint64(0), np.uint64(0))[:, None]
        more |= same & planes[k] & ~digit
        same &= ~(planes[k] ^ digit)
    return more | same


def meetings(t: pa.Table, r: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks whose prefixes share enough words for an overlap.

    Where one side is longer, it asks for more words, and the other's prefix is
    cut accordingly: tests are taken by their length class.  Trains are taken
    by their commonest word, which most often tells the language, so that the
    words of a test are not looked for among all of another language's trains.
    """
    x, xoff = _hashes(t["prefix"])
    tn, all_n = t["n"].to_numpy().astype(np.int64), r["n"].to_numpy().astype(np.int64)
    kinds = length_class(tn)
    by_last = np.argsort(r["last"].to_numpy(), kind="stable")
    prefix = r["prefix"].combine_chunks()
    left, right = [], []
    for part in range(0, by_last.size, TRAINS):
        some = by_last[part : part + TRAINS]
        rn = all_n[some]
        y, yoff = _hashes(prefix.take(pa.array(some)))
        owner = np.repeat(np.arange(rn.size), np.diff(yoff))
        place = (np.arange(y.size) - yoff[owner]).astype(np.int32)
        order = np.argsort(y, kind="stable")
        y, owner, place = y[order], owner[order], place[order]
        shortest = rn.min()
        t_size = prefix_size(tn, shortest)
        for kind in np.unique(kinds):
            rows = np.flatnonzero(kinds == kind)
            least_t = tn[rows].min()
            r_size = prefix_size(rn, least_t)
            keep = place < r_size[owner]
            held = Holders(y[keep], owner[keep], rn.size)
            if not held.words.size:
                continue
            own = x[_ranges(xoff[rows], t_size[rows])]
            off = np.concatenate(([0], np.cumsum(t_size[rows])))
            at = np.searchsorted(held.words, own)
            at[at == held.words.size] = 0
            met = held.words[at] == own
            off = np.concatenate(([0], np.cumsum(met)))[off]
            t_spare, r_spare = t_size - tn, r_size - rn
            # fewest words that any pair of the dialogue must share here
            fewest = np.minimum((t_spare + needed(np.maximum(tn, shortest)))[rows], (r_spare + needed(np.maximum(rn, least_t))).min())
            for k, j, shared in held.sharing(at[met], off, fewest):
                i = rows[k]
                least = needed(np.maximum(tn[i], rn[j]))
                j = j[(np.minimum(tn[i], rn[j]) >= least) & (shared >= least + np.minimum(t_spare[i], r_spare[j]))]
                left.append(np.full(j.size, i))
                right.append(some[j])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] numbers, then the same for the others."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def candidates(rows: DataFrame) -> DataFrame:
    """(t, r): a test and a train class whose prefixes meet."""
    columns = ["own", "block", "side", "rep", "n", "last", "prefix"]
    r = rows.filter("train = 0").withColumn("side", F.lit(0))
    # as many rows as there are length classes
    size = r.groupBy("own").agg(F.ceil(F.sum("size") / TRAIN_WORDS).cast("int").alias("blocks")).collect()
    if not size:
        return rows.sparkSession.createDataFrame([], "t long, r long")
    blocks = F.broadcast(rows.sparkSession.createDataFrame([(x["own"], x["blocks"]) for x in size], "own int, blocks int"))
    r = r.join(blocks, "own").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    # the tests of a length class meet every block of its trains
    t = rows.filter("test = 1").withColumn("side", F.lit(1)).withColumn("own", F.explode(F.sequence("low", "high")))
    t = t.join(blocks, "own").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = 2 * sum(x["blocks"] for x in size)
    both = r.select(columns).union(t.select(columns)).repartition(tasks, "own", "block").sortWithinPartitions("own", "block", "side")

    def met(trains: list[pa.RecordBatch], tests: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if trains and tests:
            a, b = pa.Table.from_batches(tests), pa.Table.from_batches(trains)
            i, j = meetings(a, b)
            x, y = a["rep"].to_numpy()[i], b["rep"].to_numpy()[j]
            yield pa.RecordBatch.from_arrays([pa.array(x[x != y]), pa.array(y[x != y])], ["t", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, trains, tests, held = None, [], [], 0
        for batch in batches:
            key = np.stack([np.asarray(batch.column(c)) for c in ("own", "block", "side")])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if block != tuple(key[:2, lo]):
                    yield from met(trains, tests)
                    block, trains, tests, held = tuple(key[:2, lo]), [], [], 0
                if key[2, lo] == 0:
                    trains.append(part)
                    continue
                tests.append(part)
                held += part.nbytes // 4
                if held >= TEST_WORDS:
                    yield from met(trains, tests)
                    tests, held = [], 0
        yield from met(trains, tests)

    return both.mapInArrow(run, "t long, r long")


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    at: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b.tolist():
        m = at.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def bag_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact Jaccard similarity of two bags of words."""
    values, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
    ca = np.bincount(inverse[: a.size], minlength=values.size)
    cb = np.bincount(inverse[a.size :], minlength=values.size)
    return np.minimum(ca, cb).sum() / max(1, np.maximum(ca, cb).sum())


def _verified(pairs: DataFrame) -> DataFrame:
    least = SHARE / (2 - SHARE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.to_pydict()
            keep, jac, lcs = [], [], []
            for i, (x, y) in enumerate(zip(d["wt"], d["wr"])):
                a, b = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                j = bag_jaccard(a, b)
                if j < least - 1e-9:
                    continue
                c = common_words(a, b)
                if c >= SHARE * max(a.size, b.size):
                    keep.append(i)
                    jac.append(float(j))
                    lcs.append(c / max(a.size, b.size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d["t"][i] for i in keep], pa.int64()), pa.array([d["r"][i] for i in keep], pa.int64()), pa.array(jac, pa.float64()), pa.array(lcs, pa.float64())],
                ["t", "r", "jaccard", "in_order"],
            )

    return pairs.mapInArrow(run, "t long, r long, jaccard double, in_order double")


def overlaps(dialogues: DataFrame) -> DataFrame:
    """(test_id, train_id, jaccard, in_order): all overlapping pairs of a test and a train record.

    Records whose split is null or of neither kind and records without words
    take no part; null elements and contents count as empty.  Copies take part
    with every member of their class.
    """
    side = F.when(F.col("split").startswith("test"), 1).when(F.col("split").startswith("train"), 0)
    source = dialogues.select("record_id", side.alias("side"), "messages").filter("side IS NOT NULL AND record_id IS NOT NULL")
    signed = written(signatures(source), "signatures")
    group = written(members(signed, ("side",)).select("record_id", "side", F.col("first_record_id").alias("rep")), "classes")
    sides = written(group.groupBy("rep").agg(F.max("side").alias("test"), F.min("side").alias("train")), "sides")
    held = F.broadcast(sides) if sides.count() <= BROADCAST_IDS else sides
    reps = signed.join(held, signed["record_id"] == held["rep"]).select("rep", "test", "train", "n", "words")
    rows = written(_prefix_rows(reps, _order(signed)), "prefixes")
    near = written(candidates(rows), "candidates")
    ids = written(near.select(F.col("t").alias("record_id")).union(near.select("r")).distinct(), "compared")
    bounded = ids.count() <= BROADCAST_IDS
    words = signed.join(F.broadcast(ids) if bounded else ids, "record_id", "left_semi").select("record_id", "words")
    both = near.join(words.select(F.col("record_id").alias("t"), F.col("words").alias("wt")), "t").join(
        words.select(F.col("record_id").alias("r"), F.col("words").alias("wr")), "r"
    )
    same = sides.filter("test = 1 AND train = 0").select(F.col("rep").alias("t"), F.col("rep").alias("r"), F.lit(1.0).alias("jaccard"), F.lit(1.0).alias("in_order"))
    found = _verified(both.select("t", "r", "wt", "wr")).unionByName(same)
    tests = group.filter("side = 1").select(F.col("record_id").alias("test_id"), F.col("rep").alias("t"))
    trains = group.filter("side = 0").select(F.col("record_id").alias("train_id"), F.col("rep").alias("r"))
    return found.join(tests, "t").join(trains, "r").select("test_id", "train_id", "jaccard", "in_order")


def report(dialogues: DataFrame) -> DataFrame:
    """Affected test records and their pairs by the test record's split and source."""
    pairs = overlaps(dialogues)
    hit = pairs.groupBy(F.col("test_id").alias("record_id")).agg(F.count("*").alias("pairs"))
    return (
        dialogues.select("record_id", "split", "source")
        .join(hit, "record_id")
        .groupBy("split", "source")
        .agg(F.count("*").alias("affected_records"), F.sum("pairs").alias("pairs"))
    )
