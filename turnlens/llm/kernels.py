"""Array kernels over Arrow batches of text, used inside ``mapInArrow``.

Texts of a batch are laid end to end as code points (one newline between two
texts) and every step - classing characters, folding case, cutting words,
hashing words and word runs - is an array operation over that block.  A block
holds about ``BLOCK`` code points, or one text if that is longer, so a task's
memory follows its longest text and not its batch.

A *word* is a stretch between white space, without punctuation at its ends and
regardless of case; stretches of punctuation alone are no words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Code points handled at once.
BLOCK = 1 << 19

SPACE, PUNCT, LETTER, DIGIT, MARK, HIDDEN, UPPER = 1, 2, 4, 8, 16, 32, 64

_M64 = (1 << 64) - 1
_MUL = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MUL, -1, 1 << 64)


class CodeTable:
    """A value per code point, worked out by ``fn`` when first met."""

    def __init__(self, fn: Callable[[int], int], dtype, eager: int = 0x3000):
        self.fn, self.eager = fn, eager
        self.values = np.zeros(0x110000, dtype)
        self.known = np.zeros(0x110000, bool)
        self.values[:eager] = [fn(c) for c in range(eager)]
        self.known[:eager] = True

    def __call__(self, cp: np.ndarray) -> np.ndarray:
        self.learn(cp)
        return np.take(self.values, cp)

    def learn(self, cp: np.ndarray) -> None:
        if cp.size and int(cp.max()) >= self.eager:
            far = np.unique(cp[cp >= self.eager])
            for c in far[~self.known[far]]:
                self.values[c] = self.fn(int(c))
                self.known[c] = True


def _class_of(c: int) -> int:
    ch = chr(c)
    if ch.isspace():
        return SPACE
    cat = unicodedata.category(ch)
    if cat[0] in "PS":
        return PUNCT
    if cat[0] == "L":
        return LETTER | (UPPER if cat in ("Lu", "Lt") else 0)
    if cat[0] == "N":
        return DIGIT
    if cat[0] == "M":
        return MARK
    return HIDDEN


def _fold_of(c: int) -> int:
    low = chr(c).lower()
    return ord(low[0]) if low else c


_tables: dict[str, CodeTable] = {}


def table(name: str, fn: Callable[[int], int], dtype) -> CodeTable:
    """The code table of this name, made once per worker."""
    if name not in _tables:
        _tables[name] = CodeTable(fn, dtype)
    return _tables[name]


def classes(cp: np.ndarray) -> np.ndarray:
    return table("class", _class_of, np.uint8)(cp)


def folded(cp: np.ndarray) -> np.ndarray:
    return table("fold", _fold_of, np.uint32)(cp)


def _weight_of(c: int) -> int:
    return int(mix(np.array([_fold_of(c) + 1], np.uint64))[0]) | 1


_powers: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MUL**i and its inverse for i < n, modulo 2**64."""
    if _powers[0].size < n:
        size = max(n, 2 * BLOCK)
        for k, base in enumerate((_MUL, _INV)):
            out = np.full(size, np.uint64(base & _M64))
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def strings(col: pa.Array) -> list[str]:
    """Python strings of a column; null as the empty text."""
    return [s or "" for s in col.to_numpy(zero_copy_only=False).tolist()]


def blocks(lengths: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` characters each."""
    ends = np.cumsum(lengths)
    lo, n = 0, len(lengths)
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + size, "right")))
        yield lo, hi
        lo = hi


class Block:
    """Code points of some texts; text i is ``cp[start[i]:end[i]]``."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.joined = joined = "\n".join(texts) + "\n"
        self.cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.int32)
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(lens + 1) - 1
        self.start = self.end - lens
        self._cls: np.ndarray | None = None

    @property
    def cls(self) -> np.ndarray:
        if self._cls is None:
            self._cls = classes(self.cp)
        return self._cls

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word."""
        solid = (self.cls & SPACE) == 0
        edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        if solid.size and solid[0]:
            edge = np.concatenate(([0], edge))
        s, e = edge[0::2].copy(), edge[1::2].copy()  # a block ends in a newline
        punct = (self.cls & PUNCT) != 0
        for _ in range(2):  # most words have few signs at their ends
            s[punct[s] & (s < e)] += 1
            e[punct[e - 1] & (s < e)] -= 1
        signs = punct.tobytes()
        for i in np.flatnonzero((punct[s] | punct[e - 1]) & (s < e)).tolist():
            first = signs.find(0, s[i], e[i])
            s[i], e[i] = (first, signs.rfind(0, first, e[i]) + 1) if first >= 0 else (e[i], e[i])
        ok = s < e
        return s[ok], e[ok]

    def prefix(self, values: np.ndarray | None = None) -> np.ndarray:
        """Running sums from which :meth:`hashes` are read."""
        p, _ = powers(self.cp.size)
        x = table("weight", _weight_of, np.uint64)(self.cp) if values is None else mix(values.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
        x *= p
        out = np.zeros(x.size + 1, np.uint64)
        np.cumsum(x, out=out[1:])
        return out

    def hashes(self, s: np.ndarray, e: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        """A hash of each stretch, equal for equal folded characters."""
        _, inv = powers(self.cp.size)
        return mix((prefix[e] - prefix[s]) * inv[s] + (e - s).astype(np.uint64))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end of every word, and the words' offsets by text."""
        s, e = self.spans()
        h = self.hashes(s, e, self.prefix())
        off = np.searchsorted(s, np.append(self.start, self.cp.size))
        return h, s, e, off


def runs(h: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k words in a row inside one text, and their offsets by text."""
    n = h.size
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    g = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        g *= np.uint64(0x9FB21C651E98DF25)
        g += h[i : n - k + 1 + i]
    g = mix(g)
    counts = np.maximum(np.diff(off) - (k - 1), 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    goff = np.concatenate(([0], np.cumsum(counts)))
    pos = np.arange(goff[-1]) - goff[owner] + off[owner]
    return g[pos], goff


def sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of values[off[i]:off[i+1]] for each i (0 for empty stretches)."""
    kind = np.int64 if values.dtype.kind in "bui" else np.float64
    c = np.zeros((len(values) + 1,) + values.shape[1:], kind)
    np.cumsum(values, axis=0, dtype=kind, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def totals(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of the rows values[off[i]:off[i+1]] for each i (0 for empty stretches), each for itself."""
    out = np.zeros((len(off) - 1,) + values.shape[1:], values.dtype)
    full = np.flatnonzero(np.diff(off))
    if full.size:
        out[full] = np.add.reduceat(values, off[full], axis=0)
    return out


def sums_u64(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The same for 64-bit hashes, modulo 2**64."""
    c = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def messages(col: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Offsets by record, contents and roles of a column of message lists.

    A null list has no turns; null elements keep their position and have null
    content and role.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = np.asarray(pc.fill_null(pc.list_value_length(col), 0), np.int64)
    flat = col.flatten()
    off = np.concatenate(([0], np.cumsum(n)))
    return off, pc.struct_field(flat, "content"), pc.struct_field(flat, "role")
