"""Problem 5: missing or wrong language labels.

Prediction by partial matching: for every language a tree of byte contexts of
up to ``ORDER`` bytes with symbol counts, frozen after training.  A symbol's
code length is that of the longest context that has seen it plus the escapes
(distinct symbols against all) of the longer contexts that have not; an unseen
byte costs 8 bits.  Contexts begin at the space before a word, so a word's
code length does not depend on its neighbours and is worked out once per
distinct word and task.  A stretch of text gets the language that codes it
shortest; the confidence is the posterior of the code lengths.

The trees are fitted on at most ``TRAIN_ROWS`` labelled dialogues, chosen by a
hash of their id.  Labels may be wrong: turns that a first fit codes shorter
in another language are left out of the second.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .unify import unify_all

LANGS = ("en", "si", "fr", "de", "es")
#: Longest context in bytes.
ORDER = 4
#: Labelled dialogues the trees are fitted on, at most.
TRAIN_ROWS = 4_000
#: Share of the words from which a language counts.
SHARE = 0.15
#: Bits by which a sentence must prefer a language over its turn's.
MARGIN = 12.0

# Notations of the languages.
NOTATIONS = {
    "en": ("en", "eng", "english", "englisch", "anglais", "inglés"),
    "si": ("si", "sin", "sinhala", "sinhalese", "සිංහල"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais", "französisch"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
}
MISSING = ("", "und", "unknown", "none", "null", "zxx", "mis", "mul")


def label_of(lang: Column) -> Column:
    """en, si, fr, de or es whatever the notation; null if missing; other labels as they are."""
    first = F.lower(F.trim(F.regexp_extract(F.coalesce(lang, F.lit("")), r"^\s*([^-_\s]*)", 1)))
    out = F.when(first.isin(*MISSING), F.lit(None).cast("string"))
    for code, names in NOTATIONS.items():
        out = out.when(first.isin(*names), F.lit(code))
    return out.otherwise(first)


def _contexts(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Word of each coded byte, and for each order its context and context+symbol keys (0 if the word is too short)."""
    raw = [(" " + w + " ").encode("utf-8", "surrogatepass") for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(raw)), size)
    begin = np.repeat(np.cumsum(size) - size, size)
    at = np.arange(data.size) - begin
    coded = at > 0  # the leading space is given
    ctx_keys, sym_keys = [], []
    ctx = np.zeros(data.size, np.uint64)
    for k in range(ORDER + 1):
        if k:
            shifted = np.zeros(data.size, np.uint64)
            shifted[k:] = data[:-k]
            ctx = ctx | shifted << np.uint64(8 * (k - 1))
        tag = np.uint64(k + 1) << np.uint64(56)
        fits = at >= k
        ctx_keys.append(np.where(fits, tag | ctx << np.uint64(8), np.uint64(0))[coded])
        sym_keys.append(np.where(fits, tag | ctx << np.uint64(8) | data | np.uint64(1) << np.uint64(63), np.uint64(0))[coded])
    return owner[coded], data[coded], ctx_keys, sym_keys


def symbols(words: list[str], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the symbols in their contexts of words that stand ``n`` times each, and how often they do."""
    owner, _, _, sym_keys = _contexts(words)
    keys = np.concatenate(sym_keys)
    weight = np.tile(n[owner], len(sym_keys))
    u, inv = np.unique(keys[keys != 0], return_inverse=True)
    return u, np.bincount(inv, weight[keys != 0], minlength=u.size)


class LanguageModel:
    """Frozen context trees of all languages."""

    def __init__(self, counts: list[dict[str, int]]):
        """``counts``: for each language its words and how often they were seen."""
        self._plant([(*symbols(list(seen), np.fromiter(seen.values(), np.float64, len(seen))), lang) for lang, seen in enumerate(counts) if seen], len(counts))

    @classmethod
    def of_symbols(cls, sym: list[tuple[np.ndarray, np.ndarray, int]]) -> LanguageModel:
        """From symbols in their contexts, how often they were seen, and the language; see :func:`symbols`."""
        model = cls.__new__(cls)
        model._plant(sym, len(LANGS))
        return model

    def _plant(self, sym: list[tuple[np.ndarray, np.ndarray, int]], langs: int) -> None:
        all_keys = np.concatenate([u for u, _, _ in sym]) if sym else np.zeros(0, np.uint64)
        self.sym = np.unique(all_keys)
        self.count = np.zeros((self.sym.size + 1, langs), np.float32)
        for u, c, lang in sym:
            self.count[np.searchsorted(self.sym, u), lang] += c
        low = np.uint64(0xFF) | np.uint64(1) << np.uint64(63)
        ctx_of = self.sym & ~low
        self.ctx, inv = np.unique(ctx_of, return_inverse=True)
        self.total = np.zeros((self.ctx.size + 1, langs), np.float32)
        self.kinds = np.zeros((self.ctx.size + 1, langs), np.float32)
        np.add.at(self.total, inv, self.count[:-1])
        np.add.at(self.kinds, inv, (self.count[:-1] > 0).astype(np.float32))
        self._cache_keys: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_cache_keys": None, "_cache": None}

    @staticmethod
    def _find(keys: np.ndarray, q: np.ndarray) -> np.ndarray:
        at = np.searchsorted(keys, q)
        at[at == keys.size] = 0
        if keys.size:
            at[keys[at] != q] = keys.size
        return at

    def code_lengths(self, words: list[str]) -> np.ndarray:
        """Bits of each word in each language."""
        langs = self.count.shape[1]
        out = np.zeros((len(words), langs))
        if not words:
            return out
        owner, _, ctx_keys, sym_keys = _contexts(words)
        bits = np.zeros((owner.size, langs), np.float32)
        open_ = np.ones((owner.size, langs), bool)
        for k in range(ORDER, -1, -1):
            c = self.count[self._find(self.sym, sym_keys[k])]
            at = self._find(self.ctx, ctx_keys[k])
            t, d = self.total[at], self.kinds[at]
            seen = open_ & (t > 0)
            hit = seen & (c > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                bits += np.where(hit, np.log2((t + d) / c), 0) + np.where(seen & ~hit, np.log2((t + d) / d), 0)
            open_ &= ~hit
        bits += np.where(open_, 8, 0)
        for j in range(langs):
            out[:, j] = np.bincount(owner, bits[:, j], minlength=len(words))
        return out

    def of_words(self, h: np.ndarray, s: np.ndarray, e: np.ndarray, joined: str) -> np.ndarray:
        """Code lengths of the words of a block, by way of a cache of fixed size."""
        if self._cache_keys is None:
            self._cache_keys = np.zeros(1 << 17, np.uint64)
            self._cache = np.zeros((1 << 17, self.count.shape[1]), np.float32)
        slot = (h >> np.uint64(47)).astype(np.int64)
        out = self._cache[slot]
        miss = np.flatnonzero(self._cache_keys[slot] != h)
        if miss.size:
            _, first, inv = np.unique(h[miss], return_index=True, return_inverse=True)
            at = miss[first]
            fresh = self.code_lengths([joined[a:b].lower() for a, b in zip(s[at].tolist(), e[at].tolist())]).astype(np.float32)
            out[miss] = fresh[inv]
            self._cache_keys[slot[at]] = h[at]
            self._cache[slot[at]] = fresh
        return out


def _blocks_of(texts: list[str]) -> Iterator[tuple[int, int, K.Block]]:
    for lo, hi in K.blocks(np.fromiter(map(len, texts), np.int64, len(texts))):
        yield lo, hi, K.Block(texts[lo:hi])


def _word_counts(texts: list[str], langs: np.ndarray) -> list[dict[str, int]]:
    """The words of the texts of each language and how often they stand there; texts of language -1 are left out."""
    out: list[dict[str, int]] = [{} for _ in LANGS]
    for lo, hi, block in _blocks_of(texts):
        h, s, e, off = block.words()
        lang = np.repeat(langs[lo:hi], np.diff(off))
        for j, seen in enumerate(out):
            at = np.flatnonzero(lang == j)
            _, first, n = np.unique(h[at], return_index=True, return_counts=True)
            for i, c in zip(at[first].tolist(), n.tolist()):
                w = block.joined[s[i] : e[i]].lower()
                seen[w] = seen.get(w, 0) + c
    return out


def fit(labelled: list[tuple[str, str]]) -> LanguageModel:
    """Trees from (language, text) pairs, of which some labels may be wrong."""
    labelled = [(lang, t) for lang, t in labelled if lang in LANGS]
    texts = unify_all([t for _, t in labelled])[0]
    langs = np.array([LANGS.index(lang) for lang, _ in labelled], np.int64)
    model = LanguageModel(_word_counts(texts, langs))
    clean = np.full(len(texts), -1, np.int64)
    for lo, hi, block in _blocks_of(texts):
        g = segment(model, block)
        own = langs[lo:hi]
        clean[lo:hi] = np.where((g["turn_bits"].argmin(1) == own) & (np.diff(g["off"]) > 0), own, -1)
    return LanguageModel(_word_counts(texts, clean))


def sampled(df: DataFrame, rows: int, id_col: str = "record_id") -> DataFrame:
    """The ``rows`` rows of the smallest id hashes.

    A bound on the hash, from the number of rows, leaves about twice as many
    to order, so what tasks send to the driver does not grow with their number.
    """
    place = F.shiftrightunsigned(F.xxhash64(id_col), 1)
    n = df.count()
    if n > 2 * rows:
        df = df.filter(place < (1 << 63) // n * 2 * rows)
    return df.orderBy(place, id_col).limit(rows)


def fit_on(dialogues: DataFrame, rows: int = TRAIN_ROWS) -> LanguageModel:
    """Trees from the labelled dialogues with the ``rows`` smallest id hashes."""
    labelled = dialogues.select("record_id", label_of(F.col("lang")).alias("lang"), F.col("messages.content").alias("contents"))
    sample = sampled(labelled.filter(F.col("lang").isin(*LANGS)), rows).collect()
    return fit([(r["lang"], t) for r in sample for t in r["contents"] or [] if t])


_BREAKS = frozenset(".!?\n。！？…:;«»“”„\"  \r")


def _break_of(c: int) -> int:
    return int(chr(c) in _BREAKS)


def segment(model: LanguageModel, block: K.Block) -> dict[str, np.ndarray]:
    """Sentences of a block with their language.

    ``lang`` and ``bits`` by sentence, ``words`` their sizes, ``first`` their
    first word, ``text`` the text they stand in; ``turn_bits`` by text.
    """
    h, s, e, off = block.words()
    bits = model.of_words(h, s, e, block.joined).astype(np.float64)
    turn_bits = K.totals(bits, off)
    if not h.size:
        empty = np.zeros(0, np.int64)
        return {"lang": empty, "bits": np.zeros((0, len(LANGS))), "words": empty, "text": empty, "first": empty, "start": empty, "end": empty, "starts": empty, "ends": empty, "turn_bits": turn_bits, "off": off, "hash": h}
    breaks = np.cumsum(K.table("break", _break_of, np.uint8)(block.cp), dtype=np.int64)
    key = breaks[s]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    first = np.flatnonzero(new)
    soff = np.append(first, h.size)
    sent = K.totals(bits, soff)
    text = np.searchsorted(off, first, "right") - 1
    lang = sent.argmin(1)
    turn_lang = turn_bits.argmin(1)[text]
    rows = np.arange(len(lang))
    weak = sent[rows, turn_lang] - sent[rows, lang] < MARGIN
    lang = np.where(weak, turn_lang, lang)
    return {
        "lang": lang, "bits": sent, "words": np.diff(soff), "text": text, "first": first,
        "start": s[first], "end": e[soff[1:] - 1], "starts": s, "ends": e, "turn_bits": turn_bits, "off": off, "hash": h,
    }


def _confidence(bits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Posterior of the chosen language under equal priors, from code lengths."""
    d = np.clip(bits - bits.min(1, keepdims=True), 0, 60)
    p = np.exp2(-d)
    return p[np.arange(len(chosen)), chosen] / p.sum(1)


def assign(dialogues: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """One row per dialogue: words in all, the label in one notation, its languages with words, share and confidence.

    ``languages`` is sorted by words, most first (ties in the order of LANGS),
    and empty for dialogues without words; null contents count as empty.
    """
    model = model or fit_on(dialogues)
    held = dialogues.sparkSession.sparkContext.broadcast(model)  # bounded by TRAIN_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("lang", pa.string()), ("words", pa.int64()), ("share", pa.float64()), ("confidence", pa.float64())])
        for batch in batches:
            off, content, _ = K.messages(batch.column(2))
            texts, _ = unify_all(K.strings(content))
            size = K.sums(np.fromiter(map(len, texts), np.int64, len(texts)), off)
            for lo, hi in K.blocks(size):
                words = np.zeros((hi - lo, len(LANGS)), np.int64)
                bits = np.zeros((hi - lo, len(LANGS), len(LANGS)))
                if off[hi] > off[lo]:
                    g = segment(held.value, K.Block(texts[off[lo] : off[hi]]))
                    rec = np.searchsorted(off[lo + 1 : hi + 1] - off[lo], g["text"], "right")
                    np.add.at(words, (rec, g["lang"]), g["words"])
                    np.add.at(bits, (rec, g["lang"]), g["bits"])
                total = words.sum(1)
                out = []
                for i in range(hi - lo):
                    row = []
                    for j in np.argsort(-words[i], kind="stable"):
                        if words[i, j]:
                            conf = _confidence(bits[i, j : j + 1], np.array([j]))[0]
                            row.append({"lang": LANGS[j], "words": int(words[i, j]), "share": words[i, j] / total[i], "confidence": float(conf)})
                    out.append(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(total, pa.int64()), pa.array(out, pa.list_(kind))],
                    ["record_id", "label", "n_words", "languages"],
                )

    schema = "record_id long, label string, n_words long, languages array<struct<lang string, words long, share double, confidence double>>"
    return dialogues.select("record_id", label_of(F.col("lang")).alias("label"), "messages").mapInArrow(run, schema)


def stretches(dialogues: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """Runs of sentences of one language in a turn: (record_id, turn, start, stop, lang, words, confidence)."""
    model = model or fit_on(dialogues)
    held = dialogues.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, content, _ = K.messages(batch.column(1))
            texts = K.strings(content)
            ids = np.repeat(np.asarray(batch.column(0)), np.diff(off))
            turn = np.arange(off[-1]) - np.repeat(off[:-1], np.diff(off))
            for lo, hi in K.blocks(np.fromiter(map(len, texts), np.int64, len(texts))):
                block = K.Block(texts[lo:hi])
                g = segment(held.value, block)
                if not g["lang"].size:
                    continue
                new = np.concatenate(([True], (g["lang"][1:] != g["lang"][:-1]) | (g["text"][1:] != g["text"][:-1])))
                at = np.flatnonzero(new)
                cut = np.append(at, new.size)
                bits, lang, text = K.sums(g["bits"], cut), g["lang"][at], g["text"][at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[lo:hi][text], pa.int64()),
                        pa.array(turn[lo:hi][text], pa.int32()),
                        pa.array(g["start"][at] - block.start[text], pa.int32()),
                        pa.array(g["end"][cut[1:] - 1] - block.start[text], pa.int32()),
                        pa.array([LANGS[j] for j in lang]),
                        pa.array(K.sums(g["words"], cut), pa.int64()),
                        pa.array(_confidence(bits, lang), pa.float64()),
                    ],
                    ["record_id", "turn", "start", "stop", "lang", "words", "confidence"],
                )

    schema = "record_id long, turn int, start int, stop int, lang string, words long, confidence double"
    return dialogues.select("record_id", "messages").mapInArrow(run, schema)


def corrections(dialogues: DataFrame, share: float = SHARE) -> DataFrame:
    """(record_id, lang, share, confidence) of dialogues whose label is missing, wrong or not the whole truth."""
    out = assign(dialogues).filter("n_words > 0").withColumn("main", F.filter("languages", lambda x: x["share"] >= share))
    wrong = F.col("label").isNull() | (F.col("label") != F.col("languages")[0]["lang"]) | (F.size("main") > 1)
    return out.filter(wrong).select("record_id", F.explode("main").alias("m")).select("record_id", "m.lang", "m.share", "m.confidence")
