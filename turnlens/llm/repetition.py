"""Problem 7: repetition inside a single turn.

Statistics of each turn come from one Arrow pass (no shuffle).  A decision list
learned from labelled statistics by sequential covering - grow a conjunction of
thresholds on one part of the rows, prune it on the other, take away what it
covers, repeat - is emitted as one ordered ``CASE WHEN`` expression and judges
every turn.  It is learned from at most ``TRAIN_ROWS`` dialogues of the table
and some invented turns.  Their labels are exact - a turn is repetitive if at
least ``SHARE`` of its words lie in a run of ``RUN`` or more words that already
stood earlier in the turn - but the labelled share is none of the statistics
the list may ask.  Repetitive turns weigh ``WEIGHT`` times as much as all others
together, as an exact check can follow a verdict but not a miss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .languages import sampled

RUN = 5
SHARE = 0.4
#: Dialogues the decision list is learned from, at most.
TRAIN_ROWS = 8_000
#: Weight of all repetitive turns to that of all others when rules are learned.
WEIGHT = 2.0
#: Part of the covered weight that is repetitive from which a rule is not grown further.
PURE = 0.995

#: What the list may ask: the part of the words in runs of eight that stood before, of words
#: that did not stand before and of the most frequent word, and the words in all.
STATS = ("dup8", "distinct", "top", "words")
SCHEMA = "record_id long, turn int, n_words long, share double, " + ", ".join(f"{s} double" for s in STATS)


def _first_seen(key: np.ndarray) -> np.ndarray:
    """Which keys did not stand earlier in the array."""
    bits = np.uint64(max(1, int(key.size).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = np.sort((key & ~low) | np.arange(key.size, dtype=np.uint64))
    at = (packed & low).astype(np.int64)
    fresh = np.ones(key.size, bool)
    fresh[at[1:]] = ((packed[1:] ^ packed[:-1]) > low) | (key[at[1:]] != key[at[:-1]])
    return fresh


def _owned(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    owner = np.repeat(np.arange(len(off) - 1, dtype=np.uint64), np.diff(off))
    owner *= np.uint64(0x9E3779B97F4A7C15)
    owner += h
    return K.mix(owner)


def text_stats(texts: list[str], run: int = RUN) -> dict[str, np.ndarray]:
    """Repetition statistics of each text; 0 where a text has no words."""
    block = K.Block(texts)
    h, _, _, off = block.words()
    n = np.diff(off)
    out = {"n_words": n}
    safe = np.maximum(n, 1)
    for name, k in (("share", run), ("dup8", 8)):
        g, goff = K.runs(h, off, k)
        at = np.flatnonzero(~_first_seen(_owned(g, goff)))
        # a word is repeated if one of the k-word runs it lies in is
        owner = np.searchsorted(goff, at, "right") - 1
        pos = at - goff[owner] + off[owner]
        cover = np.zeros(h.size + k + 1, np.int32)
        cover[pos] += 1
        cover[pos + k] -= 1
        out[name] = K.sums(np.cumsum(cover[: h.size]) > 0, off) / safe
    own = _owned(h, off)
    out["distinct"] = K.sums(_first_seen(own), off) / safe
    out["top"] = _most(own, off) / safe
    out["words"] = n.astype(np.float64)
    return out


def _most(key: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How often each text's most frequent word stands in it; ``key`` differs between texts."""
    out = np.zeros(len(off) - 1, np.int64)
    if key.size:
        order = np.argsort(key)
        edge = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
        owner = np.searchsorted(off, order[edge], "right") - 1
        np.maximum.at(out, owner, np.diff(np.append(edge, key.size)))
    return out


def stats(df: DataFrame, messages: str = "messages", id_col: str = "record_id") -> DataFrame:
    """One row per turn with the repetition statistics of its content.

    Null elements and null contents count as empty texts (0 words, all
    statistics 0); null or empty message lists give no rows; other columns are
    ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, content, _ = K.messages(batch.column(1))
            ids = np.repeat(np.asarray(batch.column(0)), np.diff(off))
            turn = np.arange(off[-1]) - np.repeat(off[:-1], np.diff(off))
            texts = K.strings(content)
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            for lo, hi in K.blocks(lens):
                s = text_stats(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi], pa.int64()), pa.array(turn[lo:hi], pa.int32()), pa.array(s["n_words"], pa.int64())]
                    + [pa.array(s[c], pa.float64()) for c in ("share", *STATS)],
                    ["record_id", "turn", "n_words", "share", *STATS],
                )

    return df.select(F.col(id_col).alias("record_id"), F.col(messages).alias("messages")).mapInArrow(run, SCHEMA)


# --- the decision list --------------------------------------------------------

Rule = list[tuple[int, str, float]]  # (statistic, ">=" or "<=", threshold)


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for j, op, t in rule:
        hit &= x[:, j] >= t if op == ">=" else x[:, j] <= t
    return hit


def _grow(x: np.ndarray, y: np.ndarray, each: float, most: int = 4) -> Rule:
    """Add the threshold of the largest information gain until nearly all of the covered weight is positive."""
    rule: Rule = []
    live = np.ones(len(x), bool)
    weight = np.where(y, each, 1.0)
    while len(rule) < most:
        w, pos = weight[live], y[live]
        p0, n0 = w[pos].sum(), w.sum()
        if not p0 or p0 >= PURE * n0:
            break
        base, best = np.log2(p0 / n0), (0.0, None)
        for j in range(x.shape[1]):
            v = x[live, j]
            order = np.argsort(v)
            vs = v[order]
            cut = np.flatnonzero(vs[1:] > vs[:-1]) + 1
            if not cut.size:
                continue
            p_below, n_below = np.cumsum(np.where(pos, w, 0)[order])[cut - 1], np.cumsum(w[order])[cut - 1]
            for op, p, n in ((">=", p0 - p_below, n0 - n_below), ("<=", p_below, n_below)):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / np.maximum(n, 1e-9)) - base), 0.0)
                i = int(np.argmax(gain))
                if gain[i] > best[0] + 1e-9:
                    # the widest threshold that parts these rows
                    edge = np.nextafter(vs[cut[i] - 1], np.inf) if op == ">=" else np.nextafter(vs[cut[i]], -np.inf)
                    best = (float(gain[i]), (j, op, float(edge)))
        if best[1] is None:
            break
        rule.append(best[1])
        live &= _covers([best[1]], x)
    return rule


def _prune(rule: Rule, x: np.ndarray, y: np.ndarray, each: float) -> Rule:
    """Drop trailing conditions while (p - n) / (p + n) on the other rows, weighted, does not fall."""

    def worth(r: Rule) -> float:
        hit = _covers(r, x)
        p = each * int(y[hit].sum())
        n = int((~y[hit]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn(x: np.ndarray, y: np.ndarray, rules: int = 16, seed: int = 7) -> list[Rule]:
    """Ordered rules for the positive class; an empty list if no row is positive."""
    out: list[Rule] = []
    left = np.ones(len(x), bool)
    each = WEIGHT * max(1, int((~y).sum())) / max(1, int(y.sum()))  # of a repetitive row
    part = np.random.default_rng(seed).random(len(x)) < 2 / 3
    while y[left].any() and len(out) < rules:
        g, p = np.flatnonzero(left & part), np.flatnonzero(left & ~part)
        if not y[g].any():  # what is left stands in the pruning rows alone
            g, p = np.flatnonzero(left), np.zeros(0, np.int64)
        rule = _grow(x[g], y[g], each)
        if p.size and y[p].any():
            rule = _prune(rule, x[p], y[p], each)
        hit = _covers(rule, x) & left
        if not rule or each * y[hit].sum() < (~y[hit]).sum():
            break
        out.append(rule)
        left &= ~hit
    return out


def to_expression(rules: list[Rule]) -> Column:
    """The list as one ordered CASE WHEN: the number of the first rule that holds, 0 if none."""
    case: Column | None = None
    for i, rule in enumerate(rules, 1):
        cond = F.lit(True)
        for j, op, t in rule:
            c = F.col(STATS[j])
            cond = cond & (c >= t if op == ">=" else c <= t)
        case = F.when(cond, i) if case is None else case.when(cond, i)
    return F.lit(0) if case is None else case.otherwise(0)


def training_texts(seed: int = 11, n: int = 2000) -> list[str]:
    """Invented turns with every amount of repetition, from none to all."""
    rng = np.random.default_rng(seed)
    vocab = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(2, 9))) for _ in range(900)]
    out = []
    for i in range(n):
        size = int(np.exp(rng.uniform(np.log(5), np.log(250))))
        base = list(rng.choice(vocab, size))
        kind = i % 6
        if kind == 5:  # nothing but a phrase, a few times, and some words more
            base = base[: int(rng.integers(5, 16))] * int(rng.integers(2, 5)) + list(rng.choice(vocab, int(rng.integers(0, size))))
        elif kind:  # paste stretches of the text so far, of one phrase or of one word
            want = int(size * rng.random() * 1.6)
            phrase = base[: int(rng.integers(1, 30))]
            while want > 0:
                a = int(rng.integers(0, len(base)))
                piece = phrase if kind == 1 else base[a : a + int(rng.integers(3, 40))] if kind < 4 else [base[0]] * int(rng.integers(2, 12))
                at = len(base) if kind != 3 else int(rng.integers(0, len(base)))
                base[at:at] = piece
                want -= len(piece)
        out.append(" ".join(base))
    return out


def labelled(dialogues: DataFrame | None = None, messages: str = "messages", id_col: str = "record_id", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and exact labels of the invented turns and of the turns of the ``rows`` smallest id hashes."""
    s = text_stats(training_texts())
    x, y = np.stack([s[c] for c in STATS], 1), s["share"] >= SHARE
    if dialogues is not None:
        columns = dialogues.select(F.col(id_col).alias("record_id"), F.col(messages).alias("messages"))
        t = stats(sampled(columns, rows)).filter("n_words > 0").select("share", *STATS).toArrow()  # turns of ``rows`` dialogues
        x = np.concatenate((x, np.stack([t[c].to_numpy() for c in STATS], 1)))
        y = np.concatenate((y, t["share"].to_numpy() >= SHARE))
    return x, y


def repetition(df: DataFrame, messages: str = "messages", id_col: str = "record_id", rules: list[Rule] | None = None) -> DataFrame:
    """Each turn with its repeated share, the rule that suspects it (0 for none) and the verdict.

    A turn is ``repetitive`` if the list suspects it and its exact share bears
    that out; ties at exactly ``SHARE`` do.  Turns without words have share 0
    and are not repetitive.  Repeated rows give repeated rows.  The list is
    learned from ``df`` unless one is given.
    """
    rules = learn(*labelled(df, messages, id_col)) if rules is None else rules
    out = stats(df, messages, id_col).withColumn("rule", to_expression(rules))
    return out.withColumn("repetitive", (F.col("rule") > 0) & (F.col("share") >= SHARE))
