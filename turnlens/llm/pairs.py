"""Problem 1: broken prompt and response pairs.

A multi-label linear classifier (one logistic unit per defect) on hashed word
n-grams of the answer, hashed features of its end and features of the pair
judges every assistant turn directly after a user turn.  It is trained on the
whole table: every pair counts as it is, and every finished answer may also be
emptied, cut, copied from the question, swapped with an answer in another
language or replaced by a refusal.  A first fit looks through the pairs as
they are: those it finds sound join the second fit as such, so that it knows
what sound answers look like in the table, and those that it calls refused
join as refusals.  Thresholds are calibrated on pairs held out from training.
The answer's defect is the one furthest above its threshold, in units of the
defect's own usual score.

The texts are unified and dealt out by a hash of their record once, the pairs'
features worked out once; both are kept as tables.  In a round of a fit every
task goes through its pairs in steps of ``BATCH`` and the tasks' weights are
averaged.  What comes to the driver is summed before: symbols of the language
trees, words seen more than once, weights and counts of scores.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import kernels as K
from .languages import LANGS, LanguageModel, label_of, segment, symbols
from .unify import unify_all

DEFECTS = ("empty", "truncated", "refusal", "copy", "other_language")
BUCKETS = 1 << 13
#: One pair in so many is held out from a fit, for its thresholds.
HELD = 4
#: Steps of a task in a round of the first and of the second fit, at least: tasks with few pairs go through them again.
STEPS = (100, 150)
#: Rounds of the first and of the second fit.
ROUNDS = (1, 2)
#: Pairs of a step.
BATCH = 512
#: Share of the best F measure that a threshold may cost.
LEEWAY = 1e-3
#: Scores are counted in cells of 1 / CELLS up to LIMIT on both sides.
CELLS, LIMIT = 512, 64
#: Bits by which another language must code the answer shorter to be taken for its language.
LANGUAGE_MARGIN = 15.0
#: Share of the question's language up to which an answer is in another.
OWN_SHARE = 0.25
COPY_SHARE = 0.75
#: Words a question's label or closing may add to its copy.
COPY_EXTRA = 4
#: Pull of the weights of hashed features towards 0, by defect: what the answer says tells
#: refusals, how it ends tells broken ones; the others are told by features of the pair.
PULL = (1e-2, 1e-3, 1e-5, 1e-2, 1e-2)
#: The same for the other features, so that chance ones do not count.
DENSE_PULL = (1e-3, 1e-5, 1e-5, 1e-3, 1e-3)

# What stands in for a missing answer.
STAND_INS = frozenset("n/a na null none nil nan blank empty void undefined missing todo tbd placeholder unknown no response answer reply text output content data given provided available keine antwort leer aucune réponse vide sin respuesta vacío pas de [blank] <empty> හිස් පිළිතුරක් නැත".split())
# Names of the languages, by which a question asks for one.
ASKS = {
    "en": re.compile(r"\b(english|englisch\w*|anglais\w*|inglés|ingles\w*)|ඉංග්‍?රීසි", re.I),
    "fr": re.compile(r"\b(french|französisch\w*|français\w*|francés|frances\w*)|ප්‍?රංශ", re.I),
    "de": re.compile(r"\b(german|deutsch\w*|allemand\w*|alemán|aleman\w*)|ජර්මන්|ජර්මානු", re.I),
    "es": re.compile(r"\b(spanish|spanisch\w*|espagnol\w*|español\w*|castellano)|ස්පාඤ්ඤ|ස්පාඥ", re.I),
    "si": re.compile(r"\b(sinhala|sinhalese|singhalesisch\w*|singhales\w*|cinghalais\w*|cingal\w*|sinhalés)|සිංහල", re.I),
}
# The languages' names in the order of LANGS, in each of them, for synthetic requests.
NAMES = {
    "en": ("English", "Sinhala", "French", "German", "Spanish"),
    "si": ("ඉංග්‍රීසි", "සිංහල", "ප්‍රංශ", "ජර්මන්", "ස්පාඤ්ඤ"),
    "fr": ("anglais", "cinghalais", "français", "allemand", "espagnol"),
    "de": ("Englisch", "Singhalesisch", "Französisch", "Deutsch", "Spanisch"),
    "es": ("inglés", "cingalés", "francés", "alemán", "español"),
}
# Invented ways to refuse, for synthetic refusals; {} is a topic from the question.
REFUSALS = {
    "en": "Sorry, this is something I won't do.|I would prefer to leave that question alone.|Helping with {} is not possible for me.|That's a request I have to turn down.|I'm going to decline this one.|It isn't appropriate for me to reply to that.|I don't feel comfortable talking about {}.|You will have to ask somebody else about {}.|As an assistant, I do not respond to requests of this kind.|The rules I follow do not let me say anything on {}.|I regret that I can offer no help here.|This is outside of what I may talk about.|Unfortunately I'm not permitted to go into {}.|I can't do that for you.|I will not give an answer to this question.|My apologies, but this request cannot be fulfilled.|No, I can't assist you in this matter.|I refuse to take part in this.|It is against my policy to discuss {}.|I'm afraid that's not possible for me.|I'm not in a position to comment on {}.|Your request has been declined.|I choose not to respond.|Sorry, but I must refuse to discuss {}.|I am not authorised to reply.|I have to turn this down.|Writing on {} is off limits for me.|I'm unable to go along with this.|There will be no answer from me on {}.",
    "de": "Das werde ich nicht tun.|Zu {} gebe ich keine Antwort.|Bei {} kann ich Ihnen nicht behilflich sein.|Leider ist es mir nicht gestattet, darauf einzugehen.|Ich bedaure, hier kann ich keine Hilfe anbieten.|Ihre Anfrage muss ich zurückweisen.|Als Assistent beantworte ich solche Anfragen nicht.|Darüber zu sprechen ist mir untersagt.|Bitte wenden Sie sich dafür an jemand anderen.|Es verstößt gegen meine Vorgaben, über {} zu reden.|Ich weigere mich, dabei mitzuwirken.|Entschuldigung, aber das darf ich nicht.|Ich lehne es ab, mich zu {} zu äußern.|Ich bin nicht befugt, darauf zu antworten.|Ich sehe mich gezwungen abzulehnen.|Über {} schreibe ich nichts.|Auf diese Frage gibt es von mir keine Antwort.|Mir ist nicht erlaubt, dazu Stellung zu nehmen.|Hierbei helfe ich nicht.|Ich kann Ihnen dabei nicht weiterhelfen.",
    "fr": "Je ne le ferai pas.|Je ne donne aucune réponse à propos de {}.|Il m'est impossible de vous assister pour {}.|Hélas, je n'ai pas l'autorisation d'en discuter.|Je regrette, je n'ai aucune aide à offrir ici.|Votre demande doit être rejetée.|En tant qu'assistant, je ne réponds pas à ce genre de demandes.|Veuillez vous adresser à quelqu'un d'autre.|Parler de {} va contre mes principes.|Je m'abstiens de tout commentaire.|Pardon, mais cela ne m'est pas permis.|Je refuse d'aborder {}.|Je ne suis pas autorisé à répondre.|Je me vois contraint de refuser.|Écrire à propos de {} m'est interdit.|Je n'ai pas le droit de répondre à cela.|Je ne peux pas donner suite à cette question.|Il faut que je refuse.|Je ne vous aiderai pas en cela.|Je préfère me taire au sujet de {}.",
    "es": "No voy a hacerlo.|No doy ninguna respuesta sobre {}.|Me resulta imposible asistirle con {}.|Lamentablemente carezco de permiso para comentarlo.|Lo lamento, aquí no puedo ofrecer ayuda.|Su solicitud debe ser rechazada.|Como asistente, no contesto a solicitudes de este tipo.|Diríjase a otra persona, por favor.|Hablar de {} va en contra de mis principios.|Me abstengo de comentar.|Perdón, pero eso no lo tengo permitido.|Me niego a tratar {}.|No estoy autorizado a responder.|Me veo obligado a negarme.|Escribir acerca de {} me está prohibido.|No tengo derecho a responder a eso.|No puedo dar curso a esta pregunta.|Tengo que rechazarlo.|No voy a ayudarle en esto.|Prefiero callar acerca de {}.",
    "si": "මම එය නොකරමි.|{} පිළිබඳව මට පිළිතුරක් දිය නොහැකිය.|එයට සහාය වීමට මට නොහැකියි.|එම ඉල්ලීම මට පිළිගත නොහැක.|කරුණාකර වෙනත් කෙනෙකුගෙන් විමසන්න.|ඒ පිළිබඳව අදහස් දැක්වීමට මම අකමැතියි.|මගේ ප්‍රතිපත්ති අනුව {} සාකච්ඡා කළ නොහැක.|සමාවෙන්න, එය කිරීමට මට අවසරයක් නැත.|ඔබේ ඉල්ලීම ප්‍රතික්ෂේප කරමි.|{} ගැන කිසිදු පිළිතුරක් ලබා නොදෙමි.|පිළිතුරු දීමට මට බලයක් නැහැ.|මට මෙය ප්‍රතික්ෂේප කිරීමට සිදු වෙනවා.|{} ගැන ලිවීම මට තහනම්.|මේකට උත්තර දෙන්න මට අයිතියක් නැහැ.|මම මේකට උදව් කරන්නේ නැහැ.|{} ගැන මම නිහඬව සිටිමි.|මේ ප්‍රශ්නයට උත්තරයක් මගෙන් නැහැ.",
}
FRAMES = {"en": ("Well. ", "I see what you are after. ", "That is a fair thing to ask. "), "de": ("Nun gut. ", "Ich verstehe Ihr Anliegen. "), "fr": ("Bon. ", "Je comprends votre souhait. "), "es": ("Bueno. ", "Entiendo su interés. "), "si": ("හොඳයි. ", "ඔබේ අදහස මට තේරෙනවා. ")}
CLOSES = {"en": (" Try asking about another matter.", " I can gladly talk about different subjects.", " Thanks for bearing with me."), "de": (" Fragen Sie gern nach etwas anderem.", " Danke für Ihre Nachsicht."), "fr": (" Demandez-moi plutôt autre chose.", " Merci de votre patience."), "es": (" Pregúnteme mejor otra cosa.", " Gracias por su paciencia."), "si": (" වෙනත් මාතෘකාවක් ගැන අසන්න.", " ඔබේ ඉවසීමට ස්තුතියි.")}

DENSE = (
    "bias", "nothing", "stand_in", "open_fence", "terminal", "soft_end", "open_end", "closed_item", "open_item", "rare_end", "rare_name_end", "closed_rare", "closed_name",
    "copied_of", "copied_in", "copied", "gap", "other", "asked", "other_unasked", "words", "brief", "no_words", "fresh",
)
_TERMINAL = frozenset(".!?。！？…;)]}\"'»”’*`|$>")
_MARKER = re.compile(r"^[ \t]*(?:[-*•–]|\d{1,3}[.)])\s", re.M)
_SENTENCE = re.compile(r"(?<=[.!?])\s")
_UNIT = re.compile(r"[\w/]+")
_M64 = (1 << 64) - 1
_SENTENCE_END = re.compile(r"[.!?。！？]\s*$")


@dataclass
class Pairs:
    """Question and answer texts of a block of pairs, in one consistent spelling."""

    question: list[str]
    answer: list[str]


def _end(text: str) -> tuple[float, float, float, float, float]:
    """How a text ends: finally, on a comma, openly, in an item of a list of phrases, in one of a list of sentences."""
    t = text.rstrip()
    if not t:
        return 0.0, 0.0, 0.0, 0.0, 0.0
    final = t[-1] in _TERMINAL or t.endswith(" -") or t.endswith("\n-")
    if final:
        return 1.0, 0.0, 0.0, 0.0, 0.0
    # the last paragraph: a list item does not reach beyond a blank line
    tail = t[t.rfind("\n\n") + 1 :]
    marks = [m.start() for m in _MARKER.finditer(tail)]
    if marks and not re.search(r"[.!?](\s|$)", _MARKER.sub("", tail[marks[-1] :], count=1)):
        before = tail[marks[-2] : marks[-1]] if len(marks) > 1 else _item_before(t[: len(t) - len(tail)])
        sentences = bool(_SENTENCE_END.search(before))
        return 0.0, float(t[-1] == ","), 0.0, float(not sentences), float(sentences)
    return 0.0, float(t[-1] == ","), 1.0, 0.0, 0.0


def _item_before(text: str) -> str:
    """The list item that ends the text, if one does."""
    last = text.rstrip()
    last = last[last.rfind("\n\n") + 1 :]
    marks = [m.start() for m in _MARKER.finditer(last)]
    return last[marks[-1] :] if marks else ""


def _stands_in(text: str) -> bool:
    """Does a text hold nothing but words that stand in for a missing answer?"""
    any_word = False
    for m in _UNIT.finditer(text):
        if m.group().lower() not in STAND_INS:
            return False
        any_word = True
    return any_word


def _once(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of hashes, each once in a text, and their offsets by text."""
    wide = np.repeat(np.arange(len(off) - 1, dtype=np.int64), np.diff(off)) * BUCKETS
    key = np.sort(wide + ((h >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int64))
    key = key[np.diff(key, prepend=-1) != 0]
    return key % BUCKETS, np.searchsorted(key, np.arange(len(off)) * BUCKETS)


class Rows:
    """Hashed (by text) and dense features of pairs, as they are stored."""

    def __init__(self, grams: tuple[np.ndarray, np.ndarray], pairs_of: tuple[np.ndarray, np.ndarray], ends: list[np.ndarray], dense: np.ndarray):
        self.grams, self.pairs_of, self.ends, self.dense = grams, pairs_of, ends, dense

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Rows:
        dense = _unpacked(batch.column("dense"), np.float32)[0].reshape(-1, len(DENSE))
        return cls(_unpacked(batch.column("grams"), np.uint16), _unpacked(batch.column("pairs_of"), np.uint16), [np.asarray(batch.column(k)) for k in ("end", "line_end")], dense)

    def columns(self) -> list[pa.Array]:
        each = np.arange(len(self.dense) + 1) * len(DENSE)
        return [_packed(*self.grams, np.uint16), _packed(*self.pairs_of, np.uint16), *(pa.array(e, pa.int32()) for e in self.ends), _packed(self.dense.ravel(), each, np.float32)]

    def take(self, rows: np.ndarray) -> Rows:
        return Rows(*(_taken(*x, rows) for x in (self.grams, self.pairs_of)), [e[rows] for e in self.ends], self.dense[rows])

    def scores(self, w: np.ndarray, dense: np.ndarray) -> np.ndarray:
        out = self.dense @ dense
        for (idx, off) in (self.grams, self.pairs_of):
            n = np.maximum(np.diff(off), 1)
            for lo in range(0, len(out), BATCH):
                part = off[lo : lo + BATCH + 1]
                out[lo : lo + BATCH] += K.totals(w.take(idx[part[0] : part[-1]], axis=0), part - part[0]) / np.sqrt(n[lo : lo + BATCH])[:, None]
        for e in self.ends:
            out += np.where(e >= 0, 1, 0)[:, None] * w[np.maximum(e, 0) + BUCKETS]
        return out

    def gradient(self, err: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients for the hashed and the dense weights."""
        gw = np.zeros((2 * BUCKETS, err.shape[1]))
        for (idx, off) in (self.grams, self.pairs_of):
            n = np.diff(off)
            idx = idx.astype(np.intp)
            for c, each in enumerate((err / np.sqrt(np.maximum(n, 1))[:, None]).T):
                gw[:BUCKETS, c] += np.bincount(idx, np.repeat(each, n), minlength=BUCKETS)
        for e in self.ends:
            ok = e >= 0
            for c in range(err.shape[1]):
                gw[BUCKETS:, c] += np.bincount(e[ok], err[ok, c], minlength=BUCKETS)
        return gw, self.dense.T @ err


def _packed(values: np.ndarray, off: np.ndarray, dtype) -> pa.Array:
    """A binary value per text of its numbers."""
    data = np.ascontiguousarray(values, dtype)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((np.asarray(off) * data.itemsize).astype(np.int32)), pa.py_buffer(data)])


def _unpacked(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of :func:`_packed` end to end, and their offsets by text."""
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    own = data.slice(int(off[0]), int(off[-1] - off[0])).to_pybytes() if data is not None else b""
    return np.frombuffer(own, dtype), (off - off[0]) // np.dtype(dtype).itemsize


def _taken(values: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of some texts, in their order."""
    if not rows.size:
        return values[:0], off[:1] * 0
    lo, hi = rows[0], rows[-1] + 1
    size, keep = np.diff(off[lo : hi + 1]), np.zeros(hi - lo, bool)
    keep[rows - lo] = True
    return values[off[lo] : off[hi]][np.repeat(keep, size)], np.concatenate(([0], np.cumsum(size[keep])))


class Features(Rows):
    """The same, worked out from the pairs."""

    def __init__(self, pairs: Pairs, langs: LanguageModel, known: np.ndarray):
        n = len(pairs.answer)
        block = K.Block(pairs.question + pairs.answer)
        g = segment(langs, block)
        h, off = g["hash"], g["off"]
        size = np.diff(off)
        qn, an = size[:n], size[n:]
        # hashed words and word pairs of the answers; numbers count as one word
        a0 = off[n]
        ah, aoff = h[a0:], off[n:] - a0
        bi, bi_off = K.runs(ah, aoff, 2)
        self.grams, self.pairs_of = _once(ah, aoff), _once(bi, bi_off)
        last = np.where(an > 0, aoff[1:] - 1, 0)
        has = an > 0
        lw = np.where(has, ah[last] if ah.size else 0, 0).astype(np.uint64)
        d = np.zeros((n, len(DENSE)))
        d[:, 0] = 1
        core = (block.cls & (K.LETTER | K.DIGIT)) != 0
        cores = np.concatenate(([0], np.cumsum(core)))
        col = {name: k for k, name in enumerate(DENSE)}
        d[:, col["nothing"]] = cores[block.end[n:]] - cores[block.start[n:]] == 0
        if n:
            d[:, col["stand_in"]] = [_stands_in(a) for a in pairs.answer]
            d[:, col["open_fence"]] = [a.count("```") % 2 for a in pairs.answer]
            d[:, col["terminal"] : col["open_item"] + 1] = [_end(a) for a in pairs.answer]
        item = d[:, col["closed_item"]].astype(np.uint64)
        at = np.searchsorted(known, lw)
        rare = has & ~((at < known.size) & (known[np.minimum(at, known.size - 1)] == lw if known.size else False))
        first = block.cls[g["starts"][a0:][last]] if ah.size else np.zeros(n, np.uint8)
        name = has & ((first & K.UPPER) != 0)
        d[:, col["rare_end"]], d[:, col["rare_name_end"]] = rare & ~name, rare & name
        d[:, col["closed_rare"]] = d[:, col["closed_item"]] * d[:, col["rare_end"]]
        d[:, col["closed_name"]] = d[:, col["closed_item"]] * d[:, col["rare_name_end"]]
        of, within = d[:, col["copied_of"]], d[:, col["copied_in"]]
        # a copy has as many words as the question, about, or those of a label more
        near = np.flatnonzero((an > 0) & (qn > 0) & (COPY_SHARE * an <= qn + COPY_EXTRA) & (an >= COPY_SHARE * qn))
        for i in near:
            q, a = h[off[i] : off[i + 1]], ah[aoff[i] : aoff[i + 1]]
            both = _shared(q, a)
            of[i], within[i] = both / q.size, both / a.size
        labelled = (of >= 1) & (an - qn <= COPY_EXTRA)
        d[:, col["copied"]] = (np.minimum(of, within) >= COPY_SHARE) | labelled
        bits = g["turn_bits"]
        ql, al = bits[:n].argmin(1), bits[n:].argmin(1)
        rows = np.arange(n)
        gap = bits[n:][rows, ql] - bits[n:][rows, al]
        d[:, col["gap"]] = gap / (gap + LANGUAGE_MARGIN)
        # words of each answer in sentences of the question's language
        own = np.zeros(2 * n)
        np.add.at(own, g["text"], np.where(g["lang"] == np.concatenate((ql, ql))[g["text"]], g["words"], 0))
        other = (al != ql) & (gap >= LANGUAGE_MARGIN) & (an > 0) & (qn > 0) & (own[n:] <= OWN_SHARE * an)
        d[:, col["other"]] = other
        for i in np.flatnonzero(other):
            d[i, col["asked"]] = bool(ASKS[LANGS[al[i]]].search(pairs.question[i]))
        d[:, col["other_unasked"]] = other & (d[:, col["asked"]] == 0)
        d[:, col["words"]] = np.log1p(an) / 5
        d[:, col["brief"]] = 20 / (20 + an)
        d[:, col["no_words"]] = an == 0
        d[:, col["fresh"]] = np.diff(self.pairs_of[1]) / np.maximum(np.diff(bi_off), 1)  # word pairs that do not come again
        self.dense = d.astype(np.float32)  # as stored
        # features of the answer's end: its last word, alone and with the kind of line
        ends = K.mix(lw + np.uint64(17)), K.mix(lw + item + np.uint64(29))
        self.ends = [np.where(has, (e % np.uint64(BUCKETS)).astype(np.int64), -1) for e in ends]
        # finished answers of some length in the question's language, which do not give it back, are the material for invented defects
        self.own = ql
        self.fine = (al == ql) & (an >= 20) & ((d[:, col["terminal"]] > 0) | (d[:, col["closed_item"]] > 0)) & (d[:, col["copied"]] == 0)


def _shared(q: np.ndarray, a: np.ndarray) -> int:
    """Words two texts share, counting repeats."""
    pool: dict[int, int] = {}
    for w in q.tolist():
        pool[w] = pool.get(w, 0) + 1
    n = 0
    for w in a.tolist():
        if pool.get(w, 0):
            pool[w] -= 1
            n += 1
    return n


class Classifier:
    """Language trees, words seen more than once, weights and thresholds; of the size of the vocabulary, not of the table."""

    def __init__(self, langs: LanguageModel, known: np.ndarray):
        self.langs, self.known = langs, known
        self.w = np.zeros((2 * BUCKETS, len(DEFECTS)))
        self.dense = np.zeros((len(DENSE), len(DEFECTS)))
        self.threshold = np.full(len(DEFECTS), np.inf)
        self.unit = np.ones(len(DEFECTS))

    def calibrate(self, cell: np.ndarray, n: np.ndarray, hits: np.ndarray, c: int) -> None:
        """For a defect the threshold of the best F measure on held-out pairs, and the usual score above it.

        Of the thresholds around the best that cost no more than ``LEEWAY`` of its
        F measure the one a quarter above the lowest: a single odd pair in a large
        table does not decide.
        ``cell``: scores in cells, ``n`` pairs have each, of which ``hits`` have the defect.
        """
        if not hits.sum():
            return
        order = np.argsort(-cell, kind="stable")
        v, n, hits = cell[order] / CELLS, n[order], hits[order]
        hit = np.cumsum(hits)
        f1 = 2 * hit / (np.cumsum(n) + hit[-1])
        k = int(np.argmax(f1))
        worse = np.flatnonzero(f1 < f1[k] * (1 - LEEWAY))
        high = v[max([0, *(worse[worse < k] + 1)])]
        below = v[min([v.size - 1, *worse[worse > k]])]
        self.threshold[c] = below + (high - below) / 4
        self.unit[c] = max(v[np.searchsorted(hit, hit[-1] / 2)] - self.threshold[c], 1e-6)

    def weights(self) -> Classifier:
        """The classifier without what features are made with."""
        out = Classifier(None, None)
        out.w, out.dense, out.threshold, out.unit = self.w, self.dense, self.threshold, self.unit
        return out

    def margins(self, f: Rows) -> np.ndarray:
        """How far each pair lies above each defect's threshold."""
        return (f.scores(self.w, self.dense) - self.threshold) / self.unit

    def judge(self, f: Rows) -> np.ndarray:
        """Index of each pair's defect, -1 for none."""
        over = self.margins(f)
        best = over.argmax(1)
        return np.where(over[np.arange(len(best)), best] > 0, best, -1)


_LABELS = {"en": ("Question:", "You asked:"), "de": ("Frage:", "Sie fragen:"), "fr": ("Question :", "Vous demandez :"), "es": ("Pregunta:", "Preguntas:"), "si": ("ප්‍රශ්නය:", "ඔබ ඇසුවේ:")}
#: Invented sentences and parts of them.
_INVENTED = [*(t for ways in REFUSALS.values() for t in ways.split("|")), *(t for each in (FRAMES, CLOSES, _LABELS, NAMES) for ways in each.values() for t in ways)]


class Draws:
    """Numbers drawn at random for one pair: the same wherever the pair stands."""

    def __init__(self, seed: int):
        self.state = seed

    def _next(self) -> int:
        self.state = (self.state + 0x9E3779B97F4A7C15) & _M64
        z = (self.state ^ self.state >> 30) * 0xBF58476D1CE4E5B9 & _M64
        z = (z ^ z >> 27) * 0x94D049BB133111EB & _M64
        return z ^ z >> 31

    def random(self) -> float:
        return (self._next() >> 11) / (1 << 53)

    def integers(self, low: int, high: int) -> int:
        return low + (self._next() * (high - low) >> 64)


def _cut(text: str, rng: Draws) -> str | None:
    """Break a finished answer off inside a word, a sentence or a code block."""
    fence = text.rfind("```")
    if fence > 0 and text.count("```") % 2 == 0 and rng.random() < 0.7:
        return text[:fence].rstrip()
    words = text.split(" ")
    if len(words) < 12:
        return None
    k = int(rng.integers(len(words) // 3, len(words) - 1))
    kept = " ".join(words[:k])
    kind = rng.random()
    broken = kind < 0.55 and len(words[k]) > 3
    if broken:
        kept += " " + words[k][:2]
    elif kind < 0.75:
        kept = kept.rstrip(".,;:!?") + ","
    kept = kept.rstrip()
    if _end(kept)[3] and not (broken and words[k][0].islower()):
        return None  # looks like a finished item, as half of a name looks like one
    return None if kept[-1:] in ".!?" or kept.count("```") % 2 else kept


def _short(text: str, rng: Draws) -> str:
    """A short answer: the first sentence of a text or its first words."""
    first = _SENTENCE.split(text, maxsplit=1)[0].rstrip()
    if rng.random() < 0.5:
        return first
    return " ".join(first.split()[: int(rng.integers(1, 6))]).rstrip(".,;:!?") + "."


def _copied(q: str, lang: str, rng: Draws) -> str:
    kind = int(rng.integers(0, 7))
    words = q.split(" ")
    if kind == 1:
        return q.lower()
    if kind == 2:
        return f"**{q}**"
    if kind == 3:
        return _LABELS[lang][int(rng.integers(0, 2))] + " " + q
    if kind == 4 and len(words) > 5:
        del words[int(rng.integers(1, len(words) - 1))]
    if kind == 5 and len(words) > 5:
        words[int(rng.integers(1, len(words) - 1))] = words[int(rng.integers(1, len(words) - 1))]
    if kind == 6:
        return f'"{q}"'
    return " ".join(words)


def synthetic(pairs: Pairs, langs: np.ndarray, seeds: np.ndarray) -> tuple[Pairs, np.ndarray, np.ndarray]:
    """The pairs, each with one defect or (where that cannot be made) without, which of them changed, and their defect or -1.

    Pairs held out from the first fit refuse in ways the others do not.
    """
    n = len(pairs.answer)
    y = np.full(n, -1, np.int8)
    questions, answers = list(pairs.question), list(pairs.answer)
    empties = ["", " ", "\n", "...", "-", "?!", "—", "n/a", "N/A", "null", "none", "(blank)", "[no response]", "<empty>", "​", "　 "]
    by_lang = [np.flatnonzero(langs == j) for j in range(len(LANGS))]
    part = _part(seeds)
    for i in range(n):
        rng = Draws(int(seeds[i]))
        c = int(rng.integers(0, 2 * len(DEFECTS)))
        if c >= len(DEFECTS):
            if rng.random() < 0.1:
                answers[i] = _SENTENCE.split(answers[i], maxsplit=1)[0]
            continue
        q, lang = pairs.question[i], LANGS[langs[i]]
        made: str | None = None
        if c == 0:
            made = empties[int(rng.integers(0, len(empties)))]
            if rng.random() < 0.25:
                made = " ".join([made] * int(rng.integers(2, 12)))
        elif c == 1:
            made = _cut(answers[i], rng)
        elif c == 2:
            # the threshold is calibrated on ways to refuse that were not learned
            options = [o for k, o in enumerate(REFUSALS[lang].split("|")) if (k % 3 == 0) == (part[i] == 0)]
            w = q.rstrip("?.!").split()
            k = int(rng.integers(0, max(1, len(w) - 2)))
            made = options[int(rng.integers(0, len(options)))].replace("{}", " ".join(w[k : k + int(rng.integers(2, 5))]))
            if rng.random() < 0.3:
                made = FRAMES[lang][int(rng.integers(0, len(FRAMES[lang])))] + made
            if rng.random() < 0.4:
                made += CLOSES[lang][int(rng.integers(0, len(CLOSES[lang])))]
        elif c == 3:
            made = _copied(q, lang, rng)
        else:
            others = [k for j, k in enumerate(by_lang) if j != langs[i] and k.size]
            if others:
                k = others[int(rng.integers(0, len(others)))]
                k = k[int(rng.integers(0, k.size))]
                made = pairs.answer[k] if rng.random() < 0.7 else _short(pairs.answer[k], rng)
                if rng.random() < 0.4:  # asked for, and so no defect
                    at = int(rng.integers(0, 2)) * len(q)
                    questions[i] = f"{q[:at]} {NAMES[lang][langs[k]]}: {q[at:]}"
                    answers[i], made = made, None
        if made is not None:
            answers[i] = made
            y[i] = c
    changed = np.array([a is not b for a, b in zip(answers, pairs.answer)], bool)
    return Pairs(questions, answers), changed, y


def _select(pairs: Pairs, rows: np.ndarray) -> Pairs:
    return Pairs([pairs.question[i] for i in rows], [pairs.answer[i] for i in rows])


def _part(seeds: np.ndarray) -> np.ndarray:
    """Which of the HELD parts a pair belongs to; one is held out from each fit."""
    return (seeds % np.uint64(HELD)).astype(np.int8)


class Here:
    """Batches in this process, with the operations of :class:`Spread`."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.batches = batches

    def mapped(self, run: Callable, schema: str, name: str) -> Here:
        return Here(list(run(iter(self.batches))))

    def summed(self, run: Callable, schema: str, keys: list[str], many: str = "") -> pa.Table:
        out = list(run(iter(self.batches)))
        if not out:
            return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in schema.split(", ")})
        rest = [c for c in out[0].schema.names if c not in keys]
        t = pa.Table.from_batches(out).group_by(keys).aggregate([(c, "sum") for c in rest]).rename_columns(keys + rest)
        return t.filter(pc.field(many) > 1) if many else t

    def kept(self, run: Callable, schema: str, keys: list[str], name: str) -> Here:
        return Here(self.summed(run, schema, keys).combine_chunks().to_batches())

    def share(self, model: Classifier | None) -> SimpleNamespace:
        return SimpleNamespace(value=model)


class Spread:
    """Rows of a table."""

    def __init__(self, df: DataFrame):
        self.df = df

    def mapped(self, run: Callable, schema: str, name: str) -> Spread:
        """What ``run`` makes of the rows, as a table that is kept."""
        return Spread(written(self.df.mapInArrow(run, schema), name))

    def _summed(self, run: Callable, schema: str, keys: list[str]) -> DataFrame:
        out = self.df.mapInArrow(run, schema)
        return out.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in out.columns if c not in keys))

    def summed(self, run: Callable, schema: str, keys: list[str], many: str = "") -> pa.Table:
        """The sums of the other columns by ``keys``; those over 1 where ``many`` names one."""
        out = self._summed(run, schema, keys)
        return (out.filter(F.col(many) > 1) if many else out).toArrow()

    def kept(self, run: Callable, schema: str, keys: list[str], name: str) -> Spread:
        """The same, as a table that is kept."""
        return Spread(written(self._summed(run, schema, keys), name))

    def share(self, model: Classifier | None):
        return self.df.sparkSession.sparkContext.broadcast(model)


def _unified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dialogues in one consistent spelling, labels as places in LANGS (-1: none of them)."""
    for batch in batches:
        off, content, role = K.messages(batch.column("messages"))
        lang = [LANGS.index(x) if x in LANGS else -1 for x in batch.column("lang").to_pylist()]
        texts = pa.array(unify_all(K.strings(content))[0], pa.string())
        turns = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.StructArray.from_arrays([texts, role.cast(pa.string())], ["content", "role"]))
        yield pa.RecordBatch.from_arrays([batch.column("record_id").cast(pa.int64()), pa.array(lang, pa.int32()), turns], ["record_id", "lang", "messages"])


class Counted:
    """Words by label, how often they stand there and how many of them are not the last of their text."""

    def __init__(self):
        self.words: dict[int, str] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, block: K.Block, h: np.ndarray, s: np.ndarray, e: np.ndarray, woff: np.ndarray, labels: np.ndarray) -> None:
        """Words of a block whose texts have these labels."""
        if not h.size:
            return
        inner = np.ones(h.size, np.int64)
        inner[woff[1:][np.diff(woff) > 0] - 1] = 0
        u, at = self._places(h)
        first = np.zeros(u.size, np.int64)
        first[at[::-1]] = np.arange(h.size - 1, -1, -1)
        for k, a, b in zip(u.tolist(), s[first].tolist(), e[first].tolist()):
            if k not in self.words:
                self.words[k] = block.joined[a:b].lower()
        self.parts.append(self._summed(u, at, np.repeat(labels, np.diff(woff)), np.ones(h.size), inner))

    @staticmethod
    def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different hashes, and the place of each hash among them."""
        coded = pa.array(h.view(np.int64)).dictionary_encode()
        return coded.dictionary.to_numpy().view(np.uint64), coded.indices.to_numpy()

    @staticmethod
    def _summed(u: np.ndarray, at: np.ndarray, labels: np.ndarray, n: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        key = at * np.int64(len(LANGS) + 1) + labels + 1
        n, inner = (np.bincount(key, x).astype(np.int64) for x in (n, inner))
        has = np.flatnonzero(n)
        return u[has // (len(LANGS) + 1)], has % (len(LANGS) + 1) - 1, n[has], inner[has]

    def table(self) -> pa.RecordBatch | None:
        if not self.parts:
            return None
        h, *rest = (np.concatenate(x) for x in zip(*self.parts))
        h, labels, n, inner = self._summed(*self._places(h), *rest)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(labels, pa.int32()), pa.array([self.words[k] for k in h.tolist()], pa.string()), pa.array(n), pa.array(inner)], ["hash", "lang", "word", "n", "inner"])


def _labelled(batch: pa.RecordBatch) -> Iterator[tuple[K.Block, np.ndarray]]:
    """Blocks of a batch's texts, with the labels of their dialogues."""
    off, content, _ = K.messages(batch.column("messages"))
    texts, lang = K.strings(content), np.repeat(np.asarray(batch.column("lang")).astype(np.int64), np.diff(off))
    for lo, hi in K.blocks(np.fromiter(map(len, texts), np.int64, len(texts))):
        yield K.Block(texts[lo:hi]), lang[lo:hi]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by label with their number, and how many are not the last of their text; each once a batch."""
    for batch in batches:
        seen = Counted()
        for block, labels in _labelled(batch):
            seen.add(block, *block.words(), labels)
        if (out := seen.table()) is not None:
            yield out


def _strays(model) -> Callable:
    """Symbols of words in their contexts, by label, of texts that the model finds in another language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counted()
            for block, labels in _labelled(batch):
                h, s, e, woff = block.words()
                bits = K.totals(model.value.langs.of_words(h, s, e, block.joined).astype(np.float64), woff)
                stray = (labels >= 0) & (bits.argmin(1) != labels)
                at = np.flatnonzero(np.repeat(stray, np.diff(woff)))
                seen.add(block, h[at], s[at], e[at], np.concatenate(([0], np.cumsum(np.diff(woff)[stray]))), labels[stray])
            if (out := seen.table()) is not None:
                yield from _symbols(iter([out]))

    return run


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols of words in their contexts, by language."""
    for batch in batches:
        langs, words, n = np.asarray(batch.column("lang")), batch.column("word").to_pylist(), np.asarray(batch.column("n"))
        for j in np.unique(langs[langs >= 0]).tolist():
            at = np.flatnonzero(langs == j)
            key, count = symbols([words[i] for i in at], n[at].astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(key.size, j, np.int32)), pa.array(key.view(np.int64)), pa.array(count.astype(np.int64))], ["lang", "key", "n"])


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("inner")], ["hash", "inner"])


def _trees(counted: pa.Table, less: pa.Table | None = None) -> LanguageModel:
    """Language trees from symbols by language, without those of ``less``, and from the invented refusals."""
    said = [(w.lower(), lang) for lang, ways in REFUSALS.items() for t in ways.replace("{}", "").split("|") for w in _words_of(t)]
    own = pa.RecordBatch.from_arrays([pa.array([LANGS.index(lang) for _, lang in said], pa.int32()), pa.array([w for w, _ in said]), pa.array(np.ones(len(said), np.int64))], ["lang", "word", "n"])

    def by_lang(t: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
        lang, key, n = (t.column(c).to_numpy() for c in ("lang", "key", "n"))
        return [(key[lang == j].view(np.uint64), n[lang == j]) for j in range(len(LANGS))]

    out = []
    for j, (key, n) in enumerate(by_lang(counted)):
        order = np.argsort(key)
        key, n = key[order], n[order]
        if less is not None:
            gone, times = by_lang(less)[j]
            n[np.searchsorted(key, gone)] -= times
            key, n = key[n > 0], n[n > 0]
        out.append((key, n, j))
    out += [(*x, j) for j, x in enumerate(by_lang(Here([own]).summed(_symbols, "", ["lang", "key"])))]
    return LanguageModel.of_symbols([x for x in out if x[0].size])


def _words_of(text: str) -> list[str]:
    block = K.Block([text])
    return [block.joined[a:b] for a, b in zip(*(x.tolist() for x in block.spans()))]


_ROW = "record_id long, turn int, part tinyint, invented boolean, stays boolean, defect tinyint, grams binary, pairs_of binary, end int, line_end int, dense binary"


def _features(model) -> Callable:
    """Features of all pairs as they are and, of finished ones, with an invented defect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ROW.split(", ")]
        for batch in batches:
            for rec, turn, pairs in _blocks_of(batch, unified=True):
                seeds = K.mix(K.mix(np.asarray(rec.fill_null(0)).view(np.uint64)) + turn.astype(np.uint64))
                f = Features(pairs, model.value.langs, model.value.known)
                fine = np.flatnonzero(f.fine)
                made, changed, y = synthetic(_select(pairs, fine), f.own[fine], seeds[fine])
                stays = f.fine.copy()
                stays[fine[changed]] = False
                new = fine[changed]
                todo = [(f, np.arange(len(rec)), False, stays, np.full(len(rec), -1, np.int8))]
                if new.size:
                    todo.append((Features(_select(made, np.flatnonzero(changed)), model.value.langs, model.value.known), new, True, np.zeros(new.size, bool), y[changed]))
                for g, at, invented, same, label in todo:
                    head = [rec.take(pa.array(at)), turn[at].astype(np.int32), _part(seeds[at]), np.full(at.size, invented), same, label]
                    yield pa.RecordBatch.from_arrays([head[0], *map(pa.array, head[1:]), *g.columns()], names)

    return run


def _blocks_of(batch: pa.RecordBatch, unified: bool) -> Iterator[tuple[pa.Array, np.ndarray, Pairs]]:
    """Record, turn and texts of the pairs of a user's and an assistant's turn."""
    off, content, role = K.messages(batch.column("messages"))
    user, assistant = (pc.fill_null(pc.equal(role, x), False).to_numpy(zero_copy_only=False) for x in ("user", "assistant"))
    rec = np.repeat(np.arange(len(off) - 1), np.diff(off))
    at = np.flatnonzero(assistant[1:] & user[:-1] & (rec[1:] == rec[:-1])) + 1
    if not at.size:
        return
    texts = K.strings(content) if unified else unify_all(K.strings(content))[0]
    ids = batch.column("record_id").cast(pa.int64())
    lens = np.array([len(texts[i]) + len(texts[i - 1]) for i in at], np.int64)
    for lo, hi in K.blocks(lens):
        part = at[lo:hi]
        yield ids.take(pa.array(rec[part])), part - off[rec[part]], Pairs([texts[i - 1] for i in part], [texts[i] for i in part])


def _cases(batch: pa.RecordBatch, first: Classifier | None, held: bool) -> tuple[Rows, np.ndarray, np.ndarray]:
    """All pairs, with a column per defect, and places of those of a fit that are held out from it, or are not.

    The first fit takes the finished pairs; the second (with the ``first``) all
    pairs without an invented defect as far as the first is sure of them.
    """
    rows = Rows.of(batch)
    invented, label, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("invented", "defect", "part"))
    y = (label[:, None] == np.arange(len(DEFECTS))).astype(np.float64)
    here = (part == (first is not None)) == held
    if first is None:
        return rows, y, np.flatnonzero(here & (invented | batch.column("stays").to_numpy(zero_copy_only=False)))
    asked = np.flatnonzero(here & (label < 0))
    s = rows.take(asked).scores(first.w, first.dense)
    over = (s - first.threshold) / first.unit
    refusal = DEFECTS.index("refusal")
    refused = (over.argmax(1) == refusal) & (over[:, refusal] > 0)
    sound = (over.max(1) <= 0) & (s.max(1) < 0)
    y[asked[refused], refusal] = 1
    here[asked] = refused | sound
    return rows, y, np.flatnonzero(here)


def _tally(first) -> Callable:
    """How many training pairs have each defect; at -1, how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(DEFECTS) + 1, np.int64)
        for batch in batches:
            if batch.num_rows:
                _, y, at = _cases(batch, first.value, held=False)
                n += np.append(y[at].sum(0), at.size).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(DEFECTS)), -1], pa.int32()), pa.array(n)], ["defect", "n"])

    return run


def _joined(parts: list[tuple[Rows, np.ndarray]]) -> tuple[Rows, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    rows = [r for r, _ in parts]

    def hashed(each: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([v for v, _ in each]), np.concatenate(([0], np.cumsum(np.concatenate([np.diff(o) for _, o in each]))))

    return (
        Rows(hashed([r.grams for r in rows]), hashed([r.pairs_of for r in rows]), [np.concatenate(e) for e in zip(*(r.ends for r in rows))], np.concatenate([r.dense for r in rows])),
        np.concatenate([y for _, y in parts]),
    )


def _steps(batches: Iterator[pa.RecordBatch], first: Classifier | None) -> Iterator[tuple[Rows, np.ndarray]]:
    """Training pairs in lots of BATCH; the last may be smaller."""
    wait: list[tuple[Rows, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, y, at = _cases(batch, first, held=False)
        while at.size:
            take = BATCH - sum(len(y) for _, y in wait)
            wait.append((rows.take(at[:take]), y[at[:take]]))
            at = at[take:]
            if sum(len(y) for _, y in wait) == BATCH:
                yield _joined(wait)
                wait = []
    if wait:
        yield _joined(wait)


def _round(model, first, share: np.ndarray, steps: int) -> Callable:
    """Weights after the task's pairs, times their number; of several defects, each weighs half of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params = [model.value.w.copy(), model.value.dense.copy()]
        state = [tuple(np.zeros_like(p) for _ in range(4)) for p in params]
        t = pairs = 0

        def step(f: Rows, y: np.ndarray, full: int) -> None:
            """Adam; what counts is the mean of the weights, later ones more."""
            nonlocal t
            t += 1
            weight = 0.5 / np.maximum(share, 0.01) * y + 0.5 / np.maximum(1 - share, 0.01) * (1 - y)
            p = 1 / (1 + np.exp(-np.clip(f.scores(*params), -30, 30)))
            for param, grad, pull, (m, v, mean, x) in zip(params, f.gradient((p - y) * weight / full), (PULL, DENSE_PULL), state):
                # in place and part by part: the arrays' way to the processor costs more than the sums
                for lo in range(0, len(param), 2048):
                    moved(*(a[lo : lo + 2048] for a in (param, grad, m, v, mean, x)), pull)

        def moved(param, grad, m, v, mean, x, pull) -> None:
            grad += np.multiply(param, pull, out=x)
            m *= 0.9
            m += np.multiply(grad, 0.1, out=x)
            v *= 0.99
            np.multiply(grad, grad, out=grad)
            v += np.multiply(grad, 0.01, out=grad)
            np.sqrt(np.divide(v, 1 - 0.99**t, out=grad), out=grad)
            grad += 1e-8
            param -= np.divide(np.multiply(m, 0.1 / (1 - 0.9**t), out=x), grad, out=x)
            mean += np.multiply(np.subtract(param, mean, out=x), 4 / (t + 3), out=x)

        kept: list[tuple[Rows, np.ndarray]] = []
        for f, y in _steps(batches, first.value):
            step(f, y, BATCH if t else len(y))
            pairs += len(y)
            if t < steps:
                kept.append((f, y))
            else:
                kept = []
        while 0 < t < steps:
            for f, y in kept:
                step(f, y, BATCH if len(kept) > 1 else len(y))
        if t:
            flat = np.concatenate([mean.ravel() for _, _, mean, _ in state]) * pairs
            at = np.append(np.flatnonzero(flat), flat.size)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.append(flat, pairs)[at])], ["place", "value"])

    return run


def _scored(model, first) -> Callable:
    """How many held-out pairs have a score, and how many of them the defect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, hits = (np.zeros((len(DEFECTS), 2 * LIMIT * CELLS + 1), np.int64) for _ in range(2))
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, y, at = _cases(batch, first.value, held=True)
            s = rows.take(at).scores(model.value.w, model.value.dense)
            cells = np.floor(np.clip(s, -LIMIT, LIMIT) * CELLS).astype(np.int64) + LIMIT * CELLS
            for c in range(len(DEFECTS)):
                n[c] += np.bincount(cells[:, c], minlength=n.shape[1])
                hits[c] += np.bincount(cells[y[at, c] > 0, c], minlength=n.shape[1])
        for c in range(len(DEFECTS)):
            cell = np.flatnonzero(n[c])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(cell.size, c, np.int32)), pa.array((cell - LIMIT * CELLS).astype(np.int32)), pa.array(n[c, cell]), pa.array(hits[c, cell])], ["defect", "cell", "n", "hits"])

    return run


def _fit(rows: Here | Spread, model: Classifier, first: Classifier | None, steps: int, rounds: int) -> Classifier | None:
    """The model with weights and thresholds of a fit from its present weights; None if there are too few pairs."""
    seen = rows.share(first)
    tally = rows.summed(_tally(seen), "defect int, n long", ["defect"])
    n = dict(zip(tally.column("defect").to_pylist(), tally.column("n").to_pylist()))
    if n.get(-1, 0) < 15:
        return None
    share = np.array([n[c] for c in range(len(DEFECTS))]) / n[-1]
    out = Classifier(model.langs, model.known)
    out.w, out.dense = model.w, model.dense
    for _ in range(rounds):
        t = rows.summed(_round(rows.share(out.weights()), seen, share, steps), "place int, value double", ["place"])
        flat = np.zeros(out.w.size + out.dense.size + 1)
        flat[t.column("place").to_numpy()] = t.column("value").to_numpy()
        flat /= flat[-1]
        out.w, out.dense = flat[: out.w.size].reshape(out.w.shape), flat[out.w.size : -1].reshape(out.dense.shape)
    t = rows.summed(_scored(rows.share(out.weights()), seen), "defect int, cell int, n long, hits long", ["defect", "cell"])
    defect, cell, n, hits = (t.column(c).to_numpy() for c in ("defect", "cell", "n", "hits"))
    for c in range(len(DEFECTS)):
        out.calibrate(cell[defect == c], n[defect == c], hits[defect == c], c)
    return out


def _train(dialogues: Here | Spread) -> tuple[Classifier, Here | Spread]:
    """The classifier and the features of all pairs; of unified dialogues."""
    count = "hash long, lang int, word string, n long, inner long"
    words = dialogues.kept(_words, count, ["hash", "lang", "word"], "words")
    # words that stand before the last of a text, as broken ones do not; invented sentences hold no rare words
    known = words.summed(_inner, "hash long, inner long", ["hash"], many="inner").column("hash").to_numpy().astype(np.int64).view(np.uint64)
    symbol = "lang int, key long, n long"
    counted = words.summed(_symbols, symbol, ["lang", "key"])
    model = Classifier(_trees(counted), np.union1d(known, K.Block(_INVENTED).words()[0]))
    # labels may be wrong
    model.langs = _trees(counted, dialogues.summed(_strays(dialogues.share(model)), symbol, ["lang", "key"]))
    rows = dialogues.mapped(_features(dialogues.share(model)), _ROW, "pairs")
    first = _fit(rows, model, None, STEPS[0], ROUNDS[0])
    if first is None:
        return model, rows
    return _fit(rows, first, first.weights(), STEPS[1], ROUNDS[1]) or first, rows


def train(labelled: list[tuple[str | None, list[tuple[str | None, str | None]]]]) -> Classifier:
    """Fit on dialogues given as (label, [(role, content), ...])."""
    turns = pa.array([[{"content": t, "role": r} for r, t in turns] for _, turns in labelled], pa.list_(pa.struct([("content", pa.string()), ("role", pa.string())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(labelled)), pa.int64()), pa.array([lang for lang, _ in labelled], pa.string()), turns], ["record_id", "lang", "messages"])
    return _train(Here(list(_unified(iter([batch])))))[0]


def train_on(dialogues: DataFrame) -> tuple[Classifier, DataFrame]:
    """Fit on all dialogues; also the features of all pairs."""
    dealt = dialogues.select("record_id", label_of(F.col("lang")).alias("lang"), "messages").mapInArrow(_unified, "record_id long, lang int, messages array<struct<content string, role string>>")
    # dealt out by a hash: every task gets dialogues of all kinds, the same whatever the files
    place = F.xxhash64("record_id")
    model, rows = _train(Spread(written(dealt.repartition("record_id").sortWithinPartitions(place, "record_id"), "unified")))
    return model, rows.df


def defects(dialogues: DataFrame, model: Classifier | None = None) -> DataFrame:
    """(record_id, turn, defect) of defective assistant turns directly after a user turn.

    Null contents count as empty; null elements have no role and make no pair;
    no turn has two defects; repeated rows are judged each.
    """
    held = dialogues.sparkSession.sparkContext.broadcast  # see Classifier

    def found(rec: pa.Array, turn: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        hit = np.flatnonzero(c >= 0)
        return pa.RecordBatch.from_arrays([rec.take(pa.array(hit)), pa.array(turn[hit], pa.int32()), pa.array([DEFECTS[k] for k in c[hit]], pa.string())], ["record_id", "turn", "defect"])

    schema = "record_id long, turn int, defect string"
    if model is None:
        model, rows = train_on(dialogues)
        fitted = held(model.weights())

        def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield found(batch.column("record_id"), np.asarray(batch.column("turn")), fitted.value.judge(Rows.of(batch)))

        return rows.filter("not invented").mapInArrow(stored, schema)
    given = held(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rec, turn, pairs in _blocks_of(batch, unified=False):
                yield found(rec, turn, given.value.judge(Features(pairs, given.value.langs, given.value.known)))

    return dialogues.select("record_id", "messages").mapInArrow(run, schema)
