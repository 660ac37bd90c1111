"""Problem 3: visually identical text written with different characters.

Each token's characters are resolved to the sets of scripts they may belong to
(a character of several scripts, or of none in particular, fits all).  If the
intersection over the token is empty the token mixes scripts; if all its
letters have look-alikes in another script it is a whole-script confusable.  In
both cases the spelling in one script is selected: of a mixed token the script
of the letters that have no look-alike, of a confusable one the script of the
nearest tokens that are no confusables themselves, and Latin where they do not
agree on another.  So one text has one form however it was typed, and plain
Russian or Greek stays as it is.  What remains - wide forms,
ligatures, separated marks, hidden characters, unusual spaces and look-alike
punctuation - is normalised character by character.

An array pass over the code points finds the turns that hold any character
this could concern; only those are looked at token by token.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

# Letters of other scripts and styles, and the plain letter each looks like.
CYRILLIC = dict(zip("аеорсухѕіјһԁԛԝѵүӏєАВЕКМНОРСТХЅІЈԚԜҮӀУ", "aeopcyxsijhdqwvylcABEKMHOPCTXSIJQWYIY"))
CYRILLIC.pop("є")
GREEK = dict(zip("ονανιρυχγκΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϳ", "ovavipuxykABEZHIKMNOPTYXcj"))
ARMENIAN = dict(zip("օհոսցզՕՍՏԼ", "ohnugqOUSL"))
CHEROKEE = dict(zip("ᎠᎡᎢᎪᎫᎳᎷᎻᏒᎬᏀᏃᏙᏚᏞᏟᏢᏦᏴ", "DRTAJWMHREGZVSLCPKB"))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
COPTIC = dict(zip("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥⲭ", "BHIKMNOPCTYXopcx"))
STYLE = dict(zip("ɑɡɩʋᴄᴏᴠᴡᴢꜱᴜıȷ", "agivcovwzsuij"))
CYRILLIC["ѡ"] = "w"
LETTERS = CYRILLIC | GREEK | ARMENIAN | CHEROKEE | {c.lower(): x.lower() for c, x in CHEROKEE.items()} | LISU | COPTIC | STYLE
#: Plain letters that have a look-alike.
_ALIKE = frozenset(LETTERS.values())
# Punctuation and the plain sign it looks like.
SIGNS = dict(zip("‐‑˗⁃−﹣۔․٠۰꞉∶ː˸։׃፡;⁄∕⧸∖⁎∗ǃ∣ǀ٫ꓸꓹ٪", "------....:::::::;///\\**!||,.,%"))
#: Looks like a comma where a comma would stand; elsewhere a quotation mark.
LOW_QUOTE = "‚"
HAL = "්"
SINHALA_LETTER = re.compile("[අ-ෆ]")
WIDE_CONTEXT = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Bopomofo}、-〿]")
EMOJI = regex.compile(r"[\p{Extended_Pictographic}\p{Emoji_Modifier}️\U0001F1E6-\U0001F1FF⃣]")
#: Characters that show nothing although they are not of category Cf.
BLANKS = "͏ᅟᅠ឴឵᠋᠌᠍᠎ㅤﾠ⠀"

_SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee", "Lisu", "Coptic", "Sinhala")
_SCRIPT_RE = {s: regex.compile(rf"\p{{Script={s}}}") for s in _SCRIPTS}
_CONFUSABLE = frozenset(_SCRIPTS) - {"Latin", "Sinhala"}
#: A letter with a look-alike in plain letters, or of a script that has such letters.
_ODD = regex.compile("[" + "".join(map(re.escape, LETTERS)) + "".join(rf"\p{{Script={s}}}" for s in sorted(_CONFUSABLE)) + "]")
_TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}]*")


@lru_cache(maxsize=1 << 16)
def scripts(ch: str) -> frozenset[str]:
    """The scripts a character may belong to; all of them for common characters."""
    if unicodedata.category(ch)[0] != "L":
        return frozenset(_SCRIPTS) | {"other"}
    found = {s for s, p in _SCRIPT_RE.items() if p.match(ch)}
    return frozenset(found or {"other"})


@lru_cache(maxsize=1 << 16)
def plain_form(ch: str) -> str | None:
    """The plain spelling of a wide form, ligature, styled letter or the like; None if it has none."""
    c = ord(ch)
    if c < 0xA0:
        return None
    tag = unicodedata.decomposition(ch)
    if not tag:
        return None
    if not tag.startswith("<"):  # a singleton such as the Kelvin sign
        nfc = unicodedata.normalize("NFC", ch)
        return nfc if nfc != ch else None
    kind = tag[1 : tag.index(">")]
    if kind in ("wide", "font", "small") or (kind == "compat" and (0xFB00 <= c <= 0xFB06 or 0x2160 <= c <= 0x217F or 0x1C4 <= c <= 0x1CC or 0x1F1 <= c <= 0x1F3 or 0x132 <= c <= 0x133)):
        return unicodedata.normalize("NFKC", ch)
    return None


def _hidden(ch: str) -> bool:
    c = ord(ch)
    return unicodedata.category(ch) == "Cf" or ch in BLANKS or 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF


def _needed(text: str, i: int) -> bool:
    """Is the hidden character at i required by Sinhala spelling or inside an emoji?"""
    ch = text[i]
    prev, nxt = text[i - 1] if i else "", text[i + 1] if i + 1 < len(text) else ""
    if ch == "‍":
        if prev == HAL and SINHALA_LETTER.match(nxt) or SINHALA_LETTER.match(prev) and nxt == HAL:
            return True
        return bool(EMOJI.match(prev) and EMOJI.match(nxt)) and not prev.isdigit()
    if 0xFE00 <= ord(ch) <= 0xFE0F:
        return bool(prev) and (bool(EMOJI.match(prev)) or unicodedata.category(prev)[0] in "SN")
    if 0xE0020 <= ord(ch) <= 0xE007F:
        return bool(prev) and (bool(EMOJI.match(prev)) or 0xE0020 <= ord(prev) <= 0xE007F)
    return False


@lru_cache(maxsize=None)
def _spelling(script: str) -> dict[str, str]:
    """The letter of a script for each plain letter that has a look-alike there; the first of several."""
    out: dict[str, str] = {}
    for ch, plain in LETTERS.items():
        if scripts(ch) == {script}:
            out.setdefault(plain, ch)
    return out


@lru_cache(maxsize=1 << 16)
def _spell(token: str) -> tuple[str, bool]:
    """A token in one script, and whether it mixed scripts or styles; confusable tokens are left."""
    shared: frozenset[str] | None = None
    alike = 0
    for ch in token:
        s = scripts(ch)
        shared = s if shared is None else shared & s
        alike += ch in LETTERS
    if not alike and (shared or not any(ch in _ALIKE for ch in token)):
        return token, False
    letters = [ch for ch in token if unicodedata.category(ch)[0] == "L"]
    plain = "".join(LETTERS.get(ch, ch) for ch in token)
    if shared:
        if "Latin" in shared:  # one script; a style letter among plain ones?
            styled = [ch for ch in letters if ch in STYLE]
            if 0 < len(styled) < len(letters) and any(ch.isascii() for ch in letters):
                return plain, True
        return token, False
    target = [ch for ch in letters if ch not in LETTERS and ch not in _ALIKE]
    kinds = {k for ch in target for k in scripts(ch)}
    if not kinds or kinds == {"Latin"}:
        return plain, True
    if len(kinds) == 1:  # plain letters strayed into a word of another script
        (kind,) = kinds
        other = "".join(ch if kind in scripts(ch) else _spelling(kind).get(LETTERS.get(ch, ch), ch) for ch in token)
        if other != token and all(kind in scripts(ch) for ch in other):
            return other, True
    return token, alike > 0


@lru_cache(maxsize=1 << 16)
def _settled(token: str) -> str | None:
    """The script of a token's letters without look-alike, if such a letter settles it."""
    found = (scripts(ch) for ch in token if ch not in LETTERS and not ch.isascii())
    return next((next(iter(s)) for s in found if len(s) == 1 and not s & {"Latin", "other"}), None)


@lru_cache(maxsize=1 << 16)
def _plain(token: str) -> str:
    return "".join(LETTERS.get(ch, ch) for ch in token)


def _consistent(text: str) -> str:
    """The text with confusable tokens in the script of the tokens around them."""
    if not _ODD.search(text):
        return text
    tokens = [(m.start(), m.group()) for m in _TOKEN.finditer(text)]
    settled = [_settled(t) for _, t in tokens]
    there = {s for s in settled if s}
    plain = [_plain(t) for _, t in tokens]
    kind: list[str | None] = []
    for (_, token), s, p in zip(tokens, settled, plain):
        if s:
            kind.append(s)
        elif p == token:  # without other scripts around, or letters they lack, it is what it is
            kind.append(None if any(all(ch in _spelling(x) for ch in p) for x in there) else "Latin")
        else:
            kind.append(None if all(ch in LETTERS for ch in token if unicodedata.category(ch)[0] == "L") else "")
    after: list[str | None] = []
    near: str | None = None
    for k in reversed(kind):
        after.append(near)
        near = near if k is None else k
    out, at, before = [], 0, None
    for (start, token), k, p, behind in zip(tokens, kind, plain, reversed(after)):
        if k is not None:
            before = k
            continue
        around = {s for s in (before, behind) if s is not None}
        script = around.pop() if len(around) == 1 else "Latin"
        spelt = p
        if script in there and all(ch in _spelling(script) for ch in p):
            # letters of the script that share a look-alike stay as they are
            spelt = "".join(ch if script in scripts(ch) else _spelling(script)[x] for ch, x in zip(token, p))
        if spelt != token:
            out += [text[at:start], spelt]
            at = start + len(token)
    return "".join(out) + text[at:]


@lru_cache(maxsize=1 << 16)
def _stands(ch: str) -> bool:
    """Does a character stay as it is wherever it stands?"""
    return not (_hidden(ch) or unicodedata.category(ch) == "Zs" or ch in SIGNS or ch == LOW_QUOTE or plain_form(ch) is not None)


def unify(text: str) -> tuple[str, bool]:
    """The consistent form of a text, and whether it held a character to be replaced."""
    out: list[str] = []
    bad = False
    done = 0
    for i, ch in enumerate(text):
        if ch < " " or _stands(ch):
            continue
        out.append(text[done:i])
        done = i + 1
        if _hidden(ch):
            if _needed(text, i):
                out.append(ch)
            else:
                bad = True
            continue
        if unicodedata.category(ch) == "Zs":
            out.append(" ")
            bad = True
            continue
        plain = SIGNS.get(ch)
        if plain is None and ch == LOW_QUOTE and i and not text[i - 1].isspace() and unicodedata.category(text[i - 1]) not in ("Ps", "Pi"):
            plain = ","
        if plain is None:
            plain = plain_form(ch)
            if plain is not None and unicodedata.category(ch)[0] in "PS" and unicodedata.decomposition(ch).startswith("<wide>"):
                near = text[max(0, i - 1) : i] + text[i + 1 : i + 2]
                if WIDE_CONTEXT.search(near):
                    plain = None
        if plain is not None:
            bad = True
            out.append(plain)
        else:
            out.append(ch)
    joined = "".join(out) + text[done:]
    composed = unicodedata.normalize("NFC", joined)
    bad |= composed != joined

    def one(m) -> str:
        nonlocal bad
        spelt, mixed = _spell(m.group())
        bad |= mixed
        return spelt

    return _consistent(_TOKEN.sub(one, composed)), bad


@lru_cache(maxsize=1)
def _joining() -> frozenset[int]:
    """Code points that may form one character with what stands before them (normal form C not certain)."""
    out = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for c in range(0xA0, 0x20000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            out.add(int(parts[1], 16))
    return frozenset(out)


SUSPECT = 1


def _suspect_of(c: int) -> int:
    ch = chr(c)
    if c < 0xA0 or 0xD800 <= c < 0xE000:
        return 0
    cat = unicodedata.category(ch)
    odd = (
        _hidden(ch) and c != 0x200D
        or cat == "Zs"
        or ch in SIGNS
        or ch == LOW_QUOTE
        or ch in LETTERS
        or cat[0] == "L" and scripts(ch) <= _CONFUSABLE
        or plain_form(ch) is not None
        or cat[0] == "M" and not 0xD80 <= c <= 0xDFF and unicodedata.combining(ch) != 0
        or c in _joining() and not 0xD80 <= c <= 0xDFF
        or not unicodedata.is_normalized("NFC", ch)
        or cat[0] == "M" and 0x300 <= c < 0x370
    )
    return SUSPECT if odd else 0


def suspects(block: K.Block) -> np.ndarray:
    """Which texts hold a character that may have to be replaced (never misses one)."""
    cp = block.cp
    flag = K.table("suspect", _suspect_of, np.uint8)(cp) > 0
    joiner = np.flatnonzero(cp == 0x200D)
    prev, nxt = cp[joiner - 1], cp[np.minimum(joiner + 1, cp.size - 1)]
    fine = (joiner > 0) & (prev == 0x0DCA) & (nxt >= 0x0D85) & (nxt <= 0x0DC6)
    flag[joiner[~fine]] = True
    tail = np.flatnonzero((cp == 0x0DCA) | (cp == 0x0DCF) | (cp == 0x0DDF))
    prev = cp[np.maximum(tail - 1, 0)]
    flag[tail[(prev == 0x0DD9) | (prev == 0x0DDC)]] = True
    hit = np.zeros(len(block.texts), bool)
    at = np.flatnonzero(flag)
    hit[np.searchsorted(block.end, at)] = True
    return hit


def unify_all(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """:func:`unify` of each text; texts without a suspect character are left as they are."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    out, bad = list(texts), np.zeros(len(texts), bool)
    for lo, hi in K.blocks(lens):
        for i in np.flatnonzero(suspects(K.Block(texts[lo:hi]))) + lo:
            out[i], bad[i] = unify(texts[i])
    return out, bad


def unify_turns(df: DataFrame, messages: str = "messages", id_col: str = "record_id", only_affected: bool = False) -> DataFrame:
    """One row per turn: its content in the consistent form and whether it had to be changed.

    Null elements and null contents give a null ``unified`` and are not
    affected; null or empty message lists give no rows; repeated rows are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, content, _ = K.messages(batch.column(1))
            texts = K.strings(content)
            out, bad = unify_all(texts)
            ids = np.repeat(np.asarray(batch.column(0)), np.diff(off))
            turn = np.arange(off[-1]) - np.repeat(off[:-1], np.diff(off))
            null = np.asarray(content.is_null())
            keep = np.flatnonzero(bad) if only_affected else np.arange(len(out))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[keep], pa.int64()),
                    pa.array(turn[keep], pa.int32()),
                    pa.array([None if null[i] else out[i] for i in keep], pa.string()),
                    pa.array(bad[keep]),
                ],
                ["record_id", "turn", "unified", "affected"],
            )

    schema = "record_id long, turn int, unified string, affected boolean"
    return df.select(F.col(id_col).alias("record_id"), F.col(messages).alias("messages")).mapInArrow(run, schema)
