"""Problem 10: personal information inside free text.

One Arrow pass proposes values: stretches that have the form of an email
address, a phone number, an identity number or a street address, and pairs of
capitalised words that could be a person's name.  What the corpus shows about
them decides.

Forms: a value's term is its form (digits and letters masked) or, of an
address, the word for its kind of street.  The words before and after a value
are its contexts.  A context tells log2(P(context | kind) / P(context | other
numbers)) bits, estimated over all documents without the term's own
occurrences; a term starts with ``PRIOR`` bits for having a known form, and is
disclosing if what its occurrences' contexts tell leaves it above 0.  So the
form of an order number that looks like a phone number is dropped where it
stands in the contexts of order numbers.

Names: a pair of a listed given and a listed family name is a protected entity;
the word after it is a context that reveals entities if it follows them more
often than chance; and a term is disclosing if, over all documents, the share
of its pairs whose other half is a listed name in such a context exceeds
``DISCLOSURE`` - at least log2(DISCLOSURE / base rate) bits more than a random
pair tells.  Listed and disclosing terms in the right places make a name.

Disclosing values are generalised to a placeholder of their kind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import written

#: Share of a term's pairs that must reveal an entity.
DISCLOSURE = 0.5
#: Bits by which a context must raise the chance of an entity.
CONTEXT_BITS = 0.0
#: Bits a value has for its form before its contexts are heard.
PRIOR = 8.0
#: Terms of one sort that every worker may hold; beyond it they are joined.
BROADCAST_TERMS = 200_000
#: Times the disclosing terms are added to the known ones and the rest is judged anew.
ROUNDS = 2

_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|punkt|punto|point)\s?[\])}]\s?)"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_HOST = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,}}", re.IGNORECASE)
_SPOKEN_HOST = re.compile(rf"{_LABEL}(?:\s(?:dot|punto|punkt|point)\s{_LABEL})+\b", re.IGNORECASE)
_AT_SIGN = re.compile(r"@|[\[({]\s?(?:at|ät|arroba)\s?[\])}]\s?", re.IGNORECASE)
_SPOKEN_AT = re.compile(r"\s(?:at|arroba)\s(?=[\w-]+\s(?:dot|punto|punkt|point)\s)", re.IGNORECASE)
_S = r"[   ]"
PHONE = re.compile(
    rf"(?<![\w+])("
    rf"\+\d{{1,3}}(?:{_S}?\(0\))?(?:[-./   ]?\(?\d{{1,5}}\)?){{2,7}}"
    rf"|\(0?\d{{2,4}}\){_S}?\d{{3,4}}(?:[-   .]\d{{2,4}}){{1,3}}"
    rf"|00\d{{9,13}}"
    rf"|0\d{{1,4}}/\d{{3,8}}(?:-\d{{1,4}})?"
    rf"|0\d(?:[   .-]\d\d){{4}}"
    rf"|0\d{{2,4}}[-   ]\d{{5,8}}"
    rf"|0\d{{1,4}}[-   ]\d{{3,4}}[-   ]\d{{3,4}}"
    rf"|\d{{3}}([.-])\d{{3}}\2\d{{4}}"
    rf")(?![\w])(?!-\d)"
)
ID_NUMBER = re.compile(
    rf"(?<![\w.+-])(?:\d{{3}}-\d{{2}}-\d{{4}}|\d{{9}}[VvXx]|(?:19|20)\d{{10}}|[A-Z]{{2}}\d{{7}}|[A-Z]{{2}}-\d{{3}}-\d{{3}}-[A-Z]"
    rf"|\d{{2}}{_S}\d{{3}}{_S}\d{{4}}{_S}[A-Z])(?![\w-])"
)
_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’-]*"
_EN_KIND = r"(?:Street|Road|Lane|Avenue|Close|Drive|Court|Square|Crescent|Terrace|Way|Place|Hill|Gardens|St\.|Rd\.|Ave\.|Ln\.|Dr\.|Blvd\.?|Boulevard)"
_FR_KIND = r"(?:rue|avenue|boulevard|bd|chemin|place|allée|impasse|quai|cours)"
_ES_KIND = r"(?:Calle|C/|Avenida|Avda\.|Plaza|Paseo|Camino|Carrera|Ronda|Travesía)"
_SI_KIND = "(?:වීදිය|මාවත|පාර|පටුමග)"
NUMBER_FIRST = re.compile(
    rf"(?<![\w.,-])\d{{1,5}}(?:[A-Za-z]|{_S}[A-Z])?{_S}(?:{_CAP}{_S}){{1,3}}{_EN_KIND}(?!\w)"
    rf"|(?<!\w)\d{{1,5}}(?:{_S}?(?:bis|ter|[A-D]))?,?{_S}{_FR_KIND}{_S}(?:(?:de{_S}la|du|des|de|la|le|les)?{_S}?(?:de{_S}l'|d'|l')?){_CAP}(?:[-{_S[1:-1]}]{_CAP})*"
)
SPANISH = re.compile(
    rf"(?<!\w){_ES_KIND}{_S}?(?:(?:de{_S}la|del|de|la|el|los|las){_S})?{_CAP}(?:{_S}{_CAP})*,?{_S}(?:n\.º{_S})?\d{{1,5}}(?:{_S}?[A-D](?!\w))?"
)
GERMAN = re.compile(
    rf"(?<!\w)[A-ZÄÖÜ][\w-]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|ufer|damm|steig)(?:{_S})\d{{1,4}}(?:{_S}?[a-d](?!\w))?"
    rf"|(?<!\w)[A-ZÄÖÜ][\w-]*[ -](?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee|Ring){_S}\d{{1,4}}(?:{_S}?[a-d](?!\w))?"
)
SINHALA = re.compile(
    rf"අංක{_S}\d{{1,5}}(?:/\d{{1,4}})?[A-Z]?,?{_S}[඀-෿‍]+(?:{_S}[඀-෿‍]+)?{_S}{_SI_KIND}(?![඀-෿‍])"
)
#: Patterns that do not begin with a number, and what a text must hold for them to be tried.
_STREETS = (
    (SPANISH, ("Calle", "C/", "Avenida", "Avda", "Plaza", "Paseo", "Camino", "Carrera", "Ronda", "Travesía")),
    (GERMAN, ("straße", "strasse", "str.", "weg ", "gasse", "platz", "allee", "ring ", "ufer", "damm", "steig", "Stra", "Str.", "Weg", "Gasse", "Platz", "Allee", "Ring")),
    (SINHALA, ("අංක",)),
)
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[A-ZÀ-ÖØ-ÞĀ-ŽΑ-ΩА-Я][^\W\d_'’-]*(?:['’-][^\W\d_]+)*\.?")
_NEXT = re.compile(r"[  ]*(\w+|\S|$)", re.MULTILINE)
# Titles and forms of address, which belong to no name.
TITLES = frozenset("ms mr mrs miss dr prof sir madam herr herrn frau fräulein monsieur madame mademoiselle mme mlle m sr sra srta señor señora señorita don doña".split())

KINDS = ("email", "phone", "id_number", "street_address")
_RAW = "doc_id long, kind string, value string, start int, stop int, given string, family string, reversed boolean, after string, term string, before string, before2 string"
#: Numbers of any form, by whose contexts those of personal ones are judged.
_NUMBER = re.compile(r"(?<![\w+])[+(]?\d[\d().\-/   ]*\d")
_WORDS = re.compile(r"\w+")
_STREET_WORD = re.compile(rf"{_EN_KIND}|{_FR_KIND}(?!\w)|{_ES_KIND}|(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|ufer|damm|steig)(?!\w)|{_SI_KIND}", re.IGNORECASE)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses, each grown from its at sign to both sides."""
    for sign, host in ((_AT_SIGN, _HOST), (_SPOKEN_AT, _SPOKEN_HOST)):
        if sign is _AT_SIGN and "@" not in text and "[" not in text and "(" not in text and "{" not in text:
            continue
        if sign is _SPOKEN_AT and not any(f" {d} " in text for d in ("dot", "punto", "punkt", "point", "DOT", "PUNTO", "PUNKT", "POINT")):
            continue
        for m in sign.finditer(text):
            right = host.match(text, m.end())
            if not right:
                continue
            b = m.start()
            if b and m.group()[0] != "@" and text[b - 1].isspace() and sign is _AT_SIGN:
                b -= 1
            a = b
            while a and (text[a - 1].isalnum() and text[a - 1].isascii() or text[a - 1] in "_.+%'-"):
                a -= 1
            while a < b and not text[a].isalnum():
                a += 1
            if a < b and text[b - 1] not in ".'":
                yield a, right.end()


def _numbered(text: str) -> Iterator[tuple[str, int, int]]:
    """Forms that begin with a number, with a sign before it or with letters before it."""
    for m in _DIGITS.finditer(text):
        p = m.start()
        hit = NUMBER_FIRST.match(text, p)
        if hit:
            yield "street_address", p, hit.end()
        starts = [p]
        if p >= 2 and text[p - 2 : p].isalpha():
            starts.append(p - 2)
        elif p >= 3 and text[p - 1] == "-" and text[p - 3 : p - 1].isalpha():
            starts.append(p - 3)
        for q in starts:
            hit = ID_NUMBER.match(text, q)
            if hit:
                yield "id_number", q, hit.end()
        q = p - 1 if p and text[p - 1] in "+(" else p
        hit = PHONE.match(text, q)
        if hit and 7 <= sum(c.isdigit() for c in hit.group(1)) <= 15:
            yield "phone", q, hit.end(1)


def fixed_forms(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of values with a form of their own; no two overlap.

    Of overlapping ones addresses of mail come first, then street addresses,
    identity numbers and telephone numbers, and of one kind the first.
    """
    found = [("email", a, b) for a, b in _emails(text)]
    for pattern, signs in _STREETS:
        if any(sign in text for sign in signs):
            found += [("street_address", m.start(), m.end()) for m in pattern.finditer(text)]
    found += _numbered(text)
    found.sort(key=lambda x: (("email", "street_address", "id_number", "phone").index(x[0]), x[1]))
    taken: list[tuple[int, int]] = []
    out = []
    for kind, a, b in found:
        if not any(a < y and x < b for x, y in taken):
            taken.append((a, b))
            out.append((kind, a, b))
    return out


def name_shapes(text: str) -> list[tuple[int, int, str | None, str, bool, str]]:
    """(start, end, given, family, reversed, what follows) of pairs that may be a name."""
    words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text) if not m.start() or not (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_")]
    out = []

    def add(a: int, b: int, given: str | None, family: str, rev: bool) -> None:
        after = _NEXT.match(text, b)
        out.append((a, b, given and given.casefold(), family.casefold(), rev, after.group(1).casefold() if after else ""))

    def bare(w: str) -> bool:  # a word, not an initial or an abbreviation
        return len(w) > 1 and w[-1] != "."

    for i, (a, b, w) in enumerate(words):
        # a sentence's full stop may be stuck to the second word
        j = i + 1
        initials = 0
        if len(w) == 2 and w[1] == ".":  # B. Family, B. C. Family
            before = words[i - 1] if i else None
            if before and before[1] + 1 == a and len(before[2]) == 2 and before[2][1] == ".":
                continue  # counted from its first initial
            k = i
            while k + 1 < len(words) and words[k + 1][0] == words[k][1] + 1 and len(words[k + 1][2]) == 2 and words[k + 1][2][1] == ".":
                k += 1
            if k + 1 < len(words) and words[k + 1][0] - words[k][1] in (0, 1) and "\n" not in text[words[k][1] : words[k + 1][0]]:
                x, y, v = words[k + 1]
                v = v.rstrip(".")
                if len(v) > 1:
                    add(a, x + len(v), None, v, False)
            continue
        if not bare(w) or w.casefold() in TITLES:
            continue
        end = b
        while j < len(words) and len(words[j][2]) == 2 and words[j][2][1] == "." and text[end : words[j][0]] in (" ", " ") and initials < 3:
            end = words[j][1]
            j += 1
            initials += 1
        if j >= len(words):
            continue
        x, y, v = words[j]
        v = v.rstrip(".")
        gap = text[end:x]
        if len(v) > 1 and v.casefold() not in TITLES:
            if gap in (" ", " "):
                add(a, x + len(v), w, v, False)
            elif gap == ", " and not initials:
                add(a, x + len(v), v, w, True)
    return out


def term_of(kind: str, value: str) -> str:
    """What values of the same form share."""
    if kind == "street_address":
        m = _STREET_WORD.search(value)
        return m.group().casefold() if m else ""
    if kind == "email":
        at = "@" if "@" in value else "at"
        return at + "." + re.split(r"\W+", value.rstrip(")]} "))[-1].casefold()
    return re.sub(r"[^\W\d_]", "A", re.sub(r"\d", "9", value))


def contexts(text: str, a: int, b: int) -> tuple[str, str, str]:
    """The word before a stretch, the two before it and the word after it."""
    last = [m.group().casefold() for m in _WORDS.finditer(text, max(0, a - 60), a)][-2:]
    after = _NEXT.match(text, b)
    return last[-1] if last else "", " ".join(last), after.group(1).casefold() if after else ""


def candidates(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Values of fixed form and pairs that may be names, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("kind", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]
            + [("given", pa.string()), ("family", pa.string()), ("reversed", pa.bool_()), ("after", pa.string()), ("term", pa.string()), ("before", pa.string()), ("before2", pa.string())]
        )
        for batch in batches:
            rows: list[tuple] = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not t:
                    continue
                fixed = fixed_forms(t)
                for k, a, b in fixed:
                    before, before2, after = contexts(t, a, b)
                    rows.append((doc, k, t[a:b], a, b, None, None, None, after, term_of(k, t[a:b]), before, before2))
                for m in _NUMBER.finditer(t):
                    a, b = m.span()
                    if not any(a < y and x < b for _, x, y in fixed):
                        before, before2, after = contexts(t, a, b)
                        rows.append((doc, "other", None, a, b, None, None, None, after, term_of("other", t[a:b]), before, before2))
                for a, b, g, f, rev, after in name_shapes(t):
                    if not any(a < y and x < b for _, x, y in fixed):
                        rows.append((doc, "name", t[a:b], a, b, g, f, rev, after, None, None, None))
                if len(rows) > 20_000:
                    yield _batch(rows, schema)
                    rows = []
            yield _batch(rows, schema)

    return documents.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).filter("text IS NOT NULL").mapInArrow(run, _RAW)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def disclosing_forms(raw: DataFrame) -> DataFrame:
    """(kind, term, bits): forms whose occurrences' contexts leave them above 0 bits."""
    said = F.array(F.concat(F.lit("1 "), "before"), F.concat(F.lit("2 "), "before2"), F.concat(F.lit("> "), "after"))
    seen = raw.filter("kind <> 'name'").select("kind", "term", F.explode(said).alias("context")).groupBy("kind", "term", "context").agg(F.count("*").alias("n"))
    seen = written(seen, "contexts")
    other = seen.filter("kind = 'other'").groupBy("context").agg(F.sum("n").alias("n_other"))
    of_kind = seen.filter("kind <> 'other'").groupBy("kind", "context").agg(F.sum("n").alias("n_kind"))
    size = seen.groupBy("kind").agg(F.sum("n").alias("size"))  # a row per kind
    size_other = seen.filter("kind = 'other'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    terms = seen.filter("kind <> 'other'").join(of_kind, ["kind", "context"]).join(other, "context", "left").join(F.broadcast(size), "kind")
    own = Window.partitionBy("kind", "term")
    rest, elsewhere, total = F.col("n_kind") - F.col("n"), F.coalesce("n_other", F.lit(0)), F.col("size") - F.sum("n").over(own)
    # a context met nowhere else tells nothing; one count is spread over what has not been met
    tells = F.when(rest + elsewhere > 0, F.log2((rest + 0.5) / (total + 1.0)) - F.log2((elsewhere + 0.5) / (size_other + 1.0))).otherwise(0.0)
    bits = F.sum("told") / 3 + PRIOR  # the three contexts of a value overlap
    return terms.select("kind", "term", (F.col("n") * tells).alias("told")).groupBy("kind", "term").agg(bits.alias("bits")).filter("bits > 0")


def _bits(hit: Column, n: Column, base: Column) -> Column:
    return F.when((hit > 0) & (base > 0), F.log2(F.try_divide(F.try_divide(hit, n), base)))


def _disclosing(shapes: DataFrame, given: DataFrame, family: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Given and family terms with those added that disclose an entity beside a known one."""
    yes = F.lit(True)
    known = shapes.join(given.withColumn("g", yes), "given", "left").join(family.withColumn("f", yes), "family", "left")
    known = known.withColumns({"g": F.coalesce("g", F.lit(False)), "f": F.coalesce("f", F.lit(False))})
    entity = F.count_if(F.col("g") & F.col("f"))
    base = F.lit(known.agg(F.try_divide(entity, F.count("*")).alias("base")).first()["base"]).cast("double")
    context = (
        known.groupBy("after")
        .agg(entity.alias("hit"), F.count("*").alias("n"))
        .filter(_bits(F.col("hit"), F.col("n"), base) > CONTEXT_BITS)
        .select("after", yes.alias("revealing"))
    )
    told = known.join(context, "after", "left").withColumn("revealing", F.coalesce("revealing", F.lit(False)))

    def found(pairs_of: DataFrame, term: str, other: str) -> DataFrame:
        score = pairs_of.groupBy(term).agg((F.count_if(F.col(other) & F.col("revealing")) / F.count("*")).alias("share"))
        return score.filter(F.col("share") >= DISCLOSURE).select(term)

    # "Regards, Given Family" says nothing against a given name, nor does the name
    # of a place or thing against the family name in it
    more = found(told.filter("NOT reversed"), "given", "f"), found(told.filter("revealing"), "family", "g")
    return tuple(written(t.union(m).distinct(), "terms") for t, m in zip((given, family), more))


def _judged(raw: DataFrame, name_list: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Disclosing forms, given names and family names."""
    pairs = raw.filter("kind = 'name'")
    listed = name_list.filter("name IS NOT NULL").select("kind", "name").distinct()

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:  # as the words of texts are
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n.casefold() for n in b.column(1).to_pylist()], pa.string())], ["kind", "term"])

    listed = written(listed.mapInArrow(folded, "kind string, term string").distinct(), "listed")
    # a pair counts once per context, however often a speaker is named
    shapes = written(pairs.filter("given IS NOT NULL").select("given", "family", "after", "reversed").distinct(), "shapes")
    given = listed.filter("kind = 'given'").select(F.col("term").alias("given"))
    family = listed.filter("kind = 'family'").select(F.col("term").alias("family"))
    for _ in range(ROUNDS):
        given, family = _disclosing(shapes, given, family)
    return written(disclosing_forms(raw).select("kind", "term"), "forms"), given, family


def _held(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_TERMS else df


def findings(documents: DataFrame, name_list: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kind, value, start, stop) of every value found.

    Null and empty texts hold nothing; a value is reported at each place where
    it stands, also in repeated documents; without listed names (or entities
    in the corpus) only values of fixed form are found.
    """
    raw = written(candidates(documents, id_col, text), "personal")
    forms, given, family = _judged(raw, name_list)
    return _found(raw, forms, given, family)


def _found(raw: DataFrame, forms: DataFrame, given: DataFrame, family: DataFrame) -> DataFrame:
    names = (
        raw.filter("kind = 'name'")
        .join(_held(family), "family")
        .join(_held(given.withColumn("g", F.lit(True))), "given", "left")
        .filter("given IS NULL OR g")
        .select("doc_id", "kind", "value", "start", "stop", (F.col("reversed") | F.col("given").isNull()).alias("weak"))
    )
    # "Given Family, Given Family": the reversed reading in the middle is none,
    # nor are the initial and family name in "Given I. Family"
    before = Window.partitionBy("doc_id").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("doc_id").orderBy("start", "stop").rowsBetween(1, Window.unboundedFollowing)
    plain_end = F.max(F.when(~F.col("weak"), F.col("stop"))).over(before)
    plain_start = F.min(F.when(~F.col("weak"), F.col("start"))).over(behind)
    names = names.withColumn("e", plain_end).withColumn("s", plain_start)
    names = names.filter(~F.col("weak") | ((F.coalesce("e", F.lit(-1)) <= F.col("start")) & (F.col("s").isNull() | (F.col("s") >= F.col("stop")))))
    return raw.filter("value IS NOT NULL AND kind <> 'name'").join(_held(forms), ["kind", "term"], "left_semi").select("doc_id", "kind", "value", "start", "stop").unionByName(
        names.select("doc_id", "kind", "value", "start", "stop")
    )


def spans_of(text: str, forms: set[tuple[str, str]], given: set[str], family: set[str]) -> list[tuple[int, int, str]]:
    """Values of one text by the disclosing terms, as :func:`findings` has them."""
    fixed = fixed_forms(text)
    names = [
        (a, b, rev or g is None)
        for a, b, g, f, rev, _ in name_shapes(text)
        if f in family and (g is None or g in given) and not any(a < y and x < b for _, x, y in fixed)
    ]
    names = sorted(set(names))
    out = [(a, b, k) for k, a, b in fixed if (k, term_of(k, text[a:b])) in forms]
    behind = [float("inf")] * (len(names) + 1)
    for i in range(len(names) - 1, -1, -1):
        behind[i] = min(behind[i + 1], float("inf") if names[i][2] else names[i][0])
    end = -1
    for i, (a, b, weak) in enumerate(names):
        if not weak or end <= a and behind[i + 1] >= b:
            out.append((a, b, "name"))
        if not weak:
            end = max(end, b)
    return out


def replace_spans(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with each span replaced by its placeholder; of overlapping spans the first."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, kind in sorted(set(spans)):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
    return "".join(out) + text[at:]


def sanitised(documents: DataFrame, name_list: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): every document with typed placeholders in place of the values found.

    Texts are not shuffled: the disclosing terms, if no more than
    BROADCAST_TERMS of a sort, go to every worker, which finds and replaces in
    one pass.  With more of them spans are joined to their texts; documents that
    share an id are then told apart by their text.
    """
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    raw = written(candidates(documents, id_col, text), "personal")
    terms = _judged(raw, name_list)
    if max(t.count() for t in terms) <= BROADCAST_TERMS:
        forms, given, family = ([tuple(r) for r in t.collect()] for t in terms)
        held = documents.sparkSession.sparkContext.broadcast((set(forms), {g for (g,) in given}, {f for (f,) in family}))

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t and replace_spans(t, spans_of(t, *held.value)) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

        return docs.mapInArrow(whole, "doc_id long, text string")
    spans = _found(raw, *terms).groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop", "kind", "value")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                fits = [(s["start"], s["stop"], s["kind"]) for s in found or [] if t is not None and t[s["start"] : s["stop"]] == s["value"]]
                texts.append(replace_spans(t, fits))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, text string")
