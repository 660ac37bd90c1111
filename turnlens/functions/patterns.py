"""Presence detectors and character classes, in the regex dialect of the JVM.

``(?Ud)`` gives Unicode character classes and makes the newline the only line
end; white space includes the four information separators.  ``RE2`` holds the
twins for engines without look-around, used by the SQL checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_S = r"[\s\x{1c}-\x{1f}]"
_NS = r"[^\s\x{1c}-\x{1f}]"

# Signs of mathematical notation.
_LATEX = r"\\(?:frac|sum|prod|int|sqrt|lim|infty|partial|nabla|alpha|beta|gamma|delta|theta|lambda|mu|sigma|pi|cdot|times|leq|geq|neq|approx|equiv|rightarrow|forall|exists)\b|\\begin\{|\\end\{|\$\$[^$]+\$\$|"
LATEX = _LATEX + r"\$(?!\()[^$\n]*[\^_]\{[^$\n]*\$"
# The detectors, in the order in which reports list them.
DETECTORS: dict[str, str] = {
    "code_fence": r"```",
    "inline_code": r"`[^`\n]+`",
    "url": r"(?U)https?://|www\.\w",
    "email": r"(?U)[\w.+-]+@[\w-]+\.[\w.-]+",
    "markdown_table": rf"(?Udm)^{_S}*\|.*\|{_S}*$",
    "bullet_list": rf"(?Udm)^{_S}*[-*+]{_S}+{_NS}",
    "numbered_list": rf"(?Udm)^{_S}*\d+[.)]{_S}+{_NS}",
    "heading": rf"(?Udm)^{_S}*#{{1,6}}{_S}+{_NS}",
    "latex_math": rf"(?U){LATEX}",
    "html_tag": rf"(?U)</?[a-zA-Z][a-zA-Z0-9]*({_S}[^>]*)?>",
    "emoji": r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}]",
    "md_link": r"\[[^\]]+\]\([^)]+\)",
    "emphasis": rf"(?U)(\*\*|__|\*[^*\s\x{{1c}}-\x{{1f}}]|_[^_\s\x{{1c}}-\x{{1f}}])",
}
# Severity of each detector in the risk register.
SEVERITY: dict[str, str] = {
    "code_fence": "high", "inline_code": "high", "latex_math": "high", "url": "high", "email": "medium", "html_tag": "medium",
    "markdown_table": "medium", "md_link": "medium", "numbered_list": "low", "bullet_list": "low", "heading": "low", "emphasis": "low", "emoji": "low",
}
#: Why each feature matters to a translation.
RATIONALE: dict[str, str] = {
    "code_fence": "Names and strings inside a program would be translated and the program broken: keep the block out.",
    "inline_code": "A term in code marks must come back letter for letter: keep it out.",
    "latex_math": "Formulas come back with their parts moved or lost: keep them out.",
    "url": "An address works only unchanged: keep it out.",
    "email": "An address reaches its owner only unchanged: keep it out.",
    "html_tag": "Tags may be lost or change places and take the structure with them.",
    "markdown_table": "Columns are told by bars that may be lost or moved.",
    "md_link": "The target must stay; only the words before it are text.",
    "numbered_list": "Numbers must stay with their items and in order.",
    "bullet_list": "Items may run together when a marker is lost.",
    "heading": "A lost marker turns a heading into a sentence.",
    "emphasis": "Lost marks change the look and hardly the meaning.",
    "emoji": "Mostly comes through; watched to be sure.",
}
SEVERITY_RANK = {"high": 0, "medium": 1, "low": 2}
# Scripts whose presence means text in a foreign language.
SCRIPTS = ("Sinhala", "Devanagari", "Tamil", "Bengali", "Arabic", "Hebrew", "Cyrillic", "Greek", "Han", "Hiragana", "Katakana", "Hangul", "Thai", "Gujarati", "Telugu", "Kannada", "Malayalam")
# Cosmetic characters beyond ASCII.
TYPOGRAPHIC = r"[\x{2010}-\x{2027}\x{2030}-\x{205E}\x{B0}\x{A9}\x{AE}\x{2122}\x{A3}\x{20AC}\x{A0}\x{BD}\x{BC}\x{BE}\x{2212}]"
NON_ASCII = r"[^\x00-\x7F]"

_W = r"\p{L}\p{M}\p{N}\p{Pc}\x{200c}\x{200d}"
_RS = r"[\s\v\x{85}\p{Z}\x{1c}-\x{1f}]"
_RNS = r"[^\s\v\x{85}\p{Z}\x{1c}-\x{1f}]"
RE2: dict[str, str] = {
    "code_fence": r"```",
    "inline_code": r"`[^`\n]+`",
    "url": rf"https?://|www\.[{_W}]",
    "email": rf"[{_W}.+-]+@[{_W}-]+\.[{_W}.-]+",
    "markdown_table": rf"(?m)^{_RS}*\|.*\|{_RS}*$",
    "bullet_list": rf"(?m)^{_RS}*[-*+]{_RS}+{_RNS}",
    "numbered_list": rf"(?m)^{_RS}*\p{{Nd}}+[.)]{_RS}+{_RNS}",
    "heading": rf"(?m)^{_RS}*#{{1,6}}{_RS}+{_RNS}",
    "latex_math": _LATEX + r"\$(?:[\^_]\{|[^($\n][^$\n]*[\^_]\{)[^$\n]*\$",
    "html_tag": rf"</?[a-zA-Z][a-zA-Z0-9]*({_RS}[^>]*)?>",
    "emoji": r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}]",
    "md_link": r"\[[^\]]+\]\([^)]+\)",
    "emphasis": r"\*\*|__|\*[^*\s\v\x{85}\p{Z}\x{1c}-\x{1f}]|_[^_\s\v\x{85}\p{Z}\x{1c}-\x{1f}]",
}


#: What a text must hold, one of them at least, for a detector to be tried: a byte search saves most patterns.
NEEDED: dict[str, tuple[str, ...]] = {
    "code_fence": ("```",), "inline_code": ("`",), "url": ("://", "www."), "email": ("@",), "markdown_table": ("|",), "bullet_list": ("-", "*", "+"),
    "numbered_list": (".", ")"), "heading": ("#",), "latex_math": ("\\", "$"), "html_tag": ("<",), "md_link": ("](",), "emphasis": ("*", "_"),
}


def beyond_ascii(text: Column) -> Column:
    """Does a text hold a character of more than one byte?"""
    return F.octet_length(text) > F.length(text)


def has(name: str, text: Column) -> Column:
    """Does the text show the feature?"""
    hit = text.rlike(DETECTORS[name])
    if name not in NEEDED:  # emoji
        return beyond_ascii(text) & hit
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(sign)) for sign in NEEDED[name]]) & hit


#: A character of any of the scripts.
ANY_SCRIPT = "[" + "".join(rf"\p{{Is{s}}}" for s in SCRIPTS) + "]"


def has_script(script: str, text: Column) -> Column:
    return beyond_ascii(text) & text.rlike(rf"\p{{Is{script}}}")
