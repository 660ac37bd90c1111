"""Settings of the command line, from the environment where it names them."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from .functions import conjuncts, segments
from .sources import sinks

PREFIX = "TURNLENS_"


@dataclass(frozen=True)
class Settings:
    """TURNLENS_MASK=0, TURNLENS_SEGMENT_CHARS=500 and so on; an empty variable counts as unset."""

    mask: bool = True
    segment_chars: int = segments.LIMIT
    segment_tokens: int = segments.MOST_TOKENS
    batch: int = 96
    files_per_batch: int = 32
    tokenizer: str = ""
    lexicon_least: int = 2
    word_threshold: int = conjuncts.THRESHOLD
    parquet_codec: str = "zstd"
    parquet_rows: int = sinks.GROUP_ROWS
    parts: int = 10
    master: str = ""
    shared_folder: str = ""


def load(environ: dict[str, str] | None = None) -> Settings:
    """Settings with the values of the environment, which must be of the setting's type."""
    env = os.environ if environ is None else environ
    given: dict[str, object] = {}
    for f in fields(Settings):
        value = env.get(PREFIX + f.name.upper(), "").strip()
        if not value:
            continue
        kind = type(f.default)
        if kind is bool:
            if value.lower() not in ("0", "1", "true", "false", "yes", "no", "on", "off"):
                raise ValueError(f"{PREFIX}{f.name.upper()} is no yes or no: {value}")
            given[f.name] = value.lower() in ("1", "true", "yes", "on")
        else:
            given[f.name] = kind(value)
    return Settings(**given)
