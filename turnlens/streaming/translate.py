"""Mask, cut, translate, rebuild and restore - in batch or as a resumable stream.

The translator is any function from a list of segments to a list of as many
translations.  It is made once per Python worker; segments go to it sorted by
length, so a batch holds segments of like size.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ..functions import masking, segments
from ..operators.curate import not_yet_done
from ..schema import RECORD

Translator = Callable[[list[str]], list[str]]
TRANSLATED = "prompt string, prompt_id string, messages array<struct<content string, role string>>"


def identity() -> Translator:
    return lambda texts: list(texts)


def _many(translate: Translator, texts: list[str], batch: int) -> list[str]:
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    out = [""] * len(texts)
    for k in range(0, len(order), batch):
        rows = order[k : k + batch]
        for i, t in zip(rows, translate([texts[i] for i in rows]), strict=True):
            out[i] = t
    return out


def translated(
    records: DataFrame,
    make: Callable[[], Translator] = identity,
    mask: bool = True,
    limit: int = segments.LIMIT,
    batch: int = 96,
    count: Callable[[], segments.Counter] | None = None,
    most: int = segments.MOST_TOKENS,
    mend: Callable[[str], str] | None = None,
) -> DataFrame:
    """Records with translated prompt and contents.

    A prompt that equals the first message shares its translation.  Null
    prompts stay null, null elements are dropped, null contents count as empty.
    ``count`` makes a token counter, under which no segment has more than
    ``most`` tokens; the translations of a segment's parts are joined by a
    space.  ``mend`` is applied to every translation, as a model's decoder may
    need it.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, counter = make(), count() if count else None

        def translate(texts: list[str]) -> list[str]:
            return segments.within(texts, model, counter, most, mend)

        for df in frames:
            texts: list[str] = []
            layout: list[tuple[list[str] | None, int]] = []
            rows = []
            for prompt, pid, messages in zip(df["prompt"], df["prompt_id"], df["messages"]):
                kept = [m for m in (messages if messages is not None else []) if m is not None]
                contents = [m["content"] or "" for m in kept]
                shared = bool(contents) and prompt == contents[0]
                own = contents + ([] if shared or prompt is None else [prompt])
                rows.append((pid, [m["role"] for m in kept], len(contents), shared, prompt is None, len(texts), len(own)))
                texts += own
            cut, plans = [], []
            for t in texts:
                masked, spans = masking.mask(t) if mask else (t, [])
                pieces, lines, per_line = segments.cut(masked, limit)
                plans.append((lines, per_line, spans, len(cut), len(pieces)))
                cut += pieces
            done = _many(translate, cut, batch)
            back = [masking.unmask(segments.rebuild(done[a : a + n], lines, per), spans) for lines, per, spans, a, n in plans]
            out = []
            for pid, roles, n, shared, no_prompt, a, size in rows:
                contents = back[a : a + n]
                prompt = None if no_prompt else contents[0] if shared else back[a + size - 1]
                out.append((prompt, pid, [{"content": c, "role": r} for c, r in zip(contents, roles)]))
            yield pd.DataFrame(out, columns=["prompt", "prompt_id", "messages"])

    return records.select("prompt", "prompt_id", "messages").mapInPandas(run, TRANSLATED)


def done_so_far(spark: SparkSession, out: str) -> DataFrame | None:
    """Ids already written under ``out``; None before the first run."""
    try:
        return spark.read.schema(RECORD).json(out).select("prompt_id")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def translate_batch(records: DataFrame, done: DataFrame | None, out: str, make: Callable[[], Translator] = identity) -> None:
    """Translate what is not yet done and append it; ids done before, null included, are left out."""
    todo = records if done is None else not_yet_done(records, done)
    translated(todo, make).write.mode("append").option("ignoreNullFields", False).json(out)


def translate_stream(spark: SparkSession, source: str, out: str, checkpoint: str, make: Callable[[], Translator] = identity, files_per_batch: int = 32) -> StreamingQuery:
    """Translate new Parquet files under ``source`` and end; a second run only sees newer files.

    The checkpoint makes each file count once, and the file sink keeps a
    micro-batch that broke off out of the result.
    """
    records = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    sink = translated(records, make).writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint)
    return sink.outputMode("append").trigger(availableNow=True).start()


def throughput(translate: Translator, texts: list[str], batch: int = 96) -> dict[str, float]:
    """Characters and segments per second of a translator over given texts."""
    pieces = [p for t in texts for p in segments.cut(masking.mask(t)[0])[0]]
    began = time.perf_counter()
    _many(translate, pieces, batch)
    took = max(time.perf_counter() - began, 1e-9)
    return {"segments": len(pieces), "chars": sum(map(len, texts)), "seconds": took, "chars_per_s": sum(map(len, texts)) / took}
