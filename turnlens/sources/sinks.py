"""Writers of records, parts, routed lines and small artifacts."""

from __future__ import annotations

import json
import warnings
from datetime import datetime, timezone

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .records import read_jsonl

#: Rows of a row group of converted records.
GROUP_ROWS = 20_000
#: Rows of a small artifact, at most; more are refused rather than collected.
ARTIFACT_ROWS = 100_000


def write_parquet(df: DataFrame, path: str, codec: str = "zstd", group_rows: int | None = None) -> None:
    """Parquet files; row groups of at most ``group_rows`` rows if given."""
    out = df.write.mode("errorifexists").option("compression", codec)
    if group_rows:
        out = out.option("parquet.block.row.count.limit", group_rows)
    out.parquet(path)


def jsonl_to_parquet(spark: SparkSession, glob: str, path: str, codec: str = "zstd", group_rows: int = GROUP_ROWS) -> None:
    """Records of JSON lines as Parquet with the record schema; a bad line fails the job."""
    write_parquet(read_jsonl(spark, glob, "raise"), path, codec, group_rows)


def write_parts(df: DataFrame, path: str, part: str = "part") -> None:
    """One folder per part; rows of a part stay together, so a part has few files."""
    df.repartition(F.col(part)).write.mode("errorifexists").option("compression", "zstd").partitionBy(part).parquet(path)


def write_sides(lines: DataFrame, path: str, side: str = "side", line: str = "line") -> None:
    """Lines routed by side, byte for byte."""
    lines.select(side, F.col(line).alias("value")).write.mode("errorifexists").partitionBy(side).text(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def rewrite_lines(lines: DataFrame, path: str, line: str = "line") -> int:
    """Write repaired JSON lines to a new place, unless one of them no longer parses; returns their number.

    The lines are read once: the first that does not parse ends the job, and
    what it had written is not committed.
    """
    says = "a line is not JSON; nothing was written"
    whole = F.when(F.try_parse_json(line).isNotNull(), F.col(line)).otherwise(F.raise_error(F.lit(says)))
    seen = Observation()
    try:
        lines.select(whole.alias("value")).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").text(path)
    except PySparkException as e:
        if says in str(e):
            raise ValueError(says) from e
        raise
    return seen.get["n"]


def artifact(tables: dict[str, DataFrame]) -> str:
    """Small results as one JSON document."""
    out: dict[str, object] = {"_generated_at": datetime.now(timezone.utc).isoformat(timespec="seconds")}
    for name, df in tables.items():
        rows = df.limit(ARTIFACT_ROWS + 1).collect()
        if len(rows) > ARTIFACT_ROWS:
            raise ValueError(f"{name} has more than {ARTIFACT_ROWS} rows; write it as a table")
        out[name] = [r.asDict(recursive=True) for r in rows]
    return json.dumps(out, ensure_ascii=False, indent=2, default=str)


def read_artifact(spark: SparkSession, path: str) -> dict[str, object]:
    """An artifact's results by name; empty, with a warning, if there is none."""
    try:
        text = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        text = None
    if text is None:
        warnings.warn(f"no artifact at {path}", stacklevel=2)
        return {}
    return json.loads(text["value"])


def markdown(df: DataFrame, title: str, rows: int = 200, beside: str | None = None) -> str:
    """A heading and a table; bars in cells are escaped.

    A table of more than ``rows`` rows is written whole to a folder under
    ``beside`` and the text says how many rows it leaves out; without ``beside``
    it is refused.
    """
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    cell = lambda v: "" if v is None else str(v).replace("|", r"\|").replace("\n", " ")
    found = df.limit(rows + 1).collect()
    note = ""
    if len(found) > rows:
        if beside is None:
            raise ValueError(f"{title} has more than {rows} rows; name a folder for the whole table")
        path = f"{beside.rstrip('/')}/{title.lower().replace(' ', '_')}"
        df.write.mode("errorifexists").parquet(path)
        note = f"\n{df.sparkSession.read.parquet(path).count() - rows} more rows; all are in {path}\n"
    body = "\n".join("| " + " | ".join(cell(v) for v in r) + " |" for r in found[:rows])
    return f"## {title}\n\n{head}\n{body}\n{note}"
