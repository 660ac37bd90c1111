"""Readers of dialogue records, raw lines, id lists, vocabularies and logs."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..schema import RECORD

_SHARD = r"^(.+?)-\d{5}-of-\d{5}.*\.parquet$"


def split_of(file_name: Column) -> Column:
    """Split of a shard: what stands before its number, or the name without its ending."""
    numbered = F.nullif(F.regexp_extract(file_name, _SHARD, 1), F.lit(""))
    return F.coalesce(numbered, F.regexp_replace(file_name, r"\.parquet$", ""))


def read_splits(spark: SparkSession, folder: str, splits: list[str] | None = None) -> DataFrame:
    """All Parquet shards below a folder with their split and an order column.

    Raises FileNotFoundError if there is none.  ``ord`` rises with the file
    and the row in it.
    """
    reader = spark.read.schema(RECORD).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    try:
        df = reader.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no shards under {folder}") from e
    if not df.inputFiles():
        raise FileNotFoundError(f"no shards under {folder}")
    df = df.select("*", split_of(F.col("_metadata.file_name")).alias("split"), F.struct("_metadata.file_path", F.monotonically_increasing_id().alias("row")).alias("ord"))
    return df.filter(F.col("split").isin(splits)) if splits else df


def read_lines(spark: SparkSession, glob: str, label: str | None = None) -> DataFrame:
    """Lines of text files with file and order (file, then row); a line ends in a newline only. Errors if nothing matches."""
    df = spark.read.option("lineSep", "\n").text(glob).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), F.struct("_metadata.file_path", F.monotonically_increasing_id().alias("row")).alias("ord")
    )
    return df.withColumn("label", F.lit(label)) if label else df


def read_labelled(spark: SparkSession, inputs: list[str]) -> DataFrame:
    """Lines of several inputs, each given as LABEL=glob or as a glob, which is its own label."""
    parts = [(a, b) if eq else (a, a) for a, eq, b in (i.partition("=") for i in inputs)]
    return reduce(DataFrame.unionByName, [read_lines(spark, glob, label) for label, glob in parts])


def read_jsonl(spark: SparkSession, glob: str, on_bad: str = "keep") -> DataFrame:
    """Dialogue records of JSON lines; blank lines are skipped.

    ``on_bad``: "keep" adds the line as ``_corrupt`` beside nulls, "drop"
    leaves bad lines out, "raise" fails on the first.
    """
    if on_bad == "keep":
        lines = spark.read.text(glob).filter(~is_blank(F.col("value")))
        bad = F.try_parse_json("value").isNull()
        parsed = lines.select(F.when(~bad, F.from_json("value", RECORD)).alias("r"), F.when(bad, F.col("value")).alias("_corrupt"))
        return parsed.select("r.*", "_corrupt")
    return spark.read.schema(RECORD).option("mode", {"drop": "DROPMALFORMED", "raise": "FAILFAST"}[on_bad]).json(glob)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a list, one per line, without surrounding white space and blank lines."""
    ids = spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("prompt_id"))
    return ids.filter("prompt_id <> ''").distinct()


def read_free_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text corpus; bytes that are no text are dropped."""
    return spark.read.text(path).select(F.replace(F.make_valid_utf8("value"), F.lit("�"), F.lit("")).alias("text"))


def read_joiner_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of a tab-separated vocabulary that hold the joiner, without word marks."""
    piece = F.ltrim(F.split("value", "\t")[0], F.lit("▁"))
    return spark.read.text(path).select(piece.alias("form")).filter(F.contains("form", F.lit("‍"))).distinct()


def line_counts(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.text(glob).groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n"))


def finished_logs(spark: SparkSession, glob: str, mark: str = "DONE ") -> DataFrame:
    """Log files that hold the completion mark."""
    lines = spark.read.text(glob).filter(F.contains("value", F.lit(mark)))
    return lines.select(F.col("_metadata.file_name").alias("file_name")).distinct()
