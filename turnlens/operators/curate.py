"""Filtering, de-duplicating, dividing and leak-checking a dataset.

Order matters to several of these; it is always an explicit column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..sources.scratch import written


def has_blank_turn(messages: Column) -> Column:
    """Is a turn null, empty or white space alone? Lists without turns have none."""
    return F.coalesce(F.exists(messages, lambda m: text.is_blank(m["content"])), F.lit(False))


def keep_first(df: DataFrame, key: str, order: str, blank: Column) -> DataFrame:
    """``df`` with an ``outcome``: kept, dup or empty.

    Of the rows of a key that are not blank the first is kept; rows after it
    are duplicates whether blank or not; blank rows before it are empty.  Null
    keys are one key.
    """
    # the first row of a key is aggregated partly before the shuffle, so a key of
    # any size costs one row per task; the join is open to skew splitting
    first = df.filter(~blank).groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    joined = df.join(first, df[key].eqNullSafe(first["_key"]), "left")
    outcome = F.when(F.col(order) > F.col("_first"), "dup").when(blank, "empty").otherwise("kept")
    return joined.withColumn("outcome", outcome).drop("_key", "_first")


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key (null is one) with the greatest ``order``, which tells the rows of a key apart.

    Only keys and orders are aggregated, partly before the shuffle; the rows
    are then picked by a semi join, so no record is held in a buffer or sorted
    by its other columns.
    """
    last = df.groupBy(F.col(key).alias("_key")).agg(F.max(order).alias("_last"))
    return df.join(last, df[key].eqNullSafe(last["_key"]) & (df[order] == last["_last"]), "left_semi")


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``order``."""
    return df.orderBy(order).limit(n)


def parts(df: DataFrame, order: str, n: int) -> DataFrame:
    """Rows dealt round-robin to ``n`` parts in the order of ``order``.

    Exact global ordinals without sorting everything in one place: rows are
    ranged by ``order``, the sizes of the ranges are summed, and a row's
    ordinal is its place in its range plus the ranges before.
    """
    ranged = df.repartitionByRange(F.col(order)).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "ranges")  # both uses below must see the same ranges
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # a row per partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.join(F.broadcast(sizes.withColumn("_before", before).drop("_n")), "_range")
    ordinal = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return placed.withColumn("part", (ordinal % n).cast("int")).drop("_range", "_before")


def route(df: DataFrame, ids: DataFrame, key: str = "prompt_id", id_col: str = "prompt_id") -> DataFrame:
    """``df`` with ``side``: test if the key is listed (white space around ids aside, blank ids left out), else train."""
    listed = ids.select(F.regexp_replace(id_col, r"^\s+|\s+$", "").alias("_listed")).filter("_listed <> ''").distinct()
    out = df.join(listed, df[key] == listed["_listed"], "left")
    return out.withColumn("side", F.when(F.col("_listed").isNotNull(), "test").otherwise("train")).drop("_listed")


def not_yet_done(df: DataFrame, done: DataFrame, key: str = "prompt_id") -> DataFrame:
    """Rows whose key (null included) is not among those done."""
    d = done.select(F.col(key).alias("_done")).distinct()
    return df.join(d, df[key].eqNullSafe(d["_done"]), "left_anti")


def leaks(train: DataFrame, test: DataFrame, value: Column, name: str) -> DataFrame:
    """Distinct values both sides share, and test rows that hold one. Null values never match."""
    a, b = train.select(value.alias("v")).filter("v IS NOT NULL"), test.select(value.alias("v")).filter("v IS NOT NULL")
    rows = b.join(a.distinct(), "v", "left_semi")
    return rows.agg(F.lit(name).alias("check"), F.countDistinct("v").alias("shared_values"), F.count("*").alias("test_rows"))


def duplicates(df: DataFrame, value: Column) -> DataFrame:
    """Rows beyond the first of their value; null is a value."""
    per = df.groupBy(value.alias("v")).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_values"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def duplicates_by_side(df: DataFrame, value: Column, side: Column) -> DataFrame:
    """The same within each side; rows of no side are left out."""
    per = df.select(side.alias("side"), value.alias("v")).filter("side IS NOT NULL").groupBy("side", "v").agg(F.count("*").alias("n"))
    return per.groupBy("side").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_values"), F.sum(F.col("n") - 1).alias("n_duplicates"))


def aligned(left: DataFrame, right: DataFrame, key: str, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages of two versions of a record side by side by position; extra ones on the left stay, with null beside them.

    ``keep`` names further columns of the left.  A key of the right stands once.
    """
    pair = F.transform(F.col("l"), lambda m, i: F.struct(i.alias("pos"), m["content"].alias("left"), F.get(F.col("r"), i)["content"].alias("right")))
    both = left.select(key, *keep, F.col(column).alias("l")).join(right.select(key, F.col(column).alias("r")), key, "left")
    return both.select(key, *keep, F.explode(pair).alias("x")).select(key, *keep, "x.*")
