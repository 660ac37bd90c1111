"""Numbers and durations as reports write them; all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grouped(value: Column) -> Column:
    """A whole number, rounded half to even, with commas between thousands; null of null."""
    return F.format_number(F.bround(value.cast("double"), 0), 0)


def percent_text(part: Column, whole: Column) -> Column:
    """A percentage with three decimals, n/a of nothing."""
    return F.when(whole == 0, F.lit("n/a")).otherwise(F.concat(F.format_string("%.3f", 100.0 * part / whole), F.lit("%")))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def human_time(seconds: Column) -> Column:
    """A duration: 45s, 12m 30s, 3h 20m or 6.4 days."""
    s = seconds.cast("double")
    whole = F.floor(s)
    return (
        F.when(s < 60, F.concat(F.bround(s, 0).cast("long").cast("string"), F.lit("s")))
        .when(s < 3_600, F.concat(F.floor(whole / 60), F.lit("m "), whole % 60, F.lit("s")))
        .when(s < 86_400, F.concat(F.floor(whole / 3_600), F.lit("h "), F.floor(whole % 3_600 / 60), F.lit("m")))
        .otherwise(F.concat(F.format_string("%.1f", s / 86_400), F.lit(" days")))
    )
