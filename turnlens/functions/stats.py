"""Exact distribution summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUANTILES = (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))


def summary(value: Column) -> list[Column]:
    """count, sum, min, max, mean, population std and linearly interpolated quantiles; zeros without values."""
    zero = F.lit(0)
    out = [
        F.count(value).alias("n"),
        F.coalesce(F.sum(value), zero).cast("long").alias("total"),
        F.coalesce(F.min(value), zero).cast("long").alias("least"),
        F.coalesce(F.max(value), zero).cast("long").alias("most"),
        F.round(F.coalesce(F.avg(value), F.lit(0.0)), 6).alias("mean"),
        F.round(F.coalesce(F.stddev_pop(value), F.lit(0.0)), 6).alias("std"),
    ]
    # one buffer of counted values serves all quantiles
    quantiles = F.percentile(value, F.array(*[F.lit(q) for _, q in QUANTILES]))
    return out + [F.round(F.coalesce(F.get(quantiles, i), F.lit(0.0)), 6).alias(name) for i, (name, _) in enumerate(QUANTILES)]


def percent(part: Column, whole: Column, digits: int = 3) -> Column:
    """Half-even percentage, 0 of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.bround(100.0 * part / whole, digits))
