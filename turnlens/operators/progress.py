"""Progress of a long job by part: state, rate, time left, as a table, as JSON and as text."""

from __future__ import annotations

import json
import math
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import percent

#: Records an hour assumed where nothing has been observed.
ASSUMED_RATE = 11_000.0


def parts_status(parts: DataFrame) -> DataFrame:
    """(part, done, total, pct, status, resume_from) from (part, done, total, finished).

    A finished part has all of its records; no part has more than its total;
    only a partial one has a place to resume from.  Null counts are 0.
    """
    count, total = F.coalesce("done", F.lit(0)), F.coalesce("total", F.lit(0))
    finished = F.coalesce("finished", F.lit(False))
    done = F.when(finished, total).otherwise(F.least(count, total))
    status = F.when(finished, "done").when(count > 0, "partial").otherwise("queued")
    return parts.select(
        "part",
        done.alias("done"),
        total.alias("total"),
        percent(done, total, 1).alias("pct"),
        status.alias("status"),
        F.when(status == "partial", done).alias("resume_from"),
    )


def totals_of(parts: DataFrame, known: dict[str, int], manifest: DataFrame | None = None) -> DataFrame:
    """``parts`` with a total: the known one, else the manifest's (part, total), else 0."""
    fixed = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.create_map().cast("map<string,bigint>")
    named = fixed[F.col("part")].cast("long")
    if manifest is None:
        return parts.withColumn("total", F.coalesce(named, F.lit(0)))
    listed = manifest.select(F.col("part").alias("_part"), F.col("total").cast("long").alias("_total"))
    out = parts.join(listed, parts["part"] == listed["_part"], "left")
    return out.withColumn("total", F.coalesce(F.nullif(named, F.lit(0)), "_total", F.lit(0))).drop("_part", "_total")


def rates(log: DataFrame, assumed: float = ASSUMED_RATE) -> DataFrame:
    """``log`` (job, ts, done) with the records an hour since the job's cycle before; ``assumed`` where none were made or no time passed."""
    w = Window.partitionBy("job").orderBy("ts", "done")
    made, took = F.col("done") - F.lag("done").over(w), F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(w)
    rate = F.when((made > 0) & (took > 0), made * 3_600_000_000.0 / took)
    return log.withColumn("per_hour", F.coalesce(rate, F.lit(assumed)))


def summary(status: DataFrame, per_hour: float = ASSUMED_RATE, name: str = "parts", at: datetime | None = None) -> tuple[str, str]:
    """JSON and a text table of :func:`parts_status`, which has a row per part."""
    rows = [r.asDict() for r in status.orderBy("part").collect()]
    done, total = sum(r["done"] for r in rows), sum(r["total"] for r in rows)
    left = (total - done) / per_hour if per_hour > 0 else math.inf
    stamp = (at or datetime.now()).strftime("%Y-%m-%d %H:%M:%S")
    document = {"name": name, "generated": stamp, "parts": rows, "done": done, "total": total, "remaining": total - done, "per_hour": round(per_hour), "hours_left": round(left, 2) if math.isfinite(left) else None}
    line = "-" * 46
    body = [f"{r['part']:10} {r['done']:8d} {r['total']:8d} {r['pct']:5.1f}%  {r['status']}" for r in rows]
    text = [f"{name.upper()} {stamp}", "", f"{'part':10} {'done':>8} {'total':>8} {'pct':>6}  status", line, *body, line, f"Done      : {done:,} / {total:,}", f"Remaining : {total - done:,}", f"Rate      : {round(per_hour):,} an hour", f"Time left : {left:.2f} h"]
    return json.dumps(document, indent=2), "\n".join(text) + "\n"
