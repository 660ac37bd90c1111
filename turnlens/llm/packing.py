"""Problem 8: filling fixed-capacity containers with items.

Only the histogram of item lengths is packed, so the work on the driver does
not depend on the number of items.  The configuration linear program - fewest
containers whose patterns cover the histogram - is solved by multiplicative
weights: every length has a weight, a knapsack over the capacity finds the
pattern worth most, the pattern is used and the weights of what it covers fall,
until every length is covered.  Each round uses its pattern a share of the
times its scarcest length allows, rounded to whole containers of what is left,
so that the rounded solution holds every item once and nothing is lost by
rounding at the end.  A round's knapsack looks at the lengths least covered and
at a changing part of the others.  Should plain best fit decreasing need fewer
containers, the program is solved again with dearer lengths where containers
were badly filled, and only if that does not help best fit's packing is taken.  Items get ordinals within their
length without gathering a length in one place, and an ordinal decides the
container and position.

Texts longer than the capacity are split into full pieces and a rest.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import written

#: Share of a pattern's scarcest length that a round of multiplicative weights covers.
STEP = 0.25
#: Lengths of a round's knapsack: those worth most, and as many others in turn.
PRICED = 48
#: Runs of the program, at most, and the power of a length's price in the one before that it begins with.
PASSES, RAISED = 4, 0.5


@dataclass
class Plan:
    """Which container an item of a length and ordinal goes to.

    Row i: items of ``length[i]`` with ordinals from ``first[i]`` up to
    ``first[i] + copies[i] * times[i]`` go to the containers from ``base[i]``
    on, ``times[i]`` to each, from position ``place[i]``.
    """

    containers: int = 0
    length: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    times: list[int] = field(default_factory=list)
    base: list[int] = field(default_factory=list)
    copies: list[int] = field(default_factory=list)
    place: list[int] = field(default_factory=list)

    def add(self, pattern: dict[int, int], copies: int, used: dict[int, int]) -> None:
        place = 0
        for length in sorted(pattern, reverse=True):
            times = pattern[length]
            self.length.append(length)
            self.first.append(used.get(length, 0))
            self.times.append(times)
            self.base.append(self.containers)
            self.copies.append(copies)
            self.place.append(place)
            used[length] = used.get(length, 0) + times * copies
            place += times
        self.containers += copies


def best_pattern(lengths: np.ndarray, weights: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """Knapsack by dynamic programming: the pattern of the greatest weight, with repeats up to ``most``.

    Lengths are taken in turn with multiplicities in powers of two, which makes
    each step one array operation over the capacity; what each step bettered is
    kept as bits, to walk back from the best total.
    """
    value = np.zeros(capacity + 1)
    taken: list[tuple[int, int, np.ndarray]] = []
    for length, w, m in zip(lengths.tolist(), weights.tolist(), most.tolist()):
        left, k = min(m, capacity // length), 1
        while left > 0:
            k_now = min(k, left)
            size = k_now * length
            new = value[: capacity + 1 - size] + k_now * w
            taken.append((length, k_now, np.packbits(new > value[size:])))
            np.maximum(value[size:], new, out=value[size:])
            left -= k_now
            k *= 2
    at = int(value.argmax())
    out: dict[int, int] = {}
    for length, k, better in reversed(taken):
        i = at - length * k
        if i >= 0 and better[i >> 3] >> (7 - (i & 7)) & 1:
            out[length] = out.get(length, 0) + k
            at = i
    return out


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Pack ``histogram`` (items by length, lengths up to the capacity) into few containers.

    The program's packing, unless plain best fit needs fewer containers.
    """
    histogram = {n: c for n, c in histogram.items() if n > 0 and c > 0}
    plain = Plan()
    _best_fit(histogram, capacity, plain, {})
    usage = solved(histogram, capacity, plain.containers)
    if sum(copies for _, copies in usage) > plain.containers:
        return plain
    p, used = Plan(), {}
    for pattern, copies in usage:
        p.add(pattern, copies, used)
    return p


def solved(histogram: dict[int, int], capacity: int, enough: int) -> list[tuple[dict[int, int], int]]:
    """The patterns of the program and how often each is used; together they hold every item once.

    While they are more than ``enough``, lengths that were left to badly filled
    containers are worth more from the start and the program is solved anew.
    """
    value = dict.fromkeys(histogram, 1.0)
    best: list[tuple[dict[int, int], int]] = []
    for _ in range(PASSES):
        usage = _covered(histogram, capacity, value)
        if not best or sum(c for _, c in usage) < sum(c for _, c in best):
            best = usage
        if sum(c for _, c in best) <= enough:
            break
        price = dict.fromkeys(histogram, 0.0)
        for pattern, copies in usage:
            fill = sum(n * m for n, m in pattern.items()) / capacity
            for n, m in pattern.items():
                price[n] += copies * m / fill
        value = {n: value[n] * (x / histogram[n]) ** RAISED for n, x in price.items()}
    return best


def _covered(histogram: dict[int, int], capacity: int, value: dict[int, float]) -> list[tuple[dict[int, int], int]]:
    """One run of the program, from lengths of this ``value`` for their share of a container."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    left = counts.copy()
    # a dual value per length: an item is worth its share of a container, less as its length is covered
    weight = np.array([value[n] for n in lengths.tolist()])
    out: list[tuple[dict[int, int], int]] = []
    turn = 0
    while (open_ := np.flatnonzero(left)).size:
        if open_.size > PRICED:
            # the lengths least covered, long ones first, and others taken in turn
            half = PRICED // 2
            first = np.lexsort((-lengths[open_], -weight[open_]))[:half]
            others = np.setdiff1d(np.arange(open_.size), first, assume_unique=True)
            stride = -(-others.size // half)
            open_ = open_[np.sort(np.concatenate((first, others[turn % stride :: stride])))]
            turn += 1
        pattern = best_pattern(lengths[open_], lengths[open_] * weight[open_], np.minimum(left[open_], capacity // lengths[open_]), capacity)
        at = np.searchsorted(lengths, np.fromiter(pattern, np.int64))
        times = np.fromiter(pattern.values(), np.int64)
        # a share of its scarcest length, in whole containers, while its items last
        copies = max(1, min(int((counts[at] // times).min() * STEP), int((left[at] // times).min())))
        out.append((pattern, copies))
        left[at] -= times * copies
        weight[at] *= np.exp(-STEP * times * copies / counts[at])
    return out


def _best_fit(stock: dict[int, int], capacity: int, result: Plan, used: dict[int, int]) -> None:
    """Fill containers one pattern at a time: longest first, then the longest that still fits."""
    stock = dict(stock)
    rising = sorted(stock)
    while rising:
        room, pattern, i = capacity, {}, len(rising)
        while room and (i := bisect_right(rising, room, 0, i)):
            n = rising[i - 1]
            pattern[n] = m = min(room // n, stock[n])
            room -= n * m
            i -= 1
        copies = min(stock[n] // m for n, m in pattern.items())
        result.add(pattern, copies, used)
        for n, m in pattern.items():
            stock[n] -= m * copies
            if not stock[n]:
                del rising[bisect_left(rising, n)]


def pack(sized: DataFrame, capacity: int, id_col: str = "doc_id") -> DataFrame:
    """(container, position, id, piece, offset, tokens): every text's place.

    ``sized`` has ``id_col`` and ``tokens``.  A text over the capacity comes in
    pieces 0, 1, ... of ``capacity`` tokens (``offset`` is their first token)
    and a rest; every other text is one piece.  Texts without tokens take no
    room and are spread over the containers (container 0 if there is none),
    after the others; null counts as no tokens; repeated rows are items each.
    """
    cap = F.lit(capacity)
    tokens = F.coalesce("tokens", F.lit(0)).cast("long")
    last = F.greatest(F.ceil(F.col("total") / cap), F.lit(1)).cast("int") - 1
    items = (
        sized.select(F.col(id_col).alias("item"), tokens.alias("total"))
        .select("item", "total", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
        .withColumn("offset", F.col("piece").cast("long") * cap)
        .withColumn("size", F.least(F.col("total") - F.col("offset"), cap))
        .withColumn("part", F.spark_partition_id())
        .withColumn("seq", F.monotonically_increasing_id())
    )
    items = written(items, "items")
    by_part = items.groupBy("size", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_part = written(by_part.withColumn("before", before), "ordinals")
    # as many rows as there are lengths up to the capacity
    histogram = {r["size"]: r["n"] for r in by_part.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    p = plan(histogram, capacity)
    numbered = items.join(by_part.select("size", "part", "before"), ["size", "part"]).withColumn(
        "ordinal", F.col("before") + F.row_number().over(Window.partitionBy("size", "part").orderBy("seq")) - 1
    )
    order = np.lexsort((np.array(p.first, np.int64), np.array(p.length, np.int64)))
    held = sized.sparkSession.sparkContext.broadcast({k: np.array(getattr(p, k), np.int64)[order] for k in ("length", "first", "times", "base", "copies", "place")} | {"containers": p.containers})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = held.value
        wide = 1 << 40
        keys = d["length"] * wide + d["first"]
        for b in batches:
            size, ordinal = np.asarray(b.column("size")), np.asarray(b.column("ordinal"))
            none = size == 0
            i = np.maximum(np.searchsorted(keys, size * wide + ordinal, "right") - 1, 0)
            if keys.size:
                r = ordinal - d["first"][i]
                container = d["base"][i] + r // d["times"][i]
                place = d["place"][i] + r % d["times"][i]
            else:
                container = place = np.zeros(len(size), np.int64)
            container = np.where(none, ordinal % max(1, d["containers"]), container)
            place = np.where(none, (1 << 20) + ordinal // max(1, d["containers"]), place)
            yield pa.RecordBatch.from_arrays(
                [pa.array(container), pa.array(place), b.column("item"), b.column("piece"), b.column("offset"), pa.array(size)],
                ["container", "place", "item", "piece", "offset", "tokens"],
            )

    placed = numbered.select("item", "piece", "offset", "size", "ordinal").mapInArrow(
        run, "container long, place long, item long, piece int, offset long, tokens long"
    )
    # places of a container become positions without gaps; a container is small
    position = F.row_number().over(Window.partitionBy("container").orderBy("place")) - 1
    return placed.select("container", position.alias("position"), F.col("item").alias(id_col), "piece", "offset", "tokens")
