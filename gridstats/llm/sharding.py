"""Shards of nearly equal bytes by histogram sort: splitters from exact counts, then one exchange.

Rows have a place in one global order: the hash of the text, then a number of the row. Splitters start as evenly spaced
probes of the order. Each round counts, over all rows, the exact rows and bytes below every probe (each task sums its
own rows, so what is exchanged and gathered is as long as the list of probes), narrows the interval of each wanted
boundary and places new probes inside it, until every boundary is within the tolerance. Equal texts have one hash and
stay in one shard, unless they are so many bytes that no boundary between hashes meets the tolerance; then probes go on
among the numbers of the rows of that hash. The last counts also tell how many rows lie before each range, so rows are
exchanged once, in ranges that a task can sort, and need no second pass for their slots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.plans.sizing import spill

PROBES = 32  # new probes in each round for a boundary that is not yet placed
TOLERANCE = 0.001  # of a shard's bytes
SPLIT = 0.01  # of a shard's bytes: rows of one hash are parted only if the boundary beside them is further off
RANGE_ROWS = 500_000  # about so many rows, and
RANGE_BYTES = 64 << 20  # about so many bytes, are one range of the sort

# A place in the order is a number below 2 ** 128: the text's hash, then the row's number, both shifted to be positive.
HASH = 1 << 64
END = 1 << 128
OWN = ("_k1", "_k2", "_size")


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text and one more; a null text is one byte."""
    return (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + 1).cast("long")


def bins(batch: pa.RecordBatch, at: int, probes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many of the sorted probes are at or before each row."""
    k1, k2 = (batch.column(at + i).to_numpy() for i in (0, 1))
    p1, p2 = probes
    found = np.searchsorted(p1, k1, "left")
    last = np.searchsorted(p1, k1, "right")
    tied = np.flatnonzero(last > found)
    for h in np.unique(k1[tied]):
        own = tied[k1[tied] == h]
        low, high = np.searchsorted(p1, h, "left"), np.searchsorted(p1, h, "right")
        found[own] = low + np.searchsorted(p2[low:high], k2[own], "right")
    return found


def as_arrays(probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([v - (1 << 63) for v in part], np.int64) for part in ([p // HASH for p in probes], [p % HASH for p in probes]))


def below(rows: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """(rows, bytes) strictly before each of the sorted probes."""
    arrays, n = as_arrays(probes), len(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, size = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        for batch in batches:
            found = bins(batch, 0, arrays)
            many += np.bincount(found, minlength=n + 1)
            np.add.at(size, found, batch.column(2).to_numpy())
        full = np.flatnonzero(many)
        yield pa.record_batch({"bin": pa.array(full, pa.int64()), "many": pa.array(many[full]), "size": pa.array(size[full])})

    counted = rows.select(*OWN).mapInArrow(count, "bin long, many long, size long").groupBy("bin").agg(F.sum("many"), F.sum("size"))
    many, size = np.zeros(n + 1, object), np.zeros(n + 1, object)
    for b, m, s in counted.collect():
        many[b], size[b] = m, s
    return list(zip(np.cumsum(many)[:n], np.cumsum(size)[:n], strict=True))


def between(low: int, high: int, parts: int) -> set[int]:
    """Places inside (low, high) that cut it into ``parts``: at hashes while there are several, else at row numbers."""
    unit = HASH if high - low > HASH else 1
    found = {(low + (high - low) * k // parts) // unit * unit for k in range(1, parts)}
    return {p for p in found if low < p < high}


def splitters(rows: DataFrame, shards: int, many: int, total: int, tolerance: float) -> list[int]:
    """Boundaries before which the bytes of 1, 2, ... shards lie, each within ``tolerance`` of a shard."""
    wanted = [total * k / shards for k in range(1, shards)]
    spans = [(0, (0, 0), END, (many, total))] * len(wanted)  # low place, rows and bytes before it; the same of a high place
    shard = total / shards

    def near(goal: float, span: tuple) -> bool:
        low, (rows_low, before), high, (rows_high, after) = span
        slack = max(tolerance, SPLIT) if high - low <= HASH else tolerance
        return min(goal - before, after - goal) <= slack * shard or rows_high - rows_low <= 1 or high - low <= 1

    while not all(near(w, s) for w, s in zip(wanted, spans, strict=True)):
        probes = sorted(set().union(*[between(s[0], s[2], PROBES + 1) for w, s in zip(wanted, spans, strict=True) if not near(w, s)]))
        counted = list(zip(probes, below(rows, probes), strict=True))
        for k, goal in enumerate(wanted):
            low, before, high, after = spans[k]
            for place, found in counted:
                if found[1] <= goal and place > low:
                    low, before = place, found
                if found[1] >= goal and place < high:
                    high, after = place, found
            spans[k] = low, before, high, after
    return [low if goal - before[1] <= after[1] - goal else high for goal, (low, before, high, after) in zip(wanted, spans, strict=True)]


def ranges(rows: DataFrame, edges: list[int], many: int, total: int, most: int, most_bytes: int) -> tuple[list[int], list[int]]:
    """(all edges, rows before each): ``edges`` and further ones, until no range but a single row's has more than twice
    ``most`` rows or ``most_bytes`` bytes."""
    edges = sorted({0, *[e for e in edges if e < END]})
    while True:
        before = [(int(n), int(size)) for n, size in below(rows, edges)]
        more: set[int] = set()
        for low, high, first, last in zip(edges, [*edges[1:], END], before, [*before[1:], (many, total)], strict=True):
            own, size = last[0] - first[0], last[1] - first[1]
            parts = max(own / most, size / most_bytes)
            if parts > 2 and own > 1 and high - low > 1:
                more |= between(low, high, min(int(parts) + 1, own))
        if not more:
            return edges, [n for n, _ in before]
        edges = sorted({*edges, *more})


def shard(
    docs: DataFrame,
    shards: int,
    group: Column,
    size: Column,
    tolerance: float = TOLERANCE,
    most: int = RANGE_ROWS,
    most_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (from 0, without gaps, in each shard), by nearly equal sums of ``size``.

    ``group`` is a hash; rows of one hash stay together if the tolerance allows. A single row larger than a shard gets
    one that is too large; with fewer rows than shards some stay empty. Repeated rows are rows like others. All given
    columns are written once and exchanged once. Columns named shard or slot are replaced. A very long text is one row of
    one range, whatever the bounds on ranges; nulls count as the given ``size`` says.
    """
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    kept = [f"_c{i}" for i in range(len(names))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(names, kept, strict=True)], group.alias("_k1"), size.alias("_size"))
    rows = spill(rows.withColumn("_k2", F.xxhash64(F.monotonically_increasing_id())).select(*kept, *OWN))
    many, total = rows.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    cuts = splitters(rows, shards, many, total, tolerance)
    edges, before = ranges(rows, cuts, many, total, most, most_bytes)
    # a range belongs to the shard whose cuts are at or before it
    owner = [sum(c <= e for c in cuts) for e in edges]
    first = [min(b for b, o in zip(before, owner, strict=True) if o == own) for own in owner]
    arrays = as_arrays(edges)
    lookup = np.array(owner, np.int32), np.array(before, np.int64) - np.array(first, np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = bins(batch, len(kept), arrays) - 1
            added = pa.array(found.astype(np.int32)), pa.array(lookup[0][found]), pa.array(lookup[1][found])
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "_range", "shard", "_before"])

    added = [T.StructField("_range", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("_before", T.LongType())]
    placed = rows.mapInArrow(place, T.StructType([*rows.schema.fields, *added]))
    slot = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy("_k1", "_k2")) - 1
    return placed.withColumn("slot", slot.cast("long")).select(*[F.col(n).alias(c) for c, n in zip(names, kept, strict=True)], "shard", "slot")
