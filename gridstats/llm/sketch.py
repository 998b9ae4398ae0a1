"""Counts of hashes in a table of fixed size, summed over all rows by Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridstats.llm.worker import tidied

BLOCK_BITS = 14


def counted(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """``2 ** bits`` counters; each hash of each row adds one at its upper ``bits`` bits.

    A counter is never below the number of rows of a hash that falls on it. The table has the same size for any
    input: it is the one thing that is gathered, and it may be broadcast.
    """
    size, block = 1 << bits, 1 << min(bits, BLOCK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for own in hashes(batch):
                np.add.at(total, (own >> np.uint64(64 - bits)).astype(np.int64), 1)
        if total.any():
            parts = total.reshape(-1, block)
            full = np.flatnonzero(parts.any(axis=1))
            yield pa.record_batch({"block": pa.array(full, pa.int32()), "counts": pa.array([narrow(parts[i]) for i in full], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(block, np.int64)
        for row in table["counts"]:
            total += widen(row.as_buffer(), block)
        return pa.table({"block": table["block"][:1], "counts": pa.array([narrow(total)], pa.binary())})

    schema = "block int, counts binary"
    rows = df.mapInArrow(tidied(count), schema).groupBy("block").applyInArrow(add, schema).collect()
    total = np.zeros((size // block, block), np.int64)
    for row in rows:
        total[row["block"]] = widen(row["counts"], block)
    return total.reshape(-1)


def narrow(counts: np.ndarray) -> bytes:
    kind = np.uint8 if counts.max() < 256 else np.uint16 if counts.max() < 65536 else np.int64
    return counts.astype(kind).tobytes()


def widen(data, block: int) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 8: np.int64}[len(data) // block]
    return np.frombuffer(data, kind).astype(np.int64)
