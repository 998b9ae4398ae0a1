"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstats.llm.worker import tidied
from gridstats.plans.sizing import spill


def smallest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``size`` nodes the smallest that the links a[i] - b[i] reach."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one batch replaced by (node, smallest node of its part): same components, at most as many links."""
    for batch in batches:
        u, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
        label = smallest(len(nodes), index[: len(u)], index[len(u) :])
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        if len(moved):
            yield pa.record_batch({"u": pa.array(nodes[moved], pa.int64()), "v": pa.array(nodes[label[moved]], pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links(u, v)``; component: the smallest node that links reach.

    Nodes without a link to another node do not occur. Each round is two joins on a column that a hot node can
    fill; both sides carry two longs, the sums combine on the map side, and the joins can be split where skewed.
    Rounds grow with the logarithm of the number of links. Lineage is cut by a written table each round.
    """
    links = links.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u is not null and v is not null and u <> v")
    links = spill(links.mapInArrow(tidied(contract), "u long, v long").distinct())
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v").distinct())
        before = state
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        rest = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = spill(rest.union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
