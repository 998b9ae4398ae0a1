"""Near duplicates among embeddings: a forest of random-projection trees, compared within leaves.

Each tree splits by the projection on a random direction, where the fewest pairs of a bounded sample are left to
compare; a vector within a margin of the split goes to both sides (spill overlap), so that close vectors rarely part. The
margin comes from the threshold: how far a pair at exactly that cosine lies apart in projection. Where the overlap takes
most of a node, as in a group of mutually close vectors, the node stays a leaf and is compared whole. Every tree has its
own directions; trees are added until pairs planted at the threshold are found. Equal vectors are one with a weight
before any tree is made.

Vectors that share a leaf are compared by exact cosine in double precision. A leaf is dealt out in blocks, and each pair
of its blocks is one group, so a leaf of any size is worked on by many tasks and whole. No pair is returned: a group
gives for each vector the number of its partners and one link towards them. A pair counts in the first tree, and there in
the first leaf, that both vectors are in, which each vector's list of leaves tells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.llm.components import components, smallest
from gridstats.plans.sizing import spill

TREES = 8  # at least
MOST_TREES = 64
RECALL = 0.97  # of planted pairs at exactly the threshold; trees are added until it is reached
PLANTED = 1000
SAMPLE = 20_000  # vectors that the splits are fitted to; all vectors are routed
LEAF = 400  # wanted vectors in a leaf
MARGIN = 0.35  # standard deviations of a threshold pair's projected distance, on each side of a split
WORTH = 0.85  # a split is made if at most this share of the pairs is left to compare
FEWEST = 8  # sampled vectors that a split can be judged by
BLOCK = 512  # vectors of a leaf in one block


@dataclass(frozen=True)
class Tree:
    """Nodes in one array: children of node i are 2 i + 1 and 2 i + 2. All nodes of a level share a direction."""

    directions: np.ndarray  # a row for each level
    middle: np.ndarray  # split of each node; NaN for a leaf
    margin: np.ndarray


def grow(points: np.ndarray, depth: int, seed: int, beside: float, few: float) -> Tree:
    """A tree with ``beside`` as margin of all splits; nodes of at most ``few`` points are leaves."""
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((depth, points.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    middle, margin = np.full((1 << (depth + 1)) - 1, np.nan), np.zeros((1 << (depth + 1)) - 1)
    level = {0: np.arange(len(points))}
    for d in range(depth):
        below = {}
        for node, own in level.items():
            n = len(own)
            if n < FEWEST or n <= few:
                continue
            along = points[own] @ directions[d]
            ordered = np.sort(along)
            at = ordered[np.linspace(0.1 * (n - 1), 0.9 * (n - 1), 33).astype(int)]
            low, high = np.searchsorted(ordered, at + beside, "right") / n, 1 - np.searchsorted(ordered, at - beside, "right") / n
            cost = low**2 + high**2
            best = int(cost.argmin())
            if cost[best] > WORTH:
                continue
            middle[node], margin[node] = at[best], beside
            below[2 * node + 1], below[2 * node + 2] = own[along <= middle[node]], own[along > middle[node]]
        level = below
    return Tree(directions, middle, margin)


def leaves(tree: Tree, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all leaves of all rows."""
    rows, nodes = np.arange(len(points)), np.zeros(len(points), np.int64)
    done = [], []
    for direction in [*tree.directions, None]:
        split = tree.middle[nodes]
        end = np.isnan(split)
        done[0].append(rows[end])
        done[1].append(nodes[end])
        rows, nodes, split = rows[~end], nodes[~end], split[~end]
        if direction is None or not len(rows):
            break
        along = points[rows] @ direction
        low, high = along <= split + tree.margin[nodes], along > split - tree.margin[nodes]
        rows, nodes = np.concatenate([rows[low], rows[high]]), np.concatenate([2 * nodes[low] + 1, 2 * nodes[high] + 2])
    return np.concatenate(done[0]), np.concatenate(done[1])


def together(forest: list[Tree], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each left vector and the right one of its row share a leaf of some tree."""
    found = np.zeros(len(left), bool)
    for tree in forest:
        own, other = (set(zip(*map(np.ndarray.tolist, leaves(tree, side)), strict=True)) for side in (left, right))
        found[[row for row, _ in own & other]] = True
    return found


def plant(points: np.ndarray, many: int, cosine: float, trees: int, seed: int) -> list[Tree]:
    """The forest for ``many`` vectors of which ``points`` are a sample: ``trees`` and more until ``RECALL`` is reached."""
    if not len(points):
        return [Tree(np.zeros((0, points.shape[1])), np.full(1, np.nan), np.zeros(1))] * trees
    width = points.shape[1]
    beside = MARGIN * np.sqrt(max(0.0, 2 - 2 * cosine) / width)
    depth = max(0, int(np.ceil(np.log2(max(1.0, many / LEAF)))))
    few = LEAF * len(points) / many
    rng = np.random.default_rng(seed)
    own = points[rng.integers(len(points), size=PLANTED)]
    across = rng.standard_normal(own.shape)
    across -= (across * own).sum(axis=1, keepdims=True) * own
    norm = np.linalg.norm(across, axis=1, keepdims=True)
    partner = cosine * own + np.sqrt(max(0.0, 1 - cosine**2)) * np.divide(across, norm, out=np.zeros_like(across), where=norm > 0)
    forest, open_pairs = [], np.ones(PLANTED, bool)
    while len(forest) < trees or (open_pairs.mean() > 1 - RECALL and len(forest) < MOST_TREES):
        forest.append(grow(points, depth, seed * 1000 + len(forest), beside, few))
        open_pairs[open_pairs] = ~together(forest[-1:], own[open_pairs], partner[open_pairs])
    return forest


def matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """id and normalised vector of the rows that can link: a vector of finite components that is not zero."""
    values = F.col("embedding").cast("array<double>")
    fine = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(values, lambda v: v != 0)
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))  # first scaled, so that no square overflows or vanishes
    rows = vectors.where("vec_id is not null").where(fine).select(F.col("vec_id").alias("id"), values.alias("v"))
    rows = rows.select("id", F.transform("v", lambda x: x / largest).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.select("id", F.transform("v", lambda x: x / norm).alias("v"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, trees: int = TREES, seed: int = 1) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors(vec_id, embedding)``; ``trees`` is the least number.

    A vector that is null, empty, zero, or holds null or non-finite components links with nothing, as do vectors of
    different lengths with each other. Rows with equal vectors link with each other. Rows that repeat a vec_id with an
    equal vector link with each other and are one node; a null vec_id links with nothing and its component is null.
    """
    spark = vectors.sparkSession
    rows = spill(unit_vectors(vectors))
    sets = spill(rows.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight")))
    sizes = [r[0] for r in sets.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    found = None
    for width in sizes:
        own = sets.where(F.size("v") == width)
        more = linked(own, own.count(), width, cosine, trees, seed)
        found = more if found is None else found.union(more)
    if found is None:
        found = spark.createDataFrame([], "id long, partners long, root long")
    found = spill(found)
    partners = found.groupBy("id").agg(F.sum("partners").alias("partners"))
    part = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    known = rows.join(sets.withColumnRenamed("id", "node"), "v").select("id", "node", "weight")
    known = known.join(partners.withColumnRenamed("id", "node"), "node", "left").join(part, "node", "left")
    known = known.select("id", (F.col("weight") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    known = known.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    result = vectors.select("vec_id").join(known, vectors["vec_id"] == known["id"], "left")
    result = result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def linked(sets: DataFrame, many: int, width: int, cosine: float, trees: int, seed: int) -> DataFrame:
    """id, partners (weights of the linked vectors) and root (the smallest id of its part of the group), several rows an id."""
    spark = sets.sparkSession
    share = min(1.0, SAMPLE / max(many, 1))
    drawn = sets.select("v", F.xxhash64("id", F.lit(seed)).alias("h")).where(F.col("h") / 2.0**64 + 0.5 <= share).orderBy("h").limit(SAMPLE)
    points = np.array([r[0] for r in drawn.select("v").collect()]).reshape(-1, width)
    planted = plant(points, many, cosine, trees, seed)
    trees = len(planted)
    # plain arrays: a broadcast value is not shipped with its class
    forest = spark.sparkContext.broadcast([(tree.directions, tree.middle, tree.margin) for tree in planted])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                places = [leaves(Tree(*tree), matrix(part.column(1))) for tree in forest.value]
                row = np.concatenate([r for r, _ in places])
                leaf = np.concatenate([n * trees + t for t, (_, n) in enumerate(places)])
                order = np.lexsort((leaf // trees, leaf % trees, row))
                at = np.searchsorted(row[order], np.arange(part.num_rows + 1))
                listed = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(leaf[order], pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, listed], names=[*part.schema.names, "leaves"])

    names = ["id", "v", "weight"]
    routed = sets.select(*names).mapInArrow(route, T.StructType([*sets.select(*names).schema.fields, T.StructField("leaves", T.ArrayType(T.LongType()))]))
    routed = spill(routed)
    # each leaf's number of blocks, so that a block meets every other block of its leaf exactly once
    entries = routed.select("id", "v", "weight", "leaves", F.posexplode("leaves").alias("rank", "leaf"))
    counts = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks")).where("n_blocks > 1")
    entries = entries.join(counts, "leaf", "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1)))
    entries = entries.withColumn("block", F.pmod(F.xxhash64("id", "leaf"), F.col("n_blocks")).cast("int"))
    met = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda k: F.struct(F.least(F.col("block"), k).alias("a"), F.greatest(F.col("block"), k).alias("b")))
    entries = entries.select("leaf", "id", "v", "weight", "block", "leaves", "rank", F.explode(met).alias("pair"))
    entries = entries.select("leaf", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"), "id", "v", "weight", "block", F.slice("leaves", F.lit(1), F.col("rank")).alias("earlier"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        left, right = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        v, ids, weight = matrix(table["v"]), table["id"].to_numpy(), table["weight"].to_numpy()
        own = table["earlier"].combine_chunks()
        row, leaf = np.repeat(np.arange(len(ids)), own.value_lengths().to_numpy()), own.flatten().to_numpy()
        # leaves that came before this one and that both blocks are in
        shared = np.intersect1d(leaf[np.isin(row, left)], leaf[np.isin(row, right)])
        known = np.isin(leaf, shared)
        earlier = np.zeros((len(ids), len(shared)), np.float32)
        earlier[row[known], np.searchsorted(shared, leaf[known])] = 1
        similar = v[left] @ v[right].T
        i, j = np.nonzero((similar >= cosine) & (earlier[left] @ earlier[right].T == 0))
        i, j = left[i], right[j]
        if key[1] == key[2]:
            i, j = i[i < j], j[i < j]
        partners = np.zeros(len(ids), np.int64)
        np.add.at(partners, i, weight[j])
        np.add.at(partners, j, weight[i])
        some = np.flatnonzero(partners)
        order = np.argsort(ids)
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        root = ids[order][smallest(len(ids), rank[i], rank[j])[rank]]
        return pa.table({"id": pa.array(ids[some], pa.int64()), "partners": pa.array(partners[some]), "root": pa.array(root[some], pa.int64())})

    return entries.groupBy("leaf", "a", "b").applyInArrow(compare, "id long, partners long, root long")
