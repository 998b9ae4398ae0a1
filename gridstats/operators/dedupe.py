"""Keep-first deduplication, samples and distinct points."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstats.functions.wkb import decode_points

# Column with the place of a row in the file it came from.
ROW_ORDER = "_order"
_ROW_ORDER_TYPE = "struct<file:string,block:bigint,row:bigint>"


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``. Deterministic, and combines on the map side."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order]))
    picked = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(first.alias("_first"))
    columns = [F.col(f"`{c}`") if c in keys else F.col(f"_first.`{c}`").alias(c) for c in df.columns]
    return picked.select(*columns)


def merge_grids(*grids: DataFrame) -> DataFrame:
    """All nodes of several grids; for a repeated ``node_id`` the earliest grid wins.

    Nodes without a geometry are left out. Inside one grid the first row by ``_order`` wins, as a node file has it; of
    a grid without that column, whose rows have no order, the smallest (lon, lat).
    """
    if not grids:
        raise ValueError("no grids given")
    ranked = []
    for rank, grid in enumerate(grids):
        place = F.col(ROW_ORDER) if ROW_ORDER in grid.columns else F.lit(None).cast(_ROW_ORDER_TYPE)
        nodes = decode_points(grid).select("node_id", "lon", "lat", place.alias(ROW_ORDER))
        ranked.append(nodes.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumn("_rank", F.lit(rank)))
    return dedupe_first(reduce(DataFrame.unionByName, ranked), ["node_id"], ["_rank", ROW_ORDER, "lon", "lat"]).drop("_rank", ROW_ORDER)


def distinct_points(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct positions, per group when ``by`` is given."""
    located = decode_points(points).select(*[F.col(f"`{c}`") for c in by], "lon", "lat")
    return located.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).distinct()


def sample_first(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``order``; 0 means all rows."""
    return df if n <= 0 else df.orderBy(*[F.col(f"`{c}`") for c in order]).limit(n)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, for a look at a finished table."""
    return df.limit(n)
