"""Points × grid nodes within a radius, as an equi join on cell ids.

A pure ``BETWEEN`` join compares every point with every node. Here each point gets exactly one cell, each
node is repeated into the few cells its window can meet, and the two sides join on the cell. The exact
window and the exact distance stay as filters after the join, so the cells never change the result, and
since a point has one cell and a node's cells are distinct, no pair appears twice.

Band ``by`` is one latitude window high. The cell width ``w(by)`` in it is at least the longitude window of any
point in the band and depends on ``by`` alone, so both sides compute the same number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.constants import DEFAULT_RADIUS_KM, EARTH_RADIUS_M, KM_PER_DEGREE_LON
from gridstats.functions.geo import arc_m, window_lat, window_lon
from gridstats.functions.wkb import decode_points
from gridstats.plans.sizing import fits_broadcast
from gridstats.plans.skew import HOT_ROWS, skew_join

# Slack against rounding of the cell borders, in cells.
_PAD = 1e-9


def _sure(value: Column) -> Column:
    """Mark a column that cannot be NULL here as such.

    Otherwise the optimizer derives ``isnotnull(<value>)`` from the join and evaluates the sines, cosines
    and cells of every point a second time in that filter.
    """
    return F.coalesce(value, F.lit(0))


def _band(lat: Column, height: float) -> Column:
    return _sure(F.floor((lat + 90.0) / height))


def _cell_width(band: Column, height: float, radius_km: float, strict_window: bool) -> Column:
    edge = F.least(F.greatest(F.abs(band * height - 90.0), F.abs((band + 1) * height - 90.0)), F.lit(90.0))
    cosine = F.greatest(F.cos(F.radians(edge)), F.lit(1e-12))
    width = F.lit(radius_km / KM_PER_DEGREE_LON) / cosine
    if not strict_window:
        reach = math.sin(min(radius_km * 1000.0 / EARTH_RADIUS_M, math.pi / 2))
        widest = F.degrees(F.asin(F.least(F.lit(reach) / cosine, F.lit(1.0)))) * (1 + 1e-9)
        width = F.when(cosine <= reach, F.lit(360.0)).otherwise(F.greatest(width, widest))
    return F.least(width, F.lit(360.0))


def _column_of(lon: Column, width: Column) -> Column:
    """Cell number along the band; a band whose window spans the globe has a single cell."""
    return _sure(F.when(width >= 360.0, F.lit(0).cast("long")).otherwise(F.floor((lon + 180.0) / width)))


def _cell_key(band: Column, column: Column) -> Column:
    """Band and column in one number: a single long key takes Spark's fast hash map."""
    return _sure(band * F.lit(2**32) + column)


def _trig(lat: str, prefix: str) -> list[Column]:
    phi = F.radians(F.col(lat))
    return [_sure(F.sin(phi)).alias(f"{prefix}_sin"), _sure(F.cos(phi)).alias(f"{prefix}_cos")]


def _node_cells(nodes: DataFrame, height: float, radius_km: float, strict_window: bool) -> DataFrame:
    """One row per (node, cell) that a point linked to the node can lie in."""
    lat, lon = F.col("node_lat"), F.col("node_lon")
    first = F.floor((lat - height + 90.0) / height - _PAD)
    last = F.floor((lat + height + 90.0) / height + _PAD)
    bands = nodes.withColumn("_by", F.explode(F.sequence(first, last)))
    bands = bands.withColumn("_w", _cell_width(F.col("_by"), height, radius_km, strict_window))
    w = F.col("_w")

    def reach(at: Column) -> Column:
        low = F.floor((at - w + 180.0) / w - _PAD)
        return F.sequence(low, F.floor((at + w + 180.0) / w + _PAD))

    cells = reach(lon)
    if not strict_window:  # the distance alone decides, so neighbours across 180° count
        cells = F.array_distinct(F.concat(cells, reach(lon - 360.0), reach(lon + 360.0)))
    whole = F.array(F.lit(0).cast("long"))
    columns = bands.withColumn("_bx", F.explode(F.when(w >= 360.0, whole).otherwise(cells)))
    return columns.withColumn("_cell", _cell_key(F.col("_by"), F.col("_bx"))).drop("_w", "_by", "_bx")


def _valid(df: DataFrame, lon: str, lat: str) -> DataFrame:
    return df.where(F.col(lon).isNotNull() & F.col(lat).isNotNull() & ~F.isnan(lon) & ~F.isnan(lat))


def pair_points(
    points: DataFrame,
    grid: DataFrame,
    radius_km: float = DEFAULT_RADIUS_KM,
    keep: Sequence[str] = ("rowid",),
    strict_window: bool = True,
    within_radius: bool = True,
    salt_by: Sequence[str] = ("lon", "lat"),
    hot_rows: int = HOT_ROWS,
    broadcast_grid: bool | None = None,
) -> DataFrame:
    """The pairs behind ``link_to_grid``, with the point columns in ``keep`` carried along.

    Returns ``keep`` + ``node_id, node_lon, node_lat``; grid rows that repeat a node count once. Cells of the nodes
    that are provably few are broadcast and the points are not shuffled at all; more join by shuffle with hot cells
    salted, as do any with ``broadcast_grid=False``.
    """
    if not radius_km > 0:
        raise ValueError("radius_km must be positive")
    if not (strict_window or within_radius):
        raise ValueError("without the window the radius must be applied")
    height = window_lat(radius_km)
    left = _valid(decode_points(points), "lon", "lat")
    carried = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, "lon", "lat"])]
    left = left.select(*carried, _band(F.col("lat"), height).alias("_by"), *(_trig("lat", "_p") if within_radius else []))
    column = _column_of(F.col("lon"), _cell_width(F.col("_by"), height, radius_km, strict_window))
    left = left.withColumn("_cell", _cell_key(F.col("_by"), column)).drop("_by")

    nodes = decode_points(grid)
    nodes = nodes.select("node_id", F.col("lon").alias("node_lon"), F.col("lat").alias("node_lat"))
    nodes = _valid(nodes, "node_lon", "node_lat").distinct()
    if within_radius:
        nodes = nodes.select("*", *_trig("node_lat", "_g"))
    cells = _node_cells(nodes, height, radius_km, strict_window)
    if broadcast_grid is not False and fits_broadcast(cells):
        pairs = left.join(F.broadcast(cells), "_cell")
    else:
        pairs = skew_join(left, cells, ["_cell"], salt_by, hot_rows)

    lon, lat, node_lon, node_lat = (F.col(c) for c in ("lon", "lat", "node_lon", "node_lat"))
    if strict_window:
        half = window_lon(radius_km, lat)
        pairs = pairs.where(node_lat.between(lat - height, lat + height) & node_lon.between(lon - half, lon + half))
    if within_radius:
        distance = arc_m(F.col("_p_sin"), F.col("_p_cos"), F.col("_g_sin"), F.col("_g_cos"), F.radians(node_lon - lon))
        pairs = pairs.where(distance <= radius_km * 1000.0)
    return pairs.select(*[F.col(f"`{c}`") for c in keep], "node_id", "node_lon", "node_lat")


def link_to_grid(
    points: DataFrame, grid: DataFrame, radius_km: float = DEFAULT_RADIUS_KM, strict_window: bool = True, **layout
) -> DataFrame:
    """Link every point to all nodes within ``radius_km``: ``(rowid, node_id)``, many-to-many.

    The latitude / longitude window is part of the definition: a node due east or west just inside the
    radius can lie outside it. ``strict_window=False`` drops the window and links across 180° too.
    """
    return pair_points(points, grid, radius_km, strict_window=strict_window, **layout).select("rowid", "node_id")


def band_join(points: DataFrame, grid: DataFrame, radius_km: float = DEFAULT_RADIUS_KM, **layout) -> DataFrame:
    """Only the window: pairs whose latitude and longitude differences are inside it."""
    return pair_points(points, grid, radius_km, within_radius=False, **layout).select("rowid", "node_id")
