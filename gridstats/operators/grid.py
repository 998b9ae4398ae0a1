"""Regular metric grids, inside a box or a footprint, with manual nodes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.constants import DEFAULT_SPACING_KM
from gridstats.functions.polygon import buffer_pieces, edge_sums, oriented, ring_bounds, xy
from gridstats.functions.utm import (
    utm_forward,
    utm_forward_point,
    utm_inverse,
    utm_zone_point,
)
from gridstats.functions.wkb import decode_points, point_wkb
from gridstats.operators.clip import points_in_polygons
from gridstats.operators.dedupe import merge_grids
from gridstats.plans.sizing import pin

Box = tuple[float, float, float, float]


def build_grid(spark: SparkSession, bbox: Box, spacing_km: float = DEFAULT_SPACING_KM, prefix: str = "G") -> DataFrame:
    """``node_id, lon, lat`` of a lattice in a (min_lon, min_lat, max_lon, max_lat) box.

    Lines are ``spacing_km`` apart in the UTM zone of the box centre, from the south-west corner inset by
    half a spacing; the last line may pass the inset edge by less than one spacing. Nodes are numbered row
    by row from 1. Only the two corners are computed on the driver.
    """
    if not spacing_km > 0:
        raise ValueError("spacing_km must be positive")
    west, south, east, north = (float(v) for v in bbox)
    zone, southern = utm_zone_point((west + east) / 2.0, (south + north) / 2.0)
    spacing = spacing_km * 1000.0
    half = spacing / 2.0
    x0, y0 = (v + half for v in utm_forward_point(west, south, zone, southern))
    x1, y1 = (v - half for v in utm_forward_point(east, north, zone, southern))
    if x0 > x1 or y0 > y1:
        raise ValueError("bounding box too small for the requested spacing")
    columns, rows = (math.ceil((high + spacing - low) / spacing) for low, high in ((x0, x1), (y0, y1)))
    index = F.col("id")
    lattice = spark.range(columns * rows).select(
        F.concat(F.lit(prefix), (index + 1).cast("string")).alias("node_id"),
        (F.lit(x0) + (index % columns) * F.lit(spacing)).alias("x"),
        (F.lit(y0) + F.floor(index / columns) * F.lit(spacing)).alias("y"),
    )
    return utm_inverse(lattice, zone, southern).select("node_id", "lon", "lat")


def _reproject(polygons: DataFrame, zone: int, southern: bool, forward: bool) -> DataFrame:
    """All ring vertices into or out of a UTM zone. Parts are identified by their own rings."""
    flat = (
        polygons.select("rings")
        .distinct()
        .select("rings", F.posexplode("rings").alias("_r", "_ring"))
        .select("rings", "_r", F.posexplode("_ring").alias("_p", "_v"))
        .select("rings", "_r", "_p", F.col("_v.x").alias("_x"), F.col("_v.y").alias("_y"))
    )
    if forward:
        moved = utm_forward(flat, zone, southern, "_x", "_y", "_tx", "_ty")
    else:
        moved = utm_inverse(flat, zone, southern, "_x", "_y", "_tx", "_ty")
    vertices = F.array_sort(F.collect_list(F.struct("_r", "_p", xy(F.col("_tx"), F.col("_ty")).alias("v"))))
    grouped = moved.groupBy("rings").agg(vertices.alias("_all"), F.max("_r").alias("_last"))
    rebuilt = F.transform(
        F.sequence(F.lit(0), F.col("_last")),
        lambda r: F.transform(F.filter(F.col("_all"), lambda v: v["_r"] == r), lambda v: v["v"]),
    )
    return grouped.select(rebuilt.alias("rings"))


def _bounds(polygons: DataFrame) -> Box:
    sides = ring_bounds(F.col("rings"))
    row = polygons.agg(
        F.min(sides["minx"]), F.min(sides["miny"]), F.max(sides["maxx"]), F.max(sides["maxy"])
    ).first()
    return tuple(row)


def centroid(polygons: DataFrame) -> tuple[float, float]:
    """Centroid of all parts together: by area, else by length, else by vertices."""
    names = ("a", "ax", "ay", "l", "lx", "ly", "px", "py", "n")
    sums = polygons.select(F.explode(edge_sums(F.col("rings"))).alias("s")).agg(*[F.sum(f"s.{k}").alias(k) for k in names])
    s = sums.first()
    if s is None or not s["n"]:
        raise ValueError("no geometries found")
    for weight, x, y in (("a", "ax", "ay"), ("l", "lx", "ly"), ("n", "px", "py")):
        if s[weight] > 0:
            return s[x] / s[weight], s[y] / s[weight]
    raise ValueError("no geometries found")


def buffer_polygons(polygons: DataFrame, buffer_km: float) -> DataFrame:
    """Footprint grown by ``buffer_km`` in the UTM zone of its centroid, as parts."""
    if buffer_km < 0:
        raise ValueError("buffer_km must not be negative")
    if buffer_km == 0:
        return polygons.select("rings")
    zone, southern = utm_zone_point(*centroid(polygons))
    metric = _reproject(polygons, zone, southern, forward=True).select(oriented(F.col("rings")).alias("rings"))
    pieces = F.concat(F.array("rings"), buffer_pieces(F.col("rings"), buffer_km * 1000.0))
    return _reproject(metric.select(F.explode(pieces).alias("rings")), zone, southern, forward=False)


def build_grid_in_hull(
    spark: SparkSession, polygons: DataFrame, spacing_km: float = DEFAULT_SPACING_KM, prefix: str = "G", buffer_km: float = 0.0
) -> DataFrame:
    """Lattice over the bounds of the (buffered) footprint, kept where the footprint covers the node.

    Numbers are given before the clip, so gaps are normal.
    """
    centroid(polygons)  # refuses an empty footprint
    shape = pin(buffer_polygons(polygons, buffer_km))
    return points_in_polygons(build_grid(spark, _bounds(shape), spacing_km, prefix), shape)


def add_nodes(grid: DataFrame, manual: DataFrame) -> DataFrame:
    """Grid plus manual nodes; for a repeated ``node_id`` the generated node wins."""
    return merge_grids(grid, manual)


def grid_from_nodes(manual: DataFrame) -> DataFrame:
    """Grid of manual nodes only, one per ``node_id``."""
    return merge_grids(manual)


def encode_grid(grid: DataFrame) -> DataFrame:
    """The published form: ``node_id, geometry`` (WKB)."""
    return decode_points(grid).select("node_id", point_wkb("lon", "lat").alias("geometry"))


def make_grid(
    spark: SparkSession,
    hull: DataFrame | None = None,
    bbox: Box | None = None,
    manual: DataFrame | None = None,
    spacing_km: float | None = DEFAULT_SPACING_KM,
    prefix: str | None = None,
    buffer_km: float = 0.0,
) -> DataFrame:
    """``node_id, geometry`` from a footprint, a box, manual nodes, or one of the first two plus manual nodes."""
    if hull is not None:
        if prefix is None or spacing_km is None:
            raise ValueError("a footprint grid needs a spacing and a prefix")
        grid = build_grid_in_hull(spark, hull, spacing_km, prefix, buffer_km)
    elif manual is not None and prefix is None and bbox is None:
        return encode_grid(grid_from_nodes(manual))
    else:
        missing = [name for name, v in (("bbox", bbox), ("spacing_km", spacing_km), ("prefix", prefix)) if v is None]
        if missing:
            raise ValueError("grid generation needs " + ", ".join(missing))
        grid = build_grid(spark, bbox, spacing_km, prefix)
    return encode_grid(add_nodes(grid, manual) if manual is not None else grid)
