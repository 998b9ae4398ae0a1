"""Bounding boxes and geometry types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.functions.wkb import geometry_bounds, is_finite

BOX = ("minx", "miny", "maxx", "maxy")


def box_columns(minx: Column, miny: Column, maxx: Column, maxy: Column) -> list[Column]:
    return [F.min(minx).alias("minx"), F.min(miny).alias("miny"), F.max(maxx).alias("maxx"), F.max(maxy).alias("maxy")]


def extent(df: DataFrame, by: Sequence[str] = (), geometry: str = "geometry") -> DataFrame:
    """``minx, miny, maxx, maxy`` of all finite geometries, per group when ``by`` is given.

    Uses ``lon`` / ``lat`` columns when the frame has them, else the geometry column (WKB or WKT, any type).
    """
    group = [F.col(f"`{c}`") for c in by]
    if "lon" in df.columns and "lat" in df.columns:
        finite = df.where(is_finite(F.col("lon")) & is_finite(F.col("lat")))
        lon, lat = F.col("lon"), F.col("lat")
        return finite.groupBy(*group).agg(*box_columns(lon, lat, lon, lat))
    boxed = geometry_bounds(df.select(*group, F.col(f"`{geometry}`").alias("_geometry")), "_geometry", "_box")
    sides = [F.col(f"_box.{s}") for s in BOX]
    for side in sides:
        boxed = boxed.where(is_finite(side))
    return boxed.groupBy(*group).agg(*box_columns(*sides))


def geometry_types(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row, ``types``: the sorted distinct geometry type names of all readable geometries."""
    named = geometry_bounds(df.select(F.col(f"`{geometry}`").alias("_geometry")), "_geometry", "_box")
    # at most seven names, so the set per task stays tiny
    return named.agg(F.array_sort(F.collect_set(F.col("_box.kind"))).alias("types"))
