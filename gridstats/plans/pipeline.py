"""All stages in one call: footprint, grid inside it, pairing and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gridstats.constants import DEFAULT_RADIUS_KM, DEFAULT_SPACING_KM
from gridstats.operators.aggregate import aggregate_grid
from gridstats.operators.grid import build_grid_in_hull
from gridstats.operators.hull import combine_hulls, convex_hull


def footprint_statistics(
    points: DataFrame,
    by: Sequence[str],
    columns: Sequence[str] | str,
    operation: str = "union",
    spacing_km: float = DEFAULT_SPACING_KM,
    prefix: str = "G",
    buffer_km: float = 0.0,
    radius_km: float = DEFAULT_RADIUS_KM,
    **options,
) -> DataFrame:
    """Statistics on a lattice inside the combined hull of the ``by`` groups.

    The points are read twice: for the hulls, and once more straight into the groups.
    """
    footprint = combine_hulls(convex_hull(points, by), operation)
    grid = build_grid_in_hull(points.sparkSession, footprint, spacing_km, prefix, buffer_km)
    return aggregate_grid(points, None, grid, columns, radius_km=radius_km, **options)
