"""Distances, windows, circular statistics and line-of-sight factors as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridstats.constants import (
    EARTH_RADIUS_M,
    KM_PER_DEGREE_LAT,
    KM_PER_DEGREE_LON,
    RHO_FLOOR,
)


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres on the mean sphere (stable ``atan2`` form)."""
    return arc_m(
        F.sin(F.radians(lat1)), F.cos(F.radians(lat1)),
        F.sin(F.radians(lat2)), F.cos(F.radians(lat2)),
        F.radians(lon2 - lon1),
    )


def arc_m(sin1: Column, cos1: Column, sin2: Column, cos2: Column, dlon: Column) -> Column:
    """The same from ready sines and cosines of the latitudes, so a join computes them once per row."""
    cos_d, sin_d = F.cos(dlon), F.sin(dlon)
    a = cos2 * sin_d
    b = cos1 * sin2 - sin1 * cos2 * cos_d
    return F.atan2(F.sqrt(a * a + b * b), sin1 * sin2 + cos1 * cos2 * cos_d) * EARTH_RADIUS_M


def window_lat(radius_km: float) -> float:
    """Half height of the link window, degrees."""
    return radius_km / KM_PER_DEGREE_LAT


def window_lon(radius_km: float, lat: Column) -> Column:
    """Half width of the link window at ``lat``, degrees; unbounded at a pole."""
    scale = KM_PER_DEGREE_LON * F.cos(F.radians(lat))
    return F.when(scale == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(radius_km), scale))


def sin_cos(angle: Column, magnitude: Column | None = None) -> tuple[Column, Column]:
    """Sine and cosine of an angle in degrees, times a magnitude when given."""
    s, c = F.sin(F.radians(angle)), F.cos(F.radians(angle))
    return (s, c) if magnitude is None else (s * magnitude, c * magnitude)


def angle_deg(sin: Column, cos: Column) -> Column:
    """Direction of a (sin, cos) pair in degrees, in (-180, 180]."""
    return F.degrees(F.atan2(sin, cos))


def dispersion(sin: Column, cos: Column, weight: Column | None = None) -> Column:
    """Circular dispersion ``sqrt(-2 ln rho)`` in radians, ``rho`` = resultant length in [1e-9, 1].

    Unweighted: NULL components give NULL. Weighted: ``rho`` is divided by ``weight`` and a missing
    or zero weight counts as ``rho`` = 0.
    """
    length = F.sqrt(sin * sin + cos * cos)
    if weight is not None:
        length = F.coalesce(F.try_divide(length, weight), F.lit(0.0))
    rho = F.least(F.greatest(length, F.lit(RHO_FLOOR)), F.lit(1.0))
    # abs() turns the -0.0 of rho = 1 into 0.0
    return F.when(length.isNotNull(), F.sqrt(F.abs(-2.0 * F.ln(rho))))


def projection_factor(
    lon: Column, lat: Column, node_lon: Column, node_lat: Column, point_lon: float, point_lat: float
) -> Column:
    """Cosine between (point - data) and (point - node) in plain degrees.

    NULL where the data point or the node is the reference point itself.
    """
    ux, uy = F.lit(float(point_lon)) - lon, F.lit(float(point_lat)) - lat
    vx, vy = F.lit(float(point_lon)) - node_lon, F.lit(float(point_lat)) - node_lat
    norm = F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy)
    return F.when(norm != 0, F.try_divide(ux * vx + uy * vy, norm))
