"""Rows of a point table that cannot enter statistics, counted by reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.functions.wkb import decode_points, is_finite, is_whole_point

# Why a row drops out. A row counts under the first that applies to it.
FAULTS = ("missing_geometry", "unreadable_geometry", "non_finite", "missing_key")


def point_fault(points: DataFrame, keys: Sequence[str] = (), geometry: str = "geometry") -> Column:
    """One of ``FAULTS``, or NULL for a row that takes part. ``points`` has ``lon`` and ``lat``.

    Without a geometry column, a missing coordinate is a missing geometry. A WKB point whose coordinates are not numbers
    (an empty point) is not finite; other kinds of geometry and broken ones are unreadable.
    """
    lon, lat = F.col("lon"), F.col("lat")
    located = lon.isNotNull() & lat.isNotNull()
    if geometry in points.columns:
        missing = F.col(f"`{geometry}`").isNull()
        text = isinstance(points.schema[geometry].dataType, T.StringType)
        empty = F.lit(False) if text else F.coalesce(is_whole_point(F.col(f"`{geometry}`")), F.lit(False))
    else:
        missing, empty = ~located, F.lit(False)
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(f"`{key}`").isNull()
    return (
        F.when(missing, FAULTS[0])
        .when(~located & ~empty, FAULTS[1])
        .when(~located | ~is_finite(lon) | ~is_finite(lat), FAULTS[2])
        .when(keyless, FAULTS[3])
    )


def _counts(fault: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(fault == name, F.lit(False))).alias(name) for name in FAULTS]]


def count_faults(
    points: DataFrame, keys: Sequence[str] = (), by: Sequence[str] = (), geometry: str = "geometry"
) -> DataFrame:
    """``by``, ``rows`` and a count for each fault, as a query of its own."""
    located = decode_points(points, geometry)
    marked = located.withColumn("_fault", point_fault(located, keys, geometry))
    return marked.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*_counts(F.col("_fault")))


def observe_faults(
    points: DataFrame, observation: Observation, keys: Sequence[str] = (), geometry: str = "geometry"
) -> DataFrame:
    """``points`` with ``lon`` and ``lat``; the first action that reads it fills ``observation`` with the same counts.

    No pass over the rows is added. As with any observed metric, a task that Spark runs again after an executor is lost may
    count its rows again; ``count_faults`` does not.
    """
    located = decode_points(points, geometry)
    marked = located.withColumn("_fault", point_fault(located, keys, geometry))
    return marked.observe(observation, *_counts(F.col("_fault"))).drop("_fault")
