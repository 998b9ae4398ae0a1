"""Footprints as GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.functions.polygon import xy
from gridstats.sources.tables import guard_target

# Fixed value: the crs member of a written collection.
_CRS = "EPSG:4326"


def _to_ring(points: Column) -> Column:
    return F.transform(points, lambda p: xy(p[0], p[1]))


def _closed_line(points: Column) -> Column:
    """A line there and back, the ring form of a degenerate footprint."""
    there = _to_ring(points)
    return F.concat(there, F.slice(F.reverse(there), 2, F.size(there) - 1))


def _parts(kind: Column, coordinates: Column) -> Column:
    """Raw GeoJSON coordinates to an array of parts, each an array of rings."""

    def parsed(depth: int) -> Column:
        return F.from_json(coordinates, "array<" * depth + "double" + ">" * depth)

    polygon = F.array(F.transform(parsed(3), _to_ring))
    multi = F.transform(parsed(4), lambda part: F.transform(part, _to_ring))
    point = F.array(F.array(_to_ring(F.array(parsed(1), parsed(1)))))
    points = F.transform(parsed(2), lambda p: F.array(_to_ring(F.array(p, p))))
    line = F.array(F.array(_closed_line(parsed(2))))
    lines = F.transform(parsed(3), lambda part: F.array(_closed_line(part)))
    return (
        F.when(kind == "Polygon", polygon)
        .when(kind == "MultiPolygon", multi)
        .when(kind == "Point", point)
        .when(kind == "MultiPoint", points)
        .when(kind == "LineString", line)
        .when(kind == "MultiLineString", lines)
        .otherwise(F.raise_error(F.concat(F.lit("unknown GeoJSON geometry type: "), F.coalesce(kind, F.lit("none")))))
    )


def read_geojson(spark: SparkSession, path: str, features: str = "first") -> DataFrame:
    """Polygon parts (``rings``) of a Geometry, a Feature or a FeatureCollection.

    ``features="first"`` takes the first feature of a collection (grids), ``"all"`` every feature (maps). A feature
    without geometry has no parts. Members of a GeometryCollection count as parts; an unknown type is an error.
    """
    if features not in ("first", "all"):
        raise ValueError("features must be 'first' or 'all'")
    member = "struct<type:string,coordinates:string>"
    shape = f"struct<type:string,coordinates:string,geometries:array<{member}>>"
    text = spark.read.text(path, wholetext=True)
    document = F.from_json(
        "value",
        f"struct<type:string,coordinates:string,geometries:array<{member}>,geometry:{shape},features:array<struct<geometry:{shape}>>>",
    )
    own = F.struct(*[F.col(f"d.{name}").alias(name) for name in ("type", "coordinates", "geometries")])
    members = F.transform("d.features", lambda f: f["geometry"])
    shapes = (
        F.when(F.col("d.features").isNotNull(), members if features == "all" else F.slice(members, 1, 1))
        .when((F.col("d.type") == "Feature") | F.col("d.geometry").isNotNull(), F.array("d.geometry"))
        .otherwise(F.array(own))
    )
    geometries = text.select(document.alias("d")).select(F.explode(shapes).alias("g")).where("g is not null")
    plain = F.struct(F.col("g.type").alias("type"), F.col("g.coordinates").alias("coordinates"))
    single = F.when(F.col("g.type") == "GeometryCollection", F.col("g.geometries")).otherwise(F.array(plain))
    geometries = geometries.select(F.explode(single).alias("g"))
    parts = geometries.select(F.explode(_parts(F.col("g.type"), F.col("g.coordinates"))).alias("rings"))
    return parts.where(F.size("rings") > 0)


def geojson_document(polygons: DataFrame) -> DataFrame:
    """One row, ``value``: a FeatureCollection with one feature.

    One part gives its own type (Polygon, or Point / LineString when degenerate). Several parts give a
    MultiPolygon that lists the parts as they are, overlaps included; degenerate parts next to others make
    a GeometryCollection. No part gives an empty GeometryCollection.
    """

    def pairs(ring: Column) -> Column:
        return F.transform(ring, lambda p: F.array(p["x"], p["y"]))

    first = F.col("rings")[0]
    size = F.size(first)
    geometry = (
        F.when(size == 2, F.to_json(F.struct(F.lit("Point").alias("type"), pairs(first)[0].alias("coordinates"))))
        .when(
            size == 3,
            F.to_json(F.struct(F.lit("LineString").alias("type"), F.slice(pairs(first), 1, 2).alias("coordinates"))),
        )
        .otherwise(
            F.to_json(F.struct(F.lit("Polygon").alias("type"), F.transform("rings", pairs).alias("coordinates")))
        )
    )
    rows = polygons.select(
        geometry.alias("g"), F.to_json(F.transform("rings", pairs)).alias("c"), (size > 3).alias("area"), first.alias("k")
    )
    # a footprint has few parts: one per table, or a buffer's edges and corners
    one = rows.agg(F.array_sort(F.collect_list(F.struct("k", "g", "c", "area"))).alias("all"))
    everything = F.col("all")
    joined = F.array_join(F.transform(everything, lambda p: p["c"]), ",")
    shape = (
        F.when(F.size(everything) == 1, everything[0]["g"])
        .when(
            (F.size(everything) > 1) & F.forall(everything, lambda p: p["area"]),
            F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), joined, F.lit("]}")),
        )
        .otherwise(
            F.concat(
                F.lit('{"type":"GeometryCollection","geometries":['),
                F.array_join(F.transform(everything, lambda p: p["g"]), ","),
                F.lit("]}"),
            )
        )
    )
    head = '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":'
    tail = ',"properties":{}}],"crs":{"type":"name","properties":{"name":"' + _CRS + '"}}}'
    return one.select(F.concat(F.lit(head), shape, F.lit(tail)).alias("value"))


def write_geojson(polygons: DataFrame, path: str) -> None:
    """Write the footprint document into the folder ``path`` (one text part; ``read_geojson`` reads it back)."""
    geojson_document(polygons).coalesce(1).write.mode("overwrite").text(guard_target(path))
