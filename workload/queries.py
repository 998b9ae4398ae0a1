"""One query per operator, all over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridstats.constants import DEFAULT_RADIUS_KM
from gridstats.functions.geo import great_circle_m
from gridstats.functions.polygon import edge_sums
from gridstats.functions.text import rfc3339, utc_time
from gridstats.functions.utm import utm_forward, utm_inverse, utm_zone
from gridstats.functions.wkb import decode_points, geometry_type, point_wkb, wkb_x, wkb_y
from gridstats.operators import aggregate, clip, dedupe, extent, faults, hull, link
from gridstats.operators import grid as grids
from gridstats.plans import tables as runs
from gridstats.plans.pipeline import footprint_statistics
from gridstats.plans.sizing import checkpoint_folder, spill
from gridstats.sources import changes, files, finalise, geojson, nodes, stac, tables
from workload.points import (
    POINT_LAT,
    POINT_LON,
    box_of,
    customer_nodes,
    events,
    global_nodes,
    global_points,
    grid,
    points,
    scattered,
    supplier_nodes,
    triangle,
    wkb_points,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounded doubles, no negative zero, dates as text and point geometry as coordinates, for comparison across engines."""
    columns = []
    for name, kind in df.dtypes:
        value = F.col(f"`{name}`")
        if kind == "double":
            columns.append((F.round(value, digits) + F.lit(0.0)).alias(name))
        elif kind == "date":
            columns.append(value.cast("string").alias(name))
        elif kind == "int":
            columns.append(value.cast("long").alias(name))
        elif kind == "binary":
            sides = zip(("lon", "lat"), (wkb_x(value), wkb_y(value)), strict=True)
            columns += [(F.round(side, digits) + F.lit(0.0)).alias(f"{name}_{axis}") for axis, side in sides]
        else:
            columns.append(value)
    return df.select(*columns)


def scratch(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint location."""
    return f"{checkpoint_folder(spark).rstrip('/')}/work-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- link


@query
def link_within_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.link_to_grid(points(spark, sf_dir), grid(spark), DEFAULT_RADIUS_KM)


@query
def link_shuffled_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout for grids beyond a broadcast, with hot cells salted."""
    return link.link_to_grid(points(spark, sf_dir), grid(spark), DEFAULT_RADIUS_KM, broadcast_grid=False, hot_rows=60)


@query
def link_without_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.link_to_grid(points(spark, sf_dir), grid(spark), DEFAULT_RADIUS_KM, strict_window=False)


@query
def link_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.link_to_grid(global_points(spark, sf_dir), global_nodes(spark), 150.0)


@query
def link_global_without_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.link_to_grid(global_points(spark, sf_dir), global_nodes(spark), 150.0, strict_window=False)


@query
def band_join_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.band_join(points(spark, sf_dir), grid(spark), DEFAULT_RADIUS_KM)


@query
def preview_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.sample_first(link_within_radius(spark, sf_dir), 10, ["rowid", "node_id"])


@query
def great_circle_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = points(spark, sf_dir)
    metres = great_circle_m(F.col("lat"), F.col("lon"), F.lit(POINT_LAT), F.lit(POINT_LON))
    return tidy(here.select("rowid", metres.alias("metres")), 3)


# ---------------------------------------------------------------- aggregate


@query
def agg_grid_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    here, nodes = points(spark, sf_dir), grid(spark)
    return tidy(aggregate.aggregate_grid(here, link.link_to_grid(here, nodes), nodes, "speed,temp"))


@query
def agg_grid_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No link table: points and nodes are paired on the way into the groups."""
    return tidy(aggregate.aggregate_grid(points(spark, sf_dir), None, grid(spark), "speed,temp"))


@query
def agg_grid_hot_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for groups too large for one task, forced on ordinary groups."""
    return tidy(aggregate.aggregate_grid(points(spark, sf_dir), None, grid(spark), "speed,temp", hot_rows=9))


@query
def agg_grid_disc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(aggregate.aggregate_grid(points(spark, sf_dir), None, grid(spark), "speed,temp", median="disc"))


@query
def agg_grid_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(aggregate.aggregate_grid(points(spark, sf_dir), None, grid(spark), "speed,temp", median="approx"))


@query
def agg_grid_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(aggregate.aggregate_grid(points(spark, sf_dir), None, grid(spark), "speed,temp", partition_by="station"))


@query
def agg_grid_wkb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary geometry on both sides, as the tables store it."""
    nodes = grids.encode_grid(grid(spark))
    return tidy(aggregate.aggregate_grid(wkb_points(spark, sf_dir), None, nodes, "speed"))


@query
def median_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(aggregate.with_mad(points(spark, sf_dir), ["timestamp", "station"], ["speed", "temp"]))


@query
def median_deviation_few_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five groups hold all rows; each is split."""
    return tidy(aggregate.with_mad(points(spark, sf_dir), ["station"], ["speed", "temp"], hot_rows=50))


@query
def agg_direction_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(aggregate.aggregate_direction(points(spark, sf_dir), None, grid(spark), "speed,dir", "dir"))


@query
def agg_direction_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(aggregate.aggregate_direction(points(spark, sf_dir), None, grid(spark), "temp", "dir", "speed"))


@query
def agg_direction_skip_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = points(spark, sf_dir).withColumn("dir2", F.pmod(F.col("dir") * 2 + 15, F.lit(360.0)))
    return tidy(
        aggregate.aggregate_direction(
            here, None, grid(spark), "speed,dir2,dir", "dir,dir2", "SKIP,speed", partition_by="station"
        )
    )


@query
def agg_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(
        aggregate.aggregate_projection(
            points(spark, sf_dir), None, grid(spark), "speed,temp", "speed", POINT_LAT, POINT_LON
        )
    )


# ---------------------------------------------------------------- geometry


@query
def wkb_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(decode_points(wkb_points(spark, sf_dir)).select("rowid", "lon", "lat"), 9)


@query
def wkb_decode_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = wkb_points(spark, sf_dir)
    return tidy(here.select("rowid", wkb_x("geometry").alias("lon"), wkb_y("geometry").alias("lat")), 9)


@query
def wkb_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hex text to binary to coordinates and back to hex."""
    text = wkb_points(spark, sf_dir).select("rowid", F.hex("geometry").alias("text"))
    decoded = decode_points(text.withColumn("geometry", F.unhex("text")))
    again = decoded.withColumn("again", F.hex(point_wkb("lon", "lat")))
    return again.select("rowid", (F.col("again") == F.col("text")).cast("long").alias("same"))


@query
def wkt_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("POINT ("), F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"), F.lit(")"))
    here = points(spark, sf_dir).select("rowid", text.alias("geometry"))
    return tidy(decode_points(here).select("rowid", "lon", "lat"), 9)


@query
def geometry_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = wkb_points(spark, sf_dir)
    return here.groupBy(geometry_type(F.col("geometry")).alias("kind")).agg(F.count("*").alias("n"))


@query
def geometry_type_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = extent.geometry_types(wkb_points(spark, sf_dir))
    return types.select(F.array_join("types", ",").alias("types"))


@query
def extent_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(extent.extent(wkb_points(spark, sf_dir), ["station"]), 9)


@query
def distinct_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(dedupe.distinct_points(points(spark, sf_dir), ["station"]), 9)


@query
def utm_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = points(spark, sf_dir).select("rowid", "lon", "lat", utm_zone(F.col("lon")).alias("zone"))
    return tidy(utm_forward(here, F.col("zone"), F.col("lat") < 0).select("rowid", "zone", "x", "y"), 4)


@query
def utm_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = points(spark, sf_dir).select("rowid", "lon", "lat")
    back = utm_inverse(utm_forward(here, 29).drop("lon", "lat"), 29)
    return tidy(back.select("rowid", "lon", "lat"), 9)


# ---------------------------------------------------------------- grids


@query
def grid_lattice_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(grids.build_grid(spark, box_of(points(spark, sf_dir)), 5.0, "N"), 7)


@query
def grid_with_manual_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lattice = grids.build_grid(spark, box_of(points(spark, sf_dir)), 10.0, "G")
    return tidy(grids.add_nodes(lattice, supplier_nodes(spark, sf_dir)), 7)


@query
def grid_manual_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = grids.make_grid(spark, manual=customer_nodes(spark, sf_dir))
    return tidy(decode_points(made).drop("geometry"), 9)


@query
def grid_in_hull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(grids.build_grid_in_hull(spark, triangle(spark, sf_dir), 5.0, "T"), 7)


@query
def grid_in_buffered_hull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(grids.build_grid_in_hull(spark, triangle(spark, sf_dir), 5.0, "T", buffer_km=12.5), 7)


@query
def merge_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(dedupe.merge_grids(grid(spark), supplier_nodes(spark, sf_dir), customer_nodes(spark, sf_dir)), 9)


@query
def first_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "event_id", "event_type", "value")
    return tidy(dedupe.dedupe_first(rows, ["user_id"], ["event_id"]))


@query
def nodes_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node file with repeated ids, written in the order of the customers and read back."""
    path = f"{scratch(spark)}/nodes"
    rows = customer_nodes(spark, sf_dir, "c_custkey").orderBy("c_custkey").coalesce(1)
    rows.select("node_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude")).write.option("header", True).csv(path)
    return tidy(decode_points(grids.make_grid(spark, manual=nodes.read_nodes_csv(spark, path))).drop("geometry"), 9)


# ---------------------------------------------------------------- footprints


def _station_hulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hull.convex_hull(scattered(spark, sf_dir), ["station"])


@query
def hull_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    hulls = _station_hulls(spark, sf_dir)
    ring = F.slice(F.col("rings")[0], 1, F.size(F.col("rings")[0]) - 1)
    corners = hulls.select("station", F.explode(ring).alias("v"))
    return tidy(corners.select("station", F.col("v.x").alias("lon"), F.col("v.y").alias("lat")), 9)


@query
def hull_union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points covered by any of the hulls of all stations."""
    shape = hull.combine_hulls(_station_hulls(spark, sf_dir), "union")
    return clip.points_in_polygons(scattered(spark, sf_dir), shape).select("rowid")


@query
def hull_union_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners of the dissolved union of the hulls of all stations."""
    shape = hull.combine_hulls(_station_hulls(spark, sf_dir), "union")
    ring = shape.select(F.explode("rings").alias("ring"))
    corners = ring.select(F.explode(F.slice(F.col("ring"), F.lit(1), F.size("ring") - 1)).alias("v"))
    return tidy(corners.select(F.col("v.x").alias("lon"), F.col("v.y").alias("lat")), 9)


@query
def hull_union_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area and centroid of the dissolved union, in square degrees."""
    shape = hull.combine_hulls(_station_hulls(spark, sf_dir), "union")
    sums = shape.select(F.explode(edge_sums(F.col("rings"))).alias("s")).agg(*[F.sum(f"s.{k}").alias(k) for k in ("a", "ax", "ay")])
    return tidy(sums.select(F.col("a").alias("area"), (F.col("ax") / F.col("a")).alias("lon"), (F.col("ay") / F.col("a")).alias("lat")), 8)


@query
def hull_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points covered by the common part of the hulls of all stations."""
    shape = hull.combine_hulls(_station_hulls(spark, sf_dir), "intersection")
    return clip.points_in_polygons(scattered(spark, sf_dir), shape).select("rowid")


@query
def hull_intersection_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = hull.combine_hulls(_station_hulls(spark, sf_dir), "intersection")
    corners = shape.select(F.posexplode(F.col("rings")[0]).alias("position", "v"))
    return tidy(corners.select("position", F.col("v.x").alias("lon"), F.col("v.y").alias("lat")), 9)


@query
def points_in_triangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = points(spark, sf_dir).select("rowid", "lon", "lat")
    return clip.points_in_polygons(here, triangle(spark, sf_dir)).select("rowid")


@query
def footprint_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined footprint as a GeoJSON document."""
    return geojson.geojson_document(hull.combine_hulls(_station_hulls(spark, sf_dir), "union"))


@query
def footprint_to_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages: hulls, footprint, lattice inside it, pairing, statistics."""
    here = points(spark, sf_dir)
    return tidy(footprint_statistics(here, ["station"], "speed,temp", spacing_km=10.0, prefix="F"))


# ---------------------------------------------------------------- tables


def _tables(spark: SparkSession, sf_dir: str, partitions: tuple[str, ...] = ("station",)) -> tuple[str, str, str]:
    """(scratch folder, point table, grid table) with names of their own."""
    base = scratch(spark)
    mark = uuid.uuid4().hex[:12]
    data, nodes_table = f"points_{mark}", f"grid_{mark}"
    tables.write_table(wkb_points(spark, sf_dir), data, f"{base}/points", partitions)
    tables.write_grid(grid(spark), nodes_table, f"{base}/grid")
    return base, data, nodes_table


@query
def links_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links from tables to a table."""
    base, data, nodes_table = _tables(spark, sf_dir)
    return runs.link_tables(spark, data, nodes_table, f"{data}_links", f"{base}/links")


@query
def statistics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned statistics from tables to a table, which is consolidated and read again."""
    base, data, nodes_table = _tables(spark, sf_dir)
    made = runs.statistics_tables(spark, data, None, nodes_table, f"{data}_stats", f"{base}/stats", ["speed", "temp"], partition_by=["station"])
    made.limit(1).collect()
    return tidy(runs.finalise_table(spark, f"{data}_stats", f"{base}/final"))


@query
def agg_grid_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and links in tables bucketed on the row id, joined bucket by bucket."""
    base, mark, many = scratch(spark), uuid.uuid4().hex[:12], 8
    tables.write_table(wkb_points(spark, sf_dir), f"points_{mark}", f"{base}/points", bucket_by=["rowid"], buckets=many)
    tables.write_grid(grid(spark), f"grid_{mark}", f"{base}/grid")
    runs.link_tables(spark, f"points_{mark}", f"grid_{mark}", f"links_{mark}", f"{base}/links", buckets=many)
    names = (f"points_{mark}", f"links_{mark}", f"grid_{mark}", f"stats_{mark}")
    return tidy(runs.statistics_tables(spark, *names, f"{base}/stats", ["speed", "temp"]))


@query
def agg_grid_repeated_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid whose rows occur twice counts as if they occurred once."""
    return tidy(aggregate.aggregate_grid(points(spark, sf_dir), None, grid(spark).union(grid(spark)), "speed,temp"))


@query
def wkb_decode_srid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that carry an SRID, by both decoders."""
    digits = F.hex("geometry")
    tagged = F.unhex(F.concat(F.lit("0101000020E6100000"), F.substring(digits, 11, 32)))
    rows = wkb_points(spark, sf_dir).select("rowid", tagged.alias("geometry"))
    both = decode_points(rows).select("rowid", "lon", "lat", wkb_x("geometry").alias("native_lon"), wkb_y("geometry").alias("native_lat"))
    return tidy(both, 9)


def _faulty_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points, of which some have no geometry, a broken one, coordinates that are no numbers, another kind, or no time."""
    n = F.col("rowid") % 13
    nowhere = point_wkb(F.lit(float("nan")), F.lit(1.0))
    kinds = (
        F.when(n == 0, None)
        .when(n == 1, F.substring("geometry", 1, 9))
        .when(n == 2, nowhere)
        .when(n == 3, F.unhex(F.lit("010200000000000000")))
        .otherwise(F.col("geometry"))
    )
    rows = wkb_points(spark, sf_dir).withColumn("geometry", kinds)
    return rows.withColumn("timestamp", F.when(F.col("rowid") % 11 != 0, F.col("timestamp")))


@query
def faults_by_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that cannot enter statistics, by reason."""
    return faults.count_faults(_faulty_points(spark, sf_dir), ["timestamp"], ["station"])


@query
def statistics_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a table with faulty rows, and the counts that the same pass gave, on every row."""
    base, mark = scratch(spark), uuid.uuid4().hex[:12]
    tables.write_table(_faulty_points(spark, sf_dir), f"points_{mark}", f"{base}/points", ["station"])
    tables.write_grid(grid(spark), f"grid_{mark}", f"{base}/grid")
    dropped = Observation("dropped")
    names = (f"points_{mark}", None, f"grid_{mark}", f"stats_{mark}", f"{base}/stats")
    made = runs.statistics_tables(spark, *names, ["speed"], dropped=dropped)
    return tidy(made.withColumns({k: F.lit(v) for k, v in dropped.get.items()}))


@query
def statistics_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a table after rows came to one partition, another went, and a third was written anew."""
    base, data, nodes_table = _tables(spark, sf_dir)
    args = (spark, data, None, nodes_table, f"{data}_stats", f"{base}/stats", ["speed", "temp"], ["station"])
    runs.refresh_statistics(*args)
    names = [r[0] for r in spark.table(data).select("station").distinct().orderBy("station").collect()]
    rows = spark.read.schema(spark.table(data).schema).parquet(f"{base}/points")
    more = spill(rows.where(F.col("station") == names[0]).where("rowid % 2 = 0").withColumn("rowid", -F.col("rowid")))
    more.write.mode("append").partitionBy("station").parquet(f"{base}/points")
    less = spill(rows.where(F.col("station") == names[1]).where("rowid % 3 = 0"))
    changes.overwrite_partitions(less, f"{base}/points", ["station"])
    changes.drop_stale(spark, data, spark.createDataFrame([(names[2],)], "station string"), ["station"])
    return tidy(runs.refresh_statistics(*args))


# ---------------------------------------------------------------- files and catalogs


def _dataset(spark: SparkSession, sf_dir: str) -> str:
    """The points as a finished dataset, one file per station."""
    base = scratch(spark)
    rows = wkb_points(spark, sf_dir).select("rowid", F.col("ts").alias("time"), "geometry", "speed", "station")
    finalise.consolidate(rows, f"{base}/data", f"{base}/staging", ["station"])
    return f"{base}/data"


@query
def consolidated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per partition folder, named after the value."""
    return files.asset_inventory(spark, _dataset(spark, sf_dir)).select("rel", "row_count")


@query
def consolidated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finished files read back."""
    back = decode_points(files.read_geoparquet(spark, _dataset(spark, sf_dir)))
    return tidy(back.select("rowid", "station", "speed", "lon", "lat"), 9)


# A box inside the points' range, for the box-pruned scans.
BOX = (-9.25, 42.2, -8.9, 42.55)


@query
def geoparquet_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in a box, from files that are ordered in space and carry each row's box."""
    base = scratch(spark)
    rows = wkb_points(spark, sf_dir).select("rowid", "geometry", "speed", "station")
    finalise.consolidate(rows, f"{base}/data", f"{base}/staging", ["station"], spatial=True)
    back = decode_points(files.read_geoparquet(spark, f"{base}/data", BOX))
    return tidy(back.select("rowid", "station", "speed", "lon", "lat"), 9)


@query
def geoparquet_in_box_without_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from files that hold geometries only."""
    back = decode_points(files.read_geoparquet(spark, _dataset(spark, sf_dir), BOX))
    return tidy(back.select("rowid", "station", "speed", "lon", "lat"), 9)


@query
def geo_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = [F.col("bbox")[k].alias(name) for k, name in enumerate(("minx", "miny", "maxx", "maxy"))]
    footers = files.geo_footers(spark, _dataset(spark, sf_dir))
    return tidy(
        footers.select("rel", "primary_column", "encoding", F.array_join("geometry_types", ",").alias("types"), *box), 9
    )


@query
def geo_footers_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    finalise.add_geo_metadata(spark, _dataset(spark, sf_dir), f"{base}/data", bbox_scope="file")
    box = [F.col("bbox")[k].alias(name) for k, name in enumerate(("minx", "miny", "maxx", "maxy"))]
    return tidy(files.geo_footers(spark, f"{base}/data").select("rel", *box), 9)


@query
def asset_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.asset_inventory(spark, _dataset(spark, sf_dir))
    types = F.array_join(F.transform("columns", lambda c: F.concat(c["name"], F.lit(":"), c["type"])), ",")
    return found.select("rel", F.array_join("partitions", "/").alias("partitions"), "row_count", types.alias("columns"))


@query
def asset_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = stac.asset_times(points(spark, sf_dir).select("station", F.col("ts").alias("time")), ["station"])
    return ranges.select("station", rfc3339(F.col("start_time")).alias("start"), rfc3339(F.col("end_time")).alias("end"))


@query
def asset_time_range_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one dataset with times under different names and types."""
    base = scratch(spark)
    rows = events(spark, sf_dir)
    n, stamp = F.col("event_id") % 3, F.col("ts")
    forms = (stamp.alias("timestamp"), rfc3339(utc_time(stamp, rows.schema["ts"].dataType)).alias("time"), stamp.cast("date").alias("date"))
    for k, form in enumerate(forms):
        rows.where(n == k).select("event_id", form).coalesce(1).write.parquet(f"{base}/data/part={k}")
    found = stac.read_assets(spark, f"{base}/data")
    ends = [rfc3339(F.col(c)).alias(c.removesuffix("_time")) for c in ("start_time", "end_time")]
    return found.select(F.element_at("partitions", 1).alias("part"), *ends, "row_count")


@query
def iso_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in the accepted text forms, and one that is not accepted."""
    n = F.col("event_id")
    stamp = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(n % 5 == 0, F.concat(stamp, F.lit("Z")))
        .when(n % 5 == 1, F.concat(stamp, F.lit("+0200")))
        .when(n % 5 == 2, F.concat(stamp, F.lit(".250000-01:30")))
        .when(n % 5 == 3, F.substring(stamp, 1, 10))
        .otherwise(stamp)
    )
    rows = events(spark, sf_dir).select("event_id", text.alias("text"))
    return rows.select("event_id", rfc3339(utc_time(F.col("text"), rows.schema["text"].dataType)).alias("time"))


@query
def stac_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    items = stac.write_stac(spark, base, "stations", source=_dataset(spark, sf_dir))
    return items.select("id", "self_path", "asset_href", "start", "end", "row_count", "primary_column")


@query
def stac_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = stac.stac_items(stac.read_assets(spark, _dataset(spark, sf_dir)))
    catalogs = stac.stac_catalogs(items)
    return catalogs.select(
        "self_path", F.array_join("children", ",").alias("children"), F.array_join("items", ",").alias("items")
    )


@query
def stac_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = stac.stac_extent(stac.read_assets(spark, _dataset(spark, sf_dir)))
    box = [F.col("bbox")[k].alias(name) for k, name in enumerate(("minx", "miny", "maxx", "maxy"))]
    return tidy(whole.select("start", "end", "row_count", *box), 9)
