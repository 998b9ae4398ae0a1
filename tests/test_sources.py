import json
import os
import struct
from datetime import date, datetime

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridstats.operators.grid import encode_grid
from gridstats.sources import files, finalise, geojson, nodes, stac, tables

RING = "rings array<array<struct<x:double,y:double>>>"
SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]


def wkb(x, y):
    return struct.pack("<BIdd", 1, 1, x, y)


def observations(spark, n=60):
    rows = [(i, wkb(i * 0.1, 40 + i * 0.01), datetime(2024, 1, 1, i % 24), i / 2, f"d{i % 3}") for i in range(n)]
    return spark.createDataFrame(rows, "rowid long, geometry binary, timestamp timestamp, v double, part string")


# ---------------------------------------------------------------- tables


def test_names_and_guards():
    assert tables.resolve_table(" t ", "db") == "db.t" and tables.resolve_table("x.t", "db") == "x.t"
    for bad in ("", " ", "/", "s3://bucket", "s3://bucket/", "file:/", "file:///", "."):
        with pytest.raises(ValueError):
            tables.guard_target(bad)
    assert tables.guard_target("s3://bucket/a/") == "s3://bucket/a" and tables.guard_target("/a/b") == "/a/b"


def test_table_round_trip(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS demo")
    path = str(tmp_path / "points")
    tables.write_table(observations(spark), "demo.points", path, ["part"])
    tables.require_tables(spark, "points", default_db="demo")
    with pytest.raises(ValueError):
        tables.require_tables(spark, "nothing", default_db="demo")
    tables.require_partitions(spark, "points", ["part"], "demo")
    with pytest.raises(ValueError):
        tables.require_partitions(spark, "points", ["v"], "demo")
    got = tables.read_points(spark, "points", ["v"], default_db="demo")
    assert got.columns == ["rowid", "geometry", "v", "lon", "lat"]
    assert tables.valid_points(got).count() == 60
    assert tables.read_points(spark, path, engine="native").where("abs(lon - rowid * 0.1) < 1e-12").count() == 60
    both = tables.read_tables(spark, ["points", path], default_db="demo")
    assert both.groupBy("source").count().count() == 2
    tables.write_table(observations(spark, 6), "demo.points", path, ["part"])
    assert spark.table("demo.points").count() == 6
    tables.repair(spark, "demo.points")


def test_grid_table_modes(spark, tmp_path):
    path = str(tmp_path / "grid")
    grid = spark.createDataFrame([("a", 1.0, 2.0)], "node_id string, lon double, lat double")
    tables.write_grid(grid, None, path)
    tables.write_grid(encode_grid(grid), None, path, "append")
    back = spark.read.parquet(path)
    assert back.columns == ["node_id", "geometry"] and back.count() == 2
    with pytest.raises(ValueError):
        tables.write_grid(grid, None, path, "merge")


def test_nodes_csv(spark, tmp_path):
    path = tmp_path / "nodes.csv"
    path.write_text("extra,node_id,longitude,latitude\nx,A,1.5,2\ny,B,-3,4e1\n")
    got = nodes.read_nodes_csv(spark, str(path)).orderBy("node_id").collect()
    assert [tuple(r)[:3] for r in got] == [("A", 1.5, 2.0), ("B", -3.0, 40.0)]
    path.write_text("node_id,longitude\nA,1\n")
    with pytest.raises(ValueError):
        nodes.read_nodes_csv(spark, str(path))


# ---------------------------------------------------------------- GeoJSON


def polygon(shift=0):
    return {"type": "Polygon", "coordinates": [[[x + shift, y] for x, y in SQUARE]]}


@pytest.mark.parametrize(
    "document, features, parts",
    [
        (polygon(), "first", 1),
        ({"type": "Feature", "properties": {"a": 1}, "geometry": polygon()}, "first", 1),
        ({"type": "FeatureCollection", "features": [{"geometry": polygon()}, {"geometry": polygon(9)}]}, "first", 1),
        ({"type": "FeatureCollection", "features": [{"geometry": polygon()}, {"geometry": polygon(9)}]}, "all", 2),
        ({"type": "MultiPolygon", "coordinates": [polygon()["coordinates"], polygon(9)["coordinates"]]}, "first", 2),
        ({"type": "LineString", "coordinates": [[0, 0], [1, 1]]}, "first", 1),
        ({"type": "Point", "coordinates": [0, 0]}, "first", 1),
    ],
)
def test_geojson_forms(spark, tmp_path, document, features, parts):
    path = tmp_path / "shape.json"
    path.write_text(json.dumps(document, indent=2))
    got = geojson.read_geojson(spark, str(path), features).collect()
    assert len(got) == parts
    first = [(p["x"], p["y"]) for p in got[0]["rings"][0]]
    assert first[0] == first[-1] == (0.0, 0.0)


def ring(*points):
    return [[{"x": float(x), "y": float(y)} for x, y in points]]


def test_geojson_documents(spark, tmp_path):
    def geometry(*shapes):
        frame = spark.createDataFrame([(s,) for s in shapes], RING)
        document = json.loads(geojson.geojson_document(frame).first()["value"])
        assert document["type"] == "FeatureCollection" and document["crs"]["properties"]["name"] == "EPSG:4326"
        return document["features"][0]["geometry"]

    one = ring(*SQUARE)
    assert geometry(one) == polygon()
    assert geometry(ring((1, 2), (1, 2))) == {"type": "Point", "coordinates": [1, 2]}
    assert geometry(ring((0, 0), (3, 3), (0, 0))) == {"type": "LineString", "coordinates": [[0, 0], [3, 3]]}
    multi = geometry(one, ring(*[(x + 9, y) for x, y in SQUARE]))
    assert multi["type"] == "MultiPolygon" and len(multi["coordinates"]) == 2
    assert geometry(one, ring((1, 2), (1, 2)))["type"] == "GeometryCollection"
    assert geometry() == {"type": "GeometryCollection", "geometries": []}
    path = str(tmp_path / "footprint")
    geojson.write_geojson(spark.createDataFrame([(one,)], RING), path)
    assert geojson.read_geojson(spark, path).first()["rings"][0][1]["x"] == 4.0


# ---------------------------------------------------------------- files


def listing(root):
    found = []
    for folder, _, names in os.walk(root):
        found += [os.path.relpath(os.path.join(folder, n), root) for n in names]
    return sorted(found)


def geo_of(path):
    return json.loads(pq.read_schema(path).metadata[b"geo"])


def test_one_file_per_partition_with_footer(spark, tmp_path):
    df = observations(spark).repartition(5)
    done = finalise.consolidate(df, str(tmp_path / "out"), str(tmp_path / "stage"), ["part"])
    assert done.agg(F.sum("rows")).first()[0] == 60
    out = tmp_path / "out"
    assert listing(out) == [f"part=d{k}/d{k}.parquet" for k in range(3)]
    stored = pq.ParquetFile(out / "part=d0/d0.parquet")
    assert "part" not in stored.schema_arrow.names
    back = spark.read.parquet(str(out))
    assert sorted(back.select(df.columns).collect()) == sorted(df.collect())
    geo = geo_of(out / "part=d1/d1.parquet")
    column = geo["columns"]["geometry"]
    assert geo["version"] == "1.1.0" and geo["primary_column"] == "geometry"
    assert (column["encoding"], column["geometry_types"]) == ("WKB", ["Point"])
    assert column["bbox"] == pytest.approx([0.0, 40.0, 5.9, 40.59]) and column["crs"]["id"]["code"] == "CRS84"
    assert "edges" not in column


def test_unpartitioned_and_split_files(spark, tmp_path):
    df = observations(spark).drop("part").repartition(6)
    df.write.parquet(str(tmp_path / "in"))
    finalise.consolidate_files(spark, str(tmp_path / "in"), str(tmp_path / "one"))
    assert listing(tmp_path / "one") == ["data.parquet"]
    finalise.consolidate_files(spark, str(tmp_path / "in"), str(tmp_path / "many"), max_rows_per_file=25)
    names = listing(tmp_path / "many")
    assert names[0] == "data-1.parquet" and "data.parquet" in names
    assert spark.read.parquet(str(tmp_path / "many")).count() == 60


@pytest.mark.parametrize("group_rows", [None, 50_000])
def test_a_merge_holds_a_bounded_part_of_a_row_group(tmp_path, group_rows):
    """Whatever the size of the source's row groups, all rows arrive in order and a task holds a fixed number of bytes."""
    stored = {n: str(tmp_path / f"{n}.parquet") for n in (600_000, 1_800_000)}
    for n, source in stored.items():
        rows = pa.array(range(n))
        place = pa.array([b"%021d" % i for i in range(n)])
        pq.write_table(pa.table({"rowid": rows, "geometry": place, "v": pc.multiply(rows, 1.5), "w": pc.sqrt(rows)}), source, row_group_size=n)
    most = {}
    before = pa.default_memory_pool()
    for n, source in stored.items():
        target, pool = str(tmp_path / f"out{n}.parquet"), pa.proxy_memory_pool(before)
        pa.set_memory_pool(pool)
        try:
            jobs = pd.DataFrame({"target": [target], "sources": [[source]], "geo": ["{}"]})
            (done,) = finalise._merge_task(iter([jobs]), group_rows)
        finally:
            pa.set_memory_pool(before)
        assert done["rows"].tolist() == [n]
        assert pq.read_table(target).replace_schema_metadata().equals(pq.read_table(source))
        meta = pq.read_metadata(target)
        sizes = [meta.row_group(g).num_rows for g in range(meta.num_row_groups)]
        assert max(sizes) * 49 <= finalise.GROUP_BYTES and max(sizes) <= (group_rows or n)
        most[n] = pool.max_memory()
    assert max(most.values()) < 3 * finalise.GROUP_BYTES and most[1_800_000] < 1.2 * most[600_000], most


def test_instants_written_as_int96_survive(spark, tmp_path):
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    try:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
        observations(spark).write.parquet(str(tmp_path / "in"))
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", before)
    finalise.consolidate_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert dict(back.dtypes)["timestamp"] == "timestamp"
    assert back.agg(F.max("timestamp")).first()[0] == datetime(2024, 1, 1, 23)


def test_later_files_are_cast_to_the_first(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    pq.write_table(pa.table({"x": pa.array([1.5]), "geometry": [wkb(0, 0)]}), tmp_path / "in" / "a.parquet")
    pq.write_table(pa.table({"geometry": [wkb(1, 1)], "x": pa.array([2], pa.int64())}), tmp_path / "in" / "b.parquet")
    finalise.consolidate_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    table = pq.read_table(tmp_path / "out" / "data.parquet")
    assert table["x"].to_pylist() == [1.5, 2.0]


def test_strays_are_ignored_and_result_folders_excluded(spark, tmp_path):
    root = tmp_path / "in"
    for folder in ("a=1", "query_results", "x_athena_results", "_temporary"):
        os.makedirs(root / folder)
        pq.write_table(pa.table({"geometry": [wkb(5, 5)]}), root / folder / "part-0")
    (root / "a=1" / "notes.txt").write_text("no parquet")
    (root / "a=1" / "empty.parquet").write_text("")
    (root / "a=1" / "SUCCESS").write_text("x")
    (root / "query_results" / "r.csv").write_text("a,b")
    found = files.parquet_inventory(spark, str(root)).collect()
    assert [(r["rel"], r["num_rows"]) for r in found] == [("a=1/part-0", 1)]
    finalise.add_geo_metadata(spark, str(root), str(tmp_path / "out"))
    assert listing(tmp_path / "out") == ["a=1/part-0"]
    assert geo_of(tmp_path / "out" / "a=1" / "part-0")["columns"]["geometry"]["bbox"] == [5, 5, 5, 5]
    with pytest.raises(ValueError):
        files.require_files(files.parquet_inventory(spark, str(root), exclude=["a=1"]).where("rel like 'a=1%'"), "x")


@pytest.mark.parametrize(
    "values, box, types",
    [
        ([None, b"junk", wkb(float("inf"), 1), wkb(1, 2)], [1, 2, 1, 2], ["Point"]),
        ([None, b"junk"], [0, 0, 0, 0], []),
    ],
)
def test_unreadable_geometries_are_skipped(spark, tmp_path, values, box, types):
    os.makedirs(tmp_path / "in")
    pq.write_table(pa.table({"geometry": pa.array(values, pa.binary())}), tmp_path / "in" / "a.parquet")
    finalise.add_geo_metadata(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    column = geo_of(tmp_path / "out" / "a.parquet")["columns"]["geometry"]
    assert (column["bbox"], column["geometry_types"]) == (box, types)


def test_text_geometry_and_missing_column(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    pq.write_table(pa.table({"shape": ["POINT (3 4)", "LINESTRING (0 0, 1 9)"]}), tmp_path / "in" / "a.parquet")
    finalise.add_geo_metadata(spark, str(tmp_path / "in"), str(tmp_path / "wkt"), geometry="shape")
    column = geo_of(tmp_path / "wkt" / "a.parquet")["columns"]["shape"]
    assert column["encoding"] == "WKT" and column["bbox"] == [0, 0, 3, 9]
    assert column["geometry_types"] == ["LineString", "Point"]
    finalise.add_geo_metadata(spark, str(tmp_path / "in"), str(tmp_path / "none"))
    assert geo_of(tmp_path / "none" / "a.parquet")["columns"]["geometry"]["bbox"] == [0, 0, 0, 0]


def test_box_per_file(spark, tmp_path):
    os.makedirs(tmp_path / "in" / "k=a b")
    pq.write_table(pa.table({"geometry": [wkb(1, 2)]}), tmp_path / "in" / "k=a b" / "a.parquet")
    pq.write_table(pa.table({"geometry": [wkb(3, 4)]}), tmp_path / "in" / "b.parquet")
    finalise.add_geo_metadata(spark, str(tmp_path / "in"), str(tmp_path / "out"), bbox_scope="file")
    got = {r["rel"]: list(r["bbox"]) for r in files.geo_footers(spark, str(tmp_path / "out")).collect()}
    assert got == {"k=a b/a.parquet": [1, 2, 1, 2], "b.parquet": [3, 4, 3, 4]}


def test_grid_file_declares_edges(spark, tmp_path):
    grid = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "node_id string, lon double, lat double")
    finalise.write_grid_file(grid, str(tmp_path / "grid"), str(tmp_path / "stage"))
    column = geo_of(tmp_path / "grid" / "data.parquet")["columns"]["geometry"]
    assert (column["orientation"], column["edges"], column["bbox"]) == ("counterclockwise", "spherical", [1, 2, 3, 4])


def test_footer_with_top_level_box(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    geo = {"primary_column": "g", "columns": {"g": {}}, "bbox": [1, 2, 3, 4]}
    table = pa.table({"g": [wkb(1, 2)]}).replace_schema_metadata({b"geo": json.dumps(geo)})
    pq.write_table(table, tmp_path / "in" / "a.parquet")
    pq.write_table(pa.table({"g": [wkb(1, 2)]}), tmp_path / "in" / "b.parquet")
    got = {r["rel"]: r for r in files.geo_footers(spark, str(tmp_path / "in")).collect()}
    assert list(got["a.parquet"]["bbox"]) == [1, 2, 3, 4] and got["b.parquet"]["bbox"] is None


# ---------------------------------------------------------------- catalogs


def put(root, rel, **columns):
    os.makedirs(os.path.dirname(f"{root}/{rel}"), exist_ok=True)
    pq.write_table(pa.table(columns), f"{root}/{rel}")


def check_links(root):
    """Every relative link of every document leads to a file."""
    for rel in listing(root):
        if not rel.endswith(".json"):
            continue
        document = json.load(open(os.path.join(root, rel)))
        hrefs = [link["href"] for link in document["links"]]
        hrefs += [asset["href"] for asset in document.get("assets", {}).values()]
        for href in hrefs:
            assert os.path.isfile(os.path.normpath(os.path.join(root, os.path.dirname(rel), href))), (rel, href)


def test_catalog(spark, tmp_path):
    source = str(tmp_path / "data")
    put(source, "a=1/b=x/x.parquet", timestamp=pa.array([datetime(2024, 1, 2), datetime(2024, 1, 5)]), v=[1, 2])
    put(source, "a=1/b=y/y.parquet", timestamp=pa.array([datetime(2024, 1, 1)]), v=[3])
    put(source, "a=2/z.parquet", timestamp=pa.array([datetime(2024, 3, 1, 0, 0, 0, 500)]), v=[4])
    put(source, "root.parquet", timestamp=pa.array([datetime(2024, 2, 1)]), v=[5])
    root = str(tmp_path / "catalog")
    items = stac.write_stac(
        spark, root, "demo", source=source, item_properties={"sensor": "s"},
        collection_properties={"license": "MIT", "description": "d", "keywords": ["k"]},
    )
    assert items.count() == 4 and os.path.isfile(f"{source}/root.parquet")
    assert [f for f in listing(root) if f.endswith(".json")] == [
        "collection.json",
        "items/a_1/catalog.json",
        "items/a_1/items/b_x/catalog.json",
        "items/a_1/items/b_x/items/a_1_b_x_x.json",
        "items/a_1/items/b_y/catalog.json",
        "items/a_1/items/b_y/items/a_1_b_y_y.json",
        "items/a_2/catalog.json",
        "items/a_2/items/a_2_z.json",
        "items/root.json",
    ]
    check_links(root)
    collection = json.load(open(f"{root}/collection.json"))
    assert collection["license"] == "MIT" and collection["keywords"] == ["k"] and collection["description"] == "d"
    assert collection["extent"]["temporal"]["interval"] == [["2024-01-01T00:00:00Z", "2024-03-01T00:00:00.000500Z"]]
    assert collection["extent"]["spatial"]["bbox"] == [[0, 0, 0, 0]]
    assert collection["table:tables"][0]["row_count"] == 5
    item = json.load(open(f"{root}/items/a_1/items/b_x/items/a_1_b_x_x.json"))
    assert item["properties"]["sensor"] == "s" and item["properties"]["end_datetime"] == "2024-01-05T00:00:00Z"
    assert item["geometry"] is None and item["collection"] == "demo"
    assert item["properties"]["table:columns"] == [
        {"name": "timestamp", "type": "datetime"},
        {"name": "v", "type": "integer"},
    ]


def test_catalog_moves_and_refuses(spark, tmp_path):
    source = str(tmp_path / "data")
    put(source, "x.parquet", date=pa.array([date(2024, 1, 2)]))
    stac.write_stac(spark, str(tmp_path / "one"), "demo", source=source, move=True)
    assert listing(source) == [] and "assets/x.parquet" in listing(tmp_path / "one")
    put(str(tmp_path / "two/assets"), "date=2024-01-01/x.parquet", v=[1])
    with pytest.raises(ValueError, match="x.parquet"):
        stac.write_stac(spark, str(tmp_path / "two"), "demo")
    put(str(tmp_path / "three/assets"), "a b.parquet", date=pa.array([date(2024, 1, 2)]))
    put(str(tmp_path / "three/assets"), "a+b.parquet", date=pa.array([date(2024, 1, 2)]))
    with pytest.raises(ValueError, match="share"):
        stac.write_stac(spark, str(tmp_path / "three"), "demo")


def test_time_candidates(spark):
    def times(schema, *rows):
        got = stac.asset_times(spark.createDataFrame([("f", *r) for r in rows], f"k string, {schema}"), ["k"]).first()
        return got["start_time"], got["end_time"]

    day = [datetime(2024, 1, d) for d in range(1, 6)]
    pair = "firstMeasurementTime timestamp_ntz, lastMeasurementTime timestamp_ntz, time timestamp_ntz"
    assert times(pair, (day[1], day[2], day[0]), (day[2], day[3], day[0])) == (day[1], day[3])
    assert times(pair, (None, day[2], day[0])) == (day[2], day[2])
    assert times(pair, (None, None, day[0])) == (day[0], day[0])
    assert times("date string", ("2024-01-02",), ("broken",), ("2024-01-01T23:00:00-0200",)) == (
        datetime(2024, 1, 2), datetime(2024, 1, 2, 1),
    )
    assert times("v int", (1,)) == (None, None)
