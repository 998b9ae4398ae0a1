"""Results that must be whole and right where inputs are mixed, repeated, broken or many."""

import datetime
import struct

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridstats.functions.text import utc_time
from gridstats.functions.wkb import decode_points
from gridstats.operators.aggregate import aggregate_grid, group_stats
from gridstats.operators.grid import grid_from_nodes
from gridstats.operators.hull import convex_hull
from gridstats.operators.link import link_to_grid
from gridstats.plans import sizing, skew
from gridstats.sources import files, finalise, geojson, nodes, stac


def point(x, y, order="<", code=1, srid=None, extra=()):
    head = struct.pack("b", 1 if order == "<" else 0) + struct.pack(order + "I", code | (0x20000000 if srid else 0))
    return head + (struct.pack(order + "I", srid) if srid else b"") + struct.pack(order + f"{2 + len(extra)}d", x, y, *extra)


@pytest.mark.parametrize("engine", ["native", "arrow"])
def test_decoders_agree_on_all_forms_of_points(spark, engine):
    inf = float("inf")
    values = [
        (point(-9.5, 42.5), (-9.5, 42.5)),
        (point(-9.5, 42.5, ">"), (-9.5, 42.5)),
        (point(-9.5, 42.5, srid=4326), (-9.5, 42.5)),
        (point(-9.5, 42.5, ">", srid=4326), (-9.5, 42.5)),
        (point(1.5, 2.5, code=1001, extra=(9.0,)), (1.5, 2.5)),
        (point(1.5, 2.5, code=0x80000001, extra=(9.0,)), (1.5, 2.5)),
        (point(inf, 1.0), (None, None)),
        (point(1.0, -inf), (None, None)),
        (point(float("nan"), 1.0), (None, None)),
        (point(1.0, 2.0, srid=4326)[:22], (None, None)),
        (point(1.0, 2.0)[:20], (None, None)),
        (point(1.0, 2.0, code=2), (None, None)),
        (b"", (None, None)),
        (None, (None, None)),
        (b"\x07" + point(1.0, 2.0)[1:], (None, None)),
    ]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, (v, _) in enumerate(values)], "i int, geometry binary")
    found = {r["i"]: (r["lon"], r["lat"]) for r in decode_points(df, engine=engine).collect()}
    assert [found[i] for i in range(len(values))] == [want for _, want in values]


def test_first_row_of_a_node_file_wins(spark, tmp_path):
    path = tmp_path / "nodes.csv"
    path.write_text("node_id,longitude,latitude\nX,5.0,1\nY,2.0,2\nX,1.0,3\nY,,\n")
    rows = {r["node_id"]: (r["lon"], r["lat"]) for r in grid_from_nodes(nodes.read_nodes_csv(spark, str(path))).collect()}
    assert rows == {"X": (5.0, 1.0), "Y": (2.0, 2.0)}


def test_grid_rows_that_repeat_count_once(spark):
    points = spark.createDataFrame([(1, "a", 0.0, 0.0, 1.0), (2, "a", 0.01, 0.0, 3.0)], "rowid long, timestamp string, lon double, lat double, v double")
    grid = spark.createDataFrame([("n", 0.0, 0.0)] * 3, "node_id string, lon double, lat double")
    assert link_to_grid(points, grid, 10).count() == link_to_grid(points, grid, 10, broadcast_grid=False, hot_rows=1).count() == 2
    for links in (None, link_to_grid(points, grid, 10)):
        row = aggregate_grid(points, links, grid, "v").collect()
        assert [(r["n"], r["v_n"], r["v_mean"]) for r in row] == [(2, 2, 2.0)]


def test_date_text_is_midnight_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # this day has no midnight there
        df = spark.createDataFrame([("2018-11-04",)], "t string")
        assert df.select(utc_time(F.col("t"), df.schema["t"].dataType)).first()[0] == datetime.datetime(2018, 11, 4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_geometry_collections_come_back(spark, tmp_path):
    parts = spark.createDataFrame(
        [([[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 1.0}, {"x": 0.0, "y": 0.0}]],), ([[{"x": 5.0, "y": 5.0}] * 2],)],
        "rings array<array<struct<x:double,y:double>>>",
    )
    geojson.write_geojson(parts, str(tmp_path / "g"))
    back = geojson.read_geojson(spark, str(tmp_path / "g")).collect()
    assert sorted(map(str, back)) == sorted(map(str, parts.collect()))
    (tmp_path / "bad.json").write_text('{"type":"Feature","geometry":{"type":"Circle","coordinates":[1,2]}}')
    with pytest.raises(Exception, match="unknown GeoJSON geometry type: Circle"):
        geojson.read_geojson(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "none.json").write_text('{"type":"Feature","geometry":null}')
    assert geojson.read_geojson(spark, str(tmp_path / "none.json")).count() == 0


def test_files_of_one_folder_unite_their_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    wkb = pa.array([point(1.0, 2.0)], pa.binary())
    pq.write_table(pa.table({"geometry": wkb, "v": [1]}), tmp_path / "in" / "a.parquet")
    pq.write_table(pa.table({"extra": ["x"], "v": pa.array([2], pa.int32()), "geometry": wkb}), tmp_path / "in" / "b.parquet")
    done = finalise.consolidate_files(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
    assert [(r["sources"], r["rows"]) for r in done] == [(2, 2)]
    table = pq.read_table(tmp_path / "out" / "data.parquet")
    assert table.column_names == ["geometry", "v", "extra"]
    assert table.select(["v", "extra"]).to_pylist() == [{"v": 1, "extra": None}, {"v": 2, "extra": "x"}]


def test_unreadable_and_broken_files_are_errors(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    pq.write_table(pa.table({"v": [1]}), folder / "a.parquet")
    (folder / "notes.txt").write_text("not a table at all, just some text")
    assert files.parquet_inventory(spark, str(folder)).count() == 1
    (folder / "b.parquet").write_bytes(b"PAR1" + b"\x01" * 40 + b"PAR1")
    with pytest.raises(Exception, match="(?i)parquet|thrift|footer"):
        files.parquet_inventory(spark, str(folder)).collect()


def test_each_file_gives_its_times_with_its_own_types(spark, tmp_path):
    (tmp_path / "in").mkdir()
    day = datetime.datetime(2024, 1, 2, 3)
    tables = {
        "a": pa.table({"timestamp": pa.array([day], pa.timestamp("us", "UTC"))}),
        "b": pa.table({"time": pa.array(["2024-02-01T00:00:00Z", "bad", "2024-03-01T00:00:00+01:00"])}),
        "c": pa.table({"timestamp": pa.array(["2024-05-06", None])}),
        "d": pa.table({"date": pa.array([day.date()], pa.date32()), "v": [1]}),
    }
    for name, table in tables.items():
        pq.write_table(table, tmp_path / "in" / f"{name}.parquet")
    found = {r["rel"][0]: (r["start_time"], r["end_time"]) for r in stac.read_assets(spark, str(tmp_path / "in")).collect()}
    utc = lambda *a: datetime.datetime(*a)
    assert found == {
        "a": (day, day),
        "b": (utc(2024, 2, 1), utc(2024, 2, 29, 23)),
        "c": (utc(2024, 5, 6), utc(2024, 5, 6)),
        "d": (utc(2024, 1, 2), utc(2024, 1, 2)),
    }


@pytest.mark.parametrize("limit", [3, 100])
def test_pinned_jobs_run_once(spark, limit):
    ran = spark.sparkContext.accumulator(0)

    def work(batches):
        for batch in batches:
            ran.add(len(batch))
            yield batch

    done = sizing.pin(spark.range(8).mapInPandas(work, "id long"), max_rows=limit)
    assert done.count() == 8 and done.count() == 8 and ran.value == 8


def test_local_scratch_is_for_local_sessions_only(monkeypatch):
    class Session:
        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sizing.checkpoint_folder(Session)


@pytest.mark.parametrize("broadcast", [True, False])
def test_any_number_of_hot_groups_is_split(spark, monkeypatch, broadcast):
    if not broadcast:  # as if the list of hot keys were too long to send
        monkeypatch.setattr(skew, "broadcast_if_small", lambda df, *_: df)
    rows = spark.range(3000).select((F.col("id") % 60).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") * 37 % 101).cast("double").alias("v"))
    shown = [F.round(c, 9).alias(c) for c in ("k", "n", "v_mean", "v_median", "v_stddev", "v_min", "v_max", "v_n", "v_mad")]
    plain = group_stats(rows, ["k"], ["v"], hot_rows=None).select(*shown).orderBy("k").collect()
    assert group_stats(rows, ["k"], ["v"], hot_rows=20).select(*shown).orderBy("k").collect() == plain
    small = spark.createDataFrame([(k, -k) for k in range(60)], "k long, w long")
    assert skew.skew_join(rows, small, ["k"], ["v"], min_rows=9).count() == 3000


def test_hulls_of_many_groups(spark):
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("g"), F.sin("id").alias("lon"), F.cos(F.col("id") * 3).alias("lat"))
    hulls = convex_hull(rows, ["g"])
    assert hulls.count() == 20_000
    rng = np.random.default_rng(1)
    cloud = spark.createDataFrame(rng.standard_normal((3000, 2)).tolist(), "lon double, lat double")
    ring = convex_hull(cloud).first()["rings"][0]
    xy = np.array([[p["x"], p["y"]] for p in ring])
    points = np.array(cloud.collect())
    for a, b in zip(xy, xy[1:], strict=False):
        assert ((b[0] - a[0]) * (points[:, 1] - a[1]) - (b[1] - a[1]) * (points[:, 0] - a[0]) >= -1e-9).all()


def test_store_paths_in_the_spelling_of_arrow():
    assert files.store_uri("s3a://bucket/a/b") == files.store_uri("s3n://bucket/a/b") == "s3://bucket/a/b"
    assert files.store_uri("wasbs://box@acct.blob.core.windows.net/a") == "abfss://box@acct.dfs.core.windows.net/a"
    assert files.store_uri("gs://bucket/a") == "gs://bucket/a" and files.store_uri("hdfs://host/a") == "hdfs://host/a"
