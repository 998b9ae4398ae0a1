import math
import random
import struct
from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.functions.geo import angle_deg, dispersion, great_circle_m, projection_factor, sin_cos
from gridstats.functions.polygon import buffer_pieces, covers, oriented
from gridstats.functions.text import arrow_type_name, item_id, partition_segments, rfc3339, utc_time
from gridstats.functions.utm import utm_forward, utm_forward_point, utm_inverse, utm_zone, utm_zone_point
from gridstats.functions.wkb import decode_points, geometry_bounds, geometry_type, point_wkb, wkb_x, wkb_y

RING = "rings array<array<struct<x:double,y:double>>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lits(*values):
    return [F.lit(v).cast("double") for v in values]


COORDINATES = [(0.0, 0.0), (-0.0, 1.5), (180.0, -90.0), (-180.0, 90.0), (5e-324, -2.2250738585072014e-308), (1e-310, 12.25)]


@pytest.mark.parametrize("engine", ["arrow", "native"])
@pytest.mark.parametrize("order", ["<", ">"])
def test_wkb_points_are_decoded_bit_for_bit(spark, engine, order):
    rng = random.Random(7)
    pairs = COORDINATES + [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200)]
    rows = [(i, struct.pack(order + "BIdd", order == "<", 1, x, y)) for i, (x, y) in enumerate(pairs)]
    df = decode_points(spark.createDataFrame(rows, "i long, geometry binary"), engine=engine)
    for row in df.collect():
        got = struct.pack("<dd", row["lon"], row["lat"])
        assert got == struct.pack("<dd", *pairs[row["i"]])


@pytest.mark.parametrize("engine", ["arrow", "native"])
def test_other_wkb_is_null(spark, engine):
    nan = float("nan")
    rows = [
        (None,),
        (b"",),
        (b"\x01\x01",),
        (struct.pack("<BIdd", 1, 1, nan, nan),),
        (struct.pack("<BIIdddd", 1, 2, 2, 0, 0, 1, 1),),
        (struct.pack("<BIdd", 1, 1, 3.0, 4.0),),
    ]
    got = decode_points(spark.createDataFrame(rows, "geometry binary").coalesce(1), engine=engine).collect()
    assert [r["lon"] for r in got] == [None] * 5 + [3.0]


def test_srid_point_is_decoded(spark):
    rows = [(struct.pack("<BIIdd", 1, 0x20000001, 4326, 3.0, 4.0),), (struct.pack("<BIdd", 1, 1, 5.0, 6.0),)]
    got = decode_points(spark.createDataFrame(rows, "geometry binary").coalesce(1)).collect()
    assert [(r["lon"], r["lat"]) for r in got] == [(3.0, 4.0), (5.0, 6.0)]


def test_native_columns_and_encoder(spark):
    df = spark.createDataFrame([(1.25, -2.5), (None, 1.0)], "lon double, lat double").coalesce(1)
    rows = df.withColumn("g", point_wkb("lon", "lat")).withColumns({"x": wkb_x("g"), "y": wkb_y("g")}).collect()
    assert bytes(rows[0]["g"]) == struct.pack("<BIdd", 1, 1, 1.25, -2.5)
    assert (rows[0]["x"], rows[0]["y"]) == (1.25, -2.5)
    assert rows[1]["g"] is None


def polygon_wkb():
    return struct.pack("<BIII", 1, 3, 1, 4) + struct.pack("<8d", 0, 0, 4, 0, 0, 3, 0, 0)


def test_geometry_headers_and_bounds(spark):
    multi = struct.pack("<BII", 1, 4, 2) + struct.pack("<BIdd", 1, 1, 1, 2) + struct.pack("<BIdd", 1, 1, 7, 8)
    z_line = struct.pack(">BII", 0, 1002, 2) + struct.pack(">6d", 0, 1, 9, 5, 6, 9)
    rows = [(1, polygon_wkb()), (2, multi), (3, z_line), (4, struct.pack("<BIdd", 1, 1, 1, 1)), (5, b"junk"), (6, None)]
    df = geometry_bounds(spark.createDataFrame(rows, "i int, geometry binary"))
    got = {r["i"]: r["bounds"] for r in df.collect()}
    assert tuple(got[1]) == (0, 0, 4, 3, "Polygon")
    assert tuple(got[2]) == (1, 2, 7, 8, "MultiPoint")
    assert tuple(got[3]) == (0, 1, 5, 6, "LineString")
    assert tuple(got[4]) == (1, 1, 1, 1, "Point")
    assert got[5]["kind"] is None and got[6]["kind"] is None
    kinds = df.where("i < 5").orderBy("i").select(geometry_type(F.col("geometry")).alias("k")).collect()
    assert [r["k"] for r in kinds] == ["Polygon", "MultiPoint", "LineString", "Point"]


def test_text_geometry(spark):
    rows = [(1, "POINT (1.5 -2e1)"), (2, "POLYGON ((0 0, 4 0, 0 3, 0 0))"), (3, "nonsense"), (4, "POINT EMPTY")]
    df = spark.createDataFrame(rows, "i int, geometry string")
    points = {r["i"]: (r["lon"], r["lat"]) for r in decode_points(df).collect()}
    assert points == {1: (1.5, -20.0), 2: (None, None), 3: (None, None), 4: (None, None)}
    boxes = {r["i"]: tuple(r["bounds"]) for r in geometry_bounds(df).collect()}
    assert boxes[2] == (0, 0, 4, 3, "Polygon") and boxes[3][-1] is None


def test_great_circle(spark):
    quarter = value(spark, great_circle_m(*lits(0, 0, 0, 90)))
    assert quarter == pytest.approx(6371010.0 * math.pi / 2)
    assert value(spark, great_circle_m(*lits(10, 20, 10, 20))) == 0.0
    assert value(spark, great_circle_m(*lits(0, 179.5, 0, -179.5))) == pytest.approx(6371010.0 * math.radians(1))


def test_circular_pieces(spark):
    s, c = sin_cos(F.lit(90.0), F.lit(2.0))
    assert value(spark, s) == pytest.approx(2.0) and value(spark, c) == pytest.approx(0.0, abs=1e-12)
    assert value(spark, angle_deg(*lits(-1, 0))) == pytest.approx(-90.0)
    none = F.lit(None).cast("double")
    assert value(spark, dispersion(none, none)) is None
    low = math.sqrt(-2 * math.log(1e-9))
    assert value(spark, dispersion(none, none, F.lit(1.0))) == pytest.approx(low)
    assert value(spark, dispersion(*lits(0, 0))) == pytest.approx(low)
    assert value(spark, dispersion(*lits(0.8, 0.6000001))) == 0.0
    assert value(spark, dispersion(*lits(3, 0, 0))) == pytest.approx(low)


def test_projection_factor(spark):
    def factor(lon, lat, node_lon, node_lat):
        return value(spark, projection_factor(*lits(lon, lat, node_lon, node_lat), 0.0, 0.0))

    assert factor(1, 1, 1, 1) == pytest.approx(1.0)
    assert factor(1, 0, 0, 1) == pytest.approx(0.0)
    assert factor(1, 0, -1, 0) == pytest.approx(-1.0)
    assert factor(0, 0, 1, 1) is None and factor(1, 1, 0, 0) is None


def test_utm_known_values_and_round_trip(spark):
    assert utm_forward_point(6.0, 0.0, 31, False)[0] == pytest.approx(833978.5569, abs=1e-3)
    assert utm_forward_point(3.0, 45.0, 31, False)[1] == pytest.approx(4982950.4002, abs=1e-3)
    rng = random.Random(3)
    rows = [(rng.uniform(-1, 7), rng.uniform(-80, 84)) for _ in range(500)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    metric = utm_forward(df, 31, F.col("lat") < 0)
    for r in metric.limit(50).collect():
        assert (r["x"], r["y"]) == pytest.approx(utm_forward_point(r["lon"], r["lat"], 31, r["lat"] < 0), abs=1e-6)
    back = utm_inverse(metric, 31, F.col("lat") < 0, lon="lon2", lat="lat2")
    gap = back.select(F.max(F.abs(F.col("lon") - F.col("lon2"))), F.max(F.abs(F.col("lat") - F.col("lat2")))).first()
    assert max(gap) < 1e-11


def test_utm_zones(spark):
    assert value(spark, utm_zone(F.lit(-9.0))) == 29
    assert value(spark, utm_zone(F.lit(-6.0))) == 30
    assert utm_zone_point(-6.0001, -1.0) == (29, True)
    with pytest.raises(ValueError):
        utm_zone_point(180.0, 0.0)


def test_covers(spark):
    square = [ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (1, 2), (2, 2), (2, 1), (1, 1))]
    cases = {
        (3, 3): True, (0, 2): True, (4, 4): True, (5, 2): False, (-1, 0): False, (2, 4): True, (2, 4.001): False,
        (1.5, 1.5): False, (1, 1.5): True, (-1, 4): False, (0, 0): True,
    }
    df = spark.createDataFrame([(square, float(x), float(y)) for x, y in cases], f"{RING}, x double, y double")
    got = {(r["x"], r["y"]): r["c"] for r in df.withColumn("c", covers(F.col("rings"), F.col("x"), F.col("y"))).collect()}
    assert got == {(float(x), float(y)): want for (x, y), want in cases.items()}


def test_degenerate_shapes_cover_themselves(spark):
    rows = [
        ([ring((1, 1), (1, 1))], 1.0, 1.0, True),
        ([ring((1, 1), (1, 1))], 0.0, 1.0, False),
        ([ring((0, 0), (2, 2), (0, 0))], 1.0, 1.0, True),
        ([ring((0, 0), (2, 2), (0, 0))], 0.5, 1.0, False),
    ]
    df = spark.createDataFrame(rows, f"{RING}, x double, y double, want boolean")
    assert df.where(covers(F.col("rings"), F.col("x"), F.col("y")) != F.col("want")).count() == 0


def _distance_to_ring(x, y, points):
    best = float("inf")
    for (ax, ay), (bx, by) in zip(points, points[1:]):
        dx, dy = bx - ax, by - ay
        t = 0 if dx == dy == 0 else max(0, min(1, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(x - ax - t * dx, y - ay - t * dy))
    return best


@pytest.mark.parametrize(
    "corners",
    [
        [(0, 0), (10, 0), (4, 8), (0, 0)],
        [(0, 0), (0, 9), (3, 3), (9, 0), (0, 0)],
        [(0, 0), (6, 2), (0, 0)],
        [(2, 2), (2, 2)],
    ],
)
def test_buffer_pieces_grow_a_shape(spark, corners):
    """Inside the exact buffer minus the chord error everything is covered, outside nothing is."""
    distance = 2.0
    shape = spark.createDataFrame([([ring(*corners)],)], RING).select(oriented(F.col("rings")).alias("rings"))
    pieces = shape.select(F.explode(F.concat(F.array("rings"), buffer_pieces(F.col("rings"), distance))).alias("rings"))
    rng = random.Random(5)
    spots = [(float(i), rng.uniform(-5, 15), rng.uniform(-5, 15)) for i in range(1500)]
    df = spark.createDataFrame(spots, "i double, x double, y double")
    hit = df.join(F.broadcast(pieces), covers(F.col("rings"), F.col("x"), F.col("y")), "left_semi")
    got = {r["i"] for r in hit.collect()}
    base = spark.createDataFrame([([ring(*corners)],)], RING)
    inner = {r["i"] for r in df.join(F.broadcast(base), covers(F.col("rings"), F.col("x"), F.col("y")), "left_semi").collect()}
    for i, x, y in spots:
        away = 0.0 if i in inner else _distance_to_ring(x, y, corners)
        if away < distance * 0.998:
            assert i in got
        if away > distance * 1.000001:
            assert i not in got


def test_times(spark):
    cases = {
        "2024-01-02T03:04:05Z": "2024-01-02T03:04:05Z",
        "2024-01-02T03:04:05.5+0100": "2024-01-02T02:04:05.500000Z",
        "2024-01-02T03:04:05-01:30": "2024-01-02T04:34:05Z",
        " 2024-01-02 ": "2024-01-02T00:00:00Z",
        "2024-01-02T03:04:05": None,
        "yesterday": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", rfc3339(utc_time(F.col("t"), T.StringType())).alias("v")).collect()}
    assert got == cases
    row = spark.createDataFrame([(date(2024, 1, 2), datetime(2024, 1, 2, 3))], "d date, n timestamp_ntz").select(
        rfc3339(utc_time(F.col("d"), T.DateType())), rfc3339(utc_time(F.col("n"), T.TimestampNTZType()))
    )
    assert tuple(row.first()) == ("2024-01-02T00:00:00Z", "2024-01-02T03:00:00Z")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    # plain, before the epoch, just before midnight, both readings of a repeated local hour, a skipped one
    instants = {
        1704164645_000000: "2024-01-02T03:04:05Z",
        -1: "1969-12-31T23:59:59.999999Z",
        1704239999_999999: "2024-01-02T23:59:59.999999Z",
        1730611800_000000: "2024-11-03T05:30:00Z",
        1730615400_000000: "2024-11-03T06:30:00Z",
        1710055800_500000: "2024-03-10T07:30:00.500000Z",
    }
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(k,) for k in instants], "m long").withColumn("t", F.timestamp_micros("m"))
        got = {r["m"]: r["v"] for r in df.select("m", rfc3339(utc_time(F.col("t"), T.TimestampType())).alias("v")).collect()}
        assert got == instants
        clock = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
        assert clock.select(rfc3339(utc_time(F.col("t"), T.TimestampNTZType()))).first()[0] == "2024-03-10T02:30:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_paths_and_ids(spark):
    rows = [("date=2024-01-01/pos=1/a b.parquet",), ("plain.parquet",), ("=x/k=/part-0",)]
    df = spark.createDataFrame(rows, "rel string").coalesce(1)
    got = df.select(partition_segments(F.col("rel")), item_id(F.col("rel"))).collect()
    assert [tuple(r) for r in got] == [
        (["date=2024-01-01", "pos=1"], "date_2024-01-01_pos_1_a_b"),
        ([], "plain"),
        ([], "_x_k__part-0"),
    ]


def test_type_names():
    kinds = [pa.int8(), pa.uint64(), pa.float16(), pa.float64(), pa.bool_(), pa.timestamp("us", "UTC"), pa.date32(), pa.binary(), pa.large_binary()]
    names = ["integer", "integer", "number", "number", "boolean", "datetime", "date", "binary", "binary"]
    assert [arrow_type_name(k) for k in kinds] == names
    others = [pa.string(), pa.list_(pa.int32()), pa.decimal128(9, 2), pa.binary(3), pa.duration("s"), pa.dictionary(pa.int8(), pa.string())]
    assert {arrow_type_name(k) for k in others} == {"string"}
