import math
import random
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridstats.functions.geo import great_circle_m
from gridstats.operators.aggregate import aggregate_direction, aggregate_grid, aggregate_projection, pair_angles, with_mad
from gridstats.operators.clip import points_in_polygons
from gridstats.operators.dedupe import dedupe_first, merge_grids, preview, sample_first
from gridstats.operators.extent import extent, geometry_types
from gridstats.operators.grid import add_nodes, build_grid, build_grid_in_hull, centroid, encode_grid, make_grid
from gridstats.operators.hull import combine_hulls, convex_hull, hull_vertices
from gridstats.operators.link import band_join, link_to_grid
from gridstats.plans.skew import hot_keys, skew_join

RING = "rings array<array<struct<x:double,y:double>>>"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def nodes(spark, *rows):
    return frame(spark, [(n, float(x), float(y)) for n, x, y in rows], "node_id string, lon double, lat double")


def spots(spark, *rows):
    return frame(spark, [(i, float(x), float(y)) for i, x, y in rows], "rowid long, lon double, lat double")


def pairs(df):
    return sorted((r["rowid"], r["node_id"]) for r in df.collect())


# ---------------------------------------------------------------- link


def test_longitude_edge_is_inside_the_radius_but_outside_the_window(spark):
    east = 9.995 / (6371.01 * math.cos(math.radians(42))) * 180 / math.pi
    north = 9.995 / 6371.01 * 180 / math.pi
    grid = nodes(spark, ("east", east, 42), ("north", 0, 42 + north))
    point = spots(spark, (1, 0, 42))
    assert pairs(link_to_grid(point, grid)) == [(1, "north")]
    assert pairs(link_to_grid(point, grid, strict_window=False)) == [(1, "east"), (1, "north")]


def test_no_wrap_at_the_dateline_unless_asked(spark):
    grid, point = nodes(spark, ("w", -179.99, 0)), spots(spark, (1, 179.99, 0))
    assert pairs(link_to_grid(point, grid)) == []
    assert pairs(link_to_grid(point, grid, strict_window=False)) == [(1, "w")]


def test_many_to_many_and_far_points(spark):
    grid = nodes(spark, ("a", 0, 0), ("b", 0.05, 0))
    assert pairs(link_to_grid(spots(spark, (1, 0.02, 0), (2, 5, 5)), grid)) == [(1, "a"), (1, "b")]


def test_missing_geometry_links_to_nothing(spark):
    point = frame(spark, [(1, None, 1.0), (2, float("nan"), 0.0), (3, 0.0, 0.0)], "rowid long, lon double, lat double")
    grid = frame(spark, [("a", 0.0, 0.0), ("b", None, None)], "node_id string, lon double, lat double")
    assert pairs(link_to_grid(point, grid)) == [(3, "a")]


def theta_links(points, grid, radius, strict):
    g = grid.select("node_id", F.col("lon").alias("glon"), F.col("lat").alias("glat"))
    near = great_circle_m(points["lat"], points["lon"], g["glat"], g["glon"]) <= radius * 1000
    half = radius / (111.320 * F.cos(F.radians(points["lat"])))
    high = radius / 110.574
    box = g["glat"].between(points["lat"] - high, points["lat"] + high)
    box = box & g["glon"].between(points["lon"] - half, points["lon"] + half)
    return points.join(g, (box & near) if strict else near).select("rowid", "node_id")


@pytest.mark.parametrize("radius", [0.7, 40.0, 333.0, 2500.0])
@pytest.mark.parametrize("strict", [True, False])
def test_cell_join_equals_theta_join(spark, radius, strict):
    rng = random.Random(radius)

    def place(polar):
        lat = rng.choice([-1, 1]) * rng.uniform(88.5, 90) if polar else rng.uniform(-90, 90)
        return rng.choice([rng.uniform(-180, 180), rng.uniform(179, 180), -rng.uniform(179, 180)]), lat

    count = 400
    grid = nodes(spark, *[(f"n{i}", *place(i % 3 == 0)) for i in range(count)])
    near_nodes = [(r["lon"], r["lat"]) for r in grid.collect()]
    points = []
    for i in range(count):
        lon, lat = place(i % 3 == 0)
        if i % 2:
            lon, lat = near_nodes[i]
            lat = max(-90.0, min(90.0, lat + rng.uniform(-1, 1) * radius / 111))
        points.append((i, lon, lat))
    points = spots(spark, *points)
    want = pairs(theta_links(points, grid, radius, strict))
    assert pairs(link_to_grid(points, grid, radius, strict_window=strict)) == want
    shuffled = link_to_grid(points, grid, radius, strict_window=strict, broadcast_grid=False, hot_rows=5)
    assert pairs(shuffled) == want
    assert len(set(want)) == len(want)


def test_longitudes_beyond_180_are_kept(spark):
    grid, point = nodes(spark, ("a", 350.0, 10.0)), spots(spark, (1, 350.01, 10.0))
    assert pairs(link_to_grid(point, grid)) == [(1, "a")]


def test_band_join_keeps_the_corners(spark):
    grid = nodes(spark, ("corner", 0.089, 0.09))
    assert pairs(band_join(spots(spark, (1, 0, 0)), grid)) == [(1, "corner")]
    assert pairs(link_to_grid(spots(spark, (1, 0, 0)), grid)) == []


def test_link_arguments(spark):
    with pytest.raises(ValueError):
        link_to_grid(spots(spark, (1, 0, 0)), nodes(spark, ("a", 0, 0)), 0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_link_plans_have_no_nested_loop(spark, sf_dir):
    from workload.points import grid, points

    here = points(spark, sf_dir)
    text = plan(link_to_grid(here, grid(spark)))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
    text = plan(link_to_grid(here, grid(spark), broadcast_grid=False, hot_rows=10**9))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_statistics_take_one_exchange_of_rows(spark, sf_dir):
    from workload.points import grid, points

    text = plan(aggregate_grid(points(spark, sf_dir), None, grid(spark), "speed,temp"))
    rows = text.split("BroadcastHashJoin [node_id")[-1]
    assert text.count("hashpartitioning(timestamp") == 1 and "NestedLoop" not in rows


# ---------------------------------------------------------------- skew


def test_hot_keys_and_salted_join(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), "id")
    assert hot_keys(big, ["k"], 10, rows_bound=10) is None
    assert hot_keys(big, ["k"], 1000) is None
    assert [r["k"] for r in hot_keys(big, ["k"], 10).collect()] == [0]
    small = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = skew_join(big, small, ["k"], ["id"], min_rows=10)
    assert sorted(joined.select("id", "v").collect()) == sorted(big.join(small, "k").select("id", "v").collect())


# ---------------------------------------------------------------- statistics


def median(values):
    return statistics.median(values) if values else None


def test_nulls_and_counts(spark):
    rows = [(1, "t", None, 1.0), (2, "t", 1.0, None), (3, "t", 3.0, None), (4, None, 9.0, 9.0)]
    points = frame(spark, rows, "rowid long, timestamp string, x double, y double")
    points = points.withColumns({"lon": F.lit(0.0), "lat": F.lit(0.0)})
    links = frame(spark, [(i, "a") for i in (1, 2, 3, 4)] + [(99, "a"), (1, "gone")], "rowid long, node_id string")
    out = aggregate_grid(points, links, nodes(spark, ("a", 0, 0)), ["x", "y"]).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["n"], r["x_n"], r["y_n"]) == (3, 2, 1)
    assert (r["x_mean"], r["x_median"], r["x_mad"], r["x_min"], r["x_max"]) == (2.0, 2.0, 1.0, 1.0, 3.0)
    assert r["x_stddev"] == pytest.approx(math.sqrt(2)) and r["y_stddev"] is None
    assert list(r.asDict()) == ["timestamp", "node_id", "geometry", "n"] + [
        f"{c}_{s}" for c in "xy" for s in ("mean", "median", "stddev", "min", "max", "n", "mad")
    ]


def test_all_null_column(spark):
    rows = frame(spark, [("k", None), ("k", None)], "k string, x double")
    for hot in (None, 1):
        assert with_mad(rows, ["k"], ["x"], hot_rows=hot).first()["x_median"] is None


@pytest.mark.parametrize("hot", [None, 1])
def test_median_kinds(spark, hot):
    values = {"odd": [1, 2, 3, 4, 100], "even": [1, 2, 3, 4], "one": [7], "ties": [2, 2, 2, 5]}
    rows = frame(spark, [(k, float(v)) for k, vs in values.items() for v in vs], "k string, x double")
    exact = {r["k"]: (r["x_median"], r["x_mad"]) for r in with_mad(rows, ["k"], ["x"], "exact", hot_rows=hot).collect()}
    assert exact == {"odd": (3, 1), "even": (2.5, 1), "one": (7, 0), "ties": (2, 0)}
    disc = {r["k"]: r["x_median"] for r in with_mad(rows, ["k"], ["x"], "disc", hot_rows=hot).collect()}
    assert disc == {"odd": 3, "even": 2, "one": 7, "ties": 2}
    approx = {r["k"]: r["x_median"] for r in with_mad(rows, ["k"], ["x"], "approx", hot_rows=hot).collect()}
    assert approx["odd"] == 3 and approx["even"] == 2
    with pytest.raises(ValueError):
        with_mad(rows, ["k"], ["x"], "mode")


@pytest.mark.parametrize("kind", ["exact", "disc"])
def test_split_medians_on_hard_distributions(spark, kind):
    rng = np.random.default_rng(11)
    shapes = {
        "normal": rng.normal(size=4001),
        "heavy": np.exp(rng.normal(size=4000) * 40),
        "two": rng.choice([0.0, 1.0], size=4000),
        "same": np.full(3000, 5.0),
        "gap": np.concatenate([rng.uniform(-1e300, -1e299, 2000), rng.uniform(1e-300, 1e-299, 2000)]),
        "infinite": np.concatenate([np.full(1500, -np.inf), rng.normal(size=10), np.full(1500, np.inf)]),
    }
    data = [(k, float(v)) for k, vs in shapes.items() for v in vs]
    rows = frame(spark, data, "k string, x double").repartition(8)
    split = {r["k"]: r["x_median"] for r in with_mad(rows, ["k"], ["x"], kind, hot_rows=100).collect()}
    for k, vs in shapes.items():
        ordered = np.sort(vs)
        n = len(ordered)
        low = ordered[(n - 1) // 2]
        want = 0.5 * low + 0.5 * ordered[n // 2] if kind == "exact" and low != ordered[n // 2] else low
        assert split[k] == want, k


def test_one_group_with_a_third_of_all_rows(spark):
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"),
        F.sin(F.col("id")).alias("x"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 101).cast("double").alias("y"),
    )
    plain = with_mad(rows, ["k"], ["x", "y"], hot_rows=None)
    split = with_mad(rows, ["k"], ["x", "y"], hot_rows=1000)
    assert sorted(plain.collect()) == sorted(split.collect())


def test_partition_columns_go_last(spark):
    points = frame(spark, [(1, "t", "p", 2.0), (2, "t", None, 3.0)], "rowid long, timestamp string, part string, x double")
    points = points.withColumns({"lon": F.lit(0.0), "lat": F.lit(0.0)})
    grid = nodes(spark, ("a", 0, 0))
    out = aggregate_grid(points, None, grid, "x", partition_by="part")
    assert out.columns[0] == "timestamp" and out.columns[-1] == "part" and out.count() == 1
    out = aggregate_grid(points, None, grid, "x", partition_by="part,timestamp")
    assert out.columns[:3] == ["node_id", "geometry", "n"] and out.columns[-2:] == ["part", "timestamp"]
    with pytest.raises(ValueError):
        aggregate_grid(points, None, grid, "x", partition_by="other")
    with pytest.raises(ValueError):
        aggregate_grid(points, None, grid, "nothing")


def directions(spark, angles, weights=None, magnitudes=None, columns=""):
    weights = weights or [1.0] * len(angles)
    rows = [(i, "t", a, w) for i, (a, w) in enumerate(zip(angles, weights))]
    points = frame(spark, rows, "rowid long, timestamp string, dir double, w double")
    points = points.withColumns({"lon": F.lit(0.0), "lat": F.lit(0.0)})
    return aggregate_direction(points, None, nodes(spark, ("a", 0, 0)), columns, "dir", magnitudes).first()


def test_directions(spark):
    low = math.sqrt(-2 * math.log(1e-9))
    same = directions(spark, [30.0, 30.0, 30.0])
    assert same["dir_mean"] == pytest.approx(30) and same["dir_stddev"] == pytest.approx(0, abs=1e-7)
    assert not math.isnan(same["dir_stddev"])
    assert directions(spark, [350.0, 10.0])["dir_mean"] == pytest.approx(0, abs=1e-9)
    assert abs(directions(spark, [170.0, 190.0])["dir_mean"]) == pytest.approx(180)
    assert directions(spark, [0.0, 180.0])["dir_stddev"] == pytest.approx(low)
    weighted = directions(spark, [0.0, 90.0], [3.0, 1.0], "w")
    assert weighted["dir_mean"] == pytest.approx(math.degrees(math.atan2(1, 3)))
    assert weighted["dir_stddev"] == pytest.approx(math.sqrt(-2 * math.log(math.hypot(0.5, 1.5) / 2)))
    assert directions(spark, [None, None])["dir_stddev"] is None
    nothing = directions(spark, [None, None], magnitudes="w")
    assert nothing["dir_stddev"] == pytest.approx(low) and nothing["dir_mean"] is None and nothing["dir_n"] == 0


def test_direction_columns(spark):
    assert "w_mean" not in directions(spark, [1.0], magnitudes="w").asDict()
    assert "w_mean" in directions(spark, [1.0], magnitudes="w", columns="w,dir").asDict()
    assert "dir_min" not in directions(spark, [1.0], columns="dir").asDict()
    assert [a.magnitude for a in pair_angles("a,b", "Skip, w")] == [None, "w"]
    for bad in (("a,b", "w"), ("", "w")):
        with pytest.raises(ValueError):
            pair_angles(*bad)


def test_direction_names_that_contain_one_another(spark):
    points = frame(spark, [(1, "t", 10.0, 20.0)], "rowid long, timestamp string, dir double, dir2 double")
    points = points.withColumns({"lon": F.lit(0.0), "lat": F.lit(0.0)})
    out = aggregate_direction(points, None, nodes(spark, ("a", 0, 0)), "dir2,dir", "dir").first()
    assert out["dir_mean"] == pytest.approx(10) and out["dir2_mean"] == 20 and out["dir2_max"] == 20


@settings(max_examples=4, deadline=None)
@given(shift=st.floats(-170, 170), seed=st.integers(0, 10**6))
def test_rotating_angles_rotates_the_mean(spark, shift, seed):
    rng = random.Random(seed)
    angles = [rng.uniform(0, 120) for _ in range(9)]
    before = directions(spark, angles)
    after = directions(spark, [a + shift for a in angles])
    turned = (after["dir_mean"] - before["dir_mean"] - shift + 180) % 360 - 180
    assert turned == pytest.approx(0, abs=1e-6)
    assert after["dir_stddev"] == pytest.approx(before["dir_stddev"], abs=1e-6)


def test_projection(spark):
    rows = [(1, "t", 0.01, 0.0, 2.0, 1.0), (2, "t", 0.0, 0.0, 5.0, 1.0)]
    points = frame(spark, rows, "rowid long, timestamp string, lon double, lat double, v double, u double")
    grid = nodes(spark, ("a", 0.02, 0.0), ("b", 0.0, 0.02))
    links = link_to_grid(points, grid)
    for given_links in (links, None):
        out = {
            r["node_id"]: r
            for r in aggregate_projection(points, given_links, grid, "v,u", "v", point_lat=0.0, point_lon=0.0).collect()
        }
        assert out["a"]["v_mean"] == pytest.approx(2.0) and out["b"]["v_mean"] == pytest.approx(0.0)
        assert (out["a"]["n"], out["a"]["v_n"], out["a"]["u_n"]) == (2, 1, 2)
    with pytest.raises(ValueError):
        aggregate_projection(points, None, grid, "u", "v", 0.0, 0.0)


# ---------------------------------------------------------------- grids


def test_lattice_counts_and_numbers(spark):
    from gridstats.functions.utm import utm_forward, utm_forward_point

    box = (-10.0, 35.0, -5.0, 40.0)
    grid = build_grid(spark, box, 25.0, "N")
    metric = {r["node_id"]: (r["x"], r["y"]) for r in utm_forward(grid, 29).collect()}
    west, south = utm_forward_point(-10.0, 35.0, 29, False)
    east, north = utm_forward_point(-5.0, 40.0, 29, False)
    xs = np.arange(west + 12500, east - 12500 + 25000, 25000)
    ys = np.arange(south + 12500, north - 12500 + 25000, 25000)
    assert len(metric) == len(xs) * len(ys)
    assert metric["N1"] == pytest.approx((xs[0], ys[0]), abs=1e-3)
    assert metric[f"N{len(xs) + 2}"] == pytest.approx((xs[1], ys[1]), abs=1e-3)
    with pytest.raises(ValueError):
        build_grid(spark, (0.0, 0.0, 0.1, 0.1), 25.0)


def test_southern_lattice(spark):
    grid = build_grid(spark, (-58.0, -35.0, -57.0, -34.0), 20.0, "S")
    box = extent(grid).first()
    assert -58 < box["minx"] < box["maxx"] < -56.7 and -35 < box["miny"] < box["maxy"] < -33.7


def square(west, south, east, north):
    points = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return ([[{"x": float(x), "y": float(y)} for x, y in points]],)


def test_grid_in_hull_leaves_gaps(spark):
    ring = [{"x": x, "y": y} for x, y in [(-9.5, 42.0), (-8.5, 42.0), (-9.5, 43.0), (-9.5, 42.0)]]
    hull = frame(spark, [([ring],)], RING)
    numbers = sorted(int(r["node_id"][1:]) for r in build_grid_in_hull(spark, hull, 10.0, "G").collect())
    assert numbers[0] == 1 and len(numbers) < numbers[-1]
    wider = build_grid_in_hull(spark, hull, 10.0, "G", buffer_km=20.0).count()
    assert wider > len(numbers)
    with pytest.raises(ValueError):
        build_grid_in_hull(spark, hull, 10.0, "G", buffer_km=-1.0)
    with pytest.raises(ValueError):
        build_grid_in_hull(spark, hull.limit(0), 10.0, "G")


def test_centroid(spark):
    assert centroid(frame(spark, [square(0, 0, 4, 2)], RING)) == pytest.approx((2, 1))
    assert centroid(frame(spark, [square(0, 0, 2, 2), square(4, 0, 6, 2)], RING)) == pytest.approx((3, 1))
    line = [{"x": x, "y": y} for x, y in [(0.0, 0.0), (4.0, 0.0), (0.0, 0.0)]]
    assert centroid(frame(spark, [([line],)], RING)) == pytest.approx((2, 0))


def test_manual_nodes(spark):
    grid = nodes(spark, ("G1", 1, 1), ("G2", 2, 2))
    manual = nodes(spark, ("G2", 9, 9), ("M", 3, 3), ("M", 4, 4))
    got = {r["node_id"]: r["lon"] for r in add_nodes(grid, manual).collect()}
    assert got == {"G1": 1, "G2": 2, "M": 3}
    only = make_grid(spark, manual=manual)
    assert only.columns == ["node_id", "geometry"] and only.count() == 2
    both = make_grid(spark, bbox=(-10.0, 35.0, -9.0, 36.0), spacing_km=25.0, prefix="N", manual=manual)
    assert {"N1", "M", "G2"} <= {r["node_id"] for r in both.collect()}
    with pytest.raises(ValueError):
        make_grid(spark, bbox=(-10.0, 35.0, -9.0, 36.0), spacing_km=25.0)
    with pytest.raises(ValueError):
        make_grid(spark, hull=frame(spark, [square(0, 0, 1, 1)], RING))


def test_merge_and_samples(spark):
    a, b = nodes(spark, ("x", 1, 1)), nodes(spark, ("x", 2, 2), ("y", 3, 3))
    assert {r["node_id"]: r["lon"] for r in merge_grids(b, a).collect()} == {"x": 2, "y": 3}
    holes = frame(spark, [("z", None, None)], "node_id string, lon double, lat double")
    assert merge_grids(a, holes).count() == 1
    assert [r["node_id"] for r in sample_first(b, 1, ["lon"]).collect()] == ["x"]
    assert sample_first(b, 0, ["lon"]).count() == 2 and preview(b, 1).count() == 1
    rows = frame(spark, [(1, "b", 2), (1, "a", 1), (2, "c", None)], "k int, v string, o int")
    assert {r["k"]: r["v"] for r in dedupe_first(rows, ["k"], ["o"]).collect()} == {1: "a", 2: "c"}


def test_extent_skips_what_is_not_finite(spark):
    rows = [(0.0, 1.0), (float("nan"), 5.0), (float("inf"), 5.0), (None, 9.0), (2.0, 3.0)]
    assert tuple(extent(frame(spark, rows, "lon double, lat double")).first()) == (0, 1, 2, 3)
    grid = encode_grid(nodes(spark, ("a", 1, 2), ("b", 3, 4)))
    assert tuple(extent(grid).first()) == (1, 2, 3, 4)
    assert geometry_types(grid).first()["types"] == ["Point"]


# ---------------------------------------------------------------- hulls


def ring_of(row):
    return [(p["x"], p["y"]) for p in row["rings"][0]]


def test_hull_shapes(spark):
    assert ring_of(convex_hull(spots(spark, (1, 1, 2), (2, 1, 2))).first()) == [(1, 2), (1, 2)]
    assert ring_of(convex_hull(spots(spark, (1, 0, 0), (2, 1, 1), (3, 3, 3))).first()) == [(0, 0), (3, 3), (0, 0)]
    corners = [(0, 0), (4, 0), (4, 4), (0, 4), (2, 0), (1, 1), (0, 0)]
    hull = convex_hull(spots(spark, *[(i, *c) for i, c in enumerate(corners)]))
    assert ring_of(hull.first()) == [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    with pytest.raises(ValueError):
        convex_hull(spots(spark, (1, float("nan"), 0)))


def brute_hull(points):
    """A point is a vertex if it is not a convex combination of others: tested by half-planes through it."""
    out = set()
    for p in points:
        angles = sorted(math.atan2(q[1] - p[1], q[0] - p[0]) for q in points if q != p)
        gaps = [b - a for a, b in zip(angles, angles[1:])] + [angles[0] + 2 * math.pi - angles[-1]]
        if max(gaps) > math.pi + 1e-9:
            out.add(p)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), min_size=3, max_size=40, unique=True))
def test_hull_vertices_by_definition(points):
    got = hull_vertices(np.array(points, float))
    assert len(set(map(tuple, got))) == len(got)
    flat = {tuple(map(int, v)) for v in got}
    if len(got) > 2:
        assert flat == brute_hull(points)
    assert {tuple(v) for v in hull_vertices(got)} == {tuple(v) for v in got}


def test_hull_covers_its_points_per_group(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(0, 3), rng.gauss(40, 2), "ab"[i % 2]) for i in range(4000)]
    points = frame(spark, rows, "rowid long, lon double, lat double, g string")
    hulls = convex_hull(points, ["g"])
    for g in "ab":
        own = points.where(F.col("g") == g)
        assert points_in_polygons(own, hulls.where(F.col("g") == g)).count() == own.count()
        mine = np.array([(r[1], r[2]) for r in rows if r[3] == g])
        assert ring_of(hulls.where(F.col("g") == g).first())[:-1] == [tuple(v) for v in hull_vertices(mine)]


def test_combined_hulls(spark):
    far = frame(spark, [square(0, 0, 1, 1), square(5, 5, 6, 6)], RING)
    near = frame(spark, [square(0, 0, 2, 2), square(1, 1, 3, 3)], RING)
    assert combine_hulls(far, "union").count() == 2
    assert combine_hulls(far, "intersection").count() == 0
    assert ring_of(combine_hulls(near, "intersection").first()) == [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    touching = frame(spark, [square(0, 0, 1, 1), square(1, 1, 2, 2)], RING)
    assert ring_of(combine_hulls(touching, "intersection").first()) == [(1, 1), (1, 1)]
    side = frame(spark, [square(0, 0, 1, 1), square(1, 0, 2, 1)], RING)
    assert ring_of(combine_hulls(side, "intersection").first()) == [(1, 0), (1, 1), (1, 0)]
    inner = frame(spark, [square(0, 0, 9, 9), square(2, 2, 3, 3), square(1, 1, 4, 4)], RING)
    assert ring_of(combine_hulls(inner, "intersection").first()) == [(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]
    with pytest.raises(ValueError):
        combine_hulls(near, "difference")


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_convex_intersection_by_sampling(seed):
    from gridstats.operators.hull import _clip_convex, _inside

    rng = np.random.default_rng(seed)
    one, other = hull_vertices(rng.normal(size=(12, 2))), hull_vertices(rng.normal(0.7, 1, size=(9, 2)))
    both = _clip_convex(one, other)
    sample = rng.normal(0.3, 1, size=(500, 2))
    want = _inside(sample, one) & _inside(sample, other)
    got = _inside(sample, both) if len(both) else np.zeros(500, bool)
    assert (want == got).all()


def test_points_in_polygons_keeps_duplicates_once_per_row(spark):
    shape = frame(spark, [square(0, 0, 2, 2), square(1, 1, 3, 3)], RING)
    points = spots(spark, (1, 1.5, 1.5), (1, 1.5, 1.5), (2, 5, 5), (3, 3, 3))
    assert sorted(r["rowid"] for r in points_in_polygons(points, shape).collect()) == [1, 1, 3]
    text = plan(points_in_polygons(points, shape))
    assert "NestedLoop" not in text and "Cartesian" not in text
