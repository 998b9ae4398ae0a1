"""The outline of overlapping parts against inclusion and exclusion, point by point, and on shared borders."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridstats.functions.polygon import covers
from gridstats.operators.dissolve import dissolve
from gridstats.operators.grid import centroid
from gridstats.operators.hull import _clip_convex, combine_hulls, hull_vertices


def frame(spark, parts):
    rows = [([[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings],) for rings in parts]
    return spark.createDataFrame(rows, "rings array<array<struct<x:double,y:double>>>").repartition(3)


def box(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]


def got(df):
    return sorted([[[(p["x"], p["y"]) for p in ring] for ring in r["rings"]] for r in df.collect()])


def ring_area(ring):
    x, y = np.array(ring).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def corners(ring):
    return set(ring[:-1])


def test_two_boxes(spark):
    (only,) = got(dissolve(frame(spark, [box(0, 0, 2, 2), box(1, 1, 3, 3)])))
    assert corners(only[0]) == {(0, 0), (2, 0), (2, 1), (3, 1), (3, 3), (1, 3), (1, 2), (0, 2)}
    assert len(only) == 1 and ring_area(only[0]) == 7


def test_shared_borders_go(spark):
    (only,) = got(dissolve(frame(spark, [box(0, 0, 1, 1), box(1, 0, 2, 1), box(0.25, 1, 1.5, 2)])))
    assert corners(only[0]) == {(0, 0), (2, 0), (2, 1), (1.5, 1), (1.5, 2), (0.25, 2), (0.25, 1), (0, 1)}


def test_equal_inner_and_apart(spark):
    parts = [box(0, 0, 4, 4), box(0, 0, 4, 4), box(1, 1, 2, 2), box(0, 0, 4, 2), box(9, 9, 10, 10)]
    assert [corners(r[0]) for r in got(dissolve(frame(spark, parts)))] == [corners(box(0, 0, 4, 4)[0]), corners(box(9, 9, 10, 10)[0])]


def test_rings_that_touch_in_a_point_stay_apart(spark):
    found = got(dissolve(frame(spark, [box(0, 0, 1, 1), box(1, 1, 2, 2)])))
    assert [corners(r[0]) for r in found] == [corners(box(0, 0, 1, 1)[0]), corners(box(1, 1, 2, 2)[0])]


def test_holes_belong_to_the_outline_around_them(spark):
    frame_parts = [box(0, 0, 6, 1), box(0, 5, 6, 6), box(0, 0, 1, 6), box(5, 0, 6, 6), box(2, 2, 4, 4)]
    outer, inner = sorted(got(dissolve(frame(spark, frame_parts))), key=len, reverse=True)
    assert corners(outer[0]) == corners(box(0, 0, 6, 6)[0]) and corners(outer[1]) == corners(box(1, 1, 5, 5)[0])
    assert ring_area(outer[0]) == 36 and ring_area(outer[1]) == -16
    assert len(inner) == 1 and corners(inner[0]) == corners(box(2, 2, 4, 4)[0])


def test_given_holes_are_filled_where_covered(spark):
    ring = [box(0, 0, 6, 6)[0], box(2, 2, 4, 4)[0]]
    (only,) = got(dissolve(frame(spark, [ring, box(3, 1, 5, 5)])))
    assert len(only) == 2 and corners(only[1]) == {(2, 2), (3, 2), (3, 4), (2, 4)}


def test_parts_without_area_stay(spark):
    parts = [[[(0, 0), (0, 0)]], [[(0, 0), (0, 0)]], [[(0, 0), (1, 5), (0, 0)]], box(0, 0, 1, 1), box(0, 0, 2, 1)]
    found = got(dissolve(frame(spark, parts)))
    assert sorted(map(lambda r: len(r[0]), found)) == [2, 3, 5]
    assert got(dissolve(frame(spark, parts).limit(0))) == []


@pytest.mark.parametrize("seed", range(3))
def test_convex_shapes_by_points_and_areas(spark, seed):
    rng = np.random.default_rng(seed)
    hulls = [hull_vertices(rng.uniform(-1, 1, 2) * 2 + rng.standard_normal((30, 2)) * rng.uniform(0.2, 1)) for _ in range(2 if seed == 0 else 9)]
    shapes = frame(spark, [[[*map(tuple, h.tolist()), tuple(h[0].tolist())]] for h in hulls])
    done = dissolve(shapes, band=0.5).cache()
    spots = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(rng.uniform(-4, 4, (800, 2)))], "id long, x double, y double")

    def inside(parts):
        met = spots.join(parts, covers(F.col("rings"), F.col("x"), F.col("y")))
        return {r["id"]: r["n"] for r in met.groupBy("id").agg(F.count("*").alias("n")).collect()}

    after = inside(done)
    assert set(after) == set(inside(shapes))
    assert set(after.values()) <= {1}
    if seed == 0:
        total = sum(ring_area([*map(tuple, h), tuple(h[0])]) for h in hulls)
        common = _clip_convex(*hulls)
        shared = ring_area([*map(tuple, common), tuple(common[0])]) if len(common) > 2 else 0
        assert sum(ring_area(ring) for rings in got(done) for ring in rings) == pytest.approx(total - shared, rel=1e-12)


def test_union_of_hulls_weighs_overlaps_once(spark):
    hulls = frame(spark, [box(0, 0, 2, 2), box(0, 0, 4, 2), box(0, 0, 2, 2.0)]).withColumn("source", F.monotonically_increasing_id())
    assert centroid(combine_hulls(hulls, "union")) == pytest.approx((2, 1))
