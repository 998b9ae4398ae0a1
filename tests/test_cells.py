"""Cells inside, outside and on the border of polygon parts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridstats.functions.polygon import RINGS, covers
from gridstats.operators.clip import BAND_DEGREES, fitting_side, marked_cells, points_in_polygons, polygon_bands

STAR = [(1 + (1.0 if k % 2 else 0.4) * math.cos(k * math.pi / 9), 45 + (0.8 if k % 2 else 0.3) * math.sin(k * math.pi / 9)) for k in range(18)]
SHAPES = {
    "star": [[STAR]],
    "hole": [[[(0, 44), (2, 44), (2, 46), (0, 46)], [(0.5, 44.5), (0.5, 45.5), (1.5, 45.5), (1.5, 44.5)]]],
    "on cell borders": [[[(0.25, 44.25), (1.25, 44.25), (1.25, 45.5), (0.25, 45.5)]]],
    "overlapping parts": [[[(0, 44), (1.2, 44.1), (0.3, 45.7)]], [[(0.1, 44.2), (1.9, 44.4), (1.1, 45.9)]]],
    "point and line": [[[(0.5, 44.5)]], [[(0, 44), (2, 46)]]],
    "sliver": [[[(0, 44), (2, 45.9999), (2, 46)]]],
}


def frame(spark, parts):
    rings = [([[{"x": float(x), "y": float(y)} for x, y in [*ring, ring[0]]] for ring in part],) for part in parts]
    return spark.createDataFrame(rings, f"rings {RINGS}")


@pytest.fixture(scope="module")
def somewhere(spark):
    rng = random.Random(11)
    spots = [(rng.uniform(-0.2, 2.2), rng.uniform(43.8, 46.2)) for _ in range(1500)]
    spots += [(x / 8, 44 + y / 8) for x in range(17) for y in range(17)]
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "rowid long, lon double, lat double").repartition(4).cache()


@pytest.mark.parametrize("name", SHAPES)
def test_cells_give_what_the_edges_give(spark, somewhere, name):
    shape = frame(spark, SHAPES[name])
    joined = somewhere.join(F.broadcast(shape), covers(F.col("rings"), F.col("lon"), F.col("lat")), "left_semi")
    expected = {r["rowid"] for r in joined.collect()}
    assert expected
    for band in (None, BAND_DEGREES, 0.1, 3.0):
        assert {r["rowid"] for r in points_in_polygons(somewhere, shape, band).collect()} == expected, band


def test_fewer_points_are_tested_against_edges(spark, somewhere):
    shape = frame(spark, SHAPES["hole"])
    side = fitting_side(shape)
    assert side < BAND_DEGREES
    cells = marked_cells(polygon_bands(shape, side, cell=side), side, side)
    assert cells.count() <= 4096 + 64
    placed = somewhere.select(F.floor(F.col("lat") / side).alias("_band"), F.floor(F.col("lon") / side).alias("_cell"))
    border = placed.join(cells.where("_edges is not null"), ["_band", "_cell"]).count()
    before = placed.join(polygon_bands(shape, side, cell=side), ["_band", "_cell"]).count()
    assert 0 < border < before / 3


def test_side_of_cells_follows_the_parts(spark):
    tiny = [[[(x / 10, 1), (x / 10 + 0.01, 1), (x / 10, 1.01)]] for x in range(50)]
    whole = [[[(-180, -90), (180, -90), (180, 90), (-180, 90)]]]
    # 50 parts may meet 4096 + 50 * 64 cells: (0.01 / side + 2) ** 2 * 50 is 2534 at a 128th and 7492 at a 256th
    assert fitting_side(frame(spark, tiny)) == BAND_DEGREES / 128
    assert fitting_side(frame(spark, tiny + whole)) == BAND_DEGREES
    assert fitting_side(frame(spark, tiny).limit(0)) == BAND_DEGREES
