"""Polygon columns.

A polygon part is one row with ``rings: array<array<struct<x, y>>>`` (outer ring first, every ring
closed). A point is the ring ``[a, a]`` and a line the ring ``[a, b, a]``, so the same predicates hold for
degenerate hulls. A multi-part shape is several rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridstats.constants import BUFFER_QUADRANT_SEGMENTS

RINGS = "array<array<struct<x:double,y:double>>>"


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring_edges(rings: Column) -> Column:
    """All edges of all rings as ``array<struct<x1, y1, x2, y2>>``."""

    def of_ring(ring: Column) -> Column:
        tails, heads = F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1)
        return F.zip_with(
            tails,
            heads,
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )

    return F.flatten(F.transform(rings, of_ring))


def side_of(e: Column, x: Column, y: Column) -> Column:
    """Positive left of an edge, negative right of it, zero on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def covers_by_edges(edges: Column, x: Column, y: Column) -> Column:
    """Whether the closed shape with these edges covers (x, y); the boundary counts as covered.

    Only edges that meet the horizontal line through ``y`` matter, so a subset with all of those is enough.
    """

    def touches(e: Column) -> Column:
        return (
            (side_of(e, x, y) == 0)
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    def crossed(e: Column) -> Column:
        up = (e["y1"] <= y) & (y < e["y2"]) & (side_of(e, x, y) > 0)
        down = (e["y2"] <= y) & (y < e["y1"]) & (side_of(e, x, y) < 0)
        return up | down

    return F.exists(edges, touches) | (F.size(F.filter(edges, crossed)) % 2 == 1)


def covers(rings: Column, x: Column, y: Column) -> Column:
    """Whether a polygon part covers a position."""
    return covers_by_edges(ring_edges(rings), x, y)


def ring_bounds(rings: Column) -> dict[str, Column]:
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return {"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)}


def edge_sums(rings: Column) -> Column:
    """Sums behind a centroid: ``area, ax, ay`` (shoelace), ``length, lx, ly`` (edges), ``px, py, n`` (vertices).

    The outer ring counts as positive and holes as negative area, whatever their direction.
    """

    def of_ring(ring: Column, index: Column) -> Column:
        edges = ring_edges(F.array(ring))

        def add(acc: Column, e: Column) -> Column:
            cross = e["x1"] * e["y2"] - e["x2"] * e["y1"]
            length = F.sqrt((e["x2"] - e["x1"]) * (e["x2"] - e["x1"]) + (e["y2"] - e["y1"]) * (e["y2"] - e["y1"]))
            return F.struct(
                (acc["a"] + cross / 2).alias("a"),
                (acc["ax"] + cross * (e["x1"] + e["x2"]) / 6).alias("ax"),
                (acc["ay"] + cross * (e["y1"] + e["y2"]) / 6).alias("ay"),
                (acc["l"] + length).alias("l"),
                (acc["lx"] + length * (e["x1"] + e["x2"]) / 2).alias("lx"),
                (acc["ly"] + length * (e["y1"] + e["y2"]) / 2).alias("ly"),
                (acc["px"] + e["x1"]).alias("px"),
                (acc["py"] + e["y1"]).alias("py"),
                (acc["n"] + 1.0).alias("n"),
            )

        zero = F.struct(*[F.lit(0.0).alias(k) for k in ("a", "ax", "ay", "l", "lx", "ly", "px", "py", "n")])
        sums = F.aggregate(edges, zero, add)
        sign = F.when(index == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.transform(
            F.array(sums),
            lambda s: F.struct(
                *[
                    (s[k] * (sign * F.when(s["a"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0)))).alias(k)
                    for k in ("a", "ax", "ay")
                ],
                *[s[k].alias(k) for k in ("l", "lx", "ly", "px", "py", "n")],
            ),
        )[0]

    return F.transform(rings, of_ring)


def buffer_pieces(rings: Column, distance: float) -> Column:
    """What a buffer of ``distance`` adds around a part, as an array of polygon ``rings``.

    Each edge adds the rectangle on its outer side, each convex corner the sector between its two edges'
    normals, cut into ``round(angle / (90° / 16))`` equal steps. Part and pieces together are the buffer.
    Rings must run with the inside on their left (outer counter-clockwise, holes clockwise).
    """
    step = math.pi / 2 / BUFFER_QUADRANT_SEGMENTS

    def around(centre: Column, start: Column, angle: Column, steps: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), steps),
            lambda k: xy(
                centre["x"] + distance * F.cos(start + angle * k / steps),
                centre["y"] + distance * F.sin(start + angle * k / steps),
            ),
        )

    def of_ring(ring: Column) -> Column:
        count = F.size(ring) - 1
        circle = F.array(F.array(around(ring[0], F.lit(0.0), F.lit(2 * math.pi), F.lit(4 * BUFFER_QUADRANT_SEGMENTS))))

        def at_edge(i: Column) -> Column:
            a, b, c = F.get(ring, i), F.get(ring, i + 1), F.get(ring, (i + 1) % count + 1)
            dx, dy, ex, ey = b["x"] - a["x"], b["y"] - a["y"], c["x"] - b["x"], c["y"] - b["y"]
            size = F.sqrt(dx * dx + dy * dy)
            ox, oy = F.try_divide(dy * distance, size), F.try_divide(-dx * distance, size)
            box = F.array(
                xy(a["x"], a["y"]), xy(a["x"] + ox, a["y"] + oy), xy(b["x"] + ox, b["y"] + oy), xy(b["x"], b["y"]),
                xy(a["x"], a["y"]),
            )
            cross, dot = dx * ey - dy * ex, dx * ex + dy * ey
            # a turn straight back has cross = ±0 and must count as +180°
            turn = F.when((cross == 0) & (dot < 0), F.lit(math.pi)).otherwise(F.atan2(cross, dot))
            steps = F.greatest(F.floor(turn / step + 0.5).cast("int"), F.lit(1))
            sector = F.concat(F.array(b), around(b, F.atan2(-dx, dy), turn, steps), F.array(b))
            return F.array(F.array(box), F.when(turn > 0, F.array(sector)))

        pieces = F.filter(
            F.flatten(F.transform(F.sequence(F.lit(0), count - 1), at_edge)), lambda p: p.isNotNull()
        )
        single = F.forall(ring, lambda p: (p["x"] == ring[0]["x"]) & (p["y"] == ring[0]["y"]))
        return F.when(single, circle).otherwise(pieces)

    return F.flatten(F.transform(rings, of_ring))


def oriented(rings: Column) -> Column:
    """Rings with the inside on their left: outer counter-clockwise, holes clockwise."""

    def turn(ring: Column, index: Column) -> Column:
        twice = F.aggregate(
            ring_edges(F.array(ring)), F.lit(0.0), lambda acc, e: acc + e["x1"] * e["y2"] - e["x2"] * e["y1"]
        )
        wrong = F.when(index == 0, twice < 0).otherwise(twice > 0)
        return F.when(wrong, F.reverse(ring)).otherwise(ring)

    return F.transform(rings, turn)
