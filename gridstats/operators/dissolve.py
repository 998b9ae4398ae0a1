"""The outline of overlapping polygon parts: one shape without inner borders, as rings of Spark rows.

Edges of all parts meet in cells, are cut where they cross or touch, and a piece stays if no other part covers it from
within. The pieces left have the shape on their left; each finds the piece that follows it, and every ring is put in order
by rounds in which a piece looks twice as far ahead. Rings that run counter-clockwise are outlines, the others holes of the
smallest outline around them. Nothing is gathered but the vertices of one ring in its row.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.functions.polygon import RINGS, covers_by_edges, edge_sums, oriented, ring_edges, xy
from gridstats.operators.clip import BAND_DEGREES, CELL_DEGREES, polygon_bands
from gridstats.plans.sizing import broadcast_if_small, fits_broadcast, pin, spill

# Positions closer than this (degrees; a tenth of a millimetre) are one, so that shared borders are found as shared.
TOLERANCE = 1e-9


def _cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * by - ay * bx


def _key(x: Column, y: Column, tolerance: float) -> Column:
    """Equal for positions that count as one."""
    return F.struct(F.round(x / tolerance).cast("long").alias("kx"), F.round(y / tolerance).cast("long").alias("ky"))


def _off_line(e: dict[str, Column], x: Column, y: Column) -> Column:
    """Twice the signed area of an edge and a position: positive on the left."""
    return _cross(e["x2"] - e["x1"], e["y2"] - e["y1"], x - e["x1"], y - e["y1"])


def _touches(e: dict[str, Column], x: Column, y: Column, tolerance: float) -> Column:
    """Whether a position lies on an edge, ends included."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    along = (x - e["x1"]) * dx + (y - e["y1"]) * dy
    square = dx * dx + dy * dy
    length = F.sqrt(square)
    return (F.abs(_off_line(e, x, y)) <= tolerance * length) & (along >= -tolerance * length) & (along <= square + tolerance * length)


def _in_cells(edges: DataFrame, band: float, cell: float) -> DataFrame:
    """Each edge once for each cell that it meets: the cells of a band between where the edge enters and leaves it."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("_band", F.explode(F.sequence(F.floor((low - band * 1e-9) / band), F.floor((high + band * 1e-9) / band))))
    bottom = F.greatest(low, F.col("_band") * band)
    top = F.least(high, (F.col("_band") + 1) * band)
    slope = F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    ends = [F.col("x1") + (y - F.col("y1")) * slope for y in (bottom, top)]
    slack = cell * 1e-9
    begin = F.when(slope.isNull(), F.least("x1", "x2")).otherwise(F.greatest(F.least(*ends), F.least("x1", "x2"))) - slack
    end = F.when(slope.isNull(), F.greatest("x1", "x2")).otherwise(F.least(F.greatest(*ends), F.greatest("x1", "x2"))) + slack
    return rows.withColumn("_cell", F.explode(F.sequence(F.floor(F.least(begin, end) / cell), F.floor(F.greatest(begin, end) / cell))))


def _cuts(edges: DataFrame, band: float, cell: float, tolerance: float) -> DataFrame:
    """(edge, x, y) of the positions at which edges of other parts cross or touch an edge, the same for both edges."""
    placed = _in_cells(edges, band, cell)
    names = ("part", "edge", "x1", "y1", "x2", "y2")
    left = placed.select("_band", "_cell", *[F.col(n).alias(f"a_{n}") for n in names])
    right = placed.select("_band", "_cell", *[F.col(n).alias(f"b_{n}") for n in names])
    pairs = left.join(right, ["_band", "_cell"]).where("a_part < b_part")
    boxes = F.lit(True)
    for axis in ("x", "y"):
        a = [F.col(f"a_{axis}{k}") for k in (1, 2)]
        b = [F.col(f"b_{axis}{k}") for k in (1, 2)]
        boxes = boxes & (F.least(*a) <= F.greatest(*b) + tolerance) & (F.least(*b) <= F.greatest(*a) + tolerance)
    # a crossing lies in a cell that both edges meet, so cells only save comparisons; a pair is compared once
    pairs = pairs.where(boxes).drop("_band", "_cell").distinct()
    a, b = ({n: F.col(f"{side}_{n}") for n in names} for side in "ab")
    on_b = [_touches(b, a[f"x{k}"], a[f"y{k}"], tolerance) for k in (1, 2)]
    on_a = [_touches(a, b[f"x{k}"], b[f"y{k}"], tolerance) for k in (1, 2)]
    d1, d2 = (_off_line(b, a[f"x{k}"], a[f"y{k}"]) for k in (1, 2))
    d3, d4 = (_off_line(a, b[f"x{k}"], b[f"y{k}"]) for k in (1, 2))
    crossing = ~(on_a[0] | on_a[1] | on_b[0] | on_b[1]) & (d1 * d2 < 0) & (d3 * d4 < 0)
    share = F.try_divide(d1, d1 - d2)
    x, y = a["x1"] + (a["x2"] - a["x1"]) * share, a["y1"] + (a["y2"] - a["y1"]) * share

    def at(edge: Column, px: Column, py: Column, when: Column) -> Column:
        return F.when(when, F.struct(edge.alias("edge"), px.alias("x"), py.alias("y")))

    found = F.array(
        *[at(b["edge"], a[f"x{k}"], a[f"y{k}"], on_b[k - 1]) for k in (1, 2)],
        *[at(a["edge"], b[f"x{k}"], b[f"y{k}"], on_a[k - 1]) for k in (1, 2)],
        at(a["edge"], x, y, crossing),
        at(b["edge"], x, y, crossing),
    )
    return pairs.select(F.explode(found).alias("cut")).where("cut is not null").select("cut.*").distinct()


def _pieces(edges: DataFrame, cuts: DataFrame, tolerance: float) -> DataFrame:
    """(part, x1, y1, x2, y2, start, end) of the stretches of edges between their ends and cuts."""
    along = (F.col("x") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y") - F.col("y1")) * (F.col("y2") - F.col("y1"))
    placed = cuts.join(edges, "edge").select("edge", F.struct(along.alias("t"), "x", "y").alias("cut"))
    listed = edges.join(placed.groupBy("edge").agg(F.array_sort(F.collect_list("cut")).alias("cuts")), "edge", "left")
    between = F.transform(F.coalesce("cuts", F.array().cast("array<struct<t:double,x:double,y:double>>")), lambda c: xy(c["x"], c["y"]))
    line = F.concat(F.array(xy(F.col("x1"), F.col("y1"))), between, F.array(xy(F.col("x2"), F.col("y2"))))
    rows = listed.select("part", line.alias("line")).select("part", F.inline(ring_edges(F.array("line"))))
    rows = rows.withColumns({"start": _key(F.col("x1"), F.col("y1"), tolerance), "end": _key(F.col("x2"), F.col("y2"), tolerance)})
    return rows.where("start <> end")


def _outer_pieces(pieces: DataFrame, parts: DataFrame, band: float, tolerance: float) -> DataFrame:
    """The pieces that border the union: not within another part and no border that other parts hold on their other side.
    Of pieces that several parts have in the same direction one stays."""
    x, y = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    middle = pieces.withColumns({"_x": x, "_y": y})
    middle = middle.withColumns({"_band": F.floor(F.col("_y") / band), "_cell": F.floor(F.col("_x") / CELL_DEGREES)})
    bands = polygon_bands(parts, band, keep=("part",), slack=tolerance).withColumnsRenamed({"part": "other", "_band": "_part_band", "_cell": "_part_cell"})
    on = (F.col("_band") == F.col("_part_band")) & (F.col("_cell") == F.col("_part_cell")) & (F.col("part") != F.col("other"))
    on = on & F.col("_x").between(F.col("_minx") - tolerance, F.col("_maxx") + tolerance)
    met = middle.join(broadcast_if_small(bands), on)

    def parallel(e: Column) -> Column:
        return (e["x2"] - e["x1"]) * (F.col("x2") - F.col("x1")) + (e["y2"] - e["y1"]) * (F.col("y2") - F.col("y1"))

    touching = F.filter("_edges", lambda e: _touches({k: e[k] for k in ("x1", "y1", "x2", "y2")}, F.col("_x"), F.col("_y"), tolerance))

    def crossed(e: Column) -> Column:
        side = _off_line({k: e[k] for k in ("x1", "y1", "x2", "y2")}, F.col("_x"), F.col("_y"))
        up = (e["y1"] <= F.col("_y")) & (F.col("_y") < e["y2"]) & (side > 0)
        down = (e["y2"] <= F.col("_y")) & (F.col("_y") < e["y1"]) & (side < 0)
        return up | down

    met = met.withColumn("_touching", touching)
    border = F.size("_touching") > 0
    within = ~border & (F.size(F.filter("_edges", crossed)) % 2 == 1)
    against = border & F.exists("_touching", lambda e: parallel(e) < 0)
    again = border & F.exists("_touching", lambda e: parallel(e) > 0) & (F.col("other") < F.col("part"))
    dropped = met.where(within | against | again).select("piece").distinct()
    return pieces.join(broadcast_if_small(dropped), "piece", "left_anti")


def _next_pieces(pieces: DataFrame) -> DataFrame:
    """(piece, hop): the piece that follows. Where several begin at one position, the first clockwise from where the piece
    came, so that rings that only touch stay apart."""
    back = F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2"))
    onward = pieces.select(F.col("start").alias("end"), F.col("piece").alias("hop"), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("_out"))
    met = pieces.select("piece", "end", back.alias("_back")).join(onward, "end")
    turn = F.pmod(F.col("_back") - F.col("_out"), F.lit(2 * math.pi))
    first = F.min(F.struct(F.when(turn > 1e-12, turn).otherwise(F.lit(2 * math.pi)).alias("turn"), F.col("hop").alias("hop")))
    return met.groupBy("piece").agg(first["hop"].alias("hop"))


def _walked(order: pd.DataFrame) -> pd.DataFrame:
    """``_ranked`` of few pieces, by walking along each ring from its smallest piece."""
    hop = dict(zip(order["piece"], order["hop"], strict=True))
    rows, seen = [], set()
    for first in sorted(hop):
        if first in seen:
            continue
        ring = [first]
        while hop[ring[-1]] != first:
            ring.append(hop[ring[-1]])
        seen.update(ring)
        rows += [(piece, first, (len(ring) - k) % len(ring)) for k, piece in enumerate(ring)]
    return pd.DataFrame(rows, columns=["piece", "ring", "steps"])


def _ranked(order: DataFrame) -> DataFrame:
    """(piece, ring, steps) of ``(piece, hop)``: the smallest piece of the ring, and how many hops lead to it.

    Pieces that are checked to be few enough for a broadcast are walked along by one task, with the same result.
    """
    order = spill(order)
    if fits_broadcast(order):
        return order.groupBy(F.lit(0).alias("_all")).applyInPandas(_walked, "piece long, ring long, steps long")
    state = spill(order.select("piece", "hop", F.col("piece").alias("ring"), F.lit(0).cast("long").alias("steps")))
    reach = 1
    while True:
        ahead = state.select(F.col("piece").alias("hop"), F.col("hop").alias("_hop"), F.col("ring").alias("_ring"), F.col("steps").alias("_steps"))
        closer = F.col("_ring") < F.col("ring")
        state = spill(
            state.join(ahead, "hop").select(
                "piece",
                F.col("_hop").alias("hop"),
                F.least("ring", "_ring").alias("ring"),
                F.when(closer, F.col("_steps") + reach).otherwise(F.col("steps")).alias("steps"),
                closer.alias("_moved"),
            )
        )
        if state.where("_moved").isEmpty():
            return state.select("piece", "ring", "steps")
        state, reach = state.drop("_moved"), reach * 2


def _straight(ring: Column, tolerance: float) -> Column:
    """A closed ring without the vertices that its neighbours' line passes through."""
    count = F.size(ring) - 1

    def bend(p: Column, i: Column) -> Column:
        before, after = F.get(ring, (i + count - 1) % count), F.get(ring, i + 1)
        ax, ay, bx, by = p["x"] - before["x"], p["y"] - before["y"], after["x"] - p["x"], after["y"] - p["y"]
        span = F.sqrt((after["x"] - before["x"]) * (after["x"] - before["x"]) + (after["y"] - before["y"]) * (after["y"] - before["y"]))
        return (F.abs(_cross(ax, ay, bx, by)) > tolerance * span) | (ax * bx + ay * by < 0)

    kept = F.filter(F.slice(ring, F.lit(1), count), bend)
    return F.concat(kept, F.slice(kept, 1, 1))


def _rings(pieces: DataFrame, ranked: DataFrame, tolerance: float) -> DataFrame:
    """(id, ring, area) of the closed rings, each from its smallest piece on, counter-clockwise ones with positive area."""
    vertices = F.array_sort(F.collect_list(F.struct(F.when(F.col("steps") == 0, F.lit(-(1 << 62))).otherwise(-F.col("steps")).alias("k"), xy(F.col("x1"), F.col("y1")).alias("v"))))
    rows = pieces.join(ranked, "piece").groupBy(F.col("ring").alias("id")).agg(vertices.alias("all"))
    line = F.transform("all", lambda s: s["v"])
    rows = rows.select("id", _straight(F.concat(line, F.slice(line, 1, 1)), tolerance).alias("ring")).where(F.size("ring") > 3)
    twice = F.aggregate(ring_edges(F.array("ring")), F.lit(0.0), lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"]))
    return rows.withColumn("area", twice / 2)


def _with_holes(rings: DataFrame, band: float) -> DataFrame:
    """``rings`` of each outline, with the holes that it is the smallest one around, largest first."""
    outer = rings.where("area > 0").select(F.col("id").alias("outer"), F.col("area").alias("outer_area"), F.col("ring").alias("outline"))
    holes = rings.where("area < 0").select("id", "ring", "area")
    if holes.isEmpty():
        return outer.select(F.array("outline").alias("rings"))
    shapes = polygon_bands(outer.select("outer", "outer_area", F.array("outline").alias("rings")), band, keep=("outer", "outer_area"))
    a, b = F.col("ring")[0], F.col("ring")[1]
    at = holes.select("id", ((a["x"] + b["x"]) / 2).alias("_x"), ((a["y"] + b["y"]) / 2).alias("_y"))
    at = at.withColumns({"_at_band": F.floor(F.col("_y") / band), "_at_cell": F.floor(F.col("_x") / CELL_DEGREES)})
    on = (F.col("_band") == F.col("_at_band")) & (F.col("_cell") == F.col("_at_cell")) & covers_by_edges(F.col("_edges"), F.col("_x"), F.col("_y"))
    owner = at.join(broadcast_if_small(shapes), on).groupBy("id").agg(F.min_by("outer", "outer_area").alias("outer"))
    inner = holes.join(owner, "id").groupBy("outer").agg(F.array_sort(F.collect_list(F.struct("area", "id", "ring"))).alias("holes"))
    listed = outer.join(inner, "outer", "left")
    return listed.select(F.concat(F.array("outline"), F.coalesce(F.transform("holes", lambda h: h["ring"]), F.array().cast(RINGS))).alias("rings"))


def dissolve(polygons: DataFrame, tolerance: float = TOLERANCE, band: float = BAND_DEGREES, cell: float = CELL_DEGREES) -> DataFrame:
    """``rings`` of the union of all parts, as parts that do not overlap; parts that touch in a border become one.

    Outer rings run counter-clockwise, holes clockwise. Vertices of the parts are taken over unchanged; crossings are new.
    Positions within ``tolerance`` (in the unit of the coordinates) count as one. A part is simple: its own rings do not
    cross. Parts without area (points and lines) stay as they are, and equal ones are one. ``band`` and ``cell`` size the
    cells that edges meet in. No rows give no rows.
    """
    distinct = polygons.select("rings").where(F.size("rings") > 0).distinct()
    area = F.aggregate(edge_sums(F.col("rings")), F.lit(0.0), lambda s, r: s + F.abs(r["a"]))
    parts = spill(distinct.select(oriented(F.col("rings")).alias("rings"), (area > 0).alias("_area")).withColumn("part", F.monotonically_increasing_id()))
    flat = parts.where("not _area").select("rings")
    solid = parts.where("_area").select("part", "rings")
    if solid.limit(2).count() < 2:
        return solid.select("rings").union(flat)
    edges = solid.select("part", F.inline(ring_edges(F.col("rings"))))
    edges = spill(edges.where("x1 <> x2 or y1 <> y2").withColumn("edge", F.monotonically_increasing_id()))
    pieces = _pieces(edges, _cuts(edges, band, cell, tolerance), tolerance)
    pieces = spill(pieces.withColumn("piece", F.monotonically_increasing_id()))
    kept = spill(_outer_pieces(pieces, solid, band, tolerance))
    rings = spill(_rings(kept, _ranked(_next_pieces(kept)), tolerance))
    return pin(_with_holes(rings, band).union(flat))

