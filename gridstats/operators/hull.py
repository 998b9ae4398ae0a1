"""Convex hulls of very large point sets, and how per-table hulls are combined.

A hull of hulls is exact, so the work is: drop points that are provably inside (native columns), reduce
each task's points to a hull, spread the vertices and reduce again, and finish on the few that are left.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.functions.polygon import RINGS
from gridstats.functions.wkb import decode_points, is_finite
from gridstats.operators.dissolve import dissolve
from gridstats.plans.sizing import broadcast_if_small, pin

# Eight compass directions, counter-clockwise; the extreme points span an octagon inside the hull.
_DIRECTIONS = ((1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1))
# Points closer than this to the octagon's border (cross product, square degrees) are kept.
_MARGIN = 1e-9
# Vertices a task holds before it passes its partial hulls on.
_HELD = 1_000_000
# More points than this are filtered in numpy before the chain, by a polygon of extreme points.
_FILTERED = 64
_COMPASS = np.stack([np.cos(np.arange(32) * np.pi / 16), np.sin(np.arange(32) * np.pi / 16)])


def _turns_left(ax: float, ay: float, bx: float, by: float, x: float, y: float) -> bool:
    """Whether a→b→(x, y) turns left; in exact arithmetic where rounding could decide."""
    left, right = (bx - ax) * (y - ay), (by - ay) * (x - ax)
    if abs(left - right) > 1e-15 * (abs(left) + abs(right)):
        return left > right
    ax, ay, bx, by, x, y = map(Fraction, (ax, ay, bx, by, x, y))
    return (bx - ax) * (y - ay) > (by - ay) * (x - ax)


def _near_border(xy: np.ndarray) -> np.ndarray:
    """The points that are not strictly inside the polygon of the extreme points of 32 directions."""
    if len(xy) <= _FILTERED:
        return xy
    corners = xy[(xy @ _COMPASS).argmax(axis=0)]
    corners = corners[(corners != np.roll(corners, 1, axis=0)).any(axis=1)]
    if len(corners) < 3:
        return xy
    inside = np.ones(len(xy), bool)
    for a, b in zip(corners, np.roll(corners, -1, axis=0), strict=True):
        inside &= (b[0] - a[0]) * (xy[:, 1] - a[1]) - (b[1] - a[1]) * (xy[:, 0] - a[0]) > _MARGIN
    return xy[~inside]


def hull_vertices(xy: np.ndarray) -> np.ndarray:
    """Hull vertices counter-clockwise from the lowest x (Andrew's monotone chain); no collinear ones."""
    points = np.unique(_near_border(xy), axis=0)
    if len(points) < 3:
        return points

    def chain(ordered: list) -> list[tuple[float, float]]:
        kept: list[tuple[float, float]] = []
        for x, y in ordered:
            while len(kept) > 1 and not _turns_left(*kept[-2], *kept[-1], x, y):
                kept.pop()
            kept.append((x, y))
        return kept

    lower, upper = chain(points.tolist()), chain(points[::-1].tolist())
    return np.array(lower[:-1] + upper[:-1])


def _ring(vertices: np.ndarray) -> list[list[dict[str, float]]]:
    closed = np.vstack([vertices, vertices[:1]])
    return [[{"x": float(x), "y": float(y)} for x, y in closed]]


def _partial(by: list[str]):
    def reduce_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hulls: dict[tuple, np.ndarray] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for key, vertices in hulls.items():
                frame = pd.DataFrame(vertices, columns=["lon", "lat"])
                yield frame.assign(**dict(zip(by, key)))[[*by, "lon", "lat"]]
            hulls.clear()

        for batch in batches:
            for key, part in batch.groupby(by, sort=False, dropna=False):
                xy = part[["lon", "lat"]].to_numpy()
                held = hulls.get(key)
                hulls[key] = hull_vertices(xy if held is None else np.vstack([held, xy]))
            if sum(map(len, hulls.values())) > _HELD:
                yield from flush()
        yield from flush()

    return reduce_task


def _outside_octagon(points: DataFrame, by: list[str]) -> DataFrame:
    """Drop points strictly inside the octagon of extreme points of their group. Never drops a vertex."""
    lon, lat = F.col("lon"), F.col("lat")
    corners = [
        F.max_by(value, dx * lon + dy * lat).alias(f"_{axis}{k}")
        for k, (dx, dy) in enumerate(_DIRECTIONS)
        for axis, value in (("x", lon), ("y", lat))
    ]
    listed = broadcast_if_small(pin(points.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*corners)))
    inside, sized = [], []
    for k in range(len(_DIRECTIONS)):
        ax, ay = F.col(f"_x{k}"), F.col(f"_y{k}")
        n = (k + 1) % len(_DIRECTIONS)
        bx, by_ = F.col(f"_x{n}"), F.col(f"_y{n}")
        empty = (ax == bx) & (ay == by_)
        cross = (bx - ax) * (lat - ay) - (by_ - ay) * (lon - ax)
        inside.append(empty | (cross > _MARGIN))
        sized.append(~empty)
    dropped = reduce(operator.and_, inside) & reduce(operator.or_, sized)
    return points.join(listed, by).where(~dropped).select(*[F.col(f"`{c}`") for c in by], "lon", "lat")


def convex_hull(points: DataFrame, by: Sequence[str] = (), geometry: str = "geometry") -> DataFrame:
    """One hull per group: ``by`` + ``rings``, computed once and pinned. A single point and a line come back as degenerate rings.

    Raises ``ValueError`` when there is no finite position at all. Rows with a NULL group are dropped.
    """
    by = list(by)
    located = decode_points(points, geometry).select(*[F.col(f"`{c}`") for c in by], "lon", "lat")
    located = located.where(is_finite(F.col("lon")) & is_finite(F.col("lat")))
    for c in by:
        located = located.where(F.col(f"`{c}`").isNotNull())
    groups = by or ["_all"]
    if not by:
        located = located.select(F.lit(0).alias("_all"), "lon", "lat")
    narrowed = _outside_octagon(located, groups)
    fields = [located.schema[c] for c in groups]
    vertices = T.StructType([*fields, T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
    rings = T.StructType([*fields, T.StructField("rings", T._parse_datatype_string(RINGS))])

    def close(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        ring = _ring(hull_vertices(part[["lon", "lat"]].to_numpy()))
        return pd.DataFrame({**{c: [v] for c, v in zip(groups, key)}, "rings": [ring]})

    names = [F.col(f"`{c}`") for c in groups]
    vertex_rows = narrowed.mapInPandas(_partial(groups), vertices)
    # by position, not by group: a hot group is spread over all tasks
    fewer = vertex_rows.repartition("lon", "lat").mapInPandas(_partial(groups), vertices)
    hulls = pin(fewer.groupBy(*names).applyInPandas(close, rings))
    if hulls.isEmpty():
        raise ValueError("no geometries found")
    return hulls if by else hulls.select("rings")


def _side(a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Cross products of every line a[i]→b[i] (rows) with every point (columns)."""
    run = b - a
    return run[:, :1] * (p[:, 1] - a[:, 1:]) - run[:, 1:] * (p[:, 0] - a[:, :1])


def _edges(shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return shape, np.roll(shape, -1, axis=0)


def _inside(p: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Which points a convex shape (point, segment or counter-clockwise polygon) covers."""
    boxed = ((p >= shape.min(axis=0)) & (p <= shape.max(axis=0))).all(axis=1)
    return boxed & (_side(*_edges(shape), p) >= 0).all(axis=0)


def _clip_convex(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Common part of two convex shapes: the hull of vertices inside the other shape and of edge crossings.

    Vertices are taken over unchanged, so a position on the border stays on the border.
    """
    if not len(one) or not len(other):
        return one[:0]
    (a, b), (c, d) = _edges(one), _edges(other)
    ac, bd = _side(c, d, a), _side(c, d, b)
    ca, db = _side(a, b, c).T, _side(a, b, d).T
    j, i = np.nonzero((ac * bd < 0) & (ca * db < 0))
    share = (ac[j, i] / (ac[j, i] - bd[j, i]))[:, None]
    crossings = a[i] + (b[i] - a[i]) * share
    return hull_vertices(np.vstack([one[_inside(one, other)], other[_inside(other, one)], crossings]))


def _intersect(rings: Sequence) -> np.ndarray:
    shapes = [np.array([[p["x"], p["y"]] for p in r[0]])[:-1] for r in rings]
    return reduce(lambda kept, s: _clip_convex(kept, s) if len(kept) else kept, shapes[1:], hull_vertices(shapes[0]))


def _frame(shapes: list) -> pd.DataFrame:
    return pd.DataFrame({"rings": pd.Series(shapes, dtype=object)})


def _fold_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shapes: list = []
    for batch in batches:
        shapes.extend(batch["rings"])
        kept = _intersect(shapes)
        shapes = [_ring(kept)] if len(kept) else [None]
        if shapes[0] is None:
            break
    if shapes:
        yield _frame(shapes)


def combine_hulls(hulls: DataFrame, operation: str = "union") -> DataFrame:
    """``union``: the dissolved outline of all hulls, as parts that do not overlap.

    ``intersection``: the common area as one convex part, or no row when there is none.
    """
    parts = hulls.select("rings")
    if operation == "union":
        return dissolve(parts)
    if operation != "intersection":
        raise ValueError("operation must be 'union' or 'intersection'")

    def fold(part: pd.DataFrame) -> pd.DataFrame:
        if part["rings"].isna().any():
            return _frame([])
        kept = _intersect(sorted(part["rings"], key=lambda r: [(p["x"], p["y"]) for p in r[0]]))
        return _frame([_ring(kept)] if len(kept) else [])

    schema = f"rings {RINGS}"
    per_task = parts.mapInPandas(_fold_task, schema)
    return pin(per_task.groupBy(F.lit(0).alias("_all")).applyInPandas(fold, schema))
