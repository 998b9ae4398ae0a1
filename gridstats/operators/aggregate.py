"""Per time and node statistics: plain, circular (angles) and projected toward a fixed point.

Rows reach a group through one exchange. Ordinary groups take their medians and median absolute
deviations from two windows over that exchange, then collapse in place. Groups with more than
``hot_rows`` rows are split off first and never meet in one task (see ``medians``). The node geometry
does not travel with the rows: it is joined to the finished groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from gridstats.constants import DEFAULT_RADIUS_KM, UNIT_WEIGHT
from gridstats.functions.geo import angle_deg, dispersion, projection_factor, sin_cos
from gridstats.functions.wkb import decode_points, point_wkb
from gridstats.operators.faults import observe_faults
from gridstats.operators.link import pair_points
from gridstats.operators.medians import median_column, split_medians
from gridstats.plans.sizing import broadcast_if_small, fits_broadcast, pin, spill
from gridstats.plans.skew import HOT_ROWS, hot_keys, skew_join, split_hot

STATISTICS = ("mean", "median", "stddev", "min", "max", "n", "mad")


def _names(columns: Sequence[str] | str) -> list[str]:
    parts = columns.split(",") if isinstance(columns, str) else columns
    return list(dict.fromkeys(p.strip() for p in parts if p.strip()))


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def stat_names(column: str) -> list[str]:
    return [f"{column}_{s}" for s in STATISTICS]


# ---------------------------------------------------------------- statistics of groups


def _moments(column: str) -> list[Column]:
    x = F.col(f"`{column}`")
    return [
        F.avg(x).alias(f"{column}_mean"),
        F.stddev_samp(x).alias(f"{column}_stddev"),
        F.min(x).alias(f"{column}_min"),
        F.max(x).alias(f"{column}_max"),
        F.count(x).alias(f"{column}_n"),
    ]


def _layout(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(*_quoted(keys), "n", *_quoted([s for c in columns for s in stat_names(c)]))


def _in_windows(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], median: str) -> DataFrame:
    """Both windows and the final aggregate share one exchange and one sort on ``keys``."""
    window = Window.partitionBy(*_quoted(keys))
    med = {f"_median_{i}": median_column(c, median).over(window) for i, c in enumerate(columns)}
    gap = {f"_gap_{i}": F.abs(F.col(f"`{c}`") - F.col(f"_median_{i}")) for i, c in enumerate(columns)}
    mad = {f"_mad_{i}": median_column(f"_gap_{i}", median).over(window) for i in range(len(columns))}
    if columns:
        rows = rows.withColumns(med).withColumns(gap).withColumns(mad)
    picks = [
        F.max(F.col(f"_{s}_{i}")).alias(f"{c}_{s}") for i, c in enumerate(columns) for s in ("median", "mad")
    ]
    moments = [m for c in columns for m in _moments(c)]
    return _layout(rows.groupBy(*_quoted(keys)).agg(F.count("*").alias("n"), *moments, *picks), keys, columns)


def _in_pieces(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], median: str) -> DataFrame:
    """The same for hot groups, by map-side-combined aggregates only.

    """
    rows = rows.select(*_quoted(dict.fromkeys([*keys, *columns])))
    moments = rows.groupBy(*_quoted(keys)).agg(F.count("*").alias("n"), *[m for c in columns for m in _moments(c)])
    if not columns:
        return _layout(moments, keys, columns)
    middle = split_medians(rows, keys, columns, median)
    renamed = middle.withColumnsRenamed({c: f"{c}_median" for c in columns})
    gaps = rows.join(broadcast_if_small(renamed), list(keys)).select(
        *_quoted(keys), *[F.abs(F.col(f"`{c}`") - F.col(f"`{c}_median`")).alias(c) for c in columns]
    )
    spread = split_medians(gaps, keys, columns, median).withColumnsRenamed({c: f"{c}_mad" for c in columns})
    # left: a group whose values are all NULL has no median
    joined = moments.join(broadcast_if_small(renamed), list(keys), "left").join(broadcast_if_small(spread), list(keys), "left")
    return _layout(joined, keys, columns)


def _in_sketches(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], rows_bound: int | None) -> DataFrame:
    """The same from quantile sketches alone: they combine on the map side, so no group is hot.

    One pass sketches the values, the next their distances from the medians, which come to the rows by a broadcast when
    they are provably few. Both read the written rows: what makes them, a spatial join, runs once.
    """
    moments = [m for c in columns for m in _moments(c)]
    picks = []
    if columns:
        rows = spill(rows.select(*_quoted(dict.fromkeys([*keys, *columns]))))
        medians = [median_column(c, "approx").cast("double").alias(f"_median_{i}") for i, c in enumerate(columns)]
        middles = pin(rows.groupBy(*_quoted(keys)).agg(*medians))
        if fits_broadcast(middles):
            rows = rows.join(F.broadcast(middles), list(keys))
        else:
            rows = skew_join(rows, middles, keys, _quoted(columns), rows_bound=rows_bound)
        gap = {f"_gap_{i}": F.abs(F.col(f"`{c}`") - F.col(f"_median_{i}")) for i, c in enumerate(columns)}
        rows = rows.withColumns(gap)
        for i, c in enumerate(columns):
            picks += [F.first(f"_median_{i}").alias(f"{c}_median"), median_column(f"_gap_{i}", "approx").alias(f"{c}_mad")]
    return _layout(rows.groupBy(*_quoted(keys)).agg(F.count("*").alias("n"), *moments, *picks), keys, columns)


def group_stats(
    rows: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    median: str = "exact",
    hot_rows: int | None = HOT_ROWS,
    rows_bound: int | None = None,
) -> DataFrame:
    """``keys``, ``n`` and seven statistics per column; keys must not be NULL.

    ``hot_rows=None`` skips the search for hot groups. ``median="approx"`` takes medians and MADs from sketches: actual
    values, exact in groups of fewer than 10,000 rows, and beyond that off by few ranks in ten thousand.
    """
    keys, columns = list(keys), list(columns)
    median_column("x", median)  # refuses an unknown kind early
    if median == "approx":
        return _in_sketches(rows, keys, columns, rows_bound)
    hot = None
    if hot_rows is not None and (rows_bound is None or rows_bound > hot_rows):
        # counting, both parts and their passes read the written rows: what makes them, a spatial join, runs once
        rows = spill(rows.select(*_quoted(dict.fromkeys([*keys, *columns]))))
        hot = hot_keys(rows, keys, hot_rows)
    if hot is None:
        return _in_windows(rows, keys, columns, median)
    ordinary, large = split_hot(rows, hot, keys)
    return _in_windows(ordinary, keys, columns, median).unionByName(_in_pieces(large, keys, columns, median))


def with_mad(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], median: str = "exact", **skew) -> DataFrame:
    """Median and unscaled median absolute deviation per group."""
    stats = group_stats(rows, keys, columns, median, **skew)
    return stats.select(*_quoted(keys), *_quoted([f"{c}_{s}" for c in columns for s in ("median", "mad")]))


# ---------------------------------------------------------------- rows × nodes


@dataclass(frozen=True)
class _Shape:
    """Names that decide keys and output order."""

    time: str
    partition_by: tuple[str, ...]

    @property
    def keys(self) -> list[str]:
        return list(dict.fromkeys([self.time, *self.partition_by]))

    @property
    def leading(self) -> list[str]:
        return [] if self.time in self.partition_by else [self.time]


def _shape(points: DataFrame, time: str, partition_by: Sequence[str] | str) -> _Shape:
    shape = _Shape(time, tuple(_names(partition_by)))
    missing = [c for c in shape.keys if c not in points.columns]
    if missing:
        raise ValueError(f"unknown time or partition columns: {', '.join(missing)}")
    return shape


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {', '.join(missing)}")


def _nodes(grid: DataFrame) -> DataFrame:
    """Distinct nodes with their geometry, and coordinates where the grid has them; none without geometry."""
    if "geometry" not in grid.columns:
        plain = grid.select("node_id", "lon", "lat").where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        return plain.distinct().withColumn("geometry", point_wkb("lon", "lat"))
    picked = [c for c in ("node_id", "geometry", "lon", "lat") if c in grid.columns]
    return grid.select(*picked).where(F.col("geometry").isNotNull()).distinct()


def _present(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.where(F.col(f"`{key}`").isNotNull())
    return df


def _rows(
    points: DataFrame,
    links: DataFrame | None,
    grid: DataFrame,
    carried: Sequence[str],
    shape: _Shape,
    radius_km: float,
    hot_rows: int | None,
    small_grid: bool,
    dropped: Observation | None = None,
) -> DataFrame:
    """One row per (point, node) with keys and ``carried`` columns; rows with a NULL key drop out, counted by ``dropped``."""
    wanted = list(dict.fromkeys([*shape.keys, *carried]))
    require_columns(points, [c for c in wanted if c not in ("lon", "lat")])
    if dropped is not None:
        # an observed row is read whole, so only the needed columns are in it
        places = [c for c in ("rowid", "geometry", "lon", "lat") if c in points.columns]
        points = points.select(*_quoted(dict.fromkeys([*places, *[c for c in wanted if c in points.columns]])))
        points = observe_faults(points, dropped, shape.keys)
    points = _present(points, shape.keys)
    if links is None:
        pairs = pair_points(
            points, grid, radius_km, keep=wanted, hot_rows=hot_rows or HOT_ROWS, broadcast_grid=small_grid
        )
        return pairs.select(*_quoted(wanted), "node_id")
    if "lon" in wanted or "lat" in wanted:
        points = decode_points(points)
    left = points.select(*_quoted(dict.fromkeys(["rowid", *wanted])))
    return left.join(links.select("rowid", "node_id"), "rowid").select(*_quoted(wanted), "node_id")


def _rows_bound(points: DataFrame, keys: Sequence[str], hot_rows: int | None) -> int | None:
    """Upper bound of the rows of any group, from the points alone.

    A point meets a node at most once, so no group is larger than the points that share its time and
    partition values. Usually that settles that no group is hot, without pairing or shuffling anything.
    """
    if hot_rows is None:
        return None
    total = points.count()
    if total <= hot_rows:
        return total
    sizes = _present(points, keys).groupBy(*_quoted(keys)).agg(F.count("*").alias("_rows"))
    return sizes.agg(F.max("_rows")).first()[0] or 0


def _finish(
    stats: DataFrame,
    nodes: DataFrame,
    shape: _Shape,
    on: Sequence[str],
    body: Sequence[str],
    parts_first: bool,
    small_grid: bool,
) -> DataFrame:
    """Attach the node geometry to finished groups and order the columns."""
    joined = stats.join(F.broadcast(nodes) if small_grid else nodes, list(on))
    parts = list(shape.partition_by)
    tail = [*parts, *body] if parts_first else [*body, *parts]
    return joined.select(*_quoted(shape.leading), "node_id", "geometry", "n", *_quoted(tail))


def aggregate_grid(
    points: DataFrame,
    links: DataFrame | None,
    grid: DataFrame,
    columns: Sequence[str] | str,
    time: str = "timestamp",
    partition_by: Sequence[str] | str = (),
    median: str = "exact",
    radius_km: float = DEFAULT_RADIUS_KM,
    hot_rows: int | None = HOT_ROWS,
    dropped: Observation | None = None,
) -> DataFrame:
    """Statistics per time, node and partition columns.

    ``links=None`` pairs points and nodes on the fly within ``radius_km``: the points are then neither
    written nor shuffled before the grouping. ``n`` counts all rows of a group, ``<column>_n`` the
    non-NULL ones. Rows with a NULL time or partition value are dropped. ``dropped`` is filled with the numbers of rows
    read and left out, by reason (``faults``), by the pass that makes the statistics.
    """
    columns = _names(columns)
    shape = _shape(points, time, partition_by)
    small = fits_broadcast(grid)
    rows = _rows(points, links, grid, columns, shape, radius_km, hot_rows, small, dropped)
    bound = _rows_bound(points, shape.keys, hot_rows)
    stats = group_stats(rows, [*shape.keys, "node_id"], columns, median, hot_rows, bound)
    nodes = _nodes(grid).select("node_id", "geometry")
    return _finish(stats, nodes, shape, ["node_id"], [s for c in columns for s in stat_names(c)], parts_first=False, small_grid=small)


# ---------------------------------------------------------------- angles


@dataclass(frozen=True)
class _Angle:
    name: str
    magnitude: str | None

    @property
    def sin(self) -> str:
        return f"{self.name}_sin"

    @property
    def cos(self) -> str:
        return f"{self.name}_cos"


def pair_angles(directions: Sequence[str] | str, magnitudes: Sequence[str] | str | None = None) -> list[_Angle]:
    """Match directions with magnitudes; the word ``skip`` (any case) means unit weight."""
    directions = _names(directions)
    if not magnitudes:
        return [_Angle(d, None) for d in directions]
    weights = [m.strip() for m in (magnitudes.split(",") if isinstance(magnitudes, str) else magnitudes)]
    if not directions:
        raise ValueError("magnitudes need directions")
    if len(weights) != len(directions):
        raise ValueError("magnitudes must match directions one to one")
    return [_Angle(d, None if w.lower() == UNIT_WEIGHT else w) for d, w in zip(directions, weights)]


def with_components(df: DataFrame, angles: Sequence[_Angle]) -> DataFrame:
    """Add ``<angle>_sin`` and ``<angle>_cos``, times the magnitude where there is one."""
    added = {}
    for a in angles:
        weight = F.col(f"`{a.magnitude}`") if a.magnitude else None
        added[a.sin], added[a.cos] = sin_cos(F.col(f"`{a.name}`"), weight)
    return df.withColumns(added)


def _angle_stats(a: _Angle) -> list[Column]:
    """Mean and median in degrees, dispersion and its MAD analogue in radians, and the count."""

    def part(component: str, statistic: str) -> Column:
        return F.col(f"`{component}_{statistic}`")

    def weight(statistic: str) -> Column | None:
        return part(a.magnitude, statistic) if a.magnitude else None

    return [
        angle_deg(part(a.sin, "mean"), part(a.cos, "mean")).alias(f"{a.name}_mean"),
        angle_deg(part(a.sin, "median"), part(a.cos, "median")).alias(f"{a.name}_median"),
        dispersion(part(a.sin, "mean"), part(a.cos, "mean"), weight("mean")).alias(f"{a.name}_stddev"),
        dispersion(part(a.sin, "mad"), part(a.cos, "mad"), weight("mad")).alias(f"{a.name}_mad"),
        part(a.sin, "n").alias(f"{a.name}_n"),
    ]


def aggregate_direction(
    points: DataFrame,
    links: DataFrame | None,
    grid: DataFrame,
    columns: Sequence[str] | str,
    directions: Sequence[str] | str,
    magnitudes: Sequence[str] | str | None = None,
    time: str = "timestamp",
    partition_by: Sequence[str] | str = (),
    median: str = "exact",
    radius_km: float = DEFAULT_RADIUS_KM,
    hot_rows: int | None = HOT_ROWS,
    dropped: Observation | None = None,
) -> DataFrame:
    """``aggregate_grid`` with angle columns, optionally weighted by magnitudes; one lazy plan.

    Angles listed in ``columns`` are not aggregated as scalars. A magnitude is reported as a scalar only
    if ``columns`` names it too.
    """
    angles = pair_angles(directions, magnitudes)
    if not angles:
        return aggregate_grid(points, links, grid, columns, time, partition_by, median, radius_km, hot_rows, dropped)
    scalars = [c for c in _names(columns) if c not in {a.name for a in angles}]
    shape = _shape(points, time, partition_by)
    small = fits_broadcast(grid)
    weights = [a.magnitude for a in angles if a.magnitude]
    carried = list(dict.fromkeys([*scalars, *weights, *[a.name for a in angles]]))
    # components are made after the pairing, so two doubles less per angle pass through the join
    rows = with_components(_rows(points, links, grid, carried, shape, radius_km, hot_rows, small, dropped), angles)
    measured = list(dict.fromkeys([*scalars, *weights, *[c for a in angles for c in (a.sin, a.cos)]]))
    keys = [*shape.keys, "node_id"]
    rows = rows.select(*_quoted(keys), *_quoted(measured))
    bound = _rows_bound(points, shape.keys, hot_rows)
    stats = group_stats(rows, keys, measured, median, hot_rows, bound)
    body = [s for c in scalars for s in stat_names(c)]
    final = stats.select(*_quoted(keys), "n", *_quoted(body), *[s for a in angles for s in _angle_stats(a)])
    body += [f"{a.name}_{s}" for a in angles for s in ("mean", "median", "stddev", "mad", "n")]
    nodes = _nodes(grid).select("node_id", "geometry")
    return _finish(final, nodes, shape, ["node_id"], body, parts_first=True, small_grid=small)


# ---------------------------------------------------------------- projection


def aggregate_projection(
    points: DataFrame,
    links: DataFrame | None,
    grid: DataFrame,
    columns: Sequence[str] | str,
    projection_col: str,
    point_lat: float,
    point_lon: float,
    time: str = "timestamp",
    partition_by: Sequence[str] | str = (),
    median: str = "exact",
    radius_km: float = DEFAULT_RADIUS_KM,
    hot_rows: int | None = HOT_ROWS,
    dropped: Observation | None = None,
) -> DataFrame:
    """``aggregate_grid`` after turning one column toward a fixed point.

    The value of ``projection_col`` is multiplied, per (row, node), by the cosine between the directions
    to the fixed point seen from the row and from the node. Other columns are aggregated as they are.
    """
    columns = _names(columns)
    if projection_col not in columns:
        raise ValueError("the projected column must be one of the columns")
    shape = _shape(points, time, partition_by)
    small = fits_broadcast(grid)
    rows = _rows(points, links, grid, [*columns, "lon", "lat"], shape, radius_km, hot_rows, small, dropped)
    nodes = decode_points(_nodes(grid)).select(
        "node_id", "geometry", F.col("lon").alias("_node_lon"), F.col("lat").alias("_node_lat")
    )
    places = nodes.drop("geometry")
    if small:
        rows = rows.join(F.broadcast(places), "node_id")
    else:
        rows = skew_join(rows, places, ["node_id"], ["lon", "lat"], hot_rows or HOT_ROWS)
    factor = projection_factor(
        F.col("lon"), F.col("lat"), F.col("_node_lon"), F.col("_node_lat"), point_lon, point_lat
    )
    value = (F.col(f"`{projection_col}`") * factor).alias(projection_col)
    keys = [*shape.keys, "node_id", "_node_lon", "_node_lat"]
    rows = rows.select(*_quoted(keys), *[value if c == projection_col else F.col(f"`{c}`") for c in columns])
    bound = _rows_bound(points, shape.keys, hot_rows)
    stats = group_stats(rows, keys, columns, median, hot_rows, bound)
    body = [s for c in columns for s in stat_names(c)]
    return _finish(stats, nodes, shape, ["node_id", "_node_lon", "_node_lat"], body, parts_first=False, small_grid=small)
