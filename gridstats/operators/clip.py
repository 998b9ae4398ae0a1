"""Points covered by polygons, as an equi join on cells of latitude bands.

A point lies in one cell of one band. A polygon part is repeated for the cells it meets, each time with only the
edges that reach into the band; those are all the edges the covers test needs there. Cells that no edge meets are inside
or outside as a whole: only the points of the others are tested against edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.functions.polygon import covers_by_edges, ring_bounds, ring_edges, side_of
from gridstats.functions.wkb import decode_points
from gridstats.plans.sizing import broadcast_if_small

BAND_DEGREES = 0.25
# Width of a cell of a band. A part is repeated for each cell it meets, so that points of one band are spread.
CELL_DEGREES = 1.0
# Bands and cells may be halved so often, while all parts together meet at most so many cells.
HALVINGS = 8
CELLS, CELLS_PER_PART = 4096, 64


def polygon_bands(
    polygons: DataFrame,
    band: float = BAND_DEGREES,
    keep: Sequence[str] = (),
    slack: float = 0.0,
    cell: float = CELL_DEGREES,
) -> DataFrame:
    """``_band, _cell, _minx, _maxx, _edges`` and the columns ``keep`` per part, band and cell of the band. Bands and cells
    within ``slack`` of a part count as met."""
    bounds = ring_bounds(F.col("rings"))
    parts = polygons.select(
        *keep, ring_edges(F.col("rings")).alias("_all"), *[bounds[k].alias(f"_{k}") for k in ("minx", "maxx", "miny", "maxy")]
    )
    spread = F.sequence(F.floor((F.col("_miny") - slack) / band), F.floor((F.col("_maxy") + slack) / band))
    bands = parts.withColumn("_band", F.explode(spread))
    low, high = F.col("_band") * band, (F.col("_band") + 1) * band
    # one part in 10^9 of slack, so that rounding of the band borders cannot lose an edge
    beyond = slack + band * 1e-9
    reach = F.filter(
        "_all",
        lambda e: (F.least(e["y1"], e["y2"]) <= high + beyond) & (F.greatest(e["y1"], e["y2"]) >= low - beyond),
    )
    cells = F.sequence(F.floor((F.col("_minx") - slack) / cell), F.floor((F.col("_maxx") + slack) / cell))
    return bands.select(*keep, "_band", F.explode(cells).alias("_cell"), "_minx", "_maxx", reach.alias("_edges"))


def fitting_side(polygons: DataFrame) -> float:
    """Side of the smallest square cells, from ``BAND_DEGREES`` down by halves, that the parts meet few enough of."""
    bounds = ring_bounds(F.col("rings"))
    boxes = polygons.select((bounds["maxx"] - bounds["minx"]).alias("w"), (bounds["maxy"] - bounds["miny"]).alias("h"))
    sides = [BAND_DEGREES / 2**k for k in range(HALVINGS + 1)]
    met = [F.sum((F.col("w") / side + 2) * (F.col("h") / side + 2)).alias(f"_{k}") for k, side in enumerate(sides)]
    parts, *cells = boxes.agg(F.count(F.lit(1)), *met).first()
    fitting = [side for side, n in zip(sides, cells, strict=True) if n is not None and n <= CELLS + CELLS_PER_PART * parts]
    return fitting[-1] if fitting else BAND_DEGREES


def marked_cells(bands: DataFrame, band: float, cell: float) -> DataFrame:
    """The rows of ``polygon_bands`` but those of cells outside their part; ``_edges`` is NULL where a cell is inside as a whole."""
    # a little more than the cell, so that a point that rounding puts into it is in it
    south, north = (F.col("_band") - 1e-9) * band, (F.col("_band") + (1 + 1e-9)) * band
    west, east = (F.col("_cell") - 1e-9) * cell, (F.col("_cell") + (1 + 1e-9)) * cell

    def meets(e: Column) -> Column:
        apart = (F.least(e["x1"], e["x2"]) > east) | (F.greatest(e["x1"], e["x2"]) < west)
        apart = apart | (F.least(e["y1"], e["y2"]) > north) | (F.greatest(e["y1"], e["y2"]) < south)
        sides = [side_of(e, x, y) for x in (west, east) for y in (south, north)]
        return ~(apart | (F.least(*sides) > 0) | (F.greatest(*sides) < 0))

    middle = (F.col("_cell") + 0.5) * cell, (F.col("_band") + 0.5) * band
    border = F.exists("_edges", meets)
    inside = (middle[0].between(F.col("_minx"), F.col("_maxx")) & covers_by_edges(F.col("_edges"), *middle))
    marked = bands.withColumn("_kind", F.when(border, "border").when(inside, "inside")).where("_kind is not null")
    return marked.withColumn("_edges", F.when(F.col("_kind") == "border", F.col("_edges"))).drop("_kind")


def points_in_polygons(points: DataFrame, polygons: DataFrame, band: float | None = None) -> DataFrame:
    """Rows of ``points`` that any polygon part covers (boundary included).

    ``band`` is the side of the cells; without it one is chosen by the number of cells that the parts then meet.
    """
    had = set(points.columns)
    band = band or fitting_side(polygons)
    located = decode_points(points).withColumns({"_band": F.floor(F.col("lat") / band), "_cell": F.floor(F.col("lon") / band)})
    bands = marked_cells(polygon_bands(polygons, band, cell=band), band, band)
    bands = bands.withColumnsRenamed({"_band": "_part_band", "_cell": "_part_cell"})
    x, y = F.col("lon"), F.col("lat")
    tested = x.between(F.col("_minx"), F.col("_maxx")) & covers_by_edges(F.col("_edges"), x, y)
    inside = F.col("_edges").isNull() | tested
    on = (F.col("_band") == F.col("_part_band")) & (F.col("_cell") == F.col("_part_cell")) & inside
    return located.join(broadcast_if_small(bands), on, "left_semi").drop(
        "_band", "_cell", *[c for c in ("lon", "lat") if c not in had]
    )
