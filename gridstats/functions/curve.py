"""Places on a space-filling curve, as a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16  # of each axis


def hilbert_key(x: Column, y: Column, west: float = -180.0, south: float = -90.0, width: float = 360.0, height: float = 180.0, bits: int = BITS) -> Column:
    """The number of a position's cell along the Hilbert curve through ``2 ** bits`` by ``2 ** bits`` cells of a box.

    Cells that follow each other touch, so rows that are near in this order are near each other. Positions outside the box
    count to its nearest cell; a NULL or NaN position has no number.
    """
    cells = 1 << bits

    def cell(value: Column, low: float, size: float) -> Column:
        return F.least(F.greatest(F.floor((value - low) / size * cells), F.lit(0)), F.lit(cells - 1)).cast("long")

    def descend(state: Column, bit: Column) -> Column:
        # which quarter of the square holds the cell, and the cell as seen from that quarter's own curve
        right, upper = F.get(state["axes"], F.lit(0)), F.get(state["axes"], F.lit(1))
        half = F.element_at(powers, bit + 1)
        in_right, in_upper = right >= half, upper >= half
        quarter = F.when(in_right, F.when(in_upper, 2).otherwise(3)).otherwise(F.when(in_upper, 1).otherwise(0))
        a, b = F.pmod(right, half), F.pmod(upper, half)
        axes = (
            F.when(in_upper, F.array(a, b))
            .when(in_right, F.array(half - 1 - b, half - 1 - a))
            .otherwise(F.array(b, a))
        )
        return F.struct((state["number"] * 4 + quarter).cast("long").alias("number"), axes.alias("axes"))

    powers = F.array(*[F.lit(1 << k).cast("long") for k in range(bits)])
    start = F.struct(F.lit(0).cast("long").alias("number"), F.array(cell(x, west, width), cell(y, south, height)).alias("axes"))
    known = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    return F.when(known, F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, descend, lambda s: s["number"]))
