"""Exact medians of hot groups without ever bringing a group into one task.

Three map-side-combined counts per call, whatever the size of the largest group:

1. a quantile sketch gives each (group, column) a narrow bracket around its middle;
2. every row falls into one of ``BUCKETS`` + 2 ordered buckets (below, inside the bracket, above) and the
   buckets are counted exactly; running totals name the one or two buckets that hold the middle ranks;
3. only rows of those buckets are counted by value, and the middle values are read off.

The sketch merely places the bucket borders; the counts are exact, so the result does not depend on it.
What each step passes on is a few rows per hot group: computed once, and broadcast when provably small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.constants import APPROX_ACCURACY
from gridstats.plans.sizing import broadcast_if_small, pin
from gridstats.plans.skew import running_total

BUCKETS = 1024
_MARGIN = 0.001


def median_column(column: str, median: str) -> Column:
    """Median aggregate of one column: ``exact`` (interpolated), ``disc`` (an actual value) or ``approx`` (the same from a
    sketch, of fewer than ``APPROX_ACCURACY / 2`` values exactly)."""
    if median == "exact":
        return F.percentile(F.col(f"`{column}`"), F.lit(0.5))
    if median == "disc":
        return F.expr(f"percentile_disc(0.5) within group (order by `{column}`)")
    if median == "approx":
        return F.percentile_approx(F.col(f"`{column}`"), 0.5, APPROX_ACCURACY)
    raise ValueError("median must be 'exact', 'disc' or 'approx'")


def _bucket(x: Column, low: Column, high: Column) -> Column:
    step = F.floor(F.try_divide(x - low, high - low) * BUCKETS)
    inside = F.least(F.coalesce(step, F.lit(0)), F.lit(BUCKETS - 1)) + 1
    return F.when(x < low, 0).when(x > high, BUCKETS + 1).otherwise(inside).cast("int")


def split_medians(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], median: str) -> DataFrame:
    """``keys`` + one median per column, for any number of arbitrarily large groups."""
    group = [F.col(f"`{k}`") for k in keys]
    sketches = rows.groupBy(*group).agg(
        F.array(*[
            F.struct(
                F.percentile_approx(F.col(f"`{c}`"), F.array(F.lit(0.5 - _MARGIN), F.lit(0.5 + _MARGIN)), APPROX_ACCURACY)
                .cast("array<double>").alias("span"),
                F.count(F.col(f"`{c}`")).alias("size"),
            )
            for c in columns
        ]).alias("_sketch")
    )
    sketch = pin(sketches)
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    long = (
        rows.withColumn("_values", values)
        .join(broadcast_if_small(sketch), list(keys))
        .select(*group, F.posexplode(F.arrays_zip(F.col("_values").alias("x"), F.col("_sketch").alias("s"))).alias("_c", "_v"))
        .select(*group, "_c", F.col("_v.x").alias("_x"), F.col("_v.s.span").alias("_span"), F.col("_v.s.size").alias("_size"))
        .where(F.col("_x").isNotNull())
        .withColumn("_b", _bucket(F.col("_x"), F.col("_span")[0], F.col("_span")[1]))
    )
    # zero-based ranks of the lower and upper middle value
    size = F.col("_size")
    if median == "exact":
        ranks = (F.floor((size - 1) / 2), F.floor(size / 2))
    else:
        ranks = (F.ceil(size * 0.5) - 1, F.ceil(size * 0.5) - 1)

    cell = [*keys, "_c"]
    end = running_total(F.col("_rows"), cell, ["_b"])
    buckets = (
        long.groupBy(*group, "_c", "_b")
        .agg(F.count("*").alias("_rows"), F.first("_size").alias("_size"))
        .withColumns({"_low": ranks[0], "_high": ranks[1], "_end": end})
        .withColumn("_start", F.col("_end") - F.col("_rows"))
        .where((F.col("_end") > F.col("_low")) & (F.col("_start") <= F.col("_high")))
        .select(*group, "_c", "_b", "_start", "_low", "_high")
    )
    picked = pin(buckets)
    bucket = [*cell, "_b"]
    upto = F.col("_start") + running_total(F.col("_rows"), bucket, ["_x"])

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_upto")), F.col("_x")))

    middles = (
        long.drop("_span", "_size")
        .join(broadcast_if_small(picked), bucket)
        .groupBy(*group, "_c", "_b", "_x", "_start", "_low", "_high")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_upto", upto)
        .withColumn("_first", F.col("_upto") - F.col("_rows"))
        .groupBy(*group, "_c")
        .agg(value_at(F.col("_low")).alias("_a"), value_at(F.col("_high")).alias("_z"))
    )
    halves = F.when(F.col("_a") == F.col("_z"), F.col("_a")).otherwise(0.5 * F.col("_a") + 0.5 * F.col("_z"))
    wide = middles.groupBy(*group).agg(
        *[F.max(F.when(F.col("_c") == i, halves)).alias(c) for i, c in enumerate(columns)]
    )
    return pin(wide)
