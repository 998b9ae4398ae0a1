"""Hot keys: find them with one map-side-combined count, then split them.

A key that holds a large share of all rows would make one task do that share of the work. The helpers below
find all such keys exactly; every other key holds at most ``min_rows`` rows and is safe in one task. The list of
hot keys is computed once and stays distributed: it is broadcast when provably small and joined by shuffle else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.plans.sizing import broadcast_if_small, pin

# Rows of one key above which the key is split. A task holds the distinct values of one key in memory for an
# exact median, so this also bounds its memory (some tens of megabytes per column).
HOT_ROWS = 200_000


def column_names(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS, rows_bound: int | None = None) -> DataFrame | None:
    """The keys with more than ``min_rows`` rows and their ``_rows``, or ``None`` when there are none.

    ``rows_bound`` is a cheap upper bound on the rows of one key; when it rules hot keys out, nothing is
    counted. The count combines on the map side, so only (key, count) pairs are shuffled, and it is made once.
    """
    if rows_bound is not None and rows_bound <= min_rows:
        return None
    counts = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("*").alias("_rows"))
    found = pin(counts.where(F.col("_rows") > min_rows))
    return None if found.isEmpty() else found


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (left[f"`{key}`"] == right[f"`{key}`"])
    return condition


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, hot rows)."""
    listed = broadcast_if_small(hot.select(*[F.col(f"`{k}`") for k in keys]))
    return df.join(listed, list(keys), "left_anti"), df.join(listed, list(keys), "left_semi")


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    salt_by: Sequence[str],
    min_rows: int = HOT_ROWS,
    rows_bound: int | None = None,
) -> DataFrame:
    """Inner equi join for a ``small`` side that is too large to broadcast.

    Rows of ``big`` under a hot key are spread by a hash of ``salt_by`` over as many sub-keys as give each about
    ``min_rows`` rows; only the matching rows of ``small`` are repeated. All other keys join as they are.
    """
    hot = hot_keys(big, keys, min_rows, rows_bound)
    if hot is None:
        return big.join(small, list(keys))
    salts = F.ceil(F.col("_rows") / min_rows).cast("int")
    listed = broadcast_if_small(hot.select(*[F.col(f"`{k}`") for k in keys], salts.alias("_salts")))
    many = F.coalesce(F.col("_salts"), F.lit(1))
    salt = F.pmod(F.xxhash64(*salt_by), many).cast("int")
    left = big.join(listed, list(keys), "left").withColumn("_salt", salt).drop("_salts")
    right = small.join(listed, list(keys), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), many - 1))).drop("_salts")
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def running_total(value: Column, partition: Sequence[str], order: Sequence[str]) -> Column:
    window = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(window)
