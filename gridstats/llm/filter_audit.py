"""What each filter of a chain removes, alone, in every order and in its fair share, without running any order.

Every row gets a mask of the filters that it fails. A coalition of filters removes the rows whose mask meets it, so the
counts by mask, at most 2 ** m a part, hold the removals of all 2 ** m coalitions, and a step of any order is the
difference of two of them. The share of each filter (Shapley value) is the solution of a least-squares problem: the
additive game that is nearest to the tabulated removals, coalitions weighted by the Shapley kernel, with shares that sum
up to what all filters remove together. Its normal equations are solved in rationals, so the shares are exact.

Rows are only counted: the texts are read once, and what is exchanged is one short row each (for the search of repeated
texts) and then counts by mask.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.plans.sizing import spill

MOST = 7  # filters: each part has m! orders of m steps


def mask_of(conditions: Sequence[Column]) -> Column:
    """Bit k is set where the k-th condition holds; an unknown condition counts as not failed."""
    bits = [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(conditions)]
    total = F.lit(0)
    for bit in bits:
        total = total + bit
    return total.cast("int")


def with_repeats(rows: DataFrame, digest: str, key: str, bit: int) -> DataFrame:
    """``rows`` with ``bit`` added to ``mask`` where a row with a smaller ``key`` has the same ``digest``.

    A null key is smaller than none and has none smaller. The least key of each digest combines on the map side, and the
    rows meet it on both columns, so the copies of one text stay spread over all tasks.
    """
    least = rows.where(F.col(key).isNotNull()).groupBy(digest).agg(F.min(key).alias(key))
    met = rows.join(least.withColumn("_least", F.lit(1)), [digest, key], "left")
    later = F.col(key).isNotNull() & F.col("_least").isNull()
    return met.withColumn("mask", F.col("mask") + F.when(later, F.lit(bit)).otherwise(F.lit(0))).drop("_least")


def removals(by_mask: dict[int, int], filters: int) -> list[int]:
    """The rows that each coalition of filters removes."""
    return [sum(n for mask, n in by_mask.items() if mask & coalition) for coalition in range(1 << filters)]


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination in rationals."""
    rows = [[*line, value] for line, value in zip(matrix, right, strict=True)]
    n = len(rows)
    for k in range(n):
        pivot = next(i for i in range(k, n) if rows[i][k] != 0)
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [v / rows[k][k] for v in rows[k]]
        for i in range(n):
            if i != k and rows[i][k] != 0:
                factor = rows[i][k]
                rows[i] = [v - factor * w for v, w in zip(rows[i], rows[k], strict=True)]
    return [line[n] for line in rows]


def shares(values: Sequence[int], filters: int) -> list[Fraction]:
    """The Shapley value of each filter from the removals of all coalitions.

    Least squares over the coalitions between none and all, weights (m - 1) / (C(m, s) s (m - s)), under the condition that
    the shares sum up to the removals of all; the last unknown is the multiplier of that condition.
    """
    everything = (1 << filters) - 1
    matrix = [[Fraction(0)] * (filters + 1) for _ in range(filters + 1)]
    right = [Fraction(0)] * (filters + 1)
    for coalition in range(1, everything):
        size = coalition.bit_count()
        weight = Fraction(filters - 1, comb(filters, size) * size * (filters - size))
        inside = [k for k in range(filters) if coalition >> k & 1]
        for i in inside:
            right[i] += weight * values[coalition]
            for j in inside:
                matrix[i][j] += weight
    for k in range(filters):
        matrix[k][filters] = matrix[filters][k] = Fraction(1)
    right[filters] = Fraction(values[everything])
    return solved(matrix, right)[:filters]


def audit(counts: DataFrame, letters: str, lost: Sequence[str] = ()) -> DataFrame:
    """Every step of every order of the filters, for each part of ``counts(part, mask, documents, *lost)``.

    ``letters`` names the filters by the bits of ``mask``. Returns part, filter_order, step (from 1), and long counts: kept
    (after this step), removed (here), redundant (failing this filter, removed earlier), unique_fails (failing this filter
    only), ``<flag>_lost`` for each of ``lost`` (removed here) and shapley: the filter's removals summed over all orders.
    A part is one group of at most ``2 ** len(letters)`` counts. No rows give no parts.
    """
    many = len(letters)
    if not 1 <= many <= MOST or len(set(letters)) != many:
        raise ValueError(f"1 to {MOST} filters with different letters")
    steps = [*["kept", "removed", "redundant", "unique_fails"], *[f"{name}_lost" for name in lost], "shapley"]

    def table(group: pd.DataFrame) -> pd.DataFrame:
        part = group["part"].iloc[0]
        rows = group["documents"].sum()
        found = {name: removals(dict(zip(group["mask"], group[name], strict=True)), many) for name in ("documents", *lost)}
        gone = found["documents"]
        everything = (1 << many) - 1
        fair = [int(v * factorial(many)) for v in shares(gone, many)]
        listed = []
        for order in permutations(range(many)):
            before = 0
            name = "".join(letters[k] for k in order)
            for step, k in enumerate(order, 1):
                after = before | 1 << k
                here = gone[after] - gone[before]
                alone = gone[everything] - gone[everything ^ 1 << k]
                flags = [found[flag][after] - found[flag][before] for flag in lost]
                listed.append((part, name, step, rows - gone[after], here, gone[1 << k] - here, alone, *flags, fair[k]))
                before = after
        return pd.DataFrame(listed, columns=["part", "filter_order", "step", *steps])

    schema = ", ".join(["part string, filter_order string, step int", *[f"{name} long" for name in steps]])
    return counts.groupBy("part").applyInPandas(table, schema)


def audited(
    docs: DataFrame,
    conditions: dict[str, Column],
    part: Column,
    flags: DataFrame | None = None,
    repeated: str | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``audit`` of ``docs``: ``conditions`` are failure conditions by letter, ``part`` the value that splits the report.

    ``repeated`` is the letter of one more filter: fails where a row with a smaller ``key`` has the same ``text``
    anywhere in the table, removed or not. ``flags`` has ``key`` and boolean columns; the flagged rows that a step removes are
    counted as ``<flag>_lost``. A key that flags list several times is flagged if any of its rows is; keys they do not list,
    and null keys, are not flagged. A null text counts as empty and a null part as an empty string. Rows that repeat a
    key are rows like others; rows with equal key and text are no copies of each other. Texts are examined whole, however
    long; a text is one row, so its words fit a task. Other columns, whatever their names, are left alone.
    """
    names = [c for c in (flags.columns if flags is not None else []) if c != key]
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("_digest"),
        F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        mask_of(list(conditions.values())).alias("mask"),
    )
    rows = spill(rows.groupBy(*rows.columns).agg(F.count("*").alias("documents")))
    letters = "".join(conditions)
    if repeated is not None:
        rows = with_repeats(rows, "_digest", "_key", 1 << len(letters))
        letters += repeated
    if names:
        marked = flags.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_key"))
        rows = rows.join(marked.agg(*[F.max(F.col(f"`{n}`").cast("int")).alias(f"_flag_{n}") for n in names]), "_key", "left")
    flagged = [F.sum(F.when(F.col(f"_flag_{n}") == 1, F.col("documents")).otherwise(F.lit(0))).alias(n) for n in names]
    return audit(rows.groupBy("part", "mask").agg(F.sum("documents").alias("documents"), *flagged), letters, names)


# The conditions of the corpus filters, on whole texts.
def quality_conditions(text: str = "text") -> dict[str, Column]:
    """A: under 100 words; B: under 80 % of the words distinct; C: over 10 % capitals; D: holds one of ``#$%&*|``.

    Words are runs of anything but x20 and x09 to x0D, told apart by case. A null text counts as empty.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    words = F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+"), "")
    capitals = F.octet_length(whole) - F.octet_length(F.regexp_replace(whole, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(whole),
        "D": whole.rlike(r"[#$%&*|]"),
    }
