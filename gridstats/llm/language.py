"""Language of a text: the nearest of several centroids per language, by cosine of TF-IDF letter n-grams.

A text becomes counts of three-byte stretches of its letters (A-Z and accented capitals lower-cased, everything else a
blank), hashed to a fixed number of features, damped by the logarithm, weighted by how few training texts hold the
feature, and normalised. A language has several centroids, clustered by cosine from a bounded sample, because prose,
lists and headings differ. A text further from its nearest centroid than nearly all of that centroid's own texts is
rejected: it is in none of the languages learned, or in several.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.llm.text import column_bytes, slices

BITS = 12  # log2 of the number of features
SAMPLE = 600  # texts of a language that its centroids are clustered from; counts cover all texts
SPARE = 50  # further texts drawn beyond twice the sample, so that even a sample of one is found
CENTROIDS = 4  # of a language
ROUNDS = 12
OWN_SHARE = 0.995  # share of a centroid's own texts that its radius holds
BLANK = 32


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]  # of each centroid
    weights: np.ndarray  # of each feature
    centroids: np.ndarray  # rows of length 1
    nearest: np.ndarray  # least cosine that is accepted


def letters_table() -> np.ndarray:
    table = np.full(256, BLANK, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def grams(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, counts of all features) for each text, the ends of which count as blanks."""
    table = letters_table()
    offsets, raw = column_bytes(column)
    for low, high in slices(offsets, 1 << 20):
        bounds = offsets[low : high + 1] - offsets[low]
        sizes = np.diff(bounds)
        padded = np.full(int(bounds[-1]) + 2 * len(sizes), BLANK, np.uint8)
        piece = table[raw[offsets[low] : offsets[high]]]
        capital = np.flatnonzero((piece[1:] >= 0x80) & (piece[1:] <= 0x9E) & (piece[:-1] == 0xC3)) + 1
        piece[capital] += 0x20
        padded[np.arange(len(piece)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)] = piece
        wide = padded.astype(np.uint32)
        code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
        with np.errstate(over="ignore"):
            feature = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        # three blanks say nothing
        feature[code == (BLANK << 16 | BLANK << 8 | BLANK)] = 1 << BITS
        for k, row in enumerate(range(low, high)):
            begin = int(bounds[k]) + 2 * k
            yield row, np.bincount(feature[begin : begin + int(sizes[k])], minlength=(1 << BITS) + 1)[: 1 << BITS]


def vectors(column: pa.Array, weights: np.ndarray, rows: int = 256) -> Iterator[tuple[list[int], np.ndarray]]:
    """(row numbers, matrix of their normalised vectors), a few rows at a time. A text without letters is all zero."""
    places, counts = [], []

    def matrix() -> np.ndarray:
        m = np.log1p(np.array(counts, np.float32)) * weights
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)

    for row, own in grams(column):
        places.append(row)
        counts.append(own)
        if len(places) == rows:
            yield places, matrix()
            places, counts = [], []
    if places:
        yield places, matrix()


def weights_of(texts: DataFrame) -> np.ndarray:
    """ln((1 + texts) / (1 + texts with the feature)) + 1, from all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, many = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for _, own in grams(batch.column(0)):
                total += own > 0
                many += 1
        yield pa.record_batch({"feature": pa.array([-1, *range(1 << BITS)], pa.int32()), "n": pa.array([many, *total], pa.int64())})

    rows = texts.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n")).collect()
    found = dict(map(tuple, rows))
    return np.log((1 + found.get(-1, 0)) / (1 + np.array([found.get(k, 0) for k in range(1 << BITS)], float))).astype(np.float32) + np.float32(1)


def clustered(points: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, least accepted cosine of each) of unit vectors: k-means by cosine, first centres far from each other."""
    centres = [points.mean(axis=0)]
    while len(centres) < min(many, len(points)):
        norms = np.linalg.norm(np.array(centres), axis=1, keepdims=True)
        centres.append(points[np.argmin((points @ (np.array(centres) / norms).T).max(axis=1))])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        own = (points @ centres.T).argmax(axis=1)
        centres = np.array([points[own == k].mean(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
    centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    similar = points @ centres.T
    own, best = similar.argmax(axis=1), similar.max(axis=1)
    least = [np.quantile(best[own == k], 1 - OWN_SHARE) if (own == k).any() else 2.0 for k in range(len(centres))]
    return centres, np.array(least)


def train(labelled: DataFrame, sample: int = SAMPLE, many: int = CENTROIDS) -> LanguageModel:
    """The model of ``labelled(text, lang)``. Feature weights come from all rows with a lang and a letter; each language's
    centroids from ``sample`` of its different texts, those with the smallest hash. Without such rows the model is empty."""
    labelled = labelled.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    weights = weights_of(labelled)
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast(weights)
    hashed = labelled.select("lang", "text", F.xxhash64("text", F.lit(7)).alias("h"))
    # copies share a hash, so the share is one of different texts
    chance = hashed.select("lang", "h").distinct().groupBy("lang").agg(F.least(F.lit(1.0), (2.0 * sample + SPARE) / F.count("*")).alias("share"))
    # twice the wanted share is left by its hash before any row is ranked, so that no language fills a task
    drawn = hashed.join(F.broadcast(chance), "lang")
    drawn = drawn.where((F.col("h") / 2.0**64 + 0.5 < F.col("share")) | (F.col("share") >= 1)).dropDuplicates(["lang", "h"])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    drawn = drawn.withColumn("r", first).where(F.col("r") <= sample).select("lang", "text")

    def cluster(group: pa.Table) -> pa.Table:
        points = np.concatenate([m for _, m in vectors(group["text"].combine_chunks(), shared.value)])
        centres, least = clustered(points.astype(np.float64), many)
        return pa.table({"lang": pa.array([group["lang"][0].as_py()] * len(centres)), "centre": pa.array(centres.tolist(), pa.list_(pa.float64())), "least": pa.array(least)})

    rows = drawn.groupBy("lang").applyInArrow(cluster, "lang string, centre array<double>, least double").orderBy("lang", "least").collect()
    centroids = np.array([r["centre"] for r in rows], np.float32).reshape(-1, 1 << BITS)
    return LanguageModel([r["lang"] for r in rows], weights, centroids, np.array([r["least"] for r in rows]))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred", score: str = "lang_score", accepted: str = "lang_accepted") -> DataFrame:
    """``docs`` with the nearest centroid's language, its cosine (0 to 1) and whether that is within its radius.

    A text that is null or has no letter is ``und`` with score 0, not accepted; so is any text if nothing was learned.
    Columns of the three names are replaced; all rows and other columns stay.
    """
    spark = docs.sparkSession
    # plain arrays: a broadcast value is not shipped with its class
    shared = spark.sparkContext.broadcast((model.languages, model.weights, model.centroids, model.nearest))
    names = [c for c in docs.columns if c.lower() not in (lang.lower(), score.lower(), accepted.lower())]
    kept = [f"_c{i}" for i in range(len(names))]
    place = names.index(text)
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(names, kept, strict=True)], has_letter(F.col(f"`{text}`")).alias("_any"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*shared.value)
        for batch in batches:
            any_letter = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            for rows, matrix in vectors(batch.column(place), m.weights):
                part = batch.slice(rows[0], len(rows)).select(kept)
                known = any_letter[rows[0] : rows[0] + len(rows)]
                if len(m.languages):
                    similar = matrix @ m.centroids.T
                    best = similar.argmax(axis=1)
                    value = np.clip(similar.max(axis=1).astype(float), 0.0, 1.0)
                    near = value >= m.nearest[best]
                else:
                    best, value, near, known = np.zeros(len(rows), int), np.zeros(len(rows)), np.zeros(len(rows), bool), np.zeros(len(rows), bool)
                named = [m.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
                added = pa.array(named, pa.string()), pa.array(np.where(known, value, 0.0)), pa.array(near & known)
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*kept, lang, score, accepted])

    fields = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType()), T.StructField(accepted, T.BooleanType())]
    done = given.mapInArrow(run, T.StructType([*[given.schema[n] for n in kept], *fields]))
    return done.select(*[F.col(n).alias(c) for c, n in zip(names, kept, strict=True)], lang, score, accepted)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))
