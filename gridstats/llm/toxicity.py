"""Toxic passages: maximum-scoring segments of token log-odds, judged by extreme-value statistics.

* Training counts, for each class, the labelled texts that hold a word (a word repeated in one text counts once). A feature is a word or the first letters of
  longer words. Its log-odds ratio between the classes has an informative Dirichlet prior (the frequencies of both
  classes together), and only features whose ratio is many standard errors above zero are kept.
* A text is a sequence of steps: the ratio of its best feature for a word that has one, a small loss for any other
  word. One linear pass finds all maximal segments (Ruzzo and Tompa), however many passages a text has.
* The best segment of n unrelated words exceeds x about as often as 1 - exp(-K n exp(-lambda x)). lambda follows from
  the steps' frequencies in clean texts, K from their best segments. The expected number of such segments by chance
  is the evidence of a text or a passage; a logistic curve fitted to the labelled texts turns it into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.llm.text import column_bytes, slices
from gridstats.llm.worker import tidied
from gridstats.plans.sizing import broadcast_if_small, spill

LETTERS = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
MAX_FEATURES = 20_000  # bound of the model; the features furthest above zero stay
MIN_Z = 4.0
MIN_RATIO = 1.5
PRIOR_WORDS = 1000.0  # weight of the prior, in words
PRIOR_COUNT = 1.0  # added for each feature, so that a class which lacks it does not make its error unbounded
LOSS = 0.1  # step of a word without a feature
MAX_STEP = 6.0
WORD_ENTRIES = 200_000  # words a task holds at once; only bounds memory
BINS = 400  # of the evidence, for the curve


@dataclass(frozen=True)
class ToxicityModel:
    steps: dict[str, float]
    decay: float  # lambda
    scale: float  # K
    slope: float
    offset: float

    def evidence(self, best: float, words: int) -> float:
        """-ln of the number of segments at least this good expected among ``words`` unrelated words."""
        return self.decay * best - math.log(self.scale * max(words, 1))

    def score(self, best: float, words: int) -> float:
        if not self.steps:
            return 0.0
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, self.slope * self.evidence(best, words) + self.offset))))


class Steps(dict):
    """word -> its step, or 0.0 for a word without a feature."""

    def __init__(self, steps: dict[str, float]) -> None:
        super().__init__()
        self.known = steps

    def __missing__(self, word: str) -> float:
        found = [self.known[f] for f in features(word) if f in self.known]
        value = self[word] = max(found, default=0.0)
        return value


def features(word: str) -> list[str]:
    return [word, *[f"{word[:k]}-" for k in STEMS if len(word) > k]]


def segments(places: list[int], gains: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text with ``gains`` at ``places``.

    Every other word costs ``LOSS``. Linear in the number of places: each candidate is pushed and merged at most once.
    """
    stack: list[tuple[int, int, float, float]] = []  # first, last, total before, total after
    link: list[int] = []  # nearest earlier candidate with a smaller total before it
    total, behind = 0.0, 0
    for place, gain in zip(places, gains, strict=True):
        before = total - LOSS * (place - behind)
        total, behind = before + gain, place + 1
        first, low = place, before
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = link[j]
            if j < 0 or stack[j][3] >= total:
                stack.append((first, place, low, total))
                link.append(j)
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:], link[j:]
    return [(a, b, after - before) for a, b, before, after in stack]


def passages(text: str, steps: Steps) -> tuple[int, list[tuple[int, int, float]]]:
    words = LETTERS.findall(text.lower())
    values = list(map(steps.__getitem__, words))
    if len(steps) > WORD_ENTRIES:
        steps.clear()
    if not any(values):
        return len(words), []
    places = [i for i, v in enumerate(values) if v]
    return len(words), segments(places, [values[i] for i in places])


def texts_of(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts that hold little text each."""
    offsets, _ = column_bytes(batch.column(place))
    for low, high in slices(offsets):
        yield batch.slice(low, high - low)


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = Counter(), Counter()

    def rows() -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        each = [pa.array([c[w] for w in words], pa.int64()) for c in counts]
        for c in counts:
            c.clear()
        return pa.record_batch({"word": pa.array(words, pa.string()), "clean": each[0], "toxic": each[1]})

    for batch in batches:
        for part in texts_of(batch, 0):
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                counts[label].update(set(LETTERS.findall((text or "").lower())))
                if len(counts[0]) + len(counts[1]) > WORD_ENTRIES:
                    yield rows()
    yield rows()


def ratios(labelled: DataFrame) -> tuple[dict[str, float], list[tuple[float, float]], float]:
    """(steps of the kept features, their (step, share of clean words), rows counted)."""
    spark = labelled.sparkSession
    words = labelled.mapInArrow(tidied(word_counts), "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    words = spill(words)
    clean, toxic = (float(x or 0) for x in words.agg(F.sum("clean"), F.sum("toxic")).first())
    if not clean or not toxic:
        return {}, [], clean
    stems = [F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("-"))) for k in STEMS]
    parts = words.select(F.explode(F.array_compact(F.array("word", *stems))).alias("feature"), "clean", "toxic")
    parts = parts.groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).where("t >= 3")
    prior = PRIOR_COUNT + F.lit(PRIOR_WORDS) * (F.col("c") + F.col("t")) / (clean + toxic)

    def odds(n: str, total: float) -> F.Column:
        return F.log((F.col(n) + prior) / (total + PRIOR_WORDS - F.col(n) - prior))

    parts = parts.withColumn("ratio", odds("t", toxic) - odds("c", clean))
    parts = parts.withColumn("z", F.col("ratio") / F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior)))
    share = (F.col("c") + prior) / (clean + PRIOR_WORDS)
    best = parts.where((F.col("z") >= MIN_Z) & (F.col("ratio") >= MIN_RATIO)).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).select("feature", F.least("ratio", F.lit(MAX_STEP)), share).collect()
    return {f: s for f, s, _ in best}, [(s, p) for _, s, p in best], clean


def decay_of(steps: list[tuple[float, float]]) -> float:
    """The positive root of: mean of exp(lambda * step) = 1, over the steps of clean words."""
    rest = 1.0 - min(0.5, sum(p for _, p in steps))
    mean = lambda x: sum(p * math.exp(x * s) for s, p in steps) + rest * math.exp(-LOSS * x) - 1.0
    low, high = 1e-6, 1e-3
    while mean(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if mean(middle) > 0 else (middle, high)
    return low


def curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """(slope, offset) of a logistic curve through (evidence, clean texts, toxic texts), by Newton steps with a ridge."""
    x, clean, toxic = (np.array(v, float) for v in zip(*bins, strict=True))
    centre, spread = np.average(x, weights=clean + toxic), max(float(np.ptp(x)) / 8, 1e-9)
    design = np.stack([(x - centre) / spread, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -40, 40)))
        n = clean + toxic
        slope = design @ (toxic - n * p) - 1e-2 * beta
        change = np.linalg.solve((design * (n * p * (1 - p))) @ design.T + 1e-2 * np.eye(2), slope)
        beta = beta + np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-9:
            break
    return float(beta[0] / spread), float(beta[1] - beta[0] * centre / spread)


def best_segments(docs: DataFrame, steps: dict[str, float], keep: list[str], text: str) -> DataFrame:
    """``keep`` columns with n_words, best (score of the best segment) and passages (all maximal segments)."""
    shared = docs.sparkSession.sparkContext.broadcast(steps)
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_scored_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Steps(shared.value)
        for batch in batches:
            for part in texts_of(batch, len(keep)):
                found = [passages(t or "", known) for t in part.column(len(keep)).to_pylist()]
                listed = [[{"first": a, "last": b, "gain": s} for a, b, s in f] for _, f in found]
                columns = [
                    *part.columns[: len(keep)],
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([max((s for *_, s in f), default=0.0) for _, f in found], pa.float64()),
                    pa.array(listed, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("gain", pa.float64())]))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "best", "passages"])

    kind = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("gain", T.DoubleType())]))
    added = [T.StructField("n_words", T.LongType()), T.StructField("best", T.DoubleType()), T.StructField("passages", kind)]
    return docs.mapInArrow(tidied(run), T.StructType([*[docs.schema[c] for c in keep], *added]))


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label) of the documents that have a label; a document with several is toxic if one says so."""
    own = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(broadcast_if_small(own), "doc_id").select("text", "label")


def train(labelled: DataFrame) -> ToxicityModel:
    """The model of ``labelled(text, label)``, label 1 for toxic and 0 for clean, over all its rows.

    Gathered on the driver: the kept features (at most ``MAX_FEATURES``), sums, and ``BINS`` counts. Without words of
    both classes the model has no features and scores everything 0.
    """
    labelled = labelled.where("label in (0, 1)").select("text", F.col("label").cast("int"))
    steps, shares, clean = ratios(labelled)
    if not steps:
        return ToxicityModel({}, 1.0, 1.0, 1.0, 0.0)
    decay = decay_of(shares)
    best = spill(best_segments(labelled, steps, ["label"], "text").select("label", F.greatest("n_words", F.lit(1)).alias("n"), "best"))
    chance = best.where("label = 0").agg(F.avg(F.col("n") * F.exp(-decay * F.col("best")))).first()[0]
    scale = 1.0 / (chance or 1.0)
    evidence = F.greatest(F.lit(-20.0), F.least(F.lit(60.0), decay * F.col("best") - F.log(scale * F.col("n"))))
    bins = best.select("label", (F.round((evidence + 20) * (BINS / 80)) / (BINS / 80) - 20).alias("x")).groupBy("x")
    bins = bins.agg(F.sum(1 - F.col("label")), F.sum("label")).orderBy("x").collect()
    return ToxicityModel(steps, decay, scale, *curve([tuple(r) for r in bins]))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", column: str = "toxicity", passages: str = "toxic_passages") -> DataFrame:
    """``docs`` with ``column`` (0 to 1) and ``passages`` (first word, last word, gain, chance).

    Words are runs of letters; a passage is a maximal segment that fewer than 0.05 unrelated texts of the same length
    would hold by chance. A null or empty text has no words and the score of that. All rows and other columns stay; columns
    of the two names are replaced.
    """
    keep = [c for c in docs.columns if c.lower() not in (column.lower(), passages.lower())]
    names = [f"_kept{i}" for i in range(len(keep))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)])
    found = best_segments(given, model.steps, names, names[keep.index(text)])
    n = F.greatest(F.col("n_words"), F.lit(1))
    power = model.slope * (model.decay * F.col("best") - F.log(model.scale * n)) + model.offset
    value = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), power)))) if model.steps else F.lit(0.0)
    chance = lambda p: model.scale * n * F.exp(-model.decay * p["gain"])
    listed = F.transform("passages", lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), p["gain"].alias("gain"), chance(p).alias("chance")))
    listed = F.filter(listed, lambda p: p["chance"] < 0.05)
    return found.select(*[F.col(n_).alias(c) for c, n_ in zip(keep, names, strict=True)], value.alias(column), listed.alias(passages))
