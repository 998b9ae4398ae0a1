"""Benchmark passages in training texts, found by spaced seeds: fixed masks of word places, some of which are ignored.

A mask of ones and zeros laid over a stretch of words takes the words under its ones. Equal words under a mask on
both sides are a hit even where words under its zeros were replaced. Several masks are used, so that replaced words
at few places leave some mask untouched. Items under 16 words are cut into one block more than the share lets words be
replaced, so that one block is whole in every text that holds the item, and blocks are their masks. Hits only name an alignment; the words of the whole item are then compared
along it, place by place, and the share of equal words decides.

Everything is column expressions: texts become arrays of words, one explode gives their places, places whose first words no
item has are dropped in a hash join, and the masks' hashes at the rest meet the items' in another. Items are broadcast only
after a check of their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.plans.sizing import broadcast_if_small, fits_broadcast, spill

MASKS = ("111011", "1101011", "11001101")
MIN_SHARE = 0.8
SHORT = 16  # items of fewer words are found whatever words are replaced


def word_list(text: Column) -> Column:
    """The lower-cased runs of letters and digits of a text; none for a null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def seed(words: Column, place: Column, number: int, mask: str) -> Column:
    """The hash of the words under a mask laid at ``place``. Where the mask reaches beyond the text, the hash is that of
    fewer words and is of no use."""
    return F.xxhash64(F.lit(number), *[F.get(words, place + k) for k, bit in enumerate(mask) if bit == "1"])


def start_length(mask: str) -> int:
    """How many words a mask begins with that a text must have there: 1 or 2."""
    return 2 if mask.startswith("11") else 1


def first_words(words: Column, place: Column, many: int) -> Column:
    return F.xxhash64(F.lit(many), *[F.get(words, place + k) for k in range(many)])


def block(n: int, min_share: float) -> tuple[int, int]:
    """(length, number) of the blocks of an item of n words: one block more than words that may be replaced."""
    number = min(n, int(n * (1 - min_share) + 1e-9) + 1)
    return n // number, number


def masks_for(items: DataFrame, masks: tuple[str, ...], min_share: float) -> tuple[tuple[str, ...], dict[int, tuple[int, int]]]:
    """``masks`` and one of ones for each length of a short item's blocks; the blocks for each number of words."""
    below = max(SHORT, *map(len, masks))
    short = items.where((F.size("item_words") > 0) & (F.size("item_words") < below)).select(F.size("item_words").alias("n")).distinct()
    blocks = {row[0]: block(row[0], min_share) for row in short.collect()}
    return (*masks, *["1" * n for n in sorted({length for length, _ in blocks.values()})]), blocks


def seeds(df: DataFrame, words: str, masks: tuple[str, ...], *keep: str) -> DataFrame:
    """``keep`` columns, seed, place and mask, for each of the rows' places (``place``) and each mask."""
    own = F.array(*[F.struct(F.lit(k).alias("mask"), seed(F.col(words), F.col("place"), k, mask).alias("seed")) for k, mask in enumerate(masks)])
    return df.select(*keep, "place", F.inline(own))


def places(df: DataFrame, words: str, *keep: str) -> DataFrame:
    return df.select(*keep, words, F.posexplode(words).alias("place", "_word")).drop("_word")


def leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_share: float = MIN_SHARE) -> DataFrame:
    """Of each text that holds an item: text_key (md5 of the text), item_id, start, matched, n_words, share.

    One row for each text and item: the alignment with most equal words, the first of several. ``start`` is the place
    of the item's first word in the text, negative where the text begins later in the item. Equal texts are one. Null
    and wordless texts and items match nothing; items with equal words are found each by itself.
    """
    items = benchmark.select("item_id", word_list(F.col("text")).alias("item_words")).distinct()
    items = spill(items.where(F.size("item_words") > 0))
    spaced = len(masks)
    masks, blocks = masks_for(items, masks, min_share)
    lengths = F.element_at(F.array(*[F.lit(len(m)) for m in masks]), F.col("mask") + 1)
    n = F.size("item_words").alias("_n")
    own = seeds(places(items.select("item_id", "item_words", n), "item_words", "item_id", "_n"), "item_words", masks, "item_id", "_n", "item_words")
    own = own.where(F.col("place") + lengths <= F.col("_n"))
    fits = (F.col("mask") < spaced) & ~F.col("_n").isin(list(blocks))
    for n, (length, number) in blocks.items():
        fits |= (F.col("_n") == n) & (F.col("mask") >= spaced) & (lengths == length) & (F.col("place") % length == 0) & (F.col("place") < length * number)
    own = spill(own.where(fits))
    texts = docs.select(F.md5(F.col("text").cast("string").cast("binary")).alias("text_key"), word_list(F.col("text")).alias("words"))
    at = places(texts, "words", "text_key")
    # a place is looked at only if an item has the same first words under some mask, and only then are masks hashed
    kinds = sorted({start_length(m) for m in masks})
    starts = F.element_at(F.array(*[F.lit(start_length(m)) for m in masks]), F.col("mask") + 1)
    gates = [own.where(starts == k).select(first_words(F.col("item_words"), F.col("place"), k).alias("gate")) for k in kinds]
    gate = gates[0] if len(gates) == 1 else gates[0].union(gates[1])
    gate = gate.distinct()
    if fits_broadcast(gate):
        opened = F.explode(F.array(*[first_words(F.col("words"), F.col("place"), k) for k in kinds])).alias("gate")
        at = at.select("*", opened).join(F.broadcast(gate), "gate", "left_semi")
    own = own.select("seed", "item_id", F.col("place").alias("item_place")).distinct()
    hits = seeds(at, "words", masks, "text_key").join(broadcast_if_small(own), "seed")
    # texts are split again only where there is a hit: few, so each once, and a row of it meets each of its hits
    hits = spill(hits.select("text_key", "item_id", (F.col("place") - F.col("item_place")).alias("start")).distinct())
    found = docs.select(F.md5(F.col("text").cast("string").cast("binary")).alias("text_key"), "text")
    found = found.join(broadcast_if_small(hits.select("text_key").distinct()), "text_key", "left_semi").dropDuplicates(["text_key"])
    found = found.select("text_key", word_list(F.col("text")).alias("words")).join(broadcast_if_small(hits), "text_key").join(broadcast_if_small(items), "item_id")
    equal = F.filter(F.col("item_words"), lambda w, k: (F.col("start") + k >= 0) & (w == F.get(F.col("words"), F.col("start") + k)))
    found = found.select("text_key", "item_id", "start", F.size(equal).alias("matched"), F.size("item_words").alias("n_words"))
    found = found.where(F.col("matched") >= min_share * F.col("n_words"))
    best = Window.partitionBy("text_key", "item_id").orderBy(F.desc("matched"), "start")
    found = found.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")
    return found.withColumn("share", F.round(F.col("matched") / F.col("n_words"), 6))


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, item_id, start, matched, n_words, share for each document (row) and item that it holds; see ``leaks``."""
    found = spill(leaks(docs, benchmark, masks, min_share))
    keyed = docs.select("doc_id", F.md5(F.col("text").cast("string").cast("binary")).alias("text_key"))
    return keyed.join(broadcast_if_small(found), "text_key").drop("text_key")


def without_leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; all columns stay. Rows with a null text are kept."""
    found = spill(leaks(docs, benchmark, masks, min_share).select("text_key").distinct())
    key = F.md5(F.col("text").cast("string").cast("binary"))
    return docs.join(broadcast_if_small(found), key == found["text_key"], "left_anti")
