"""Words one edit apart, found by pivotal grams, and the frequent form that each rare spelling leads to.

A word's bigrams are ordered by how many words hold them, rarest first (ties by the gram); its prefix is the three rarest
places, with all further places of the third gram. Among the prefix two disjoint bigrams of least total weight are its
pivots, chosen by dynamic programming. One edit breaks at most one of two disjoint pivots, so of two words that are one
edit apart the one whose prefix ends earlier in the order has a pivot that the other's prefix holds too: pivots are
indexed and met by prefixes, in both directions.

Position limits: behind an unbroken gram the edit is on one side only. On the other side the words agree letter for letter,
and the gram moves by the difference in length or not at all. So a list is kept for a gram together with all letters of its
unbroken side and the length of the partner. The side with the edit is halved once more: one half is unbroken too and
joins the key. Lists are as short as words that share more than half of their letters are few, so frequent grams make no
long lists. Pairs that meet are verified by their edit distance.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.plans.sizing import spill

EDITS = 1
PREFIX = 2 * EDITS + 1  # bigrams that hold every way of choosing one more disjoint ones than edits
LEAST = 4  # letters of a word that has two disjoint bigrams
COUNTERS = 1 << 16  # grams are counted in a table of this size, whatever the alphabet
RATIO = 10  # a form occurs at least so many times as often


def runs(docs: DataFrame, least: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the maximal runs of A-Z, a-z and U+00C0 to U+00FF of at least ``least`` letters, A-Z lower-cased.

    Whole texts, however long. A run from which a letter goes is counted as what is left: of a run whose crc32 of
    ``<doc_id>:<run>`` is divisible by 31 the code point at that number modulo its length. A null text has no runs; a null
    key counts as an empty string.
    """
    found = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{least},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.explode(found).alias("run"))
    rows = rows.select("key", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    rows = rows.select("run", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    left = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    rows = rows.select(F.when(F.col("h") % 31 == 0, left).otherwise(F.col("run")).alias("word"))
    return rows.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


def gram_counts(words: DataFrame) -> np.ndarray:
    """How many places of all words fall on each of ``COUNTERS`` numbers, by the crc32 of their bigram."""
    places = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda p: F.substring("word", p, F.lit(2)))
    grams = words.where(F.length("word") >= LEAST).select(F.explode(places).alias("gram"))
    # combined by gram first: there are far fewer grams than places
    grams = grams.groupBy("gram").agg(F.count("*").alias("n"))
    rows = grams.groupBy((F.crc32(F.col("gram").cast("binary")) % COUNTERS).alias("at")).agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(COUNTERS, np.int64)
    for row in rows:
        counts[row["at"]] = row["n"]
    return counts


def disjoint(weights: list[int], places: list[int], many: int) -> list[int]:
    """The ``many`` of the ascending ``places`` that lie two or more apart and have the least total weight.

    best[k] holds, for the places seen so far, the least weight of k of them; each place either joins the best k - 1 that
    end two or more before it, or is left out. Ties: the earliest places.
    """
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * many]
    for i, place in enumerate(places):
        before = i
        while before and places[before - 1] > place - 2:
            before -= 1
        row = list(best[-1])
        for k in range(1, many + 1):
            shorter = best[before][k - 1]
            if shorter is not None:
                joined = shorter[0] + weights[i]
                if row[k] is None or joined < row[k][0]:
                    row[k] = joined, [*shorter[1], place]
        best.append(row)
    return best[-1][many][1]


def chosen(word: str, key) -> tuple[list[int], list[int]]:
    """(places of the prefix, places of the pivots) of a word; ``key(gram)`` is its (count, gram)."""
    keys = [key(word[p : p + 2]) for p in range(len(word) - 1)]
    last = sorted(keys)[PREFIX - 1]
    prefix = [p for p, k in enumerate(keys) if k <= last]
    return prefix, disjoint([keys[p][0] for p in prefix], prefix, EDITS + 1)


def with_grams(words: DataFrame) -> DataFrame:
    """(word, n, prefix, pivots) of the words that have two disjoint bigrams."""
    counts = gram_counts(words)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}

        def key(gram: str) -> tuple[int, str]:
            found = known.get(gram)
            if found is None:
                found = known[gram] = int(counts[zlib.crc32(gram.encode()) % COUNTERS]), gram
            return found

        kind = pa.list_(pa.int32())
        for batch in batches:
            pairs = [chosen(word, key) for word in batch.column(0).to_pylist()]
            added = [pa.array([p[i] for p in pairs], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["word", "n", "prefix", "pivots"])

    own = words.select("word", "n").where(F.length("word") >= LEAST)
    return own.mapInArrow(choose, "word string, n long, prefix array<int>, pivots array<int>")


def lists(place: Column, partner: Column) -> Column:
    """Keys of the lists for the gram at ``place`` (from 0) of ``word``, with a partner of ``partner`` letters.

    Four: the side before or behind the gram is unbroken, and on the other side, whose length in the partner is ``rest``,
    the half at the gram or the half at the end. A side that would be shorter than nothing has no key.
    """
    length = F.length("word")

    def part(begin: Column, end: Column) -> Column:
        return F.substring("word", begin + 1, F.greatest(end - begin, F.lit(0)))

    rest = partner - place - 2  # of the partner behind the gram
    half = F.floor(rest / 2).cast("int")
    head = part(F.lit(0), place + 2)
    behind = [
        F.when(rest >= 0, F.xxhash64(F.lit(0), place, partner, head, part(place + 2, F.least(place + 2 + half, length)))),
        F.when(rest >= 0, F.xxhash64(F.lit(1), place, partner, head, part(F.greatest(length - (rest - half), place + 2), length))),
    ]
    end = length - place  # the gram's place from the end, the same in both words
    front = partner - end  # of the partner before the gram
    middle = F.floor(front / 2).cast("int")
    tail = part(place, length)
    before = [
        F.when(front >= 0, F.xxhash64(F.lit(2), end, partner, tail, part(F.lit(0), F.least(middle, place)))),
        F.when(front >= 0, F.xxhash64(F.lit(3), end, partner, tail, part(F.greatest(place - (front - middle), F.lit(0)), place))),
    ]
    return F.filter(F.array(*behind, *before), lambda k: k.isNotNull())


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a < b, once for each two words of ``words(word, n)`` that differ by one inserted, deleted or
    replaced letter (code point). Words are different and not null; those under four letters have no two disjoint bigrams
    and are near no word.
    """
    grams = spill(with_grams(words))
    length = F.length("word")
    lengths = F.explode(F.array(length - 1, length, length + 1)).alias("m")
    index = grams.select("word", "n", F.explode("pivots").alias("p")).select("word", "n", "p", lengths)
    index = index.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(lists(F.col("p"), F.col("m"))).alias("list"))
    probes = grams.select("word", "n", F.explode("prefix").alias("p"))
    probes = probes.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.explode(lists(F.col("p"), length)).alias("list"))
    met = index.join(probes, "list").where("a <> b").where(F.levenshtein("a", "b", EDITS) == EDITS)
    ordered = [
        F.least("a", "b").alias("a"),
        F.when(F.col("a") < F.col("b"), F.col("a_n")).otherwise(F.col("b_n")).alias("a_n"),
        F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("b_n")).otherwise(F.col("a_n")).alias("b_n"),
    ]
    return met.select(*ordered).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: where following forms ends. A form occurs more often than its word, so
    chains end; each round doubles the steps that a word has gone."""
    reached = spill(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = spill(reached.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        reached = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reached


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words(word, n)``, whose words are different.

    Words are near if one inserted, deleted or replaced letter makes one the other; n_near counts them. form: the near word
    of largest n (ties: the smallest in code-point order) if its n is at least ``ratio`` times the word's, with its n as
    form_n; else null. root: the last of the forms that follow, the word itself if it has none. Null words are left out,
    a null n counts as 0, words under four letters are near no word. ``ratio`` is 2 or more, so that no circle can arise.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = spill(words.where("word is not null").select("word", F.coalesce("n", F.lit(0)).cast("long").alias("n")))
    pairs = spill(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(pairs.select("b", "a", "a_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = (F.col("n_near") > 0) & (-F.col("best.less") >= ratio * F.col("n")) & (-F.col("best.less") > 0)
    known = words.join(near, "word", "left").select(
        "word",
        F.when(formed, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, -F.col("best.less")).alias("form_n"),
    )
    known = spill(known)
    ends = roots(known.where("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
