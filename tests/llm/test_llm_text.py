"""Words, hashes, sketches and components against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gridstats.llm import text as T
from gridstats.llm.components import components
from gridstats.llm.sketch import counted
from gridstats.llm.worker import kept, tidied

WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def plain(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("piece", [1 << 20, 16, 3])
def test_words_hash_like_words(monkeypatch, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    rng = random.Random(piece)
    texts = ["".join(rng.choice("aAbB \t\né") for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["", "   ", "abc" * 50, None, "A b"]
    hashes, at = T.WordHasher().words(*T.column_bytes(pa.array(texts)))
    names: dict[int, str] = {}
    for i, text in enumerate(texts):
        words = plain(text)
        own = hashes[at[i] : at[i + 1]].tolist()
        assert len(own) == len(words)
        for h, w in zip(own, words, strict=True):
            assert names.setdefault(h, w) == w
    assert len(set(names.values())) == len(names)


def test_shingles_of_slices_and_short_texts():
    texts = pa.array(["skipped", "a b c d", "a b", "", None, "x x x x"]).slice(1)
    found = dict(T.shingle_sets(texts, 3, T.WordHasher()))
    assert [len(found[i]) for i in range(5)] == [2, 1, 0, 0, 1]
    again = dict(T.shingle_sets(pa.array(["A\tB  C d"]), 3, T.WordHasher()))
    assert (again[0] == found[0]).all()


def test_counts_are_never_too_small(spark):
    df = spark.range(1000).repartition(5)

    def hashes(batch):
        yield T.mix64(batch.column(0).to_numpy().view(np.uint64) % np.uint64(10))

    table = counted(df, hashes, 6)
    assert table.sum() == 1000
    own = T.mix64(np.arange(10, dtype=np.uint64))
    assert (table[(own >> np.uint64(58)).astype(int)] >= 100).all()
    assert counted(df.limit(0), hashes, 6).sum() == 0


def test_components_of_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(900, k) for k in range(500, 560)] + [(7, 7)]
    up = list(range(1000))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links + links[:20], "u long, v long").repartition(7)
    found = {r["node"]: r["component"] for r in components(df).collect()}
    assert found == {x: top(x) for a, b in links if a != b for x in (a, b)}
    assert components(df.limit(0)).count() == 0


def test_word_patterns_agree_where_they_overlap():
    import itertools

    from gridstats.llm import bpe

    rng = random.Random(9)
    latin = [chr(c) for c in range(256) if chr(c).lower() == chr(c)]
    texts = ["".join(pair) for pair in itertools.product(latin, repeat=2)]
    texts += ["".join(rng.choice(latin + list("'s't're ' ")) for _ in range(40)) for _ in range(2000)]
    for text in texts:
        assert bpe.words_of(text) == bpe.WORDS.findall(text), text


def test_worker_drops_what_other_work_kept():
    made = []

    def make(content):
        made.append(content)
        return content.upper()

    same = tidied(lambda batches: (kept("words", "a", make) for _ in batches), keeps="words")
    other = tidied(lambda batches: batches)
    assert list(same(iter([1, 2]))) == ["A", "A"] and list(same(iter([3]))) == ["A"] and made == ["a"]
    assert list(other(iter([4]))) == [4]
    assert list(same(iter([5]))) == ["A"] and made == ["a", "a"]
