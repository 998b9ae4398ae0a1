"""Token codes, the filter audit and spelling variants on awkward rows and against brute force."""

import random
import zlib
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from awkward import awkward_docs, empty_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridstats.llm import filter_audit, spelling, token_codes
from gridstats.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


# ---------------------------------------------------------------- 11: token codes


def stored(tmp_path, ids, ends=(), keys=()):
    path = tmp_path / "one.dac"
    with open(path, "wb") as sink:
        token_codes.write_file(sink, np.array(ids, np.uint32), np.array(keys, np.int64), np.zeros(len(keys), bool), np.array(ends, np.int64))
    return token_codes.TokenFile(pa.OSFile(str(path)))


@pytest.mark.parametrize("top", [1, 255, 256, 50_257, 65_536, 2**32])
@pytest.mark.parametrize("count", [0, 1, 511, 512, 513, 3000])
def test_any_token_of_a_file(tmp_path, top, count):
    rng = random.Random(top + count)
    ids = [rng.randrange(top) if rng.random() < 0.5 else rng.randrange(min(top, 300)) for _ in range(count)]
    file = stored(tmp_path, ids, [count], [7])
    assert [file.token(i) for i in range(count)] == ids
    for _ in range(20):
        low = rng.randint(0, count)
        high = rng.randint(low, count)
        assert file.tokens(low, high).tolist() == ids[low:high]
    for place in (-1, count):
        with pytest.raises(IndexError):
            file.token(place)


def test_pieces_give_the_ids_of_whole_texts(library):
    with open(PATH, encoding="utf-8") as source:
        encoder = token_codes.Encoder(source.read())
    assert encoder.pieces
    rng = random.Random(4)
    pool = ["word", "Él", "it's", "  ", " ", "\n", "\t", "12", "½", "日本", "👍🏽", "<|endoftext|>", "!?", "\x85", "\xa0", "'s", "ñ", "​", "À", "\x7f", "ẞ"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(rng.choice([chr(rng.randrange(256)), " ", "a", "'s"]) for _ in range(40)) for _ in range(2000)]
    texts += [chr(a) + chr(b) for a in range(256) for b in (*range(0, 256, 7), 32, 39, 115)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def expected(library, rows):
    """Documents in ascending order of their ids with start, tokens and checksum."""
    found, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        found.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_token_query_is_the_brute_force(spark, sf_dir, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_token_codes"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == expected(library, rows)


def test_files_of_awkward_rows(spark, tmp_path, library):
    docs = awkward_docs(spark).repartition(5)
    files = token_codes.write_codes(docs, PATH, str(tmp_path / "codes"), file_tokens=50)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = expected(library, rows)
    found = sorted(map(tuple, token_codes.read_codes(files).collect()), key=lambda r: r[1])
    assert Counter((k, n, c) for k, _, n, c in found) == Counter((k, n, c) for k, _, n, c in wanted)
    assert [r[0] for r in found] == [r[0] for r in wanted]
    assert [r[1] for r in found] == np.cumsum([0, *[r[2] for r in found]])[:-1].tolist()
    assert files.count() > 3
    ids = [i for r in sorted(token_codes.read_codes(files, ids=True).collect(), key=lambda r: r["start"]) for i in r["token_ids"]]
    asked = [0, 1, 17, len(ids) - 1, len(ids), None, -1, 17]
    places = spark.createDataFrame([(p, "x") for p in asked], "position long, token_id string")
    looked = token_codes.tokens_at(files, places)
    assert looked.columns == ["position", "token_id"]
    assert Counter(map(tuple, looked.collect())) == Counter((p, ids[p] if p is not None and 0 <= p < len(ids) else None) for p in asked)


def test_no_rows_have_no_files(spark, tmp_path):
    files = token_codes.write_codes(empty_docs(spark), PATH, str(tmp_path / "codes"))
    assert files.count() == 0 and token_codes.read_codes(files).count() == 0
    with pytest.raises(Exception, match="already exists"):
        token_codes.write_codes(empty_docs(spark), PATH, str(tmp_path / "codes"))


# ---------------------------------------------------------------- 12: filter audit


@pytest.mark.parametrize("many", [1, 2, 3, 5])
def test_shares_are_the_mean_over_all_orders(many):
    rng = random.Random(many)
    by_mask = {mask: rng.randrange(100) for mask in range(1 << many)}
    gone = filter_audit.removals(by_mask, many)
    total = [Fraction(0)] * many
    orders = list(permutations(range(many)))
    for order in orders:
        before = 0
        for k in order:
            total[k] += gone[before | 1 << k] - gone[before]
            before |= 1 << k
    assert filter_audit.shares(gone, many) == [t / len(orders) for t in total]


def brute_audit(rows, letters):
    """rows: (part, fails by letter, good, toxic); every order is run."""
    found = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        sums = Counter()
        steps = {}
        for order in permutations(letters):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if r[1][letter]]
                left = [r for r in left if not r[1][letter]]
                all_fail = [r for r in own if r[1][letter]]
                alone = [r for r in all_fail if sum(r[1].values()) == 1]
                sums[letter] += len(gone)
                steps["".join(order), step] = (len(left), len(gone), len(all_fail) - len(gone), len(alone), sum(r[2] for r in gone), sum(r[3] for r in gone), letter)
        for (order, step), values in steps.items():
            found[part, order, step] = (*values[:6], sums[values[6]])
    return found


def test_audit_is_every_order_run(spark):
    rng = random.Random(8)
    texts = ["a a a", "A B", "x " * 120, " ".join(map(str, range(150))), "p|q", "", None, "ÀÉ", "same same"]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "", None, "de"])) for _ in range(300)]
    labels = [(k, k % 3 if k % 3 < 2 else None, k % 2) for k in range(0, 40, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    flags = marks.select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    done = filter_audit.audited(docs, filter_audit.quality_conditions(), F.col("lang"), flags, repeated="E")
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    least = {}
    for k, t, _ in rows:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    judged = []
    for k, t, part in rows:
        t = t or ""
        words = [w for w in t.replace("\n", " ").split(" ") if w]
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": k is not None and k > least[t],
        }
        judged.append((part or "", fails, int(k in good), int(k in toxic)))
    assert {tuple(r[:3]): tuple(r[3:]) for r in done.collect()} == brute_audit(judged, "ABCDE")


def test_audit_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    done = filter_audit.audited(docs, filter_audit.quality_conditions(), F.col("lang"), repeated="E")
    assert done.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "shapley"]
    last = done.where("filter_order = 'EABCD' and step = 1")
    assert {r["part"]: (r["kept"], r["removed"]) for r in last.collect()} == {"": (3, 0), "en": (7, 3), "es": (1, 0)}
    assert filter_audit.audited(empty_docs(spark), filter_audit.quality_conditions(), F.col("lang"), repeated="E").count() == 0
    with pytest.raises(ValueError, match="different letters"):
        filter_audit.audit(docs, "AA")


# ---------------------------------------------------------------- 13: spelling variants


def apart_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_variants(words, ratio):
    found, forms = {}, {}
    for word, n in words.items():
        near = [w for w in words if apart_by_one(word, w)] if len(word) >= 4 else []
        near = [w for w in near if len(w) >= 4]
        best = min(near, key=lambda w: (-words[w], w)) if near else None
        if best is not None and words[best] >= ratio * n and words[best] > 0:
            forms[word] = best
        found[word] = n, len(near)
    rows = {}
    for word, (n, near) in found.items():
        root = word
        while root in forms:
            root = forms[root]
        rows[word] = (forms.get(word), root, n, near, words.get(forms.get(word)))
    return rows


@pytest.mark.parametrize(("letters", "lengths"), [("ab", (1, 8)), ("abcde", (4, 7)), ("aé日\U0001f600", (3, 9)), ("abcdefghijklmnop", (7, 12))])
def test_variants_are_those_of_all_pairs(spark, letters, lengths):
    rng = random.Random(len(letters))
    words = {}
    for _ in range(150):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(*lengths)))
        words[word] = rng.choice([1, 2, 5, 30, 400, 9000])
        for _ in range(rng.choice([0, 1, 3])):
            k = rng.randrange(len(word) + 1)
            other = rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice(letters) + word[k + 1 :], word[:k] + rng.choice(letters) + word[k:]])
            if other:
                words.setdefault(other, rng.choice([1, 2, 5, 30, 400, 9000]))
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = {r["word"]: tuple(r)[1:] for r in spelling.variants(df).collect()}
    assert found == brute_variants(words, spelling.RATIO)


def test_chosen_pivots_are_disjoint_and_lightest():
    rng = random.Random(6)
    for _ in range(2000):
        places = sorted(rng.sample(range(12), rng.randint(3, 6)))
        weights = [rng.randrange(20) for _ in places]
        own = spelling.disjoint(weights, places, 2)
        cost = dict(zip(places, weights, strict=True))
        assert own[1] - own[0] >= 2
        assert sum(cost[p] for p in own) == min(cost[a] + cost[b] for a in places for b in places if b - a >= 2)


def test_long_chains_end_in_one_root(spark):
    words = [("aaaaaaaa"[:k] + "b" * (8 - k), 10 ** (k + 1)) for k in range(9)]
    rows = {r["word"]: r["root"] for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert set(rows.values()) == {"a" * 8}


def test_words_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    found = {r["word"]: r["n"] for r in spelling.runs(docs, 4).collect()}
    wanted = Counter()
    import re

    for key, text in [tuple(r) for r in docs.select("doc_id", "text").collect()]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            if len(word) >= 4:
                wanted[word] += 1
    assert found == wanted
    assert spelling.variants(spelling.runs(empty_docs(spark), 4)).count() == 0
    odd = spark.createDataFrame([(None, 3), ("word", None), ("words", 50)], "word string, n long")
    assert {tuple(r) for r in spelling.variants(odd).collect()} == {("word", "words", "words", 0, 1, 50), ("words", None, "words", 50, 1, None)}
    with pytest.raises(ValueError, match="ratio"):
        spelling.variants(odd, 1)
