"""Byte-pair encoding and decoding of whole texts with the vocabulary file of a public tokenizer.

Encoding is the backtracking search: an Aho-Corasick automaton gives the longest token at each place of a word; a
token may follow another only if no earlier merge would have crossed their border, which a table of merges tells
in a few steps; where the longest token does not fit, its longest proper prefix is tried, and where none is left
the search steps back. Each place is given up at most once, so the time is linear in the word, and the result is
exactly that of applying the merges by rank. Decoding copies token strings out of one blob by an offset table.

The file is read once on the driver and broadcast (a vocabulary has a fixed size); tasks map rows, without exchange.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridstats.llm.text import column_bytes, slices
from gridstats.llm.worker import kept, tidied

END = "\0"  # stands for the word end; byte-level strings cannot hold it
WORD_ENTRIES = 100_000  # words remembered by a worker, and as many older ones; only saves time


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next letter from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """Automaton, merge table and offset table of a vocabulary whose ids follow the order of its merges."""

    def __init__(self, text: str) -> None:
        content = json.loads(text)
        model = content["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        strings = {i: s for s, i in ids.items()}
        self.split = {i: (i, i) for i in strings}
        self.merged: dict[tuple[int, int], int] = {}
        own: dict[int, str] = {}
        made = {ids[a + b] for a, b in pairs}
        for i, s in strings.items():
            if i not in made:
                ends = self.suffix and len(s) > 1 and s.endswith(self.suffix)
                own[i] = s.removesuffix(self.suffix) + END if ends else s
        for a, b in pairs:
            left, right = ids[a], ids[b]
            token = ids[a + b]
            own[token] = own[left] + own[right]
            self.split[token] = (left, right)
            self.merged[left, right] = token
        self.fits: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        self.token_of: dict[str, int] = {}
        whole: set[int] = set()
        for i in sorted(own):
            left, right = self.split[i]
            # a string that merging by rank would never arrive at is no token of any text
            if left == i or (left in whole and right in whole and self.compatible(left, right, i)):
                whole.add(i)
                self.token_of[own[i]] = i
                self.automaton.add_word(own[i], (i, len(own[i])))
        self.automaton.make_automaton()
        self.length = {i: len(s) for i, s in own.items()}
        self.own = own
        self.shorter: dict[int, int] = {}
        self.special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        strings |= {i: s for s, i in self.special.items()}
        pieces = [(strings.get(i, "") + " ").encode() for i in range(max(strings) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.letters = byte_letters()

    def compatible(self, left: int, right: int, limit: int = 1 << 31) -> bool:
        """Whether merging by rank, with merges below ``limit``, leaves the border between two tokens alone."""
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and joined < limit:
                return False
            if left > right:
                limit, left = left, self.split[left][1]
                if left == limit:
                    limit, right = right + 1, self.split[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, self.split[right][0]
                if right + 1 == limit:
                    limit, left = left, self.split[left][1]
                    if left == limit:
                        return True

    def follows(self, left: int, right: int) -> bool:
        key = left, right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 200_000:
                self.fits.clear()
            known = self.fits[key] = self.compatible(left, right)
        return known

    def prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        known = self.shorter.get(token)
        if known is None:
            s = self.own[token]
            known = self.shorter[token] = next((self.token_of[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.token_of), -1)
        return known

    def encode_word(self, word: str) -> list[int]:
        letters = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode()])
        if self.suffix:
            letters += END
        size = len(letters)
        longest = [-1] * (size + 1)
        reach = [0] * (size + 1)
        for end, (token, length) in self.automaton.iter(letters):
            start = end + 1 - length
            if length > reach[start]:
                reach[start], longest[start] = length, token
        lengths, fits = self.length, self.fits
        closed = {size - 1} if self.suffix else set()  # the word end is no token of its own
        tokens: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < size:
            while token >= 0:
                end = at + lengths[token]
                if end not in closed:
                    if last < 0:
                        break
                    fit = fits.get((last, token))
                    if self.follows(last, token) if fit is None else fit:
                        break
                token = self.prefix(token)
            if token >= 0:
                tokens.append(token)
                at, last = end, token
                token = longest[at]
            else:
                closed.add(at)
                token = tokens.pop()
                at -= lengths[token]
                last = tokens[-1] if tokens else -1
        return tokens

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, bytes) of the texts of ``ids[at[i]:at[i + 1]]``: token strings joined by a space."""
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(self.offsets[ids] - ends[:-1], lengths)
        take += np.arange(len(take))
        raw = self.blob[take]
        bounds = ends[at]
        filled = np.flatnonzero(bounds[1:] > bounds[:-1])
        keep = np.ones(len(raw), bool)
        keep[bounds[1:][filled] - 1] = False  # the blank behind a text's last token
        sizes = np.diff(bounds)
        sizes[filled] -= 1
        return np.concatenate([[0], np.cumsum(sizes)]), raw[keep]


class WordIds(dict):
    """word -> bytes of its 32-bit ids; forgets the words that were not met since the table was last full."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = array("i", self.vocabulary.encode_word(word)).tobytes()
        self[word] = found
        return found

    def age(self) -> None:
        if len(self) > WORD_ENTRIES:
            self.older = dict(self)
            self.clear()


# The word pattern of the vocabulary, and the same for ASCII texts and for those of code points under U+0100.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d a-z0-9]+")
LATIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\x09-\x0d \x85\xa0a-z0-9\xaa\xb5\xba\xdf-\xf6\xf8-\xff\xb2\xb3\xb9\xbc-\xbe]+"
)


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def words_of(text: str) -> list[str]:
    """The words of a lowered text."""
    if text.isascii():
        return ASCII_WORDS.findall(text)
    return (LATIN_WORDS if is_latin(text) else WORDS).findall(text)


def lowered(text: str) -> str:
    """Composed (NFC) and lower-cased character by character, so a final sigma is not treated apart."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def encode_text(text: str, words: WordIds, special: re.Pattern | None) -> bytes:
    if special is not None and "<" in text:
        parts = special.split(text)
        if len(parts) > 1:
            ids = words.vocabulary.special
            return b"".join(np.int32(ids[p]).tobytes() if k % 2 else encode_text(p, words, None) for k, p in enumerate(parts))
    return b"".join(map(words.__getitem__, words_of(lowered(text))))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids array<int>`` and, if named, the ``decoded`` text of these ids.

    ``path``: a ``tokenizer.json`` of the BPE kind with lower-casing and word ends, read on the driver. A null text
    counts as empty; an empty one has no ids and decodes to an empty text. Strings of special tokens become their ids.
    Rows, their number and all other columns stay as they are; columns of the new names are replaced.
    """
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    added = [ids, *([decoded] if decoded else [])]
    docs = docs.drop(*added)
    place = docs.columns.index(text)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept("bpe", shared.value, lambda text: WordIds(Vocabulary(text)))
        vocabulary = words.vocabulary
        special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        for batch in batches:
            offsets, _ = column_bytes(batch.column(place))
            for low, high in slices(offsets, 1 << 21):
                part = batch.slice(low, high - low)
                rows = []
                for value in part.column(place).to_pylist():
                    rows.append(encode_text(value or "", words, special))
                    words.age()
                at = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
                flat = np.frombuffer(b"".join(rows), np.int32)
                columns = [*part.columns, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))]
                if decoded:
                    bounds, raw = vocabulary.decode(flat, at)
                    buffers = [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())]
                    columns.append(pa.StringArray.from_buffers(len(rows), buffers[1], buffers[2]))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *added])

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.StringType())] if decoded else [])]
    return docs.mapInArrow(tidied(tokens, keeps="bpe"), T.StructType([*docs.schema.fields, *fields]))
