"""Words and hashes of whole Arrow batches of text, in numpy, inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are turned into words at once. Only bounds memory: longer texts go in several pieces.
PIECE = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    base = int(offsets[0]) if len(offsets) else 0
    raw = np.frombuffer(data, np.uint8)[base : int(offsets[-1])] if data is not None and len(offsets) else np.empty(0, np.uint8)
    return offsets - base, raw


class WordHasher:
    """64-bit hashes of the words of texts: A-Z lower-cased, words are runs of anything but x20 and x09 to x0D."""

    def __init__(self) -> None:
        space = np.zeros(256, bool)
        space[[0x20, *range(0x09, 0x0E)]] = True
        lower = np.arange(256)
        lower[65:91] += 32
        self.space = space
        self.value = mix64((lower + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.power = self.inverse = np.empty(0, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.power) < size:
            base = 0xD1342543DE82EF95
            steps = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
            steps[0][0] = steps[1][0] = 1
            self.power, self.inverse = (np.multiply.accumulate(s) for s in steps)

    def _piece(self, raw: np.ndarray, starts_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each word of ``raw``; ``starts_text``: where a text begins."""
        blank = self.space[raw]
        solid = ~blank
        opens, closes = solid.copy(), solid.copy()
        fresh = blank[:-1] | starts_text[1:]
        opens[1:] &= fresh
        closes[:-1] &= blank[1:] | starts_text[1:]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self._grow(len(raw))
        running = np.zeros(len(raw) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.value[raw] * self.power[: len(raw)], out=running[1:])
            hashed = (running[end] - running[start]) * self.inverse[start] + (end - start).astype(np.uint64)
        return start, mix64(hashed)

    def words(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words, where each text's words start and end): text i has ``hashes[at[i]:at[i + 1]]``."""
        starts_text = np.zeros(len(raw), bool)
        starts_text[offsets[:-1][offsets[:-1] < len(raw)]] = True
        found_at, found = [], []
        low = 0
        while low < len(raw):
            high = min(low + PIECE, len(raw))
            if high < len(raw):  # cut before a blank or a text's start, so that no word is cut
                cuts = np.flatnonzero(self.space[raw[low + 1 : high + 1]] | starts_text[low + 1 : high + 1])
                while not len(cuts) and high < len(raw):
                    step = high
                    high = min(high + PIECE, len(raw))
                    cuts = np.flatnonzero(self.space[raw[step:high]] | starts_text[step:high]) + step - low - 1
                high = low + 1 + int(cuts[-1]) if len(cuts) else len(raw)
            at, hashes = self._piece(raw[low:high], starts_text[low:high])
            found_at.append(at + low)
            found.append(hashes)
            low = high
        if not found:
            return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
        at = np.concatenate(found_at)
        return np.concatenate(found), np.searchsorted(at, offsets)


def slices(offsets: np.ndarray, most: int = 4 * PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``most`` bytes together, or a single row."""
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = max(low + 1, min(high, len(offsets) - 1))
        yield low, high
        low = high


def shingle_sets(column: pa.Array, width: int, hasher: WordHasher) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its word shingles). Fewer words than ``width``: all words as one shingle."""
    offsets, raw = column_bytes(column)
    for low, high in slices(offsets):
        begin = offsets[low]
        words, at = hasher.words(offsets[low : high + 1] - begin, raw[begin : offsets[high]])
        whole = combine([words[i : len(words) - width + 1 + i] for i in range(width)]) if len(words) >= width else words[:0]
        for row in range(low, high):
            first, last = int(at[row - low]), int(at[row - low + 1])
            if last - first >= width:
                own = np.sort(whole[first : last - width + 1])
                keep = np.empty(len(own), bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                yield row, own[keep]
            elif last > first:
                yield row, combine([words[i : i + 1] for i in range(first, last)])
            else:
                yield row, words[:0]


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each place from the word hashes there, which depends on order and number of the words."""
    total = np.full(len(parts[0]), len(parts), np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            total = total * np.uint64(0x9FB21C651E98DF25) + part
    return mix64(total)
