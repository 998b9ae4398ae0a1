"""Token ids in files of directly addressable codes: any token is read without decoding its neighbours.

An id is cut into chunks of 8, 8 and 16 bits, lowest first. The first level holds the first chunk of every id of the file;
a bitmap beside it says which ids go on, and the next level holds only their next chunks, in the same order. A rank
directory, the number of set bits before each block of 512, gives the place in the next level in a few reads. Frequent
ids have small numbers in a byte-pair vocabulary, so most end early. As the order is kept, the ids of a range are a
range of each level.

A file, numbers little-endian::

    magic                     8 bytes
    documents                 1 long
    entries of each level     3 longs
    levels, each              chunks; but for the last: bitmap (lowest bit first), rank directory (a long a block)
    directory of documents    keys (long), 1 byte each whether the key is null, tokens up to the end of each (long)

Texts are exchanged once, into ranges of ascending keys, tokenised behind that exchange and written by the task that holds
the range, in files of bounded length. A file has a name of its own and counts only if the list of files names it, so a
repeated task leaves at most a file that nobody reads.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstats.llm.bpe import byte_letters, is_latin
from gridstats.llm.text import column_bytes, slices
from gridstats.llm.worker import kept
from gridstats.plans.sizing import broadcast_if_small, checkpoint_folder, spill
from gridstats.sources.files import open_location, qualified, write_whole

MAGIC = b"DACIDS01"
WIDTHS = (8, 8, 16)  # bits of the chunks
KINDS = ("<u1", "<u1", "<u2")
BLOCK = 512  # bits a rank directory counts by
HEAD = 8 + 8 * (1 + len(WIDTHS))
FILE_TOKENS = 1 << 22  # a file ends with the document that reaches this
PIECES = 200_000  # pieces of text whose ids a worker remembers, and as many older ones; only saves time
LONG_PIECE = 64  # longer pieces are not remembered
TEXT_BYTES = 1 << 21  # bytes of text taken out of a batch at once, or one text
CELL = 1 << 22  # positions of one cell when positions are looked up
LISTED = ["file", "part", "number", "documents", "tokens"]

# The word pattern of byte-level vocabularies, written out for texts of code points under U+0100.
LATIN_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+| ?[0-9\xb2\xb3\xb9\xbc-\xbe]+"
    r"| ?[^\t-\r \x85\xa0A-Za-z0-9\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff\xb2\xb3\xb9\xbc-\xbe]+"
    r"|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+"
)
# In other texts a blank between two of these characters always begins a token: the pattern takes one blank together with
# what follows, and no other token holds a blank that has such neighbours.
BORDER = re.compile("(?<=[!-~À-ž])(?= [!-~À-ž])")


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """(chunks, goes on) of each level; the last level has no marks."""
    left, found = ids.astype(np.uint32), []
    for k, (width, kind) in enumerate(zip(WIDTHS, KINDS, strict=True)):
        chunk, left = (left & np.uint32((1 << width) - 1)).astype(kind), left >> np.uint32(width)
        on = None if k == len(WIDTHS) - 1 else left > 0
        found.append((chunk, on))
        if on is not None:
            left = left[on]
    return found


def directory(on: np.ndarray) -> np.ndarray:
    """The number of set marks before each block."""
    blocks = np.add.reduceat(on.astype(np.int64), np.arange(0, len(on), BLOCK)) if len(on) else np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum(blocks)])[: len(blocks)].astype("<i8")


def write_file(sink, ids: np.ndarray, keys: np.ndarray, null: np.ndarray, ends: np.ndarray) -> None:
    """One file: ``ids`` of documents with these ``keys`` (``null``: none), ``ends``: tokens up to the end of each."""
    parts = levels_of(ids)
    sink.write(MAGIC)
    sink.write(np.array([len(keys), *[len(chunk) for chunk, _ in parts]], "<i8").tobytes())
    for chunk, on in parts:
        sink.write(chunk.tobytes())
        if on is not None:
            sink.write(np.packbits(on, bitorder="little").tobytes())
            sink.write(directory(on).tobytes())
    sink.write(keys.astype("<i8").tobytes())
    sink.write(null.astype("u1").tobytes())
    sink.write(ends.astype("<i8").tobytes())


class TokenFile:
    """Random access to a file; reads only the bytes it needs."""

    def __init__(self, handle) -> None:
        self.handle = handle
        head = handle.read_at(HEAD, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a file of token codes")
        self.documents, *self.sizes = np.frombuffer(head, "<i8", offset=8).tolist()
        self.chunks, self.bits, self.ranks = [], [], []
        at = HEAD
        for k, (width, size) in enumerate(zip(WIDTHS, self.sizes, strict=True)):
            self.chunks.append(at)
            at += size * width // 8
            if k < len(WIDTHS) - 1:
                self.bits.append(at)
                at += (size + 7) // 8
                self.ranks.append(at)
                at += 8 * ((size + BLOCK - 1) // BLOCK)
        self.end = at

    def read(self, at: int, count: int, kind: str) -> np.ndarray:
        return np.frombuffer(self.handle.read_at(count * np.dtype(kind).itemsize, at), kind)

    def marks(self, level: int, low: int, high: int) -> np.ndarray:
        first = low // 8
        packed = self.read(self.bits[level] + first, (high + 7) // 8 - first, "u1")
        return np.unpackbits(packed, bitorder="little")[low - 8 * first : high - 8 * first].astype(bool)

    def rank(self, level: int, place: int) -> int:
        """How many entries before ``place`` go on."""
        if place >= self.sizes[level]:
            return self.sizes[level + 1]
        block = place // BLOCK
        return int(self.read(self.ranks[level] + 8 * block, 1, "<i8")[0]) + int(self.marks(level, block * BLOCK, place).sum())

    def token(self, place: int) -> int:
        """The id at ``place``."""
        if not 0 <= place < self.sizes[0]:
            raise IndexError(place)
        value = shift = 0
        for k, (width, kind) in enumerate(zip(WIDTHS, KINDS, strict=True)):
            value |= int(self.read(self.chunks[k] + place * width // 8, 1, kind)[0]) << shift
            shift += width
            if k == len(WIDTHS) - 1 or not self.marks(k, place, place + 1)[0]:
                return value
            place = self.rank(k, place)
        return value

    def tokens(self, low: int, high: int, level: int = 0) -> np.ndarray:
        """The ids of a range, which is a range of each level."""
        found = self.read(self.chunks[level] + low * WIDTHS[level] // 8, high - low, KINDS[level]).astype(np.uint32)
        if level < len(WIDTHS) - 1 and high > low:
            on = self.marks(level, low, high)
            if on.any():
                begin = self.rank(level, low)
                found[on] |= self.tokens(begin, begin + int(on.sum()), level + 1) << np.uint32(WIDTHS[level])
        return found

    def directory(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, whether null, tokens up to the end) of the documents."""
        n = self.documents
        return self.read(self.end, n, "<i8"), self.read(self.end + 8 * n, n, "u1").astype(bool), self.read(self.end + 9 * n, n, "<i8")


class PieceIds(dict):
    """piece of text -> bytes of its 32-bit ids, as ``ids_of`` gives them; long pieces are not remembered, and others as
    long as they were met since the table was last full."""

    def __init__(self, ids_of: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.ids_of = ids_of
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = array("I", self.ids_of(piece)).tobytes()
        if len(piece) <= LONG_PIECE:
            self[piece] = found
        return found

    def age(self) -> None:
        if len(self) > PIECES:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Ids of whole texts by the tokenizers library, which sees each piece between certain token borders once."""

    def __init__(self, content: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given the task one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        rules = json.loads(content)
        before = rules.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
        added = rules.get("added_tokens", [])
        # anything else is done on texts, or asks for blanks beside special strings, and does not allow for pieces
        plain = plain and rules.get("normalizer") is None and rules.get("post_processor") is None
        self.pieces = plain and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        self.special = [t["content"] for t in added]
        letters = byte_letters()
        model = self.library.model
        self.words = PieceIds(lambda piece: [t.id for t in model.tokenize("".join([letters[b] for b in piece.encode()]))])
        self.parts = PieceIds(lambda piece: self.library.encode(piece, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        if not self.pieces:
            ids, split = self.parts, [text]
        elif is_latin(text) and not any(s in text for s in self.special):
            ids, split = self.words, LATIN_PIECES.findall(text)  # these are the words that the library would cut
        else:
            ids, split = self.parts, BORDER.split(text)
        found = b"".join(map(ids.__getitem__, split))
        ids.age()
        return found


def write_codes(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, key: str = "doc_id", text: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, to files under ``folder`` in ascending order of ``key``.

    Returns the list of files, also written to ``folder/files``: file, part, number (order of the files), documents, tokens,
    start (tokens before the file). ``tokenizer`` is a tokenizer.json, read on the driver. A null text counts as empty.
    Rows without key come first; rows that repeat a key are ordered by their text's hash. Texts are encoded whole, however
    long; a text and its ids fit a task. An empty table has no files. Other columns are left alone.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    base = qualified(spark, folder)
    closing = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        encoder = kept("token codes", shared.value, Encoder)
        codes, keys, ends, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            target = f"{base}/tokens-{part:06d}-{number:06d}-{uuid.uuid4().hex}.dac"
            listed = pa.concat_arrays(keys)
            null = listed.is_null().to_numpy(zero_copy_only=False)
            values = listed.fill_null(0).to_numpy(zero_copy_only=False)
            ids = np.frombuffer(b"".join(codes), "<u4")
            write_whole(target, lambda sink: write_file(sink, ids, values, null, np.array(ends, np.int64)))
            columns = [[target], [part], [number], [len(ends)], [len(ids)]]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], LISTED)

        for batch in batches:
            offsets, _ = column_bytes(batch.column(1))
            for low, high in slices(offsets, TEXT_BYTES):
                piece = batch.slice(low, high - low)
                begin = 0
                for row, value in enumerate(piece.column(1).to_pylist()):
                    codes.append(encoder.encode(value) + closing)
                    size += len(codes[-1]) // 4
                    ends.append(size)
                    if size >= file_tokens or row == piece.num_rows - 1:
                        keys.append(piece.column(0).slice(begin, row + 1 - begin))
                        begin = row + 1
                    if size >= file_tokens:
                        yield flush()
                        codes, keys, ends, size, number = [], [], [], 0, number + 1
        if ends:
            yield flush()

    files = spill(rows.mapInArrow(store, "file string, part int, number int, documents long, tokens long"))
    # the sums before a part are over at most one row a task
    parts = files.groupBy("part").agg(F.sum("tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.join(broadcast_if_small(parts), "part").withColumn("start", F.col("_before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    files.select("file", "part", "number", "documents", "tokens", "start").write.mode("errorifexists").parquet(f"{base}/files")
    return list_codes(spark, folder)


def list_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The list of files that ``write_codes`` left in ``folder``."""
    return spark.read.schema("file string, part int, number int, documents long, tokens long, start long").parquet(f"{qualified(spark, folder)}/files")


def _spread(files: DataFrame) -> DataFrame:
    """The files one by one over the tasks of the session."""
    return files.repartition(max(files.sparkSession.sparkContext.defaultParallelism, 1), "file")


def read_codes(files: DataFrame, ids: bool = False) -> DataFrame:
    """key, start, n_tokens and ids_crc32 of each document, read from the ``files``; with ``ids`` also its token_ids.

    start: tokens of all documents before; ids_crc32: of the ids as little-endian 32-bit numbers, unsigned.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for location, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                system, where = open_location(location)
                with system.open_input_file(where) as handle:
                    file = TokenFile(handle)
                    keys, null, ends = file.directory()
                    begins = np.concatenate([[0], ends])[:-1]
                    for low in range(0, len(keys), 4096):
                        own = slice(low, min(low + 4096, len(keys)))
                        first, last = int(begins[own][0]), int(ends[own][-1])
                        codes = file.tokens(first, last).astype("<u4")
                        bounds = np.concatenate([begins[own], [last]]) - first
                        sums = [zlib.crc32(codes[a:b].tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)]
                        columns = [pa.array(keys[own], pa.int64(), mask=null[own]), pa.array(begins[own] + start), pa.array(ends[own] - begins[own]), pa.array(sums, pa.int64())]
                        if ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(codes.astype(np.int32))))
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n_tokens", "ids_crc32", "token_ids"][: len(columns)])

    schema = "key long, start long, n_tokens long, ids_crc32 long" + (", token_ids array<int>" if ids else "")
    return _spread(files).mapInArrow(read, schema)


def tokens_at(files: DataFrame, positions: DataFrame) -> DataFrame:
    """``positions`` (their ``position`` counts tokens of all files from 0) with ``token_id``; null where there is none.

    A position meets its file in the cell of positions that both fall into; each token is read by itself. A column named
    token_id is replaced.
    """
    names = [c for c in positions.columns if c.lower() != "token_id"]
    rows = positions.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)], F.col("position").cast("long").alias("_at"))
    rows = rows.withColumn("_cell", F.floor(F.col("_at") / CELL))
    last = F.col("start") + F.col("tokens") - 1
    cells = files.where("tokens > 0").select("file", "start", last.alias("last"), F.explode(F.sequence(F.floor(F.col("start") / CELL), F.floor(last / CELL))).alias("_in"))
    cells = broadcast_if_small(cells)
    found = rows.join(cells, (rows["_cell"] == cells["_in"]) & rows["_at"].between(cells["start"], cells["last"]), "left")
    found = found.select(*[f"_c{i}" for i in range(len(names))], "file", (F.col("_at") - F.col("start")).alias("_place"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, place = batch.column("file").to_pylist(), batch.column("_place").to_pylist()
            values: list[int | None] = [None] * batch.num_rows
            for location in {w for w in where if w is not None}:
                system, path = open_location(location)
                with system.open_input_file(path) as handle:
                    file = TokenFile(handle)
                    for row in [r for r, w in enumerate(where) if w == location]:
                        values[row] = file.token(place[row])
            kept = batch.select([f"_c{i}" for i in range(len(names))])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(values, pa.int64())], names=[*kept.schema.names, "token_id"])

    kept = found.select(*[f"_c{i}" for i in range(len(names))]).withColumn("token_id", F.lit(None).cast("long"))
    done = found.mapInArrow(look, kept.schema)
    return done.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)], "token_id")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder beside the session's checkpoints, which the driver and all executors share."""
    return f"{checkpoint_folder(spark).rstrip('/')}/codes-{uuid.uuid4().hex}"
