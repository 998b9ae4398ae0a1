"""N-gram Jaccard join: all documents whose sets of word shingles overlap by at least a given share.

T-occurrence search. Two sets of sizes a and b link when they share at least T(a, b) shingles. Every set is put
in one order, rarest first by a fixed-size table of counts. The inverted lists of the frequent shingles are the
long ones: a set has up to T - 1 of them that a search never merges, so a partner must occur in a list of its
remaining, short ones. Spark merges these lists by sorting (shingle, document) rows; the long lists are only
probed for the candidates, by binary search of their shingles in the partner's sorted set (DivideSkip).

* Equal sets are one node before any list is made, so exact copies cost nothing.
* Of a list, each document is first compared with one leader, the one that has the fewest shingles rarer than
  the list's own. That is linear in the list. Only pairs that the leaders leave in different components, and that
  the position and size bounds allow, are then compared, by a join on the shingle that Spark can split.
* A list that the table of counts says may be long is salted, with a leader for each salt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.llm.components import components
from gridstats.llm.sketch import counted
from gridstats.llm.text import WordHasher, mix64, shingle_sets
from gridstats.llm.worker import tidied
from gridstats.plans.sizing import broadcast_if_small, spill

# log2 of the number of counters that order the shingles, and of those that preselect documents to verify
COUNT_BITS = 20
# a list expected to be longer than this is salted
LIST_ROWS = 20_000


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Smallest shared number of shingles with 100 * shared >= percent * union."""
    return F.floor((percent * (a + b) + 99 + percent) / (100 + percent))


def signatures(docs: DataFrame, width: int, percent: int, bits: int) -> DataFrame:
    """doc_id, n, d1, d2 (digest of the set) and its short lists: token, salts."""
    spark = docs.sparkSession

    def all_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        hasher = WordHasher()
        for _, own in shingle_sets(batch.column(0), width, hasher):
            yield own

    table = np.minimum(counted(docs.select("text"), all_hashes, bits), 2**31 - 1).astype(np.int32)
    shared = spark.sparkContext.broadcast(table)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = WordHasher(), shared.value
        for batch in batches:
            n, digests, lists, salts = [], [], [], []
            for _, own in shingle_sets(batch.column(1), width, hasher):
                size = len(own)
                n.append(size)
                digests.append((int(mix64(own + np.uint64(1)).sum()), int(mix64(own ^ np.uint64(0x5851F42D4C957F2D)).sum())))
                seen = counts[(own >> np.uint64(64 - bits)).astype(np.int64)]
                short = size + 1 - -(-percent * size // 100) if size else 0
                first = np.lexsort((own, seen))[:short]
                lists.append(own[first].view(np.int64))
                salts.append(seen[first] // LIST_ROWS + 1)
            d = np.array(digests, np.uint64).reshape(-1, 2).view(np.int64)
            at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            flat, many = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (lists, salts))
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "n": pa.array(n, pa.int64()),
                    "d1": pa.array(d[:, 0], pa.int64()),
                    "d2": pa.array(d[:, 1], pa.int64()),
                    "token": pa.ListArray.from_arrays(pa.array(at), pa.array(flat, pa.int64())),
                    "salts": pa.ListArray.from_arrays(pa.array(at), pa.array(many.astype(np.int32), pa.int32())),
                }
            )

    schema = "doc_id long, n long, d1 long, d2 long, token array<long>, salts array<int>"
    return spill(docs.select("doc_id", "text").mapInArrow(tidied(sign), schema))


def overlapping(docs: DataFrame, pairs: DataFrame, width: int, percent: int, bits: int) -> DataFrame:
    """The pairs (u, v) that link, from the whole sets of both texts.

    Both sets of a pair travel once, to where the pair is. A doc_id that stands for several texts links by any of them.
    """
    spark = docs.sparkSession
    sides = pairs.select(F.col("u").alias("id"), "u", "v", F.lit(0).alias("side")).union(pairs.select(F.col("v").alias("id"), "u", "v", F.lit(1)))

    def ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield mix64(batch.column(0).to_numpy().view(np.uint64))

    # A fixed-size filter spares most documents the hashing; the join below decides.
    passing = spark.sparkContext.broadcast(counted(sides.select("id"), ids, bits) > 0)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(passing.value[(mix64(keys) >> np.uint64(64 - bits)).astype(np.int64)]))
            for row, own in shingle_sets(batch.column(1), width, hasher):
                yield pa.record_batch({"id": batch.column(0).slice(row, 1), "tokens": pa.array([own.tobytes()], pa.binary())})

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, met = None, (set(), set())

        def linked() -> bool:
            return any(links(x, y, percent) for x in met[0] for y in met[1])

        for batch in batches:
            found = []
            for u, v, side, tokens in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3), strict=True):
                if (u, v) != pair:
                    if pair and linked():
                        found.append(pair)
                    pair, met = (u, v), (set(), set())
                met[side].add(tokens.as_py())
            yield as_pairs(found)
        if pair and linked():
            yield as_pairs([pair])

    own = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(tidied(sets), "id long, tokens binary")
    both = own.join(broadcast_if_small(sides), "id").select("u", "v", "side", "tokens").repartition("u", "v").sortWithinPartitions("u", "v")
    return spill(both.mapInArrow(tidied(probe), "u long, v long"))


def as_pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})


def links(a: bytes, b: bytes, percent: int) -> bool:
    """Whether two sets link: the shingles of the smaller are probed in the larger by binary search."""
    x, y = sorted((np.frombuffer(z, np.uint64) for z in (a, b)), key=len)
    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def possible(a: str, b: str, percent: int) -> Column:
    """Whether two documents of a list can link if its shingle is the rarest that they share.

    ``a`` and ``b`` prefix columns ``n`` and ``pos``. Shingles before ``pos`` are in one of the sets only.
    """
    na, nb, pa_, pb = (F.col(f"{x}{y}") for y in ("n", "pos") for x in (a, b))
    return F.least(na - pa_, nb - pb) >= least_overlap(na, nb, percent)


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, bits: int = COUNT_BITS) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id.

    Words: A-Z lower-cased, runs of anything but blanks. Set: distinct ``width``-word shingles; with fewer words all
    words are one shingle; a null, empty or blank text has an empty set and links with nothing. Documents link when
    ``100 * shared >= percent * union``; component_id is the smallest doc_id that links reach. Repeated rows come back
    as often; rows that share a doc_id are one node. A null doc_id links with nothing and has a null component.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = signatures(docs, width, percent, bits)
    known = sets.where("doc_id is not null and n > 0")
    nodes = known.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("id"))
    nodes = spill(nodes)
    # copies go by a list of them, usually short, so that the token arrays need no exchange
    copies = known.select("doc_id", "n", "d1", "d2").join(nodes, ["n", "d1", "d2"]).where("doc_id <> id").select("doc_id", "d1", "d2").distinct()
    lists = (
        known.join(broadcast_if_small(copies), ["doc_id", "d1", "d2"], "left_anti")
        .select("doc_id", "n", F.posexplode(F.arrays_zip("token", "salts")).alias("pos", "x"))
        .select(F.col("doc_id").alias("id"), "n", "pos", "x.token", F.pmod(F.xxhash64("doc_id"), F.col("x.salts")).alias("salt"), "x.salts")
    )
    by_place = Window.partitionBy("token", "salt").orderBy("pos", "n", "id")
    lists = lists.withColumns(
        {
            "first": F.first(F.struct("id", "n", "pos")).over(by_place),
            "last": F.lag("id").over(by_place),
            "next": F.lead("id").over(by_place),
            "place": F.row_number().over(by_place),
        }
    )
    # rows that repeat a document stand beside each other
    lists = lists.where("last is null or last <> id").drop("last")
    # single rows of a salted list stay: its other salts may have rows
    lists = spill(lists.where("place > 1 or next is not null or salts > 1").drop("place", "next"))

    star = lists.where("id <> first.id").select("*", F.col("first.n").alias("fn"), F.col("first.pos").alias("fpos"))
    star = star.where(possible("", "f", percent)).select(F.least("id", "first.id").alias("u"), F.greatest("id", "first.id").alias("v"))
    star = spill(star.distinct())
    part = components(overlapping(docs, star, width, percent, bits))
    rows = lists.join(part.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = spill(rows.select("token", "id", "n", "pos", "component", "salts"))
    mixed = rows.groupBy("token").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("salts").alias("salts"))
    mixed = mixed.where("lo < hi and (m > 2 or salts > 1)").select("token")
    rows = spill(rows.join(mixed, "token", "left_semi"))
    # the smaller set of a pair is found within a shorter stretch of its order
    x = rows.where(F.col("pos") <= F.col("n") - least_overlap(F.col("n"), F.col("n"), percent))
    x = x.select("token", *[F.col(c).alias(f"x{c}") for c in ("id", "n", "pos", "component")])
    y = rows.select("token", *[F.col(c).alias(f"y{c}") for c in ("id", "n", "pos", "component")])
    ordered = F.struct("xn", "xid") < F.struct("yn", "yid")
    rest = x.join(y, (x["token"] == y["token"]) & (F.col("xcomponent") != F.col("ycomponent")) & ordered & possible("x", "y", percent))
    rest = rest.select(F.least("xid", "yid").alias("u"), F.greatest("xid", "yid").alias("v")).distinct().join(star, ["u", "v"], "left_anti")
    more = overlapping(docs, spill(rest), width, percent, bits)
    part = components(part.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))

    result = sets.select("doc_id", F.col("n").alias("n_shingles"), "n", "d1", "d2")
    result = result.join(nodes, ["n", "d1", "d2"], "left").join(part.withColumnRenamed("node", "id"), "id", "left")
    # a doc_id may stand for several sets when its rows differ
    return result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id")).alias("component_id"))
