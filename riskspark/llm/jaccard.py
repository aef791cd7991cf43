"""Similarity join of documents on word shingles, filtered by several global orders.

A text's set is that of its distinct shingles. Under any total order of all
shingles, two sets of Jaccard similarity t share a shingle among the first
n - ceil(t * n) + 1 of both. The orders used here put rare shingles first (by a
table of bounded size that counts hashed shingles over all documents) and differ in
how they break ties. The first order makes candidates by an equal join on shingles,
the others must agree by sharing one of their own first shingles, and what is left
is verified on the whole sets.

Equal sets are one vertex. Only components are asked for, so a shingle's sets are
first compared with one pivot, and then only sets that are still in different
components are compared with each other: no link between different sets is lost,
and a large group of near copies is not expanded into its pairs.
"""

from __future__ import annotations

import hashlib
import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.common import materialise
from riskspark.llm import columns, tables
from riskspark.llm.components import components

SIZE = 4
PERCENT = 85
#: Tie breaks of the orders, and how coarsely each sees the counts.
ORDERS = ((0x9E3779B97F4A7C15, 1), (0xC2B2AE3D27D4EB4F, 8), (0x165667B19E3779F9, 32))
#: Cells of the table of counts, as powers of two: with the input, within these bounds.
CELL_BITS = (16, 26)
#: At most so many shared halves of digests are resolved (no sound digest has as many).
TWINS = 100_000
#: Bytes of text that a task hashes at once; a longer text makes a block of its own.
BLOCK = columns.WORD_BLOCK
_LIFT = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                                     0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


def shingle_sets(col: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text: runs of ``size`` words,
    or the whole sequence where there are fewer; none without words."""
    h, at = columns.words(col)
    n = np.diff(at)
    with np.errstate(over="ignore"):
        runs = np.zeros(max(len(h) - size + 1, 0), np.uint64)
        for k in range(size):
            runs += columns.mix(h[k : k + len(runs)] * _LIFT[k % len(_LIFT)] + np.uint64(k))
        runs = columns.mix(runs)
    out = []
    for i, (a, k) in enumerate(zip(at[:-1].tolist(), n.tolist())):
        if k >= size:
            out.append(np.unique(runs[a : a + k - size + 1]))
        else:
            short = h[a : a + k]
            out.append(np.array([int.from_bytes(hashlib.blake2b(short.tobytes(), digest_size=8).digest(), "little")] if k else [], np.uint64))
    return out


def _digest(found: np.ndarray) -> tuple[int, int]:
    """Both signed halves of a set's 128-bit digest."""
    return struct.unpack("<qq", hashlib.blake2b(found.tobytes(), digest_size=16).digest())


def _key(found: np.ndarray, twins: dict[int, int]) -> int:
    """A signed 64-bit key of a set: the first half of its digest. Where different sets
    share that half, ``twins`` names the second half of the one that keeps it; the
    others take a key made of both halves."""
    key, other = _digest(found)
    if key in twins and other != twins[key]:
        return int.from_bytes(hashlib.blake2b(struct.pack("<qq", key, other), digest_size=8).digest(), "little", signed=True)
    return key


def _twins(rows: DataFrame) -> dict[int, int]:
    """First halves that several sets share, each with its smallest second half. Of n sets,
    about n**2 / 2**65 pairs are of this kind: some hundreds for 10**11."""
    sets = rows.where("key is not null").select("key", "check").distinct()
    shared = sets.groupBy("key").agg(F.min("check").alias("check"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return {r["key"]: r["check"] for r in shared.limit(TWINS).collect()}


def _survey(docs: DataFrame, text: str, bits: int, size: int) -> DataFrame:
    """Per row (doc_id, n_shingles, key, check), and the tasks' tables of counts."""

    def run(batches):
        counts, salt = np.zeros(1 << bits, np.uint32), 0
        names = ["doc_id", "n_shingles", "key", "check", "chunk", "salt", "cells"]
        for batch in columns.small_batches(batches, text, BLOCK):
            sets = shingle_sets(batch.column(text), size)
            if sets:
                cell, times = np.unique(np.concatenate(sets) >> np.uint64(64 - bits), return_counts=True)
                counts[cell.astype(np.int64)] += times.astype(np.uint32)
                salt += len(cell)
            n, used = np.array([len(s) for s in sets], np.int64), [len(s) > 0 for s in sets]
            none = pa.nulls(len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), *(pa.array([_digest(s)[half] if u else None for s, u in zip(sets, used)], pa.int64()) for half in (0, 1)),
                 none, none, pa.nulls(len(sets), pa.binary())], names=names)
        for part in tables.emit(counts, salt):
            none = pa.nulls(part.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none] * 4 + part.columns, names=names)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key long, check long, " + tables.SCHEMA)


def _prefixes(docs: DataFrame, text: str, rarity, bits: int, size: int, percent: int, twins: dict[int, int]) -> DataFrame:
    """(key, n, first, second...): the first shingles of each set under each order, those
    of the later orders as 16-bit prints. A block of text sends equal sets once, and of
    those of all blocks one stays."""

    def run(batches):
        for batch in columns.small_batches(batches, text, BLOCK):
            seen: set[int] = set()
            keys, sizes, lists = [], [], [[] for _ in ORDERS]
            for s in shingle_sets(batch.column(text), size):
                if not len(s) or (key := _key(s, twins)) in seen:
                    continue
                seen.add(key)
                rank = rarity.value[(s >> np.uint64(64 - bits)).astype(np.int64)]
                kept = len(s) - -(-percent * len(s) // 100) + 1
                for (seed, step), out in zip(ORDERS, lists):
                    tie = columns.mix(s ^ np.uint64(seed))
                    first = np.lexsort((tie, rank // step))[:kept]
                    out.append(s[first].view(np.int64) if out is lists[0] else np.unique(tie[first] >> np.uint64(48)).astype(np.uint16).view(np.int16))
                keys.append(key)
                sizes.append(len(s))
            if keys:
                arrays = [pa.array(x, pa.list_(pa.int64() if i == 0 else pa.int16())) for i, x in enumerate(lists)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), *arrays],
                                                 names=["key", "n", "first", "second", "third"])

    sent = docs.select(text).mapInArrow(run, "key long, n int, first array<long>, second array<short>, third array<short>")
    return sent.dropDuplicates(["key"])


def _may_link(n1: Column, p1: Column, n2: Column, p2: Column, percent: int) -> Column:
    """Size and position filter: at the first shingle that both share, what is left of
    each bounds their intersection."""
    left = F.least(n1 - p1, n2 - p2).cast("long")
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * left >= percent * (n1 + n2))


def _members(spark, keys: DataFrame, bits: int):
    """A bitmap of hashed document ids, of fixed size: others need not be shingled again."""

    def run(batches):
        table = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            table[np.asarray(batch.column("cell"))] = 1
        yield from tables.emit(table, int(table.sum()))

    cell = keys.select(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << bits)).alias("cell"))
    return spark.sparkContext.broadcast(tables.total(cell.mapInArrow(run, tables.SCHEMA), (1 << bits,), np.uint8) > 0)


def _verified(pairs: DataFrame, docs: DataFrame, text: str, rows: DataFrame, bits: int, size: int, percent: int, orders: DataFrame, twins: dict[int, int]) -> DataFrame:
    """The pairs (a, b) of keys that all orders let pass and whose whole sets link."""
    b_side = orders.select(F.col("key").alias("b"), F.col("second").alias("b2"), F.col("third").alias("b3"))
    a_side = orders.select(F.col("key").alias("a"), F.col("second").alias("a2"), F.col("third").alias("a3"))
    passed = pairs.join(b_side, "b").join(a_side, "a").where(F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3"))
    passed = materialise(passed.select("a", "b").distinct(), "jaccard-passed")
    wanted = passed.select(F.col("a").alias("key")).union(passed.select(F.col("b").alias("key"))).distinct()
    wanted = materialise(rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")).join(wanted, "key"), "jaccard-wanted")
    spark = docs.sparkSession
    member = _members(spark, wanted, bits)
    cell = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << bits)).alias("cell")

    def run(batches):
        for batch in batches:
            own = np.flatnonzero(member.value[np.asarray(batch.column("cell"))])
            if not len(own):
                continue
            for part in columns.small_batches([batch.take(pa.array(own))], text, BLOCK):
                sets = dict((_key(s, twins), s) for s in shingle_sets(part.column(text), size) if len(s)).items()
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sets], pa.int64()), pa.array([s.tobytes() for _, s in sets], pa.binary())], names=["key", "cells"])

    full = docs.where("doc_id is not null").select(text, cell).mapInArrow(run, "key long, cells binary").join(wanted.select("key"), "key", "left_semi")
    full = materialise(full.dropDuplicates(["key"]), "jaccard-sets")

    def intersect(batches):
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = passed.join(full.select(F.col("key").alias("b"), F.col("cells").alias("y")), "b").join(
        full.select(F.col("key").alias("a"), F.col("cells").alias("x")), "a")
    return materialise(both.select("a", "b", "x", "y").mapInArrow(intersect, "a long, b long"), "jaccard-links")


def classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its set and the smallest
    doc_id reachable by links, 100 * intersection >= percent * union.

    An empty or NULL text, or one of white space, has no shingles and is alone. A row
    without doc_id links with nothing and has a NULL component_id. Rows that repeat a
    doc_id are taken row by row; equal rows come out equal. Other columns are ignored."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    bits = min(max(math.ceil(math.log2(max(docs.count(), 1) * 32)), CELL_BITS[0]), CELL_BITS[1])
    surveyed = materialise(_survey(docs, "text", bits, size), "jaccard-survey")
    rows = surveyed.where("chunk is null").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"), "check")
    twins = _twins(rows)
    if twins:
        # The rest of such sets take their own keys, here by the same rule as in _key.
        own = F.udf(lambda key, check: int.from_bytes(hashlib.blake2b(struct.pack("<qq", key, check), digest_size=8).digest(), "little", signed=True), "long")
        names = spark.createDataFrame(list(twins.items()), "key long, kept long")
        rows = rows.join(names, "key", "left").withColumn(
            "key", F.when(F.col("kept").isNotNull() & (F.col("check") != F.col("kept")), own("key", "check")).otherwise(F.col("key"))).drop("kept")
        rows = materialise(rows.select("doc_id", "n_shingles", "key", "check"), "jaccard-rows")
    counts = tables.total(surveyed.where("chunk is not null").select("chunk", "salt", "cells"), (1 << bits,), np.uint32)
    rarity = spark.sparkContext.broadcast(np.minimum(8 * np.log2(counts + 1.0), 255).astype(np.uint8))
    orders = materialise(_prefixes(docs.where("doc_id is not null"), "text", rarity, bits, size, percent, twins), "jaccard-orders")

    entries = orders.select("key", "n", F.posexplode("first").alias("pos", "shingle"))
    held = entries.groupBy("shingle").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("shingle")
    shared = materialise(entries.join(held, "shingle"), "jaccard-shared")
    early = F.shiftleft(F.col("pos").cast("long"), 32) + F.pmod(F.xxhash64("key"), F.lit(1 << 31))
    pivots = shared.groupBy("shingle").agg(F.min_by("key", early).alias("a"), F.min_by("n", early).alias("a_n"), F.min_by("pos", early).alias("a_pos"))
    near = _may_link(F.col("n"), F.col("pos"), F.col("a_n"), F.col("a_pos"), percent)
    pairs = shared.join(pivots, "shingle").where((F.col("key") != F.col("a")) & near).select("a", F.col("key").alias("b")).distinct()
    verify = lambda p: _verified(p, docs, "text", rows, bits, size, percent, orders, twins)
    links = verify(pairs)

    # What is left: sets of different components that share a first shingle. One side
    # leaves out the shingle's largest component, so a large group does not meet itself.
    roots = components(links)
    placed = shared.join(roots.withColumnRenamed("vertex", "key"), "key", "left").select(
        "shingle", "key", "n", "pos", F.coalesce("root", "key").alias("root"))
    split = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("shingle")
    placed = materialise(placed.join(split, "shingle"), "jaccard-left")
    most = placed.groupBy("shingle", "root").count().groupBy("shingle").agg(F.max_by("root", "count").alias("most"))
    other = placed.join(most, "shingle").where("root <> most").select(
        "shingle", *[F.col(c).alias(f"{c}_2") for c in ("key", "n", "pos", "root")])
    meets = (F.col("root") != F.col("root_2")) & _may_link(F.col("n"), F.col("pos"), F.col("n_2"), F.col("pos_2"), percent)
    pairs = placed.join(other, "shingle").where(meets).select(F.least("key", "key_2").alias("a"), F.greatest("key", "key_2").alias("b")).distinct()
    more = verify(pairs)
    roots = components(links.union(more)).withColumnRenamed("vertex", "key")

    # The smallest id goes from rows to sets to components and back to sets; only the last
    # join meets rows, by set, and copies of one set need no more than one row of it.
    sets = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = materialise(sets.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "jaccard-roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("smallest"), F.count(F.lit(1)).alias("sets"))
    linked = rooted.join(smallest.where("sets > 1"), "root").select("key", "smallest")
    alone = rooted.join(smallest.where("sets = 1").select("root"), "root", "left_semi").select("key", F.col("least").alias("smallest"))
    component = F.coalesce("smallest", "doc_id").alias("component_id")
    return rows.join(linked.union(alone), "key", "left").select("doc_id", "n_shingles", component)


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, that come first in their class by doc_id. Rows
    without doc_id or without words stay. Rows are judged one by one: of rows that share
    a doc_id, those of one class come in the order of their texts' hashes and one stays,
    and a text that is alone stays although another of its doc_id goes."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # the table's own names may be any
    id_, text_ = (names[docs.columns.index(c)] for c in (key, text))
    rows = docs.toDF(*names)
    known = rows.where(F.col(id_).isNotNull())
    repeated = known.groupBy(id_).count().where("count > 1").limit(1).count()
    if repeated:  # every row gets a number that follows the ids
        known = materialise(known.orderBy(id_, F.xxhash64(text_)).withColumn("row_", F.monotonically_increasing_id()), "jaccard-numbered")
    else:
        known = known.withColumn("row_", F.col(id_).cast("long"))
    found = classes(known.select("row_", text_), size, percent, "row_", text_)
    gone = materialise(found.where("component_id < doc_id").select(F.col("doc_id").alias("row_")), "jaccard-gone")
    kept = known.join(gone, "row_", "left_anti").select(names)
    return kept.union(rows.where(F.col(id_).isNull())).toDF(*docs.columns)
