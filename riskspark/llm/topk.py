"""Exact top-k by integer inner product with a three-phase uniform threshold.

The dimensions are split into ``LISTS`` ranges; a row's score is the sum of its
entries in the ranges' score lists. The blocks of rows are dealt to spans, one a task;
a task holds its span's vectors while all queries pass by, so a query is copied once a
span, through a shuffle. Phase one gathers each list's k best entries of every
span with the rows' sums and derives, for each query, a score that k rows
surely reach (sums of entries and floors alone are weak where entries are negative;
few lists keep the even shares high for the same reason). Phase
two sends the cutoff back: a row that reaches that score has, in one list at least,
an even share of it above the list's floor, so only such rows are collected. Those
whose bound may still reach it are summed up where their span's vectors are, and a span
hands on its k best, as no other can be among the first k. The k best of all spans
are resolved from the vectors in phase three.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskspark.common import materialise
from riskspark.llm import vectors

LISTS = 2
BLOCK_ROWS = 512
QUERY_ROWS = 256
TILE_ROWS = 2048
#: Bytes of vectors of a span; small tables have as many spans as this if their blocks allow.
SPAN_BYTES = 8 << 20
LEAST_SPANS = 24
#: Packed blocks that a reader holds at a time.
GROUP = 32
SCALE = 256
NONE = np.iinfo(np.int64).min


def _meeting(blocks: DataFrame, asked: DataFrame, spans: int) -> DataFrame:
    """The blocks of rows and a copy of all queries for each span, a span in one partition with its rows first."""
    rows = blocks.select((F.col("block") % spans).alias("span"), F.lit(False).alias("asks"), "ids", "cells")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(spans - 1)))  # the stated query set meets every span of rows
    asked = asked.withColumnsRenamed({"q_ids": "ids", "q_cells": "cells"}).drop("q_block").withColumns({"span": everywhere, "asks": F.lit(True)})
    both = rows.unionByName(asked, allowMissingColumns=True)
    return both.repartitionById(spans, F.col("span")).sortWithinPartitions("span", "asks")


def _passing(batches):
    """(query ids, their score lists with each tile of the span's rows, cutoffs) of each block of queries."""
    span, held, tiles = None, [], None
    for batch in batches:
        for row in range(batch.num_rows):
            cell = lambda c: batch.column(c)[row].as_py()
            if cell("span") != span:
                span, held, tiles = cell("span"), [], None
            ids, m = vectors.unpack(cell("ids"), cell("cells"))
            if not cell("asks"):
                held.append((ids, m))
                continue
            if tiles is None:
                tiles, held = _tiles(held), []
            if tiles:
                kind = _kind(np.abs(m).max() * max(most for *_, most in tiles) * m.shape[1])
                yield ids, _lists(ids, [x.astype(kind) for x in _ranges(m)], tiles), cell("cutoffs") if "cutoffs" in batch.schema.names else None


def _tiles(held: list) -> list:
    """(ids, ranges of the matrix, largest component) of each TILE_ROWS rows, ids ascending."""
    if not held:
        return []
    ids, m = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(ids)
    parts = [order[i : i + TILE_ROWS] for i in range(0, len(ids), TILE_ROWS)]
    return [(ids[at], _ranges(m[at]), np.abs(m[at]).max()) for at in parts]


def _ranges(m: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(x) for x in np.array_split(m, min(LISTS, m.shape[1]), axis=1)]


def _kind(most: float):
    """The narrowest type whose sums of products are exact."""
    return np.float32 if most < 2**24 else np.float64 if most < 2**52 else np.int64


def _lists(queries: np.ndarray, q: list[np.ndarray], tiles: list):
    """(ids, who is itself, score lists) of a block of queries with each tile of rows."""
    for ids, parts, _ in tiles:
        at = np.searchsorted(ids, queries)
        who = np.flatnonzero(ids[np.minimum(at, len(ids) - 1)] == queries)
        yield ids, (who, at[who]), [x @ y.astype(x.dtype).T for x, y in zip(q, parts)]


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.nonzero of a matrix, several times faster where few cells are set."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


class _Best:
    """The k best rows of each query so far, ties to smaller ids, and the k-th one's score."""

    def __init__(self, k: int, bar: np.ndarray):
        self.k, self.bar, self.cols = k, bar.copy(), [np.empty(0, np.int64)] * 4

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray, total: np.ndarray) -> None:
        if not len(who):
            return
        cols = [np.concatenate(c) for c in zip(self.cols, (who, score, ids, total))]
        order = np.lexsort((cols[2], -cols[1], cols[0]))
        own = cols[0][order]
        n = np.bincount(own, minlength=len(self.bar))
        self.cols = [c[order[np.arange(len(own)) - (n.cumsum() - n)[own] < self.k]] for c in cols]
        full, ends = n >= self.k, np.minimum(n, self.k).cumsum()
        self.bar[full] = np.maximum(self.bar[full], self.cols[1][ends[full] - 1])


def _gather(meeting: DataFrame, k: int) -> DataFrame:
    """Phase one: each list's k best entries of every span, and its least entry there."""

    def run(batches):
        for queries, tiles, _ in _passing(batches):
            none = np.full(len(queries), NONE)
            best, floors = [], []
            for ids, own, lists in tiles:
                if not best:
                    best, floors = [_Best(k, none) for _ in lists], [~none for _ in lists]
                for number, (s, top) in enumerate(zip(lists, best)):
                    floors[number] = np.minimum(floors[number], s.min(1).astype(np.int64))
                    more = s > top.bar.astype(s.dtype)[:, None]
                    if len(ids) > k + 1 and (top.bar == NONE).any():  # no bar yet: the tile's own, with room for the row itself
                        more &= s >= np.partition(s, -k - 1, axis=1)[:, [-k - 1]]
                    more[own] = False
                    who, at = _places(more)
                    top.add(who, s[who, at].astype(np.int64), ids[at], sum(x[who, at].astype(np.int64) for x in lists))
            for number, (top, floor) in enumerate(zip(best, floors)):
                who, entry, found, total = top.cols
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (queries[who], np.full(len(who), number, np.int32), found, entry, floor[who], total)],
                                                 names=["query_id", "list", "vec_id", "entry", "floor", "total"])

    return meeting.mapInArrow(run, "query_id long, list int, vec_id long, entry long, floor long, total long")


def _collect(meeting: DataFrame, k: int) -> DataFrame:
    """Phase two: rows with an entry at or above the cutoff, whose bound reaches the sure score
    (other entries are below the cutoff), and that are among the span's k best."""

    def run(batches):
        for queries, tiles, cutoffs in _passing(batches):
            told = {c["query_id"]: c for c in cutoffs}
            told = [told.get(q, {}) for q in queries.tolist()]
            best = _Best(k, np.array([NONE if c.get("sure") is None else c["sure"] for c in told], np.int64))
            for ids, own, lists in tiles:
                share = np.array([c.get("cutoff", [NONE] * len(lists)) for c in told], np.int64).T
                known = [s >= c.astype(s.dtype)[:, None] for s, c in zip(lists, share)]
                some = np.logical_or.reduce(known)
                some[own] = False
                who, at = _places(some)
                entries = [s[who, at].astype(np.int64) for s in lists]
                high = sum(np.where(x[who, at], e, c[who] - 1) for x, e, c in zip(known, entries, share))
                left = np.flatnonzero(high >= best.bar[who])
                who, found, total = who[left], ids[at[left]], sum(e[left] for e in entries)
                left = total >= best.bar[who]
                best.add(who[left], total[left], found[left], total[left])
            who, total, found, _ = best.cols
            yield pa.RecordBatch.from_arrays([pa.array(queries[who]), pa.array(found), pa.array(total)], names=["query_id", "vec_id", "total"])

    return meeting.mapInArrow(run, "query_id long, vec_id long, total long")


def _sure(bounded: DataFrame, k: int) -> DataFrame:
    """(query_id, sure): the k-th largest lower bound of each query's rows, none with fewer rows."""
    best = vectors.ranked(bounded.select("query_id", "vec_id", "low"), k, score="low")
    return best.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("low")).alias("sure"))


def search(df: DataFrame, every: int = 50, k: int = 5, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of floor(scale * x)
    of each row whose id is a multiple of ``every`` with all other rows, ties to the
    smaller vec_id; all of them if there are fewer. Left out are rows without an id
    and vectors that are NULL, empty, of another length, or hold a NULL or non-finite
    component; of rows that repeat an id, one takes part. Scores must fit a long."""
    rows, dim = vectors.usable(df, key, vector)
    rows = materialise(rows.select("vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("double")).alias("vector")), "topk-vectors")
    n, lists = rows.count(), min(LISTS, max(dim, 1))
    many = vectors.blocks_for(n, BLOCK_ROWS)
    blocks = materialise(vectors.pack(rows.withColumn("block", vectors.hashed("vec_id", many)), ["block"], copies=k + 1), "topk-blocks", GROUP)
    queries = rows.where(F.col("vec_id") % every == 0)
    bins = vectors.blocks_for(queries.count(), QUERY_ROWS)
    asked = queries.withColumn("q_block", vectors.hashed("vec_id", bins))
    asked = materialise(vectors.pack(asked, ["q_block"]).withColumnsRenamed({"ids": "q_ids", "cells": "q_cells"}), "topk-queries", GROUP)
    spans = min(many, max(LEAST_SPANS, vectors.blocks_for(n * dim * 8, SPAN_BYTES)))

    gathered = materialise(_gather(_meeting(blocks, asked, spans), k), "topk-gathered")
    floors = gathered.groupBy("query_id", "list").agg(F.min("floor").alias("floor"))
    order = Window.partitionBy("query_id", "list").orderBy(F.desc("entry"), "vec_id")
    top = gathered.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    per_query = floors.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("list", "floor"))).alias("floors"))
    all_floors = F.aggregate(F.map_values("floors"), F.lit(0).cast("long"), lambda a, x: a + x)
    seen = top.groupBy("query_id", "vec_id").agg(F.max("total").alias("low"))
    # An entry must exceed its floor by a share of (sure - base), rounded up.
    cut = per_query.join(_sure(seen, k), "query_id", "left").withColumn("base", all_floors)
    share = F.ceil((F.col("sure") - F.col("base")) / F.lit(lists)).cast("long") - 1  # one less: safe from rounding of the quotient
    by_list = F.transform(F.sequence(F.lit(0), F.lit(lists - 1)), lambda j: F.element_at("floors", j) + F.coalesce(F.col("share"), F.lit(0)))
    cut = materialise(cut.withColumn("share", share).select("query_id", "sure", by_list.alias("cutoff")), "topk-cutoffs")

    blocked = cut.withColumn("q_block", vectors.hashed("query_id", bins))
    cutoffs = blocked.groupBy("q_block").agg(F.collect_list(F.struct("query_id", "sure", "cutoff")).alias("cutoffs"))
    collected = materialise(_collect(_meeting(blocks, asked.join(cutoffs, "q_block"), spans), k), "topk-collected")
    left = vectors.ranked(collected, k, score="total").select("query_id", "vec_id")

    zero = F.lit(0).cast("long")
    exact = left.join(rows, "vec_id").join(queries.withColumnsRenamed({"vec_id": "query_id", "vector": "q"}), "query_id")
    product = F.zip_with("vector", "q", lambda a, b: a.cast("long") * b.cast("long"))
    exact = exact.select("query_id", "vec_id", F.aggregate(product, zero, lambda a, x: a + x).alias("score"))
    return vectors.ranked(exact, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
