"""Approximate nearest neighbours by inner product: a hierarchical k-means tree,
searched best bin first.

The tree is fitted on a sample of at most about ``SAMPLE`` vectors, a parameter;
every vector is indexed in a leaf. A query takes nodes from a priority queue by the
inner product with their centres. How many leaves it visits is widened until some
calibration queries, whose true neighbours come from all vectors, reach the wanted
recall; if need be that is all leaves.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.common import materialise
from riskspark.llm import vectors

SAMPLE = 16_384
BRANCHES = 8
LEAF_ROWS = 48
CALIBRATION = 96
TARGET = 0.97
#: Rows of a block of one leaf; a leaf with more vectors has more blocks.
BLOCK_ROWS = 256


@dataclass
class Tree:
    centres: list[np.ndarray]  # of the children of each inner node
    children: list[list[int]]  # inner node >= 0, leaf as -1 - number
    leaves: int

    @classmethod
    def fit(cls, m: np.ndarray, seed: int = 3) -> Tree:
        tree, rng = cls([], [], 0), np.random.default_rng(seed)
        tree._grow(m, rng)
        return tree

    def _grow(self, m: np.ndarray, rng) -> int:
        if len(m) > LEAF_ROWS and (m != m[0]).any():
            centres, of = _kmeans(m, BRANCHES, rng)
            if len(centres) > 1:
                at = len(self.children)
                self.centres.append(centres)
                self.children.append([])
                self.children[at] = [self._grow(m[of == c], rng) for c in range(len(centres))]
                return at
        self.leaves += 1
        return -self.leaves

    def assign(self, m: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest centre at each level."""
        out = np.zeros(len(m), np.int32)
        todo = [(0 if self.children else -1, np.arange(len(m)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            of = _nearest(m[rows], self.centres[node])
            todo += [(child, rows[of == c]) for c, child in enumerate(self.children[node])]
        return out

    def visit(self, q: np.ndarray, count: int, sizes: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """The first ``count`` leaves for a query, best bin first, and as many more as it
        takes to hold ``least`` rows by the leaves' ``sizes``."""
        queue, out, tick, rows = [(0.0, 0, 0 if self.children else -1)], [], 0, 0
        while queue and (len(out) < count or rows < least):
            _, _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                rows += sizes.get(-1 - node, 0) if sizes else 0
                continue
            for near, child in zip((self.centres[node] @ q).tolist(), self.children[node]):
                tick += 1
                heapq.heappush(queue, (-near, tick, child))
        return out


def _nearest(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * (m @ centres.T)).argmin(1)


def _kmeans(m: np.ndarray, k: int, rng, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = [m[rng.integers(len(m))]]
    far = ((m - centres[0]) ** 2).sum(1)
    while len(centres) < k and far.sum() > 0:
        centres.append(m[rng.choice(len(m), p=far / far.sum())])
        far = np.minimum(far, ((m - centres[-1]) ** 2).sum(1))
    centres = np.array(centres)
    for _ in range(rounds):
        of = _nearest(m, centres)
        used = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, m)
        centres = sums[used > 0] / used[used > 0, None]
    of = _nearest(m, centres)
    used = np.unique(of)
    return centres[used], np.searchsorted(used, of)


def _sample(rows: DataFrame, n: int, most: int) -> np.ndarray:
    part = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most / max(n, 1))))
    return np.array([r["vector"] for r in part.orderBy("vec_id").collect()], float)


def _search(index: DataFrame, asked: DataFrame, k: int, with_leaf: bool = False) -> DataFrame:
    """Best rows of every pair of blocks that share ``bin``: query_id, vec_id, score."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, m = vectors.unpack(batch.column("ids")[row].as_py(), batch.column("cells")[row].as_py())
                queries, q = vectors.unpack(batch.column("q_ids")[row].as_py(), batch.column("q_cells")[row].as_py())
                found = [vectors.best_rows(x, m, ids, own, k) for own, x in zip(queries.tolist(), q)]
                n = [len(a) for a, _ in found]
                out = [np.repeat(queries, n), ids[np.concatenate([a for a, _ in found])], np.concatenate([s for _, s in found])]
                names = ["query_id", "vec_id", "score"]
                if with_leaf:
                    out.append(np.full(sum(n), batch.column("leaf")[row].as_py(), np.int32))
                    names.append("leaf")
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)

    asked = asked.withColumnsRenamed({"ids": "q_ids", "cells": "q_cells"})
    schema = "query_id long, vec_id long, score double" + ", leaf int" * with_leaf
    return index.join(asked, "bin").select("leaf", "ids", "cells", "q_ids", "q_cells").mapInArrow(run, schema)


def search(df: DataFrame, every: int = 20, k: int = 20, target: float = TARGET, sample: int = SAMPLE,
           key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is a
    multiple of ``every`` among all other rows, by inner product in double precision;
    all of them if there are fewer. Left out are rows without an id and vectors that
    are NULL, zero, of another length, or hold a NULL or non-finite component; of rows
    that repeat an id, one takes part. Equal scores go to the smaller vec_id."""
    rows, dim = vectors.usable(df, key, vector, zero=False)
    rows = materialise(rows, "ann-vectors")
    n = rows.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = Tree.fit(_sample(rows, n, sample) if n > 1 else np.zeros((1, dim)))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = tree.assign(vectors.matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(leaf), batch.column("vector")], names=["vec_id", "leaf", "vector"])

    stored = materialise(rows.mapInArrow(assign, "vec_id long, leaf int, vector array<double>"), "ann-leaves")
    sizes = {r["leaf"]: r["count"] for r in stored.groupBy("leaf").count().collect()}  # one a leaf of the tree
    index = materialise(vectors.pack(_in_blocks(stored, sizes), ["leaf", "block"], copies=k + 1), "ann-index")
    queries = rows.where(F.col("vec_id") % every == 0)

    # Calibration: the true neighbours of a few queries, and when their leaves come up.
    unit = F.pmod(F.xxhash64("vec_id", F.lit(13)), F.lit(1 << 30))
    some = queries.where(unit < int((1 << 30) * min(1.0, CALIBRATION / max(n / every, 1))))
    asked = vectors.pack(some.withColumn("bin", F.lit(0)), ["bin"])
    true = vectors.ranked(_search(index.withColumn("bin", F.lit(0)), asked, k, True), k).collect()
    places: dict[int, dict[int, int]] = {}
    for r in some.collect():
        places[r["vec_id"]] = {leaf: i for i, leaf in enumerate(tree.visit(np.array(r["vector"]), tree.leaves))}
    at = np.array([places[r["query_id"]][r["leaf"]] for r in true], int)
    visits = next((v for v in range(1, tree.leaves) if len(at) and (at < v).mean() >= target), tree.leaves)

    def leaves_of(batches):
        for batch in batches:
            if batch.num_rows:
                found = [tree.visit(q, visits, sizes, k + 1) for q in vectors.matrix(batch.column("vector"))]
                take = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(take), pa.array(np.concatenate(found), pa.int32()), batch.column("vector").take(take)],
                                                 names=["vec_id", "leaf", "vector"])

    wanted = materialise(queries.mapInArrow(leaves_of, "vec_id long, leaf int, vector array<double>"), "ann-visits")
    asking = {r["leaf"]: r["count"] for r in wanted.groupBy("leaf").count().collect()}
    asked = vectors.pack(_in_blocks(wanted, asking), ["leaf", "block"]).withColumnRenamed("leaf", "bin").drop("block")
    found = _search(index.withColumn("bin", F.col("leaf")), asked, k)
    return vectors.ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _in_blocks(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Deal the rows of each leaf to blocks of about BLOCK_ROWS by a hash of the id."""
    if not sizes:
        return rows.withColumn("block", F.lit(0))
    blocks = F.create_map(*[F.lit(x) for leaf, n in sizes.items() for x in (leaf, vectors.blocks_for(n, BLOCK_ROWS))])
    return rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.element_at(blocks, F.col("leaf")).cast("long")).cast("int"))
