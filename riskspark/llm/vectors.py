"""Usable vectors of a table and packing of rows into matrix blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding", zero: bool = True) -> tuple[DataFrame, int]:
    """((vec_id, vector array<double>), dimension): one row for each id, the smallest of its
    vectors. Left out are rows without an id and vectors that are NULL, empty, of another
    length than the most frequent one, or hold a NULL or non-finite component (and zero
    vectors unless ``zero``)."""
    v = F.col(vector)
    known = df.select(F.col(key).cast("long").alias("vec_id"), v.cast("array<double>").alias("vector"))
    limit = float("inf")
    known = known.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x > -limit)))
    if not zero:
        known = known.where(F.exists("vector", lambda x: x != 0))
    sizes = known.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dim = sizes[0]["n"] if sizes else 0
    return known.where(F.size("vector") == dim).groupBy("vec_id").agg(F.min("vector").alias("vector")), dim


def pack(rows: DataFrame, by: list[str], key: str = "vec_id", copies: int | None = None) -> DataFrame:
    """One row for each group of ``by``: ids and matrix as bytes, ids ascending. With
    ``copies``, only so many smallest ids of equal vectors of the group are kept: the
    rest cannot be among the first ``copies`` of any ranking with ties to smaller ids."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by(key)
        ids, m = group[key].to_numpy(), matrix(group["vector"])
        if copies:
            seen: dict[bytes, int] = {}
            keep = []
            for i, row in enumerate(m):
                seen[b] = seen.get(b := row.tobytes(), 0) + 1
                if seen[b] <= copies:
                    keep.append(i)
            ids, m = ids[keep], m[keep]
        head = [group[c].slice(0, 1) for c in by]
        return pa.Table.from_arrays([*head, pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                                    names=[*by, "ids", "cells"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)
    return rows.select(*by, key, "vector").groupBy(*by).applyInArrow(run, f"{kinds}, ids binary, cells binary")


def matrix(col) -> np.ndarray:
    """A column of equally long arrays as a matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.ascontiguousarray(col.flatten().to_numpy(zero_copy_only=False), float).reshape(len(col), -1)


def unpack(ids, cells) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(cells, float).reshape(len(ids), -1)


def blocks_for(n: int, rows: int) -> int:
    return max(1, math.ceil(n / rows))


def hashed(col: Column | str, n: int) -> Column:
    return F.pmod(F.xxhash64(col, F.lit(3)), F.lit(n)).cast("int")


def ranked(scored: DataFrame, k: int, by: str = "query_id", score: str = "score") -> DataFrame:
    """The k best rows of each query, ties to smaller vec_id, with their rank."""
    order = Window.partitionBy(by).orderBy(F.desc(score), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_rows(q: np.ndarray, m: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the k largest inner products. The matrix product only picks;
    the scores are summed row by row, so equal vectors have equal scores."""
    rough = m @ q
    rough[ids == own] = -np.inf
    if len(rough) > k:
        cut = np.partition(rough, len(rough) - k)[len(rough) - k]
        slack = 1e-9 * (np.abs(q) @ np.abs(m).max(0)) + 1e-300
        at = np.flatnonzero(rough >= cut - slack)
    else:
        at = np.arange(len(rough))
    at = at[ids[at] != own]
    score = (m[at] * q).sum(1)
    order = np.lexsort((ids[at], -score))[:k]
    return at[order], score[order]
