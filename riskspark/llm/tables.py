"""Fixed-size numeric tables that tasks fill while they stream and Spark sums."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CHUNKS = 64
SCHEMA = "chunk int, salt int, cells binary"


def _squeeze(part: np.ndarray) -> bytes:
    """Compressed byte planes: the upper bytes of counts are nearly all zero."""
    return zlib.compress(np.ascontiguousarray(part.reshape(-1).view(np.uint8).reshape(-1, part.itemsize).T).tobytes(), 1)


def _spread(cells: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(cells), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def emit(table: np.ndarray, salt: int) -> Iterator[pa.RecordBatch]:
    """The chunks of a task's table that are not all zero."""
    for chunk, part in enumerate(np.array_split(table, min(CHUNKS, len(table)))):
        if part.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([salt % 64], pa.int32()), pa.array([_squeeze(np.ascontiguousarray(part))], pa.binary())],
                names=["chunk", "salt", "cells"])


def total(parts: DataFrame, shape: tuple[int, ...], dtype) -> np.ndarray:
    """Sum the tasks' tables in two shuffles (salted, then by chunk). A task holds one
    table at most; the result has the fixed ``shape``, whatever the input's size."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells in zip(batch.column("chunk").to_pylist(), batch.column("cells").to_pylist()):
                own = _spread(cells, dtype)
                sums[chunk] = sums[chunk] + own if chunk in sums else own
        for chunk, own in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([0], pa.int32()), pa.array([_squeeze(own)], pa.binary())],
                names=["chunk", "salt", "cells"])

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summed = parts.repartition(n, "chunk", "salt").mapInArrow(add, SCHEMA)
    summed = summed.repartition(min(n, CHUNKS), "chunk").mapInArrow(add, SCHEMA)
    out = np.zeros(shape, dtype)
    views = np.array_split(out, min(CHUNKS, shape[0]))
    for row in summed.select("chunk", "cells").collect():
        views[row["chunk"]][...] = _spread(row["cells"], dtype).reshape(views[row["chunk"]].shape)
    return out


def share(df: DataFrame, by: str, most: int) -> DataFrame:
    """A sample of about ``most`` rows for each value of a column of few values, by a
    hash of ``doc_id``: the same rows whatever the partitioning."""
    counts = {r[by]: r["count"] for r in df.groupBy(by).count().collect() if r[by] is not None}
    if not counts:
        return df.limit(0)
    unit = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 40)) / float(1 << 40)
    rates = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, most / n)))])
    return df.where(F.col(by).isNotNull() & (unit < F.element_at(rates, F.col(by))))
