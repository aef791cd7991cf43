"""A key index beside a sink of batch folders.

Every committed batch has, for each bucket of key hashes, a Bloom filter and the range of
its keys. A new batch asks the index which folders may hold its keys and reads only
those; the anti-join that follows is exact. Filters hold a bounded number of keys, as the
number of buckets follows the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from riskspark.common import materialise
from riskspark.operators import normalise as nz

BUCKET_KEYS = 1 << 20
BITS_PER_KEY, PROBES = 12, 5
SCHEMA = "batch long, buckets int, bucket int, low string, high string, bits binary"


def _probes(h: np.ndarray, bits: int) -> np.ndarray:
    """Places of a hash in a filter of ``bits`` (a power of two)."""
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return ((a + np.arange(PROBES, dtype=np.uint64)[:, None] * b) & np.uint64(bits - 1)).astype(np.int64)


def bloom(h: np.ndarray) -> np.ndarray:
    cells = np.zeros(1 << max(int(np.ceil(np.log2(max(len(h) * BITS_PER_KEY, 64)))), 6), bool)
    cells[_probes(h, len(cells)).ravel()] = True
    return np.packbits(cells)


def may_hold(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _probes(h, len(bits) * 8)
    return ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(0)


def _hashed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(F.xxhash64(*keys).alias("h"), F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]).alias("key"))


def describe(rows: DataFrame, keys: list[str], batch: int) -> DataFrame:
    """The index rows of one batch. A bucket's keys are gathered by their hashes, some
    ``BUCKET_KEYS`` of them."""
    buckets = 1 << max(int(np.ceil(np.log2(max(rows.count(), 1) / BUCKET_KEYS))), 0)
    h = _hashed(rows, keys).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    ends = h.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high"))

    def one(key, table):
        bits = bloom(table["h"].to_numpy().view(np.uint64)).tobytes()
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits], pa.binary())})

    filters = h.select("bucket", "h").groupBy("bucket").applyInArrow(one, "bucket int, bits binary")
    return filters.join(ends, "bucket").select(F.lit(batch).cast("long").alias("batch"), F.lit(buckets).alias("buckets"), "bucket", "low", "high", "bits")


def candidates(index: DataFrame, rows: DataFrame, keys: list[str]) -> list[int]:
    """The batches that may hold a key of ``rows``. New keys meet the filters of their
    bucket in chunks; only batch numbers come back."""
    h = materialise(_hashed(rows, keys), "keyindex-new")
    sizes = [r["buckets"] for r in index.select("buckets").distinct().collect()]
    if not sizes:
        return []
    chunk = F.pmod(F.xxhash64("h", F.lit(5)), F.lit(max(1, h.count() // BUCKET_KEYS))).alias("chunk")
    each = h.select("h", "key", chunk, F.explode(F.array(*[F.lit(n) for n in sizes])).alias("buckets"))
    each = each.withColumn("bucket", F.pmod("h", "buckets").cast("int")).groupBy("buckets", "bucket", "chunk")

    def packed(key, table):
        names = ["buckets", "bucket"]
        ends = pa.compute.min_max(table["key"]).as_py()
        return pa.table({**{n: pa.array([k.as_py()], pa.int32()) for n, k in zip(names, key)}, "first": pa.array([ends["min"]], pa.string()),
                         "last": pa.array([ends["max"]], pa.string()), "hashes": pa.array([table["h"].to_numpy().tobytes()], pa.binary())})

    asked = each.applyInArrow(packed, "buckets int, bucket int, first string, last string, hashes binary")

    def hit(batches):
        for b in batches:
            found = [may_hold(np.frombuffer(x.as_py(), np.uint8), np.frombuffer(y.as_py(), np.uint64)).any() for x, y in zip(b.column("bits"), b.column("hashes"))]
            yield pa.RecordBatch.from_arrays([b.column("batch").filter(pa.array(found, pa.bool_()))], names=["batch"])

    meet = index.join(asked, ["buckets", "bucket"]).where("high >= first AND low <= last")
    return sorted(r["batch"] for r in meet.select("batch", "bits", "hashes").mapInArrow(hit, "batch long").distinct().collect())


class IndexedSink:
    """A folder of ``batch=<n>`` folders with an index in ``_keys`` (which readers skip)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), keys, schema
        self.read_batches: list[int] = []

    def _names(self, folder: str) -> list[int]:
        """Batch numbers below a folder, by one listing of the sink's own file system."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        names = [s.getPath().getName() for s in files.listStatus(where)]
        return sorted(int(n[6:]) for n in names if n.startswith("batch="))

    def index(self, but: int | None = None) -> DataFrame:
        folders = [f"{self.path}/_keys/batch={b}" for b in self._names(f"{self.path}/_keys") if b != but]
        return self.spark.read.schema(SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)

    def stored(self, batches: list[int]) -> DataFrame:
        folders = [f"{self.path}/batch={b}" for b in batches]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def append(self, rows: DataFrame, batch: int, order: list[Column]) -> list[int]:
        """Append the first row of each key that no other batch holds; returns the batches
        whose folders were read. A repeated batch replaces its own folder and index."""
        rows = materialise(nz.keep_first(rows, self.keys, order), "sink-batch")
        self.read_batches = candidates(self.index(but=batch), rows, self.keys)
        old = self.stored(self.read_batches)
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in self.keys]
        on = same[0]
        for c in same[1:]:
            on = on & c
        new = rows.alias("n").join(old.select(*self.keys).distinct().alias("o"), on, "left_anti")
        new.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        # The index last: a batch without one is repeated by the stream's own checkpoint.
        describe(self.stored([batch]), self.keys, batch).write.mode("overwrite").parquet(f"{self.path}/_keys/batch={batch}")
        return self.read_batches

    def read(self) -> DataFrame:
        return self.stored(self._names(self.path))
