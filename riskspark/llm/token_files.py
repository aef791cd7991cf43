"""Token ids in binary shard files, coded with Simple-8b.

Documents are range partitioned and sorted by id; each partition streams its ids
into one file. A file belongs to the data set once its row is in the manifest, a
table that Spark commits: files of failed or repeated attempts have other names and
are never read.

File: magic, blocks (words, then escapes, as little-endian 64-bit words), the block
index (byte offset, words, escapes, values; four 64-bit integers a block), the
document table (an Arrow stream of key and number of ids), and a tail with the
places of index and table. A block is decoded on its own, so a reader may begin at
any of them.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskspark.common import materialise, scratch_path
from riskspark.llm import simple8b
from riskspark.llm.columns import small_batches
from riskspark.llm.tokens import encoder, frequent_words, vocabulary_path

END_ID = 2
BLOCK_IDS = 65_536
MAGIC = b"S8BTOK01"
_TAIL = struct.Struct("<qqqq8s")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


class ShardWriter:
    def __init__(self, out, block_ids: int = BLOCK_IDS):
        self.out, self.block_ids, self.index, self.held, self.waiting = out, block_ids, [], [], 0
        self.at = out.write(MAGIC)
        self.tables: list[pa.RecordBatch] = []

    def add(self, keys: pa.Array, ids: np.ndarray, n: np.ndarray) -> None:
        self.tables.append(pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64())], names=["key", "n_tokens"]))
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block_ids:
            self._blocks(False)

    def _blocks(self, last: bool) -> None:
        values = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
        full = len(values) if last else len(values) // self.block_ids * self.block_ids
        for i in range(0, full, self.block_ids):
            block = values[i : min(i + self.block_ids, full)]
            words, escapes = simple8b.encode(block)
            self.index.append((self.at, len(words), len(escapes), len(block)))
            self.at += self.out.write(words.astype("<u8").tobytes()) + self.out.write(escapes.astype("<u8").tobytes())
        self.held, self.waiting = [values[full:]], len(values) - full

    def close(self) -> tuple[int, int, int]:
        """(documents, ids, bytes) of the file."""
        self._blocks(True)
        index = np.array(self.index, "<i8").reshape(-1, 4)
        index_at = self.at
        self.at += self.out.write(index.tobytes())
        sink, table_at = io.BytesIO(), self.at
        with pa.ipc.new_stream(sink, self.tables[0].schema) as stream:
            for t in self.tables:
                stream.write_batch(t)
        self.at += self.out.write(sink.getvalue())
        self.at += self.out.write(_TAIL.pack(index_at, len(index), table_at, self.at - table_at, MAGIC))
        self.out.close()
        return sum(t.num_rows for t in self.tables), int(index[:, 3].sum()), self.at


def read_shard(source):
    """Yield (keys, list of id arrays) of a shard, block by block."""
    source.seek(source.size() - _TAIL.size)
    index_at, blocks, table_at, table_size, magic = _TAIL.unpack(source.read(_TAIL.size))
    if magic != MAGIC:
        raise ValueError("not a token file")
    source.seek(index_at)
    index = np.frombuffer(source.read(32 * blocks), "<i8").reshape(-1, 4)
    source.seek(table_at)
    table = pa.ipc.open_stream(source.read(table_size)).read_all().combine_chunks()
    counts = table["n_tokens"].to_numpy()
    ends = np.cumsum(counts)
    rest, done, seen = np.zeros(0, np.uint64), 0, 0
    for at, n_words, n_escapes, _ in index.tolist():
        source.seek(at)
        raw = np.frombuffer(source.read(8 * (n_words + n_escapes)), "<u8")
        values = np.concatenate([rest, simple8b.decode(raw[:n_words], raw[n_words:])])
        whole = int(np.searchsorted(ends, seen + len(values), side="right"))
        if whole > done:
            cuts = ends[done:whole] - seen
            yield table["key"].slice(done, whole - done).combine_chunks(), np.split(values, cuts)[:-1]
            values, seen, done = values[cuts[-1] :], int(ends[whole - 1]), whole
        rest = values


def write_tokens(docs: DataFrame, path: str | None = None, end_id: int = END_ID, key: str = "doc_id",
                 text: str = "text", shards: int | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode every whole text and write shard files in ascending key order below
    ``spark.checkpoint.dir``; returns the manifest (shard, file, docs, tokens, bytes).

    Order: NULL keys first; rows of one key by the hash of their text, equal rows
    in any order, so that a key with very many rows may span shards. A NULL text is
    empty and has its end id only. An empty table gives an empty manifest."""
    path, spark = path or vocabulary_path(), docs.sparkSession
    folder = scratch_path(spark, "tokens")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = frequent_words(docs, path, text)

    def run(batches):
        task, writer, size = TaskContext.get(), None, 0
        shard = task.partitionId()
        for batch in small_batches(batches, text, keep="tokens"):
            if writer is None:
                where, name = _open(f"{folder}/shard-{shard:06d}-{task.taskAttemptId()}.s8b")
                where.create_dir(name.rpartition("/")[0], recursive=True)
                writer = ShardWriter(where.open_output_stream(name), block_ids)
            ids, n = encoder(path, words).column(batch.column(text), end_id)
            writer.add(batch.column(key), ids.astype(np.uint64), n)
        if writer:
            row = (shard, f"{folder}/{name.rpartition('/')[2]}", *writer.close())
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["shard", "file", "docs", "tokens", "bytes"])

    order = [F.col(key).asc_nulls_first(), F.col("text_hash"), F.col("row")]
    rows = docs.select(key, text).withColumns({"text_hash": F.xxhash64(text), "row": F.monotonically_increasing_id()})
    sorted_rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    written = sorted_rows.select(key, text).mapInArrow(run, "shard long, file string, docs long, tokens long, bytes long")
    return materialise(written, "token-manifest")


def read_tokens(manifest: DataFrame, key_type: str = "long", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Read the files of a manifest back: key, start (ids of all documents before),
    n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers) and, if wanted,
    the ids. The manifest has one row a file, so its prefix sum is small."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("shard", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    files = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [key, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                where, name = _open(row["file"])
                at = row["base"]
                with where.open_input_file(name) as source:
                    for keys, ids in read_shard(source):
                        n = np.array([len(x) for x in ids], np.int64)
                        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                        out = [keys, pa.array(at + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64())]
                        out += [pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))] * with_ids
                        yield pa.RecordBatch.from_arrays(out, names=names)
                        at += int(n.sum())

    schema = f"{key} {key_type}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return placed.repartition(files, "shard").mapInArrow(run, schema)
