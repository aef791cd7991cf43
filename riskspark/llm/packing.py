"""Packing of documents into fixed windows of token ids by concatenate and cut.

Pass one encodes every document once and stores its ids with the position inside
its partition; pass two adds the prefix sum over the partitions' token totals, so
every id has a global offset, and cuts at the multiples of the window. No rows are
sorted or shuffled: the order is that of the stored partitions.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.common import materialise
from riskspark.llm.columns import WORD_BLOCK, small_batches
from riskspark.llm.tokens import encoder, frequent_words, id_type, vocabulary_path

WINDOW = 1024
END_ID = 0


def encode_documents(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, part, row, local_start, n_tokens, ids): the end id is appended to each text."""
    words = frequent_words(docs, path, text)

    def run(batches):
        part, row, at = TaskContext.get().partitionId(), 0, 0
        for batch in small_batches(batches, text, WORD_BLOCK, keep="tokens"):
            ids, n = encoder(path, words).column(batch.column(text), end_id)
            start, ends = at + np.cumsum(n) - n, np.append(0, np.cumsum(n) * ids.itemsize)
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(np.full(len(n), part, np.int32)), pa.array(row + np.arange(len(n))),
                 pa.array(start), pa.array(n), coded.cast(pa.binary())],
                names=[key, "part", "row", "local_start", "n_tokens", "ids"])
            row, at = row + len(n), at + int(n.sum())

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"{key} {kind}, part int, row long, local_start long, n_tokens long, ids binary")


def with_global_start(stored: DataFrame) -> DataFrame:
    """Add global_start. There is one total for each partition of the stored table
    (some bytes a task), so the totals' prefix sum and its broadcast stay small."""
    totals = stored.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return stored.join(F.broadcast(base), "part").withColumn("global_start", F.col("base") + F.col("local_start"))


def cut(placed: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Boundary records: one row for each piece of a document inside one window."""
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kind = id_type(placed.sparkSession, path)  # known here, so that these tasks need no vocabulary
    width = kind.itemsize

    def run(batches):
        for batch in batches:
            first, n = (np.asarray(batch.column(c)) for c in ("global_start", "n_tokens"))
            pieces = (first + n - 1) // window - first // window + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            turn = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[doc] // window + turn
            begin = np.maximum(sequence * window, first[doc])
            length = np.minimum((sequence + 1) * window, first[doc] + n[doc]) - begin
            start = begin - first[doc]
            ids = batch.column("ids")
            crc, held = np.zeros(len(doc), np.int64), []
            raw, now = b"", -1
            for i, (d, a, k) in enumerate(zip(doc.tolist(), (start * width).tolist(), (length * width).tolist())):
                if d != now:
                    raw, now = ids[d].as_py(), d
                values = np.frombuffer(raw, kind, k // width, a).astype("<u4").tobytes()
                crc[i] = zlib.crc32(values)
                if with_ids:
                    held.append(np.frombuffer(values, "<u4").astype(np.int32))
            out = [batch.column(key).take(pa.array(doc)), *map(pa.array, (start, length, crc, n[doc], sequence, begin % window))]
            yield pa.RecordBatch.from_arrays(out + [pa.array(held, pa.list_(pa.int32()))] * with_ids, names=names)

    key_kind = placed.schema[key].dataType.simpleString()
    schema = f"{key} {key_kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.select(key, "global_start", "n_tokens", "ids").mapInArrow(run, schema + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, key: str = "doc_id",
         text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pack every document into windows of ``window`` ids.

    Only the last window is not full. A NULL text counts as empty and still has its
    end id; a repeated row is packed once for each row; a NULL key is kept; an empty
    table gives no rows. Other columns of ``docs`` are ignored."""
    path = path or vocabulary_path()
    stored = materialise(encode_documents(docs, path, end_id, key, text), "packing-ids")
    return cut(with_global_start(stored), path, window, key, with_ids)


def sequences(pieces: DataFrame, window: int = WINDOW, padding_id: int = END_ID) -> DataFrame:
    """The padded id windows of ``pack(..., with_ids=True)``: sequence_id, length, ids.
    A window is gathered from at most ``window`` pieces. The last one is padded with
    ``padding_id`` unless its length is a power of two."""
    together: Column = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(together.alias("parts"), F.sum("length").alias("length"))
    ids = F.flatten("parts.ids")
    n = F.col("length")
    padded = F.when(n.bitwiseAND(n - 1) == 0, ids).otherwise(
        F.concat(ids, F.array_repeat(F.lit(padding_id), (F.lit(window) - n).cast("int"))))
    return whole.select("sequence_id", "length", padded.alias("ids"))
