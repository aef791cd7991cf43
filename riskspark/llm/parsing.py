"""Repeated byte strings across documents by prefix-free parsing.

A rolling hash runs over the bytes; a trigger is a gram whose hash is the least of the
``SPAN`` grams inside some string of ``WIDTH`` bytes, so each such string is dealt to
one trigger by its content alone, and the consecutive starts dealt to one trigger make
a phrase (the minimum instead of a residue, as residues leave strings without any
trigger). The parse is the sequence of phrases; phrases that are equal with all that
their strings reach make one entry of the dictionary, known by two 64-bit hashes.

Only the first place of an entry needs a closer look: all others repeat whole. Entries
that share a trigger may still share some strings. Their bytes are fetched, and two
orders are made: the dictionary's, of what stands before the trigger, backwards, and
the parse's, of what follows from the trigger on. Equal stretches of both, joined at
each distance to the trigger, are the runs of equal strings in the corpus order; the
first place of a run stays.

What crosses the network are entries (some twenty bytes for forty of text), packed by
ranges of the trigger's hash. A map task sends an entry once for each stretch of text
it reads, however often it stands there. A trigger with very many different
surroundings, found in a sample of fixed size, is split into its single strings, which
are dealt by their own hashes; so no range gathers an unbounded group. The sample only
steers the work, never the result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from riskspark.common import materialise
from riskspark.llm.columns import BLOCK_BYTES, U64, _buffers, _powers, _TABLE, mix, small_batches

WIDTH = 100
GRAM = 30
SPAN = WIDTH - GRAM + 1
#: Text that a task reads before it sends entries on.
STRETCH_BYTES = 16 << 20
RANGE_ROWS = 1 << 20
RANGE_SURROUNDINGS = 100_000
#: A trigger with more than this share of all entries is split; this many can exist at most.
HOT_KEYS, MOST_HOT_KEYS, HOT_SEEN = 10_000, 1_000_000, 40
_OTHER = np.random.default_rng(20240602).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_STRING = 255  # in place of a distance: the row is a single string, not a phrase


# ---------------------------------------------------------------- parse


def _least(x: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` values in a row."""
    out, w = x, 1
    while 2 * w <= span:
        out, w = np.minimum(out[:-w], out[w:]), 2 * w
    n = len(x) - span + 1
    return np.minimum(out[:n], out[span - w:span - w + n])


class Phrases:
    """Phrases of texts laid end to end. ``doc`` and ``lo``..``hi`` (first and last start)
    are places in these bytes, ``trigger`` too; ``h`` and ``c`` are the hashes of the
    trigger and of all bytes that the phrase's strings reach."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray):
        n = len(raw)
        count = np.maximum(np.diff(offs) - WIDTH + 1, 0)
        total = int(count.sum())
        if not total:
            self.doc = self.lo = self.hi = self.trigger = np.zeros(0, np.int64)
            self.h = self.c = np.zeros(0, U64)
            return
        with np.errstate(over="ignore"):
            power, self.inverse = _powers(n + 1), _powers(n + 1, True)
            self.sums = []
            for table in (_TABLE, _OTHER):
                s = np.zeros(n + 1, U64)
                np.cumsum(table[raw] * power[:-1], out=s[1:])
                self.sums.append(s)
            s = self.sums[0]
            grams = mix((s[GRAM:] - s[:-GRAM]) * self.inverse[:n - GRAM + 1])
            low = U64(0xFFFFFFFF)
            found = _least((grams & ~low) | np.arange(len(grams), dtype=U64), SPAN) & low  # ties to the first
            doc = np.repeat(np.arange(len(count)), count)
            start = np.repeat(offs[:-1] - (np.cumsum(count) - count), count) + np.arange(total)
            t = found[start].astype(np.int64)
            first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            last = np.append(first[1:], total) - 1
            self.doc, self.lo, self.hi, self.trigger = doc[first], start[first], start[last], t[first]
            self.h = grams[self.trigger]
            shape = ((self.trigger - self.lo) * 256 + self.hi - self.lo + 1).astype(U64)
            self.c = mix((self.sums[1][self.hi + WIDTH] - self.sums[1][self.lo]) * self.inverse[self.lo] ^ mix(shape))

    def strings(self, some: np.ndarray) -> tuple[np.ndarray, ...]:
        """(phrase, start, two hashes) of each string of some phrases."""
        n = self.hi[some] - self.lo[some] + 1
        of = np.repeat(some, n)
        at = np.repeat(self.lo[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        with np.errstate(over="ignore"):
            h, c = (mix((s[at + WIDTH] - s[at]) * self.inverse[at] + U64(17)) for s in self.sums)
        return of, at, h, c


def _slices(batches, key: str, text: str, piece_bytes: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, first byte of the piece in its text, bytes, offsets): small slices of a
    batch; a long text comes in pieces that overlap by all but one byte of a string, so
    every string is in one piece and memory doesn't follow the longest text."""
    for batch in small_batches(batches, text, piece_bytes):
        keys = batch.column(key).to_numpy()
        offs, raw = _buffers(batch.column(text))
        if batch.num_rows > 1 or len(raw) <= piece_bytes:
            yield keys, np.zeros(len(keys), np.int64), raw, offs
            continue
        for at in range(0, len(raw), piece_bytes):
            piece = raw[at:at + piece_bytes + WIDTH - 1]
            yield keys, np.array([at]), piece, np.array([0, len(piece)])


_COLUMNS = (("k", "<i8"), ("start", "<i8"), ("h", "<u8"), ("c", "<u8"), ("a", "u1"), ("b", "u1"))


def _joined(held: list[dict]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([x[c] for x in held]) if held else np.zeros(0, kind) for c, kind in _COLUMNS}


def _pack(rows: dict[str, np.ndarray], at: np.ndarray) -> bytes:
    steps = lambda x: np.diff(x, prepend=0)
    cells = [steps(rows[c][at]).astype(kind) if c in ("k", "start") else rows[c][at].astype(kind) for c, kind in _COLUMNS]
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(at), -1).T).tobytes() if c in ("k", "start") else x.tobytes() for x, (c, _) in zip(cells, _COLUMNS)]
    return zstandard.compress(b"".join(planes), 1)


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    data = np.frombuffer(zstandard.decompress(raw), np.uint8)
    n, out, at = len(data) // sum(np.dtype(kind).itemsize for _, kind in _COLUMNS), {}, 0
    for c, kind in _COLUMNS:
        size = np.dtype(kind).itemsize
        cell = data[at:at + n * size]
        at += n * size
        out[c] = np.cumsum(np.ascontiguousarray(cell.reshape(size, n).T).reshape(-1).view(kind)) if c in ("k", "start") else cell.view(kind)
    return out


def _classes(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first of each class in it, class of each place): rows by trigger, entry and place."""
    order = np.lexsort((rows["start"], rows["k"], rows["c"], rows["h"]))
    h, c = rows["h"][order], rows["c"][order]
    new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])) if len(order) else np.zeros(0, bool)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _later(rows: dict[str, np.ndarray], order: np.ndarray, first: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Rows whose entry has an earlier place. (Repeated rows share theirs.)"""
    lead = order[first][of]
    return order[(rows["k"][order] != rows["k"][lead]) | (rows["start"][order] != rows["start"][lead])]


def _spans(k: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts of a document, adjoining ones as one."""
    if not len(k):
        return k, lo, hi
    order = np.lexsort((lo, k))
    k, lo, hi = k[order], lo[order], hi[order]
    new = np.append(True, (k[1:] != k[:-1]) | (lo[1:] > hi[:-1] + 1))
    at = np.flatnonzero(new)
    return k[at], lo[at], np.maximum.reduceat(hi, at)


def _parse(docs: DataFrame, ranges: int, hot: np.ndarray, key: str, text: str, stretch: int, piece: int) -> DataFrame:
    """(p, kind, cells): entries of each stretch of text by ranges of the trigger's hash
    (kind 0), and runs of starts that repeat inside the stretch (kind 1)."""

    def flush(held: list[dict]) -> pa.RecordBatch:
        rows = _joined(held)
        with np.errstate(over="ignore"):
            both = rows["h"] ^ mix(rows["c"])
        by = np.argsort(both, kind="stable")
        same = both[by][1:] == both[by][:-1]
        double = by[np.append(same, False) | np.append(False, same)]
        some = {c: x[double] for c, x in rows.items()}
        order, first, of = _classes(some)
        later = _later(some, order, first, of)
        rest = np.ones(len(both), bool)
        rest[double] = False
        rest[double[order[first]]] = True  # an entry goes on once
        at = np.flatnonzero(rest)
        p = (mix(rows["h"][at]) % U64(ranges)).astype(np.int64)
        at, p = at[np.argsort(p, kind="stable")], np.sort(p, kind="stable")
        cuts = np.flatnonzero(np.append(True, p[1:] != p[:-1])) if len(p) else []
        out = [(int(p[a]), 0, _pack(rows, x)) for a, x in zip(cuts, np.split(at, cuts[1:]))] if len(p) else []
        if len(later):
            k, lo, hi = _spans(some["k"][later], some["start"][later], some["start"][later] + some["b"][later])
            out.append((int(k[0]) % ranges, 1, zstandard.compress(np.concatenate([k, lo, hi]).astype("<i8").tobytes(), 1)))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))], names=["p", "kind", "cells"])

    def run(batches):
        held, size = [], 0
        for keys, base, raw, offs in _slices(batches, key, text, piece):
            x = Phrases(raw, offs)
            if len(x.h):
                place = lambda doc, at: base[doc] + at - offs[doc]
                split = np.isin(x.h, hot)
                whole = np.flatnonzero(~split)
                doc = x.doc[whole]
                held.append({"k": keys[doc], "start": place(doc, x.lo[whole]), "h": x.h[whole], "c": x.c[whole],
                             "a": (x.trigger - x.lo)[whole].astype(np.uint8), "b": (x.hi - x.lo)[whole].astype(np.uint8)})
                if split.any():
                    of, at, h, c = x.strings(np.flatnonzero(split))
                    doc = x.doc[of]
                    held.append({"k": keys[doc], "start": place(doc, at), "h": h, "c": c,
                                 "a": np.full(len(of), _STRING, np.uint8), "b": np.zeros(len(of), np.uint8)})
            size += len(raw)
            if size >= stretch and held:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return docs.select(key, text).mapInArrow(run, "p int, kind int, cells binary")


def _hot(docs: DataFrame, total: int, keys: int, key: str, text: str) -> np.ndarray:
    """Triggers of very many surroundings in a hash sample of documents. The sample's size
    follows ``keys``, which also bounds the result."""
    share = min(1.0, keys * HOT_SEEN * (SPAN + 1) / 2 / max(total, 1))

    def run(batches):
        for _, _, raw, offs in _slices(batches, key, text):
            x = Phrases(raw, offs)
            yield pa.RecordBatch.from_arrays([pa.array(x.h.view(np.int64)), pa.array(x.c.view(np.int64))], names=["h", "c"])

    some = docs.where(F.pmod(F.xxhash64(key, F.lit(12)), F.lit(1 << 30)) < int(share * (1 << 30)))
    seen = some.select(key, text).mapInArrow(run, "h long, c long").distinct().groupBy("h").count()
    found = seen.where(F.col("count") > HOT_SEEN).orderBy(F.desc("count"), "h").limit(keys).collect()
    return np.sort(np.array([r["h"] for r in found], np.int64).view(U64))


# ---------------------------------------------------------------- dictionary and corpus order


_FOUND = "kind int, h long, k long, lo long, hi long, a int"


def _resolve(parsed: DataFrame) -> DataFrame:
    """Per range of triggers: entries' later places repeat whole (kind 1: k, lo..hi);
    the first places of entries that share their trigger with others go on (kind 0)."""

    def run(table: pa.Table) -> pa.Table:
        cells, kinds = table["cells"].to_pylist(), table["kind"].to_pylist()
        rows = _joined([_unpack(c) for c, kind in zip(cells, kinds) if kind == 0])
        spans = [np.frombuffer(zstandard.decompress(c), "<i8").reshape(3, -1) for c, kind in zip(cells, kinds) if kind == 1]
        by = np.argsort(rows["h"], kind="stable")
        same = rows["h"][by][1:] == rows["h"][by][:-1]
        shared = by[np.append(same, False) | np.append(False, same)] if len(by) else by
        rows = {c: x[shared] for c, x in rows.items()}
        order, first, of = _classes(rows)
        later = _later(rows, order, first, of)
        lead = order[first]
        h = rows["h"][lead]
        near = np.append(h[1:] == h[:-1], False) | np.append(False, h[1:] == h[:-1]) if len(h) else np.zeros(0, bool)
        lead = lead[near & (rows["a"][lead] != _STRING)]
        spans.append(np.stack(_spans(rows["k"][later], rows["start"][later], rows["start"][later] + rows["b"][later])).reshape(3, -1))
        k, lo, hi = np.concatenate(spans, 1)
        start = rows["start"][lead]
        n = len(lead)
        return pa.Table.from_arrays(
            [pa.array(np.append(np.zeros(n, np.int32), np.ones(len(k), np.int32))), pa.array(np.append(rows["h"][lead].view(np.int64), np.zeros(len(k), np.int64))),
             pa.array(np.append(rows["k"][lead], k)), pa.array(np.append(start, lo)), pa.array(np.append(start + rows["b"][lead], hi)),
             pa.array(np.append(rows["a"][lead].astype(np.int32), np.zeros(len(k), np.int32)))],
            names=["kind", "h", "k", "lo", "hi", "a"])

    return parsed.groupBy("p").applyInArrow(run, _FOUND)


def _surroundings(docs: DataFrame, shared: DataFrame, ranges: int, key: str, text: str) -> DataFrame:
    """(p, h, k, t, a, b, bytes): the bytes that a phrase's strings reach. The list of a
    document's phrases is bounded by its text."""

    def run(batches):
        for batch in small_batches(batches, text):
            offs, raw = _buffers(batch.column(text))
            lists = batch.column("phrases")
            n = np.diff(np.asarray(lists.offsets))
            doc = np.repeat(np.arange(batch.num_rows), n)
            cell = {f: np.asarray(lists.flatten().field(f)) for f in ("h", "lo", "hi", "a")}
            size = cell["hi"] - cell["lo"] + WIDTH
            ends = np.cumsum(size)
            bytes_ = raw[np.repeat(offs[doc] + cell["lo"] - (ends - size), size) + np.arange(size.sum())]
            held = pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(bytes_.tobytes())])
            p = (mix(cell["h"].view(U64) ^ U64(5)) % U64(ranges)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array(cell["h"]), batch.column(key).take(pa.array(doc)), pa.array(cell["lo"] + cell["a"]),
                 pa.array(cell["a"].astype(np.int32)), pa.array((cell["hi"] - cell["lo"]).astype(np.int32)), held],
                names=["p", "h", "k", "t", "a", "b", "bytes"])

    lists = shared.groupBy("k").agg(F.collect_list(F.struct("h", "lo", "hi", "a")).alias("phrases")).withColumnRenamed("k", "_k")
    wanted = docs.join(lists, docs[key] == lists["_k"]).select(key, text, "phrases")
    return wanted.mapInArrow(run, "p int, h long, k long, t long, a int, b int, bytes binary")


def _sides(flat: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For triggers at ``at``: the bytes before, backwards, and those from there on, as rows
    of fixed width, zeros where there are no more."""
    i, j = np.arange(SPAN - 1), np.arange(WIDTH)
    flat = np.append(flat, 0).astype(np.uint8)
    cut = lambda place, inside: np.where(inside, flat[np.where(inside, place, 0)], 0).astype(np.uint8)
    return cut(at[:, None] - 1 - i, i[None] < before[:, None]), cut(at[:, None] + j, j[None] < after[:, None])


def _ordered(bucket: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, how many bytes each row has in common with the one before): by bucket, then bytes."""
    head = bucket.astype(">u8").view(np.uint8).reshape(len(bucket), 8)
    keys = np.ascontiguousarray(np.concatenate([head, side], 1))
    order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    common = np.where(same.all(1), keys.shape[1], (~same).argmax(1)) - 8
    return order, np.append(-1, common)


def repeats(bucket: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Row x start: which strings of phrases have an equal one at a smaller place.

    ``bucket`` names the trigger, ``place`` orders the rows (of all rows with one trigger
    distance), ``a`` is the trigger's distance from the first start and ``b`` the last
    start. Strings at one distance d from the trigger are equal if both the d bytes before
    it and the WIDTH - d bytes from it on are: two stretches of the sorted sides."""
    n = len(bucket)
    begin = ends - (b + WIDTH)
    left, right = _sides(flat, begin + a, a, b - a + WIDTH)
    orders = [_ordered(bucket, side) for side in (left, right)]
    out = np.zeros((n, SPAN), bool)
    for d in range(SPAN):
        row = np.flatnonzero((a >= d) & (a - d <= b))
        if len(row) < 2:
            continue
        group = np.zeros(n, np.int64)
        for (order, common), depth in zip(orders, (d, WIDTH - d)):
            stretch = np.empty(n, np.int64)
            stretch[order] = np.cumsum(common < depth)
            group = group * (n + 1) + stretch
        g = group[row]
        by = np.lexsort((place[row], g))
        g, at = g[by], place[row][by]
        new = np.append(True, g[1:] != g[:-1])
        least = at[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = row[by[at > least]]
        out[later, a[later] - d] = True
    return out


def _compare(surroundings: DataFrame) -> DataFrame:
    """(k, lo, hi): starts, among the entries of shared triggers, that repeat earlier ones."""

    def run(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        col = lambda c: t[c].to_numpy()
        held = t["bytes"].combine_chunks()
        offs, flat = _buffers_of(held)
        k, at, a, b = col("k"), col("t"), col("a").astype(np.int64), col("b").astype(np.int64)
        order = np.lexsort((at, k))
        new = np.append(True, (k[order][1:] != k[order][:-1]) | (at[order][1:] != at[order][:-1]))
        place = np.empty(len(k), np.int64)
        place[order] = np.cumsum(new)
        found = repeats(np.ascontiguousarray(col("h")).view(U64), place, a, b, flat, offs[1:])
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, lo = np.nonzero(edge == 1)
        _, hi = np.nonzero(edge == -1)
        start = (at - a)[row]
        return pa.Table.from_arrays([pa.array(k[row]), pa.array(start + lo), pa.array(start + hi - 1)], names=["k", "lo", "hi"])

    return surroundings.groupBy("p").applyInArrow(run, "k long, lo long, hi long")


def _buffers_of(col: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a binary column without NULLs."""
    wide = col.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    offs = np.frombuffer(offsets, np.int64)[wide.offset:wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return offs - offs[0], raw


# ---------------------------------------------------------------- documents


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents (id, text, k) with a long k that orders them. Integer ids that are unique
    and not NULL order themselves; otherwise k is the place of (id, hash of the text) in
    their order, so rows alike in both are one document."""
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    if isinstance(docs.schema["id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        odd = docs.groupBy("id").count().where(F.col("id").isNull() | (F.col("count") > 1)).limit(1).count()
        if not odd:
            return docs.withColumn("k", F.col("id").cast("long"))
    hashed = docs.withColumn("hash", F.xxhash64("text", F.lit(11)))
    places = materialise(hashed.select("id", "hash").distinct().orderBy("id", "hash").withColumn("k", F.monotonically_increasing_id()), "parsing-keys")
    same = hashed["id"].eqNullSafe(places["id"]) & (hashed["hash"] == places["hash"])
    return materialise(hashed.join(places, same).select(hashed["id"], hashed["text"], "k"), "parsing-documents")


def repeated_starts(docs: DataFrame, key: str = "k", text: str = "text", stretch: int = STRETCH_BYTES, piece: int = BLOCK_BYTES) -> DataFrame:
    """(k, lo, hi): runs of starts of strings of ``WIDTH`` bytes that also start earlier, in
    a document of smaller k or further left. k must be a long that names one text."""
    spark = docs.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).collect()[0]["n"] or 0
    ranges = max(shuffled, math.ceil(2 * total / (SPAN + 1) / RANGE_ROWS))
    hot = _hot(docs, total, min(MOST_HOT_KEYS, max(HOT_KEYS, 4 * ranges)), key, text)
    found = materialise(_resolve(_parse(docs, ranges, hot, key, text, stretch, piece)), "parsing-found")
    shared = found.where("kind = 0")
    ranges = max(shuffled, math.ceil(shared.count() / RANGE_SURROUNDINGS))
    more = _compare(_surroundings(docs, shared, ranges, key, text))
    return found.where("kind = 1").select("k", "lo", "hi").union(more)


def _cover(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte ranges [from, to) covered by strings that start in the runs."""
    order = np.argsort(lo, kind="stable")
    lo, to = lo[order], np.maximum.accumulate(hi[order] + WIDTH)
    new = np.append(True, lo[1:] > to[:-1])
    at = np.flatnonzero(new)
    return lo[at], to[np.append(at[1:], len(lo)) - 1]


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False, stretch: int = STRETCH_BYTES,
            piece: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row, and the bytes that
    stay if ``with_text``.

    Removed is each byte covered by a string of ``WIDTH`` bytes that also starts earlier:
    in a smaller doc_id (NULL is the smallest) or further left in the same document. Rows
    that are alike in id and text are one document and have equal results; rows of one id
    with other texts come in the order of the texts' hashes. A NULL or empty text, or one
    shorter than a string, loses nothing; an empty table gives no rows. Texts are UTF-8
    bytes, cut without regard to characters. Other columns are ignored."""
    keyed = _keyed(docs, key, text)
    runs = repeated_starts(keyed, stretch=stretch, piece=piece).groupBy("k").agg(F.collect_list(F.struct("lo", "hi")).alias("runs")).withColumnRenamed("k", "_k")

    def run(batches):
        for batch in small_batches(batches, "text"):
            offs, raw = _buffers(batch.column("text"))
            lists = batch.column("runs")
            n = np.diff(np.asarray(lists.offsets)) if len(lists) else []
            ends = np.cumsum(np.where(np.asarray(lists.is_valid()), n, 0)) if len(lists) else []
            lo, hi = (np.asarray(lists.flatten().field(f)) for f in ("lo", "hi"))
            gone, spans, digest, kept = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), [], []
            for i in range(batch.num_rows):
                own = raw[offs[i]:offs[i + 1]]
                a, b = (ends[i - 1] if i else 0), ends[i]
                if b > a:
                    start, to = _cover(lo[a:b], hi[a:b])
                    gone[i], spans[i] = (to - start).sum(), len(start)
                    own = b"".join(own[x:y].tobytes() for x, y in zip(np.append(0, to), np.append(start, len(own))))
                else:
                    own = own.tobytes()
                digest.append(hashlib.sha256(own).hexdigest())
                if with_text:
                    kept.append(own)
            cells = [batch.column("id"), pa.array(np.diff(offs)), pa.array(gone), pa.array(spans), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(cells + [pa.array(kept, pa.binary())] * with_text, names=names)

    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    whole = keyed.join(runs, keyed["k"] == runs["_k"], "left").select("id", "text", "runs")
    return whole.mapInArrow(run, schema)
