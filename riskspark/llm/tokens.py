"""Token ids of whole texts from a public vocabulary file, by the tokenizers library.

A byte-level pre-tokenizer never joins what stands on both sides of a single space or
line break between two visible characters, nor a letter and a mark other than an
apostrophe. Texts are therefore cut there into units (a word with the space or break
before it, a run of marks), whose ids in a row are the ids of the whole text. Units are found and hashed on a column's bytes, and the ids of frequent
ones are looked up in a sorted table; only the others go to the library, each once a
block. Texts with two white spaces in a row, with rare white space or with a special
token are encoded whole.

The table is made in Spark from a sample of documents, with a fixed number of words,
and reaches each worker once. It saves time and decides no result: ids of every block
are turned back into bytes and compared with the text.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm.columns import U64, _buffers, _powers, _TABLE, give_back, mix, small_batches, worker_kept, WORD_BLOCK

VOCABULARY = "byte_bpe_50k.json"
#: Units of the table, the text they are counted in, and their longest.
TABLE_WORDS, SAMPLE_BYTES, LONGEST = 400_000, 48 << 20, 64
#: Bits of the table that leads to a unit's place.
SLOT_BITS = 20
_SPACES = np.isin(np.arange(256), [*range(0x09, 0x0E), *range(0x1C, 0x21)])
#: Letters and marks whose classes every Unicode version agrees on.
_PLAIN = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ɏ]+|[!-&(-/:-@\\[-`{-~]+")
_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_MARK = np.array([33 <= b < 127 and not chr(b).isalnum() and b != 0x27 for b in range(256)])


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _narrow(top: int) -> np.dtype:
    """Two bytes an id if the vocabulary allows, four otherwise."""
    return np.dtype("<u2" if top < 1 << 16 else "<u4")


def id_type(spark: SparkSession, path: str) -> np.dtype:
    """Asked of a task, so that the driver holds no vocabulary."""
    def run(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([encoder(path).dtype.str])], names=["kind"])

    return np.dtype(spark.range(1, numPartitions=1).mapInArrow(run, "kind string").collect()[0]["kind"])


@dataclass
class Words:
    """Ids of units by the units' hashes, which ascend. ``slots`` leads from a hash's upper
    bits to one unit; where several share them, the others are searched for."""

    keys: np.ndarray
    starts: np.ndarray
    ids: np.ndarray

    def __getstate__(self):
        return {"keys": self.keys, "starts": self.starts, "ids": self.ids}  # slots are made where they are used

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def __post_init__(self):
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)
        self.slots[(self.keys >> U64(64 - SLOT_BITS)).astype(np.int64)] = np.arange(len(self.keys))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, place) of hashes."""
        if not len(self.keys):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = self.slots[(h >> U64(64 - SLOT_BITS)).astype(np.int64)].astype(np.int64)
        known = self.keys[at] == h
        rest = np.flatnonzero(~known)
        at[rest] = np.minimum(np.searchsorted(self.keys, h[rest]), len(self.keys) - 1)
        known[rest] = self.keys[at[rest]] == h[rest]
        return known, at

    @classmethod
    def of(cls, keys: np.ndarray, n: np.ndarray, ids: np.ndarray) -> Words:
        """From units in any order: hashes, numbers of ids, and the ids in a row."""
        order = np.argsort(keys)
        begin, n = (np.cumsum(n) - n)[order], n[order]
        ends = np.cumsum(n)
        at = np.repeat(begin - (ends - n), n) + np.arange(n.sum())
        return cls(keys[order], np.append(0, ends).astype(np.int32), ids[at])


def units(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the units of texts laid end to end."""
    begins = (raw == 0x20) | (raw == 0x0A)
    begins[offs[:-1][np.diff(offs) > 0]] = True
    letter = _LETTER[raw]
    two = (raw[:-1] >= 0xC3) & (raw[:-1] <= 0xC8) & ~((raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7)))
    letter[1:] |= two  # the second byte of U+00C0 to U+023F, but for the signs of times and division
    begins[1:] |= letter[:-1] & _MARK[raw[1:]]
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(raw))[: len(start)]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, U64)
        np.cumsum(_TABLE[raw] * _powers(len(raw) + 1)[:-1], out=sums[1:])
        h = (sums[end] - sums[start]) * _powers(len(raw) + 1, True)[start]
        return start, end, mix(h + U64(0x632BE59BD9B4E019) * (end - start).astype(U64))


def _odd(raw: np.ndarray, offs: np.ndarray, special: list[bytes]) -> np.ndarray:
    """Texts that are not cut into units."""
    at = []
    space = _SPACES[raw]
    at.append(np.flatnonzero(space[1:] & space[:-1]))
    wide = np.flatnonzero((raw == 0xC2) | (raw == 0xE1) | (raw == 0xE2) | (raw == 0xE3))
    if len(wide):
        far = np.append(raw, [0, 0])
        a, b, c = far[wide], far[wide + 1], far[wide + 2]
        at.append(wide[((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
                       | ((a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))))])
    whole = raw.tobytes() if special else b""
    for mark in special:
        i = whole.find(mark)
        while i >= 0:
            at.append(np.array([i]))
            i = whole.find(mark, i + 1)
    out = np.zeros(len(offs) - 1, bool)
    found = np.concatenate(at)
    # White space on both sides of a text's end is none in a row; such texts are taken whole all the same.
    out[np.searchsorted(offs, found, side="right") - 1] = True
    return out


def _spelled() -> list[str]:
    """The character by which byte-level vocabularies spell each byte: itself if it is
    visible in Latin-1, the next one from U+0100 on otherwise."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + rest.index(b)) for b in range(256)]


class Encoder:
    """Encodes texts to ids: ``dtype`` is two bytes wide if the vocabulary allows, four otherwise."""

    def __init__(self, path: str, words: Words | None = None):
        self.tokenizer = _tokenizer(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = _narrow(max(vocab.values()))
        self.words = words or Words(np.zeros(0, U64), np.zeros(1, np.int32), np.zeros(0, self.dtype))
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [t.encode() for t in added]
        level, model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        level = json.loads(level.__getstate__()) if level else {}
        #: Whether texts may be cut, and pieces given to the model itself.
        self.byte_level = (level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and level.get("use_regex")
                           and not self.tokenizer.normalizer and type(model).__name__ == "BPE" and not model.dropout)
        self.spelled = dict(enumerate(_spelled()))
        if self.byte_level:
            back = {ord(c): b for b, c in self.spelled.items()}
            spelt: list[bytes] = [b""] * (max(vocab.values()) + 1)
            for token, i in vocab.items():
                if token not in added:
                    spelt[i] = bytes(back[ord(c)] for c in token)
            self.token_starts = np.cumsum([0, *map(len, spelt)])
            self.token_bytes = np.frombuffer(b"".join(spelt), np.uint8)
        del vocab
        give_back()

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), 1_000):
            coded = self.tokenizer.encode_batch_fast(texts[i : i + 1_000], add_special_tokens=False)
            out += [np.array(x.ids, self.dtype) for x in coded]
        return out

    def encode_units(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids) of units. Letters alone and marks alone are one
        piece, which the model takes without the library's own cutting."""
        texts = [u.decode() for u in found]
        rest = [i for i, u in enumerate(texts) if not _PLAIN.fullmatch(u)]
        others = dict(zip(rest, self.whole([texts[i] for i in rest])))
        ids, n = [], []
        tokenize, spelled = self.tokenizer.model.tokenize, self.spelled
        for i, (unit, text) in enumerate(zip(found, texts)):
            own = others.get(i)
            if own is not None:
                own = own.tolist()
            elif text.isascii():
                own = [t.id for t in tokenize(text.replace(" ", spelled[32]))]
            else:
                own = [t.id for t in tokenize(unit.decode("latin-1").translate(spelled))]
            ids += own
            n.append(len(own))
        return np.array(ids, self.dtype), np.array(n, np.int64)

    def column(self, col: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n): the ids of all texts of a column in a row, each text followed by
        ``end_id``, and the number of each text's ids. NULL counts as empty."""
        offs, raw = _buffers(col)
        odd = _odd(raw, offs, self.special) if self.byte_level else np.diff(offs) > 0
        text = lambda i: raw[offs[i]:offs[i + 1]].tobytes().decode()
        apart = np.flatnonzero(odd)
        start, end, h = units(raw, offs)
        of = np.searchsorted(offs, start, side="right") - 1
        keep = ~odd[of]
        start, end, h, of = start[keep], end[keep], h[keep], of[keep]
        known, at = self.words.find(h)
        new, first, which = np.unique(h[~known], return_index=True, return_inverse=True)
        first = np.flatnonzero(~known)[first]
        data = raw.tobytes()
        own, sizes = self.encode_units([data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())])
        others = self.whole([text(i) for i in apart])
        if end_id is not None:
            others.append(np.array([end_id], self.dtype))
        pool = np.concatenate([self.words.ids, own, *others])
        sizes = np.append(sizes, [len(x) for x in others]).astype(np.int64)
        begins = len(self.words.ids) + np.cumsum(sizes) - sizes
        src, n = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        src[known], n[known] = self.words.starts[at[known]], np.diff(self.words.starts)[at[known]]
        src[~known], n[~known] = begins[which], sizes[which]
        more = [(apart, begins[len(new):len(new) + len(apart)], sizes[len(new):len(new) + len(apart)])]
        if end_id is not None:
            every = np.arange(len(col))
            more.append((every, np.full(len(col), begins[-1]), np.ones(len(col), np.int64)))
        of, src, n = (np.concatenate(x) for x in zip((of, src, n), *more))
        by = np.argsort(of, kind="stable")
        of, src, n = of[by], src[by], n[by]
        ids = pool[np.repeat(src - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        per = np.bincount(of, n, len(col)).astype(np.int64) if len(of) else np.zeros(len(col), np.int64)
        if self.byte_level:
            self._proved(ids, per, odd, raw, offs, end_id)
        return ids, per

    def _proved(self, ids, per, odd, raw, offs, end_id) -> None:
        """Raise if the ids of cut texts don't spell them (two units of one 64-bit hash)."""
        ends = np.cumsum(per)
        inside = np.repeat(~odd, per)
        if end_id is not None:
            inside[ends - 1] = False
        some = ids[inside].astype(np.int64)
        n = np.diff(self.token_starts)[some]
        back = self.token_bytes[np.repeat(self.token_starts[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        if not np.array_equal(back, raw[np.repeat(~odd, np.diff(offs))]):
            raise ValueError("two different words have one hash")

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        ids, n = self.column(pa.array(texts, pa.large_string()))
        return np.split(ids, np.cumsum(n)[:-1]) if len(n) else []


def frequent_words(docs: DataFrame, path: str, text: str = "text", words: int = TABLE_WORDS, sample_bytes: int = SAMPLE_BYTES):
    """A broadcast table of the most frequent units in a hash sample of texts: at most
    ``words`` units of at most ``LONGEST`` bytes, whatever the size of ``docs``."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).collect()[0]["n"] or 0
    share = int(min(1.0, sample_bytes / max(total, 1)) * (1 << 30))
    some = docs.select(text).where(F.pmod(F.xxhash64(F.col(text), F.lit(13)), F.lit(1 << 30)) < share)

    def count(batches):
        for batch in small_batches(batches, text, WORD_BLOCK):
            offs, raw = _buffers(batch.column(text))
            if not len(raw):
                continue
            start, end, h = units(raw, offs)
            fit = end - start <= LONGEST
            start, end, h = start[fit], end[fit], h[fit]
            h, first, n = np.unique(h, return_index=True, return_counts=True)
            held = [raw[a:b].tobytes() for a, b in zip(start[first].tolist(), end[first].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(held, pa.binary()), pa.array(n)], names=["hash", "unit", "n"])

    def encode(batches):
        enc = encoder(path)
        for batch in batches:
            ids, n = enc.encode_units(batch.column("unit").to_pylist() if enc.byte_level else [])
            cells = [x.tobytes() for x in np.split(ids, np.cumsum(n)[:-1])] if len(n) else []
            yield pa.RecordBatch.from_arrays([batch.column("hash").slice(0, len(n)), pa.array(cells, pa.binary())], names=["hash", "ids"])

    counted = some.mapInArrow(count, "hash long, unit binary, n long").groupBy("hash").agg(F.min("unit").alias("unit"), F.sum("n").alias("n"))
    best = counted.where("n > 1").orderBy(F.desc("n"), "hash").limit(words)
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The collected table has ``words`` rows at most, and stays in Arrow's form.
    table = best.repartition(shuffled, "hash").mapInArrow(encode, "hash long, ids binary").toArrow().combine_chunks()
    kind = id_type(spark, path)
    ids = table["ids"].cast(pa.large_binary()).combine_chunks()
    n = np.asarray(pa.compute.binary_length(ids)) // kind.itemsize
    flat = np.frombuffer(b"".join(ids.to_pylist()), kind)
    found = Words.of(np.ascontiguousarray(table["hash"].to_numpy()).view(U64), n.astype(np.int64), flat)
    return spark.sparkContext.broadcast(found)


def encoder(path: str, words=None) -> Encoder:
    """One encoder a worker process, kept between tasks that encode; ``words`` is a
    broadcast table."""
    return worker_kept(f"tokens:{path}:{words.value.keys[:64].tobytes() if words else ''}", lambda: Encoder(path, words.value if words else None))
