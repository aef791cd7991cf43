"""Text quality: random-indexing word vectors, pooled over a document, into a network
of two layers whose probabilities are calibrated by a temperature.

Each word bucket has a sparse index vector drawn from its hash; a bucket's context
vector is the sum of the index vectors of its neighbours over all documents. A
document's features are means, deviations and neighbour products of its words'
vectors. The network is fitted on about ``SAMPLE`` labelled rows a class, a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.common import materialise
from riskspark.llm import columns, tables
from riskspark.llm.language import temperature

BUCKETS = 1 << 14
DIM = 32
NONZERO = 2
REACH = 2
SAMPLE = 4_000
FEATURES = 3 * DIM + 1


def _index() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the nonzero components of each bucket's index vector."""
    rng = np.random.default_rng(97)
    return rng.integers(0, DIM, (BUCKETS, NONZERO)), rng.choice(np.array([-1.0, 1.0]), (BUCKETS, NONZERO))


def _buckets(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    h, at = columns.words(batch.column(text), lower=False, split_marks=True)
    return (h >> np.uint64(40)).astype(np.int64) % BUCKETS, at


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit context vectors of all buckets, the mean direction taken out."""

    def run(batches):
        place, sign = _index()
        table, salt = np.zeros(BUCKETS * DIM), 0
        for batch in columns.small_batches(batches, text):
            word, at = _buckets(batch, text)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
            for gap in range(1, REACH + 1):
                same = doc[gap:] == doc[:-gap]
                left, right = word[:-gap][same], word[gap:][same]
                for a, b in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        table += np.bincount(a * DIM + place[b, k], sign[b, k], BUCKETS * DIM)
            salt += len(word)
        yield from tables.emit(table.reshape(BUCKETS, DIM), salt)

    table = tables.total(docs.select(text).mapInArrow(run, tables.SCHEMA), (BUCKETS, DIM), np.float64)
    size = np.linalg.norm(table, axis=1, keepdims=True)
    unit = table / np.maximum(size, 1e-12)
    used = size[:, 0] > 0
    if used.any():
        unit[used] -= unit[used].mean(0)
        unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    return unit.astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, features): means, deviations and products of neighbours, log length."""

    def run(batches):
        for batch in columns.small_batches(batches, text):
            word, at = _buckets(batch, text)
            out = np.zeros((batch.num_rows, FEATURES), np.float32)
            for i in range(batch.num_rows):
                v = vectors[word[at[i] : at[i + 1]]]
                if len(v):
                    out[i, :DIM], out[i, DIM : 2 * DIM] = v.mean(0), v.std(0)
                    if len(v) > 1:
                        out[i, 2 * DIM : 3 * DIM] = np.einsum("ij,ij->j", v[1:], v[:-1]) / (len(v) - 1)
                    out[i, -1] = np.log1p(len(v)) / 10
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([x.tobytes() for x in out], pa.binary())], names=[key, "features"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, features binary")


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, seed: int = 5) -> Network:
    """Adam on the log loss of shuffled batches; each fifth row calibrates. Both classes
    weigh by their rows. One class only: a constant just short of certainty."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    net = Network(mean, scale, layers)
    held = np.arange(len(y)) % 5 == 4
    xt, yt = (x[~held] - mean) / scale, y[~held]
    m, v, t = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(yt))
        for i in range(0, len(order), 128):
            own = order[i : i + 128]
            w1, b1, w2, b2 = layers
            h = np.maximum(xt[own] @ w1 + b1, 0)
            g = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -40, 40))) - yt[own]) / len(own)
            gh = np.outer(g, w2) * (h > 0)
            t += 1
            for p, d, a, b in zip(layers, (xt[own].T @ gh + 1e-4 * w1, gh.sum(0), h.T @ g + 1e-4 * w2, g.sum(keepdims=True)), m, v):
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= 0.003 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    if held.any():
        logit = net.logit(x[held])
        net.temperature = temperature(np.stack([np.zeros_like(logit), logit], 1), y[held].astype(int))
    return net


def held_out(key: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row; the score is the probability of
    quality 1. Learns from rows that are not held out. A NULL text counts as empty and
    has the score of a text without words; without usable labels every score is 0.5.
    Labels repeated for a key count by their largest value; keys may be NULL or repeat."""
    stored = materialise(pooled(docs, word_vectors(docs, text), key, text), "quality-features")
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("quality"))
    some = tables.share(one.where(~held_out()), "quality", sample).withColumnRenamed("doc_id", key)
    rows = stored.join(F.broadcast(some), key).groupBy(key).agg(F.first("features").alias("features"), F.max("quality").alias("quality")).collect()
    rows.sort(key=lambda r: (hash(r[key]) * 2654435761 % (1 << 32), r[key]))
    net = fit(np.array([np.frombuffer(r["features"], np.float32) for r in rows], float), np.array([r["quality"] for r in rows], float)) if rows else None

    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("features").to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)
            p = net.probability(x) if net else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(p), pa.array((p >= 0.7).astype(np.int32))], names=[key, "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    scored = stored.mapInArrow(run, f"{key} {kind}, score double, predicted int")
    return scored.select(key, held_out(key).alias("held_out"), "score", "predicted")
