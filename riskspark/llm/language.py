"""Language identification: multinomial logistic regression on TF-IDF character
n-grams, trained with follow-the-regularised-leader (proximal, elastic net) and
calibrated by a temperature.

The document frequencies come from all training rows; the weights are fitted on a
sample of at most about ``SAMPLE`` rows a language, a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm import tables
from riskspark.llm.columns import small_batches

#: Fixed by the 16 bits that ``grams`` keeps of a hash.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE = 800
UNKNOWN = "und"
#: A language is known when its calibrated score is past an even guess by this share of
#: what an even guess leaves: 0.2875 of four languages, 0.525 of two. Short clean texts
#: score from 0.3 on, so only texts in which no language shows are turned down.
MARGIN = 0.05


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def clean(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, a space before and after each run of
    them; empty without a letter."""
    code = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[code]
    if not letter.any():
        return code[:0]
    kept = letter.copy()
    kept[:-1] |= letter[1:]
    kept[1:] |= letter[:-1]
    kept = np.where(letter, code, np.uint32(32))[kept]
    space = kept == 32
    return kept[~(space & np.concatenate([[False], space[:-1]]))]


def grams(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the character n-grams of a cleaned text."""
    held, h = [], np.zeros(len(code), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        h = (h[: len(code) - n + 1] + code[n - 1 :] + np.uint32(n)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n in ORDERS:
            held.append(h)
    at = (np.concatenate(held) * np.uint32(0x85EBCA77)) >> np.uint32(16)
    if len(at) > 1_000:
        counts = np.bincount(at, minlength=BUCKETS)
        found = np.flatnonzero(counts)
        return found, counts[found]
    return np.unique(at.astype(np.int64), return_counts=True)


def tfidf(code: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, counts = grams(code)
    value = (1 + np.log(counts)) * idf[at]
    return at, value / max(float(np.sqrt(value @ value)), 1e-12)


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each bucket, and documents, over all rows."""

    def run(batches):
        seen, salt = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in small_batches(batches, "text"):
            for text in batch.column("text").to_pylist():
                code = clean(text)
                if len(code):
                    seen[grams(code)[0]] += 1
                    seen[BUCKETS] += 1
                    salt += len(code)
        yield from tables.emit(seen, salt)

    all_ = tables.total(rows.select("text").mapInArrow(run, tables.SCHEMA), (BUCKETS + 1,), np.int64)
    return all_[:BUCKETS], int(all_[BUCKETS])


@dataclass
class Ftrl:
    """Per-coordinate follow-the-regularised-leader for a softmax of sparse rows."""

    classes: int
    features: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self):
        self.z, self.n = np.zeros((self.features, self.classes)), np.zeros((self.features, self.classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, value: np.ndarray, target: int) -> None:
        w = self.weights(at)
        p = softmax(value @ w)
        p[target] -= 1
        g = value[:, None] * p
        squared = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(squared) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = squared


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm;
    one pseudo-row of even odds keeps it finite when every row is right."""
    if not len(target):
        return 1.0

    def loss(log_t):
        p = softmax(logits / np.exp(log_t))
        best = p.max(1)
        return -np.log(np.maximum(p[np.arange(len(target)), target], 1e-12)).sum() - np.log(np.maximum(1 - best, 1e-12)).mean() * 0.5

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        code = clean(text)
        if not len(code) or not self.languages:
            return UNKNOWN, 0.0
        at, value = tfidf(code, self.idf)
        p = softmax(value @ self.weights[at] / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def fit(rows: DataFrame, sample: int = SAMPLE, epochs: int = 2) -> Model:
    """Learn from (doc_id, text, lang); rows without lang or letters teach nothing."""
    rows = rows.select("doc_id", "text", "lang").where(F.col("lang").isNotNull())
    seen, n = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + seen)) + 1

    def run(batches):
        for batch in small_batches(batches, "text"):
            kept, at, value = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                code = clean(text)
                if len(code):
                    a, v = tfidf(code, idf)
                    kept.append(i)
                    at.append(a.astype(np.uint16).tobytes())
                    value.append(v.astype(np.float32).tobytes())
            picked = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([picked.column("doc_id"), picked.column("lang"), pa.array(at, pa.binary()), pa.array(value, pa.binary())],
                                             names=["doc_id", "lang", "at", "value"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    some = tables.share(rows, "lang", sample).mapInArrow(run, f"doc_id {kind}, lang string, at binary, value binary")
    order = F.xxhash64("doc_id", F.lit(11))
    found = [(r["lang"], np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["value"], np.float32).astype(float))
             for r in some.withColumn("o", order).sort("o", "doc_id", "at").collect()]
    languages = sorted({x[0] for x in found})
    if not languages:
        return Model([], idf, np.zeros((BUCKETS, 0)), 1.0)
    model, target = Ftrl(len(languages), BUCKETS), {x: i for i, x in enumerate(languages)}
    held = [x for i, x in enumerate(found) if i % 5 == 4]
    for _ in range(epochs):
        for i, (lang, at, value) in enumerate(found):
            if i % 5 != 4:
                model.learn(at, value, target[lang])
    w = model.weights()
    logits = np.array([v @ w[a] for _, a, v in held]).reshape(len(held), len(languages))
    t = temperature(logits, np.array([target[x[0]] for x in held], int))
    return Model(languages, idf, w.astype(np.float32), t)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every whole text; ``und`` and 0 for a text that is NULL
    or has no letter. Keys may be NULL or repeat; other columns are ignored."""

    def run(batches):
        for batch in small_batches(batches, text):
            out = [model.predict(x) for x in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                                             names=[key, "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, lang_pred string, score double")


def known_language(docs: DataFrame, model: Model, margin: float = MARGIN, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text has a letter and a language whose
    calibrated score is past an even guess by ``margin``. A NULL text or one without a letter goes; if no
    language could be learned (a table without any lang), every text with a letter stays.
    Rows are judged one by one, so repeated rows share their fate; keys may be NULL."""

    even = 1 / max(len(model.languages), 1)
    floor = even + margin * (1 - even)

    def known(value: str | None) -> bool:
        if not model.languages:
            return len(clean(value)) > 0
        lang, score = model.predict(value)
        return lang != UNKNOWN and score >= floor

    def run(batches):
        for batch in small_batches(batches, text):
            yield batch.filter(pa.array([known(x) for x in batch.column(text).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
