"""Toxicity: cumulative-link ordinal regression on sparse word counts.

One vector of weights serves all ordered thresholds: P(grade <= k) is the logistic
function of threshold k minus the text's score. The terms are words whose share
of toxic labelled rows stands out, chosen one after another for rows that the terms
so far don't explain. Look-alike rows of one label count once, in every share and in
the fit: a group of copies neither makes its words toxic nor hides those that unlike
rows show too. Words of most documents are no terms. Labels know toxic or not; grades 1 to ``GRADES`` - 1 of toxic rows
are quantile bands of the density of such terms.

Labelled rows are a sample of at most about ``SAMPLE`` rows a class, a parameter;
every other count covers all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.common import materialise
from riskspark.llm import columns, tables

BUCKETS = 1 << 18
SAMPLE = 10_000
GRADES = 4
#: Candidate words; the terms are chosen among them.
TERMS = 4_000
#: Terms that explain a toxic row, and the least number of unlike rows that show a term.
COVER = 3
UNLIKE = 5
#: Least hashes of a text's word pairs, and the share of equal ones that makes rows look alike.
SIGNATURE = 32
ALIKE = 0.5
#: A group of look-alike rows of one label in the tables of counts, dealt to its rows.
UNIT = 1 << 16
#: Standard errors by which a word's share in toxic rows must exceed that in clean rows.
LEAST_Z = 5.0
REJECT_AT = 0.5


def labelled(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic): one row a document (the larger of repeated labels), without the
    rows held out (crc32 of doc_id modulo 5 is 0), at most about 2 * sample rows."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    return tables.share(one.where(~held), "toxic", sample)


def _distinct_words(batch: pa.RecordBatch, text: str):
    h, at = columns.words(batch.column(text), split_marks=True)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return h[first], doc[first], np.diff(np.append(first, len(h))), np.diff(at)


def _stands_out(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Standard errors between the two shares, under one common share."""
    if not n_toxic or not n_clean:
        return np.zeros(len(toxic))
    common = np.clip((toxic + clean) / (n_toxic + n_clean), 1e-12, 1 - 1e-12)
    return (toxic / n_toxic - clean / n_clean) / np.sqrt(common * (1 - common) * (1 / n_toxic + 1 / n_clean))


def _signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_words, sig): least hashes of each text's word pairs; of its only word, or
    zeros without one."""

    def run(batches):
        for batch in columns.small_batches(batches, text, columns.WORD_BLOCK):
            h, at = columns.words(batch.column(text), split_marks=True)
            n = np.diff(at)
            doc = np.repeat(np.arange(batch.num_rows), n)
            pair = columns.mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:])[doc[:-1] == doc[1:]] if len(h) else h
            alone = np.flatnonzero(n == 1)
            pair = np.append(pair, h[at[:-1][alone]])
            doc = np.append(doc[:-1][doc[:-1] == doc[1:]] if len(h) else doc, alone)
            order = np.argsort(doc, kind="stable")
            pair, doc = pair[order], doc[order]
            sig, some = np.zeros((batch.num_rows, SIGNATURE), np.uint32), np.flatnonzero(np.diff(np.append(-1, doc)))
            for k in range(SIGNATURE if len(some) else 0):
                least = np.minimum.reduceat(columns.mix(pair ^ columns.mix(np.array([k + 1], np.uint64))), some)
                sig[doc[some], k] = (least & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(n, pa.int64()), pa.array([x.tobytes() for x in sig], pa.binary())],
                                             names=[key, "n_words", "sig"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, n_words long, sig binary")


def _look_alike(signatures: list[bytes]) -> np.ndarray:
    """The number of each row's group: that of the first row before it that it looks like,
    found by two equal hashes side by side."""
    group, firsts, bands = np.zeros(len(signatures), np.int64), [], {}
    for i, raw in enumerate(signatures):
        own = np.frombuffer(raw, np.uint32)
        keys = [(k, raw[8 * k : 8 * k + 8]) for k in range(SIGNATURE // 2)]
        found = {bands[x] for x in keys if x in bands}
        like = next((g for g in sorted(found) if (firsts[g] == own).sum() >= ALIKE * SIGNATURE), None)
        if like is None:
            like = len(firsts)
            firsts.append(own)
            for x in keys:
                bands.setdefault(x, like)
        group[i] = like
    return group


def _sizes(like: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Of each row: the rows of its label in its group."""
    _, at, times = np.unique(2 * like + toxic, return_inverse=True, return_counts=True)
    return times[at]


def _terms(marked: DataFrame, text: str, n_toxic: int, n_clean: int) -> np.ndarray:
    """Hashes of the chosen words: buckets first, then the words of the chosen buckets.
    ``marked`` has toxic, like and part (a row's part of UNIT) of labelled rows; there are
    so many groups of toxic and of clean rows."""

    def count(batches):
        seen, salt = np.zeros((BUCKETS + 1, 3), np.int64), 0
        for batch in columns.small_batches(batches, text, columns.WORD_BLOCK):
            h, doc, _, _ = _distinct_words(batch, text)
            toxic, part = np.asarray(batch.column("toxic").fill_null(-1)), np.asarray(batch.column("part").fill_null(0))
            at = (h % np.uint64(BUCKETS)).astype(np.int64)
            seen[:BUCKETS, 0] += np.bincount(at, minlength=BUCKETS)
            seen[BUCKETS, 0] += len(toxic)
            for c, own in ((1, 1), (2, 0)):
                rows = np.flatnonzero(toxic[doc] == own)
                if len(rows):
                    seen[:BUCKETS, c] += np.bincount(at[rows], part[doc[rows]], BUCKETS).astype(np.int64)
            salt += len(h)
        yield from tables.emit(seen, salt)

    seen = tables.total(marked.select(text, "toxic", "part").mapInArrow(count, tables.SCHEMA), (BUCKETS + 1, 3), np.int64)
    z = _stands_out(seen[:BUCKETS, 1] / UNIT, seen[:BUCKETS, 2] / UNIT, n_toxic, n_clean)
    z[seen[:BUCKETS, 0] > 0.5 * seen[BUCKETS, 0]] = 0  # in most documents
    chosen = np.zeros(BUCKETS, bool)
    best = np.argsort(-z)[:TERMS]
    chosen[best[z[best] >= LEAST_Z]] = True
    if not chosen.any():
        return np.zeros(0, np.uint64)

    def exact(batches):
        found: set[tuple[int, int, int]] = set()
        for batch in columns.small_batches(batches, text, columns.WORD_BLOCK):
            h, doc, _, _ = _distinct_words(batch, text)
            own = chosen[(h % np.uint64(BUCKETS)).astype(np.int64)]
            like, toxic = (np.asarray(batch.column(c))[doc[own]].tolist() for c in ("like", "toxic"))
            found.update(zip(h[own].astype(np.int64).tolist(), like, toxic))
        if found:
            word, like, toxic = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(like, pa.int64()), pa.array(toxic, pa.int32())], names=["word", "like", "toxic"])

    found = (marked.where("toxic is not null").select(text, "toxic", "like").mapInArrow(exact, "word long, like long, toxic int").distinct()
             .groupBy("word").agg(F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_clean")))
    some = found.where(F.col("in_toxic") >= UNLIKE).orderBy(F.desc("in_toxic"), "word").limit(16 * TERMS).toPandas()
    z = _stands_out(some["in_toxic"].to_numpy(float), some["in_clean"].to_numpy(float), n_toxic, n_clean)
    best = np.argsort(-z, kind="stable")[:TERMS]
    return np.sort(some["word"].to_numpy(np.int64)[best[z[best] >= LEAST_Z]].astype(np.uint64))


def _features(docs: DataFrame, terms: np.ndarray, key: str, text: str) -> DataFrame:
    """(key, n_words, at, counts): the terms of each whole text."""

    def run(batches):
        for batch in columns.small_batches(batches, text, columns.WORD_BLOCK):
            h, doc, counts, n = _distinct_words(batch, text)
            at = np.searchsorted(terms, h)
            own = np.flatnonzero((at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == h)) if len(terms) else np.zeros(0, np.int64)
            ends = np.searchsorted(doc[own], np.arange(batch.num_rows + 1))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[own].astype(np.int32))) for x in (at, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(n, pa.int64()), *lists], names=[key, "n_words", "at", "counts"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, n_words long, at array<int>, counts array<int>")


def _explaining(rows: list, toxic: np.ndarray, like: np.ndarray, terms: int) -> np.ndarray:
    """Numbers of the chosen candidates, from (at, ...) of the labelled rows. A group of
    look-alike rows counts once wherever one of its rows does."""
    doc = np.repeat(np.arange(len(rows)), [len(r["at"]) for r in rows])
    term = np.concatenate([np.asarray(r["at"], int) for r in rows])
    if not len(term):
        return np.zeros(0, int)
    bad, covered, chosen = toxic == 1, np.zeros(len(rows), int), []
    order = np.argsort(pair := term * (like.max() + 1) + like[doc], kind="stable")
    first = np.flatnonzero(np.diff(pair[order], prepend=-1))

    def groups(own):  # of each term, those with an own row that shows it
        return np.bincount(term[order[first]][np.logical_or.reduceat(own[doc[order]], first)], minlength=terms)

    n_clean, in_clean = len(np.unique(like[~bad])), groups(~bad)
    open_ = np.ones(terms, bool)
    while True:
        left = bad & (covered < COVER)
        seen = groups(left)
        z = np.where(open_ & (seen >= UNLIKE), _stands_out(seen, in_clean, len(np.unique(like[left])), n_clean), 0)
        best = int(z.argmax())
        if z[best] < LEAST_Z:
            break
        open_[best] = False
        chosen.append(best)
        covered[doc[term == best]] += 1
    seen = groups(bad)
    only = (in_clean == 0) & (seen >= UNLIKE) & (_stands_out(seen, in_clean, len(np.unique(like[bad])), n_clean) >= LEAST_Z)
    return np.union1d(np.array(chosen, int), np.flatnonzero(only))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    terms: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, at: list, counts: list, n_words: np.ndarray) -> np.ndarray:
        """Probability of each grade of each row."""
        score = np.array([_row(c, n) @ self.weights[np.append(a, len(self.terms)).astype(int)] for a, c, n in zip(at, counts, n_words)])
        below = _sigmoid(self.thresholds[None, :] - score.reshape(-1, 1))
        return np.diff(np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], 1), axis=1)


def _row(counts, n_words) -> np.ndarray:
    """Damped counts of the terms, then the density of all of them."""
    c = np.asarray(counts, float)
    return np.append(np.log1p(c), np.log1p(100 * c.sum() / max(n_words, 1)))


def _fit_ordinal(rows: list, grade: np.ndarray, weight: np.ndarray, terms: int, steps: int = 400, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient steps (Adam) on the weighted mean log loss."""
    share = weight / weight.sum()
    row = np.repeat(np.arange(len(rows)), [len(x[0]) + 1 for x in rows])
    col = np.concatenate([np.append(a, terms) for a, _, _ in rows]).astype(int)
    val = np.concatenate([_row(c, n) for _, c, n in rows])
    p = np.zeros(terms + 1 + GRADES - 1)  # weights, first threshold, log gaps
    p[terms + 1] = 1.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        gaps = np.exp(p[terms + 2 :])
        theta = p[terms + 1] + np.append(0, np.cumsum(gaps))
        score = np.bincount(row, val * p[col], len(rows))
        edge = np.concatenate([np.full((len(rows), 1), -np.inf), theta - score[:, None], np.full((len(rows), 1), np.inf)], 1)
        cdf = _sigmoid(edge)
        dens = cdf * (1 - cdf)
        i = np.arange(len(rows))
        prob = np.maximum(cdf[i, grade + 1] - cdf[i, grade], 1e-12)
        up, low = dens[i, grade + 1] / prob * share, dens[i, grade] / prob * share
        by_theta = np.array([low[grade == k + 1].sum() - up[grade == k].sum() for k in range(GRADES - 1)])
        g = np.zeros_like(p)
        g[: terms + 1] = np.bincount(col, val * (up - low)[row], terms + 1) + l2 * p[: terms + 1]
        g[terms + 1] = by_theta.sum()
        g[terms + 2 :] = np.cumsum(by_theta[::-1])[::-1][1:] * gaps
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return p[: terms + 1], p[terms + 1] + np.append(0, np.cumsum(np.exp(p[terms + 2 :])))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Model:
    """Learn from (doc_id, text) and labels (doc_id, toxic). Labels that teach nothing (no
    toxic or no clean rows, or no word that stands out) give a model without terms."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    chosen = materialise(labelled(labels, sample), "toxicity-labels")
    none = Model(np.zeros(0, np.uint64), np.zeros(1), np.arange(6.0, 6.0 + GRADES - 1))
    signed = _signatures(docs.join(F.broadcast(chosen), "doc_id", "left_semi"), "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    signed = signed.groupBy("doc_id").agg(F.max(F.struct("n_words", "sig", "toxic")).alias("row")).orderBy("doc_id").select("doc_id", "row.sig", "row.toxic").collect()
    toxic = np.array([r["toxic"] for r in signed], int)
    if not 0 < toxic.sum() < len(toxic):
        return none
    like = _look_alike([bytes(r["sig"]) for r in signed])
    size = _sizes(like, toxic)
    groups = [(r["doc_id"], r["toxic"], g, max(UNIT // n, 1)) for r, g, n in zip(signed, like.tolist(), size.tolist())]
    kind = docs.schema["doc_id"].dataType.simpleString()
    groups = materialise(docs.sparkSession.createDataFrame(groups, f"doc_id {kind}, toxic int, like long, part long"), "toxicity-groups")
    marked = docs.join(F.broadcast(groups), "doc_id", "left")  # about 2 * sample rows
    terms = _terms(marked, "text", len(np.unique(like[toxic == 1])), len(np.unique(like[toxic == 0])))
    if not len(terms):
        return none
    known = _features(marked.where("toxic is not null"), terms, "doc_id", "text")
    rows = known.groupBy("doc_id").agg(F.max(F.struct("n_words", "at", "counts")).alias("row")).orderBy("doc_id").select("row.*").collect()
    kept = _explaining(rows, toxic, like, len(terms))
    if not len(kept):
        return none
    place = {old: new for new, old in enumerate(kept.tolist())}
    known = []
    for r in rows:
        own = [(place[a], c) for a, c in zip(r["at"], r["counts"]) if a in place]
        known.append(([a for a, _ in own], [c for _, c in own], r["n_words"]))
    terms = terms[kept]
    density = np.array([100 * sum(c) / max(n, 1) for _, c, n in known])
    bands = np.quantile(density[toxic == 1], np.arange(1, GRADES - 1) / (GRADES - 1))
    grade = np.where(toxic == 1, 1 + np.searchsorted(bands, density, side="right"), 0)
    return Model(terms, *_fit_ordinal(known, grade, 1 / size, len(terms)))


def _grades(batch: pa.RecordBatch, model: Model, text: str):
    """(words, term counts, probabilities of the grades) of a batch's texts."""
    h, doc, counts, n = _distinct_words(batch, text)
    at = np.searchsorted(model.terms, h)
    own = np.flatnonzero(model.terms[np.minimum(at, len(model.terms) - 1)] == h) if len(model.terms) else np.zeros(0, np.int64)
    ends = np.searchsorted(doc[own], np.arange(1, batch.num_rows))
    ats, times = np.split(at[own], ends), np.split(counts[own], ends)
    return n, np.array([t.sum() for t in times], np.int64), model.probabilities(ats, times, n)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_terms, p_toxic, severity_grade, expected_severity, toxic) of each row.

    expected_severity is the mean grade (0 to GRADES - 1); toxic is p_toxic >= 0.5,
    p_toxic being the probability of any grade over 0. A NULL or empty text has the score
    of no terms. Keys may be NULL or repeat; other columns are ignored."""

    def run(batches):
        for batch in columns.small_batches(batches, text, columns.WORD_BLOCK):
            n, hits, p = _grades(batch, model, text)
            toxic = 1 - p[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(n, pa.int64()), pa.array(hits), pa.array(toxic), pa.array(p.argmax(1).astype(np.int32)),
                 pa.array(p @ np.arange(GRADES)), pa.array(toxic >= REJECT_AT)],
                names=[key, "n_words", "n_terms", "p_toxic", "severity_grade", "expected_severity", "toxic"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"{key} {kind}, n_words long, n_terms long, p_toxic double, severity_grade int, expected_severity double, toxic boolean")


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that are not toxic."""

    def run(batches):
        for batch in columns.small_batches(batches, text, columns.WORD_BLOCK):
            yield batch.filter(pa.array(1 - _grades(batch, model, text)[2][:, 0] < REJECT_AT))

    return docs.mapInArrow(run, docs.schema)
