"""Ranked lexical search with range-maximum tables over posting lists.

A scan of the documents keeps, for each block of documents, their lengths and the
posting lists of the asked terms. Block sums give the corpus statistics. With them,
each block answers every item best first: a queue holds intervals of documents, each
bounded by the sum of its terms' largest impacts there, which sparse tables answer in
two look-ups a list. The interval with the highest bound is split at the document
that holds the largest of these impacts; that document is scored exactly, and the
parts left and right of it are queued if their bounds reach the score that the item's
k best documents so far surely have. The best intervals of all items of a block go
through numpy together.

Items are taken in groups of bounded text, so what a task is sent is bounded; text is
never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.common import materialise
from riskspark.llm.columns import small_batches, words
from riskspark.llm.vectors import ranked

TOP = 20
#: Bytes of item text that are sent to the tasks at once.
GROUP_BYTES = 4 << 20
#: A block of the index holds at most so many postings (and one document more).
BLOCK_POSTINGS = 1 << 20
BLOCK_DOCUMENTS = 1 << 15
#: Intervals of an item that are split in one step.
WIDTH = 16
#: Bytes of terms: all but the ASCII characters that are no letter or digit.
TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def _terms(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return words(col, inside=TERM)


# ---------------------------------------------------------------- index


def _index(docs: DataFrame, asked: np.ndarray, key: str, text: str, most: int) -> DataFrame:
    """Blocks (docs, lengths, terms, starts, places, counts): the lists of the asked
    terms, in the order of the hashes; a block's documents are ordered by key. Documents
    without a term are left out."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["docs", "lengths", "terms", "starts", "places", "counts"]

    def block(keys: list, lengths: list, term: list, place: list, count: list) -> pa.RecordBatch:
        ids, n = pa.concat_arrays(keys), np.concatenate(lengths)
        order = pa.compute.array_sort_indices(ids).to_numpy().astype(np.int64)  # NULL last
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        term, place, count = np.concatenate(term), rank[np.concatenate(place)], np.concatenate(count)
        by = np.lexsort((place, term))
        held, starts = np.unique(term[by], return_index=True)
        cells = [n[order].astype("<i8"), held.astype("<i4"), np.append(starts, len(by)).astype("<i4"), place[by].astype("<i4"), count[by].astype("<i4")]
        whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order)))
        return pa.RecordBatch.from_arrays([whole, *(pa.array([c.tobytes()], pa.binary()) for c in cells)], names=names)

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[list] = [[], [], [], [], []]
        docs_held = postings = 0
        for batch in small_batches(batches, text):
            h, first = _terms(batch.column(text))
            n = np.diff(np.append(first, len(h))[: batch.num_rows + 1])
            row = np.repeat(np.arange(batch.num_rows), n)
            at = np.minimum(np.searchsorted(asked, h), max(len(asked) - 1, 0))
            hit = asked[at] == h if len(asked) else np.zeros(len(h), bool)
            pairs, count = np.unique(at[hit] * batch.num_rows + row[hit], return_counts=True)
            full = np.flatnonzero(n)
            new = np.cumsum(n > 0) - 1
            for column, part in zip(held, (batch.column(key).take(pa.array(full)), n[full], pairs // batch.num_rows, docs_held + new[pairs % batch.num_rows], count)):
                column.append(part)
            docs_held, postings = docs_held + len(full), postings + len(pairs)
            if postings >= BLOCK_POSTINGS or docs_held >= most:
                yield block(*held)
                held, docs_held, postings = [[], [], [], [], []], 0, 0
        if docs_held:
            yield block(*held)

    return docs.select(key, text).mapInArrow(run, f"docs array<{kind}>, lengths binary, terms binary, starts binary, places binary, counts binary")


def _statistics(index: DataFrame, asked: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, their terms, documents with each asked term); what is
    collected has one row for each asked term of the group."""

    def run(batches):
        df, n, length = np.zeros(asked, np.int64), 0, 0
        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda c, kind: np.frombuffer(batch.column(c)[row].as_py(), kind)
                own = cell("lengths", "<i8")
                n, length = n + len(own), length + int(own.sum())
                df[cell("terms", "<i4")] += np.diff(cell("starts", "<i4"))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(df[at], [n, length]))], names=["term", "total"])

    sums = index.select("lengths", "terms", "starts").mapInArrow(run, "term long, total long").groupBy("term").agg(F.sum("total").alias("total")).collect()
    total = {r["term"]: r["total"] for r in sums}
    return total.get(-1, 0), total.get(-2, 0), np.array([total.get(t, 0) for t in range(asked)], np.int64)


# ---------------------------------------------------------------- search


def sparse_table(values: np.ndarray, longest: int) -> list[np.ndarray]:
    """Level j holds at i the place of the largest of values[i : i + 2**j]; of equal values the first."""
    levels = [np.arange(len(values), dtype=np.int32)]
    span = 1
    while 2 * span <= longest:
        a, b = levels[-1][:-span], levels[-1][span:]
        levels.append(np.where(values[b] > values[a], b, a))
        span *= 2
    return levels


class Block:
    """Posting lists of one block, laid end to end, with their impacts."""

    def __init__(self, lengths, terms, starts, places, counts, n: int, total: int, weights: np.ndarray):
        self.size = len(lengths)
        m = 100 - 25 + (25 * lengths * n) // total
        tf = counts.astype(np.int64)
        term = np.repeat(terms, np.diff(starts))
        self.impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[places]))
        self.place = places.astype(np.int64)
        self.key = np.repeat(np.arange(len(terms)), np.diff(starts)) * self.size + self.place
        self.list_of = {t: i for i, t in enumerate(terms.tolist())}
        self.levels = sparse_table(self.impact, int(np.diff(starts).max(initial=1)))

    def lists(self, item: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """The item's lists that this block has, and how often the item holds each."""
        own = [(self.list_of[t], times) for t, times in item if t in self.list_of]
        return np.array([x for x, _ in own], np.int64), np.array([x for _, x in own], np.int64)

    def bounds(self, lists: np.ndarray, times: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals [left, right): the sum of the lists' largest impacts there, and the
        document of the largest one."""
        base = lists[:, None] * self.size
        a, b = (np.searchsorted(self.key, base + x[None]) for x in (left, right))
        best = np.zeros(a.shape, np.int64)
        where = np.zeros(a.shape, np.int64)
        some = b > a
        level = np.zeros(a.shape, np.int64)
        level[some] = np.frexp((b - a)[some])[1] - 1
        for j in np.unique(level[some]):
            at = some & (level == j)
            x, y = self.levels[j][a[at]], self.levels[j][b[at] - (1 << j)]
            top = np.where(self.impact[y] > self.impact[x], y, x)
            best[at], where[at] = self.impact[top], self.place[top]
        best *= times[:, None]
        return best.sum(0), where[best.argmax(0), np.arange(best.shape[1])]

    def scores(self, lists: np.ndarray, times: np.ndarray, docs: np.ndarray) -> np.ndarray:
        wanted = lists[:, None] * self.size + docs[None]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return (np.where(self.key[at] == wanted, self.impact[at], 0) * times[:, None]).sum(0)

    def best(self, item: list[tuple[int, int]], k: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, documents looked at): the k best ones, ties to the first."""
        lists, times = self.lists(item)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(lists):
            return docs, scores, 0
        left, right = np.zeros(1, np.int64), np.full(1, self.size)
        bound, split = self.bounds(lists, times, left, right)
        looked = 0
        while len(left):
            first = np.argsort(-bound, kind="stable")  # the queue, best bound first
            left, right, bound, split = left[first], right[first], bound[first], split[first]
            a, b, d = left[:width], right[:width], split[:width]
            looked += len(d)
            docs, scores = np.append(docs, d), np.append(scores, self.scores(lists, times, d))
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            sure = max(scores[-1] if len(scores) == k else 1, 1)
            low, high = np.concatenate([a, d + 1]), np.concatenate([d, b])
            some = high > low
            low, high = low[some], high[some]
            more, at = self.bounds(lists, times, low, high) if len(low) else (np.zeros(0, np.int64),) * 2
            left, right, bound, split = (np.append(x[width:], y) for x, y in ((left, low), (right, high), (bound, more), (split, at)))
            # Equal scores go to the smaller document, so an interval after all documents
            # held that can only equal the last of them is of no use, but others are.
            may = (bound > sure) | ((bound == sure) & (left <= (docs[-1] if len(docs) == k else self.size)))
            left, right, bound, split = left[may], right[may], bound[may], split[may]
        some = scores > 0
        return docs[some], scores[some], looked


def _answers(index: DataFrame, items: list[list[tuple[int, int]]], n: int, total: int, weights: np.ndarray, k: int, kind: str, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda c, t="<i4": np.frombuffer(batch.column(c)[row].as_py(), t)
                if not len(cell("terms")):
                    continue
                block = Block(cell("lengths", "<i8"), cell("terms").astype(np.int64), cell("starts"), cell("places"), cell("counts"), n, total, weights)
                found = [block.best(item, k, width) for item in items]
                ids = batch.column("docs")[row].values
                asked = np.repeat(np.arange(len(items)), [len(d) for d, _, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked), ids.take(pa.array(np.concatenate([d for d, _, _ in found]))), pa.array(np.concatenate([s for _, s, _ in found]))],
                    names=["item", "vec_id", "score"])

    return index.mapInArrow(run, f"item long, vec_id {kind}, score long")


def _groups(items: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """The items in groups of about ``GROUP_BYTES`` of text (a longer text is a group of
    its own), each group read by a job of its own."""
    sizes = items.select("place", F.octet_length(text).alias("bytes")).orderBy("place").toLocalIterator()
    cuts, held = [0], 0
    last = 0
    for r in sizes:
        if held and held + r["bytes"] > GROUP_BYTES:
            cuts.append(r["place"])
            held = 0
        held, last = held + r["bytes"], r["place"] + 1
    for a, b in zip(cuts, [*cuts[1:], last]):
        if b > a:
            yield [(r[item], r[text]) for r in items.where(F.col("place").between(a, b - 1)).orderBy("place").collect()]


def search(docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id",
           block_documents: int = BLOCK_DOCUMENTS, width: int = WIDTH) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k documents with the highest score above
    0, equal scores by ascending doc_id (NULL last).

    Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased, known
    by 64-bit hashes. A NULL or empty text, of a document or an item, has no term and no
    row. A repeated document row counts and is ranked once for each row; repeated rows of
    one item and text are one item, rows of one item_id with other texts are items of
    their own. Empty tables give no rows. Other columns are ignored."""
    spark = docs.sparkSession
    kinds = [items.schema[item].dataType.simpleString(), docs.schema[key].dataType.simpleString()]
    out = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    known = items.select(item, text).where(F.octet_length(text) > 0).distinct()
    known = materialise(known.withColumn("place", F.monotonically_increasing_id()), "items")
    for group in _groups(known, item, text):
        h, first = _terms(pa.array([t for _, t in group], pa.large_string()))
        asked, term = np.unique(h, return_inverse=True)
        ends = np.append(first, len(h))[1:len(group) + 1]
        queries = [list(zip(*(x.tolist() for x in np.unique(term[a:b], return_counts=True)))) for a, b in zip(first, ends)]
        index = materialise(_index(docs, asked, key, text, block_documents), "lexical-index")
        n, total, df = _statistics(index, len(asked))
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        answers = _answers(index, queries, n, total, weights, k, kinds[1], width)
        # Ties to the smaller id, NULL after all of them.
        best = ranked(answers.withColumns({"doc": F.col("vec_id"), "vec_id": F.struct(F.col("vec_id").isNull(), "vec_id")}), k, by="item")
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(group)], f"item long, item_id {kinds[0]}")  # the group's items
        out = out.union(best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score"))
    return out


SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
held AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM held, corpus GROUP BY term, docs),
impacts AS (
  SELECT doc_id, h.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // length))) AS impact
  FROM held h JOIN weights w ON h.term = w.term JOIN sizes USING (doc_id), corpus),
scored AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM asked JOIN impacts ON asked.term = impacts.term GROUP BY 1, 2),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 20"""
