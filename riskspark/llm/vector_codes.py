"""Vector codes: one small codebook for each part of the vectors, refined by integer
k-means whose passes walk metric trees instead of rows.

Rows are stored once in blocks. Each block has a tree for each part position, built
middle-out by the anchors hierarchy: anchors take over the points nearest to them,
are merged upwards into balls and split downwards the same way; every ball caches the
sum and count of its points. A pass goes down from the root with the list of entries
that can still be the nearest of some point of the ball. The list is inherited and
shrinks; a ball with one entry left is owned by it and adds its cached sum as a whole.
Points of leaves are compared with the entries left, in exact integers.

The trees stay with their blocks; only part x entry sums leave a task.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.common import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_ROWS = 4096
LEAF = 32
#: Scaled components stay below this, so that errors of whole vectors fit a long.
LARGEST = 1 << 27


# ---------------------------------------------------------------- trees


def _anchors(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Split rows among about sqrt(n) anchors. Each new anchor is the farthest point of
    the widest one and takes the points that are nearer to it; points within half the
    way to their own anchor cannot change and are not looked at."""
    pts = x[rows]
    pivots = [pts[0]]
    far = np.linalg.norm(pts - pts[0], axis=1)
    owner = np.zeros(len(rows), int)
    for number in range(1, int(np.ceil(np.sqrt(len(rows))))):
        new = int(far.argmax())
        if far[new] == 0:
            break
        between = np.linalg.norm(np.array(pivots) - pts[new], axis=1)
        open_ = np.flatnonzero(far > between[owner] / 2)
        d = np.linalg.norm(pts[open_] - pts[new], axis=1)
        won = open_[d < far[open_]]
        far[won], owner[won] = d[d < far[open_]], number
        pivots.append(pts[new])
    return [g for g in (rows[owner == i] for i in range(len(pivots))) if len(g)]


class _Ball:
    __slots__ = ("rows", "kids", "center", "radius")

    def __init__(self, x: np.ndarray, rows: np.ndarray, kids: tuple = ()):
        self.rows, self.kids = rows, kids
        self.center = x[rows].mean(0)
        self.radius = float(np.linalg.norm(x[rows] - self.center, axis=1).max())


def _merge(x: np.ndarray, balls: list[_Ball]) -> _Ball:
    """Join the two balls whose union is the tightest until one is left."""
    bound = lambda a, b: np.linalg.norm(a.center - b.center) / 2 + max(a.radius, b.radius)
    n = len(balls)
    c = np.array([b.center for b in balls])
    r = np.array([b.radius for b in balls])
    cost = np.linalg.norm(c[:, None] - c[None], axis=2) / 2 + np.maximum(r[:, None], r[None])
    np.fill_diagonal(cost, np.inf)
    for _ in range(n - 1):
        i, j = divmod(int(cost.argmin()), n)
        balls[i] = _Ball(x, np.concatenate([balls[i].rows, balls[j].rows]), (balls[i], balls[j]))
        cost[j, :] = cost[:, j] = np.inf
        for o in np.flatnonzero(np.isfinite(cost[i])):
            cost[i, o] = cost[o, i] = bound(balls[i], balls[o])
    return balls[i] if n > 1 else balls[0]


def _grow(x: np.ndarray, rows: np.ndarray) -> _Ball:
    if len(rows) > LEAF:
        groups = _anchors(x, rows)
        if len(groups) > 1:
            return _merge(x, [_grow(x, g) for g in groups])
    return _Ball(x, rows)


def tree(cells: np.ndarray) -> dict[str, np.ndarray]:
    """A tree over integer points as arrays; a ball's points are a range of ``order``."""
    x = cells.astype(float)
    todo, balls, kids = [_grow(x, np.arange(len(x)))], [], []
    spans, order, at = [], [], 0
    stack = [(todo[0], -1, 0)]
    while stack:  # preorder; leaves lay out the points, and the spans follow from below
        ball, parent, side = stack.pop()
        me = len(balls)
        balls.append(ball)
        kids.append([-1, -1])
        if parent >= 0:
            kids[parent][side] = me
        spans.append([at, at + len(ball.rows)])
        if ball.kids:
            stack += [(ball.kids[1], me, 1), (ball.kids[0], me, 0)]
        else:
            order.append(ball.rows)
            at += len(ball.rows)
    return {"center": np.array([b.center for b in balls]), "radius": np.array([b.radius for b in balls]),
            "sum": np.array([cells[b.rows].sum(0) for b in balls], np.int64), "span": np.array(spans, np.int64),
            "kids": np.array(kids, np.int64), "order": np.concatenate(order).astype(np.int64)}


def square_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points to integer entries."""
    largest = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * x.shape[1] * float(largest) ** 2 < 2**52:  # all terms are exact in doubles
        a, b = x.astype(float), entries.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)
    return ((x[:, None, :] - entries[None]) ** 2).sum(2)


def walk(t: dict[str, np.ndarray], cells: np.ndarray, entries: np.ndarray):
    """Go down the tree level by level. Yields ('ball', nodes, entry) for balls that one
    entry owns and ('points', rows, entry, distance) for points of other leaves."""
    e = entries.astype(float)
    first = np.array([not any((entries[j] == entries[i]).all() for j in range(i)) for i in range(len(entries))])
    apart = np.linalg.norm(e[:, None] - e[None], axis=2)
    nodes, lists = np.zeros(1, np.int64), first[None]  # an entry equal to an earlier one never wins
    while len(nodes):
        center, radius = t["center"][nodes], t["radius"][nodes]
        d = ((center[:, None, :] - e[None]) ** 2).sum(2)
        best = np.where(lists, d, np.inf).argmin(1)
        own = d[np.arange(len(nodes)), best]
        # On the whole ball, an entry is farther than the best one by more than rounding.
        slack = 1e-6 + 1e-9 * (own + radius**2)[:, None] + 1e-9 * d
        lists = lists & (d - own[:, None] - 2 * radius[:, None] * apart[best] <= slack)
        single = lists.sum(1) == 1
        if single.any():
            yield "ball", nodes[single], best[single]
        rest, left = nodes[~single], lists[~single]
        leaf = t["kids"][rest, 0] < 0
        if leaf.any():
            spans = t["span"][rest[leaf]]
            n = spans[:, 1] - spans[:, 0]
            at = np.repeat(spans[:, 0] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows = t["order"][at]
            dist = np.where(np.repeat(left[leaf], n, axis=0), square_distances(cells[rows], entries), np.iinfo(np.int64).max)
            entry = dist.argmin(1)
            yield "points", rows, entry, dist[np.arange(len(rows)), entry]
        nodes, lists = t["kids"][rest[~leaf]].ravel(), np.repeat(left[~leaf], 2, axis=0)


def sums(t: dict[str, np.ndarray], cells: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """One row an entry: the count and the component sums of the points nearest to it."""
    out = np.zeros((len(entries), 1 + cells.shape[1]), np.int64)
    for kind, who, entry, *_ in walk(t, cells, entries):
        if kind == "ball":
            span = t["span"][who]
            np.add.at(out, entry, np.column_stack([span[:, 1] - span[:, 0], t["sum"][who]]))
        else:
            np.add.at(out, entry, np.column_stack([np.ones(len(who), np.int64), cells[who]]))
    return out


def nearest(t: dict[str, np.ndarray], cells: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every point."""
    code = np.zeros(len(cells), np.int64)
    for kind, who, entry, *_ in walk(t, cells, entries):
        if kind == "ball":
            for (a, b), one in zip(t["span"][who], entry):
                code[t["order"][a:b]] = one
        else:
            code[who] = entry
    return code, ((cells - entries[code]) ** 2).sum(1)


# ---------------------------------------------------------------- blocks


def _saved(trees: list[dict[str, np.ndarray]]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{p}_{name}": a for p, t in enumerate(trees) for name, a in t.items()})
    return out.getvalue()


def _loaded(raw: bytes, parts: int) -> list[dict[str, np.ndarray]]:
    with np.load(io.BytesIO(raw)) as f:
        return [{name: f[f"{p}_{name}"] for name in ("center", "radius", "sum", "span", "kids", "order")} for p in range(parts)]


def _blocks(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """(ids, labels, cells, trees): rows as they come, up to ``BLOCK_ROWS`` in a block."""
    kinds = rows.schema

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        cells = t["cells"].chunk(0).flatten().to_numpy().astype(np.int64).reshape(len(t), -1)
        trees = [tree(cells[:, p * width:(p + 1) * width]) for p in range(parts)]
        whole = lambda c: pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t[c].chunk(0))
        return pa.RecordBatch.from_arrays(
            [whole("id"), whole("label"), pa.array([cells.astype("<i8").tobytes()], pa.binary()), pa.array([_saved(trees)], pa.binary())],
            names=["ids", "labels", "cells", "trees"])

    def run(batches: Iterator[pa.RecordBatch]):
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, BLOCK_ROWS - n)
                held, n, at = held + [piece], n + piece.num_rows, at + piece.num_rows
                if n == BLOCK_ROWS:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return rows.mapInArrow(run, f"ids array<{kinds['id'].dataType.simpleString()}>, labels array<{kinds['label'].dataType.simpleString()}>, cells binary, trees binary")


def _opened(batch: pa.RecordBatch, row: int, parts: int):
    raw = np.frombuffer(batch.column("cells")[row].as_py(), "<i8")
    n = len(batch.column("ids")[row])
    return np.split(raw.reshape(n, -1), parts, axis=1), _loaded(batch.column("trees")[row].as_py(), parts)


def _refined(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: new entries from the sums of all blocks; unused entries stay. What is
    collected has the fixed size of the codebooks."""
    parts, entries, width = books.shape

    def run(batches):
        total = np.zeros((parts, entries, 1 + width), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, (cells, t) in enumerate(zip(*_opened(batch, row, parts))):
                    total[p] += sums(t, np.ascontiguousarray(cells), books[p])
        part, entry, place = (a.ravel() for a in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()), pa.array(total.ravel())],
                                         names=["part", "entry", "place", "total"])

    found = blocks.select("ids", "cells", "trees").mapInArrow(run, "part int, entry int, place int, total long")
    total = np.zeros((parts, entries, 1 + width), np.int64)
    for r in found.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
        total[r["part"], r["entry"], r["place"]] = r["total"]
    count = total[:, :, :1]
    return np.where(count > 0, np.floor_divide(total[:, :, 1:], np.maximum(count, 1)), books)


def _coded(blocks: DataFrame, books: np.ndarray, id_kind: str, label_kind: str) -> DataFrame:
    parts = len(books)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                pairs = [nearest(t, np.ascontiguousarray(c), books[p]) for p, (c, t) in enumerate(zip(*_opened(batch, row, parts)))]
                codes = np.stack([c for c, _ in pairs], 1).astype(np.uint8)
                error = np.sum([e for _, e in pairs], 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[row].values, batch.column("labels")[row].values, pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())],
                    names=["id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"id {id_kind}, label {label_kind}, code string, error long")


def fit_and_code(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error), codebooks): the codes of all rows and the final entries,
    parts x entries x components.

    Left out are vectors that are NULL, hold a NULL or non-finite component, have
    another length than the most frequent one that ``parts`` divides, or a scaled
    component of 2**27 or more (their errors don't fit a long). A repeated row is coded
    once for each row; of rows that share one of the smallest ids, the smallest vector
    starts an entry. Rows without id are coded but start no entry. With fewer ids than
    ``entries`` the codebooks are shorter; an empty table gives no rows. Other columns
    are ignored."""
    v, limit = F.col(vector).cast("array<double>"), float(LARGEST) / scale
    known = df.select(F.col(key).alias("id"), F.col(label).alias("label"), v.alias("vector"))
    known = known.where((F.size("vector") > 0) & (F.size("vector") % parts == 0) & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x >= -limit)))
    sizes = known.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    width = sizes[0]["n"] // parts if sizes else 1
    rows = known.where(F.size("vector") == width * parts).select(
        "id", "label", F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("cells"))
    smallest = [r["id"] for r in rows.where(F.col("id").isNotNull()).select("id").distinct().orderBy("id").limit(entries).collect()]
    starts = rows.where(F.col("id").isin(smallest)).groupBy("id").agg(F.min("cells").alias("cells")).orderBy("id").collect() if smallest else []
    books = np.array([r["cells"] for r in starts], np.int64).reshape(len(starts), parts, width).transpose(1, 0, 2)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    if not len(starts):
        return df.sparkSession.createDataFrame([], f"id {kinds[0]}, label {kinds[1]}, code string, error long"), books
    blocks = materialise(_blocks(rows, parts, width), "codes-blocks")
    for _ in range(rounds):
        books = _refined(blocks, books)
    return _coded(blocks, books, *kinds), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the error summed over rows of equal label (NULLs together). The sums are made
    before the shuffle; a label of a third of all rows comes back by a join that
    adaptive execution may split or broadcast by its measured size."""
    coded = materialise(coded, "codes")
    per = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_of")
    return coded.join(per, coded["label"].eqNullSafe(per["_of"])).drop("_of")


def digest(books: np.ndarray) -> str:
    """sha256 of all entries' components in decimals by part, entry, place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def sql(table: str = "embeddings", key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
        entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same fit row by row, one named step a round."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT {key} AS id, {label} AS label, list_transform({vector}, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM {table}
  WHERE {vector} IS NOT NULL AND len({vector}) > 0 AND len(list_filter({vector}, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""pieces AS MATERIALIZED (
  SELECT id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v FROM kept, range({parts}) AS r(p))""",
             f"""book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY id) - 1 AS e, v FROM pieces
  WHERE id IN (SELECT id FROM kept ORDER BY id LIMIT {entries}))"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT x.id, x.p, any_value(x.v) AS v, min(struct_pack(d := list_sum(list_transform(list_zip(x.v, b.v), lambda q: (q[1] - q[2]) * (q[1] - q[2]))), e := b.e)) AS best
  FROM pieces x JOIN book{k} b ON x.p = b.p GROUP BY x.id, x.p)""")
        if k < rounds:
            steps.append(f"""mean{k} AS (
  SELECT p, e, list(CAST(m AS BIGINT) ORDER BY j) AS v FROM (
    SELECT p, best.e AS e, j, floor(CAST(sum(v[j]) AS DOUBLE) / count(*)) AS m FROM near{k}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM pieces) + 1)) AS j)
    GROUP BY 1, 2, 3) GROUP BY 1, 2)""")
            steps.append(f"book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e)")
    steps.append(f"""coded AS MATERIALIZED (
  SELECT id, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY id)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT c.id AS vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded c JOIN kept k ON c.id = k.id"""
