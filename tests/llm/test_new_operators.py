"""Vector codes, repeated strings and ranked search against brute force, and their odd inputs."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import lexical, parsing, vector_codes

# ---------------------------------------------------------------- vector codes


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, _, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted((r for r in kept if r[0] is not None))[:entries]
    books = [[cut(v, p) for _, v in first] for p in range(parts)]
    far = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e))
    near = lambda x, book: min((far(x, e), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for _, v in kept:
                held[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(h) for c in zip(*h)] if h else e for h, e in zip(held, books[p])]
    out = {}
    for i, v in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out[i] = ("".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best))
    return out, books


def vectors(n, dim=16, seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dim))
    return [(i, i % 3 if i % 7 else None, [float(x) for x in scale * (centers[i % 5] + 0.1 * rng.normal(size=dim))]) for i in range(n)]


VECTORS = "vec_id long, label int, embedding array<double>, _of int, code int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 0) for r in rows], VECTORS)


@pytest.mark.parametrize("scale", [1.0, 3000.0])
def test_codes_equal_brute_force(spark, scale):
    rows = vectors(150, scale=scale) + [(200 + i, 1, [0.5] * 16) for i in range(120)]  # a hot vector
    odd = [(900, 1, None), (901, 1, [None] + [0.1] * 15), (902, 1, [math.nan] + [0.1] * 15), (903, 1, [math.inf] * 16)]
    coded, books = vector_codes.fit_and_code(frame(spark, rows + odd).repartition(3))
    want, want_books = brute_codes(rows)
    got = vector_codes.with_label_error(coded).collect()
    assert {r["id"]: (r["code"], r["error"]) for r in got} == want and len(got) == len(rows)
    assert books.tolist() == want_books
    sums = {}
    for r in got:
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    assert all(r["label_error"] == sums[r["label"]] for r in got)
    assert vector_codes.digest(books) == hashlib.sha256(",".join(str(x) for b in want_books for e in b for x in e).encode()).hexdigest()


def test_codes_of_few_and_equal_rows(spark):
    same = [(i, None, [0.25] * 8) for i in range(40)] + [(None, 1, [0.5] * 8), (3, 1, [0.25] * 8)]
    coded, books = vector_codes.fit_and_code(frame(spark, same))
    got = coded.collect()
    # The first round moves entry 0 away, as the row without id is its own too; entry 1 takes over.
    assert len(got) == 42 and {r["code"] for r in got if r["id"] is not None} == {"01" * 8} and books.shape == (8, 16, 1)
    assert [r["code"] for r in got if r["id"] is None] == ["00" * 8]
    coded, books = vector_codes.fit_and_code(frame(spark, vectors(3, 8)))
    assert coded.count() == 3 and books.shape == (8, 3, 1) and sum(r["error"] for r in coded.collect()) == 0
    coded, books = vector_codes.fit_and_code(frame(spark, [(1, 1, [1.0] * 7), (2, 1, [])]))
    assert vector_codes.with_label_error(coded).count() == 0
    assert vector_codes.fit_and_code(frame(spark, vectors(5, 8) + [(9, 1, [1e300] + [0.0] * 7)]))[0].count() == 5


def test_balls_hold_their_points():
    rng = np.random.default_rng(2)
    cells = np.concatenate([rng.integers(-500, 500, (400, 3)), np.zeros((300, 3), np.int64)])
    t = vector_codes.tree(cells)
    assert sorted(t["order"].tolist()) == list(range(700)) and (t["sum"][0] == cells.sum(0)).all()
    for (a, b), center, radius, total in zip(t["span"], t["center"], t["radius"], t["sum"]):
        pts = cells[t["order"][a:b]]
        assert (pts.sum(0) == total).all() and np.linalg.norm(pts - center, axis=1).max() <= radius + 1e-9
    entries = rng.integers(-500, 500, (16, 3))
    entries[5] = entries[2]  # the later of two equal entries is never used
    code, _ = vector_codes.nearest(t, cells, entries)
    assert (code == vector_codes.square_distances(cells, entries).argmin(1)).all()
    owned = sum(np.diff(t["span"][who]).sum() for kind, who, *_ in vector_codes.walk(t, cells, entries) if kind == "ball")
    assert owned > 300  # whole balls take part by their cached sums


# ---------------------------------------------------------------- repeated strings


def brute_repeats(rows):
    """Rows (id, text), ids unique."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        mark = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                mark[s:s + 100] = b"\1" * 100
            seen.add(b[s:s + 100])
        kept = bytes(x for x, m in zip(b, mark) if not m)
        spans = sum(1 for j, m in enumerate(mark) if m and not (j and mark[j - 1]))
        out[i] = (len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest())
    return out


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdeé"), rng.integers(2, 7))) for _ in range(n))


def texts(seed=0):
    rng = np.random.default_rng(seed)
    line, passage = prose(rng, 16)[:95], prose(rng, 60)
    out = [prose(rng, 120) for _ in range(10)]
    out += [f"{prose(rng, 20)}\n{line}\n{prose(rng, 20)}\n{line}\n{prose(rng, 5)}" for _ in range(40)]  # a common line below 100 bytes
    out += [prose(rng, int(rng.integers(1, 30))) + passage + prose(rng, int(rng.integers(1, 30))) for _ in range(20)]
    out += [out[3]] * 5 + [out[4][:200], out[4][50:151], out[4][50:149], None, "", "a" * 99, "a" * 100, "a" * 101, "b" * 3000, "ab" * 2000, "\0" * 300]
    out += [out[5][:300] + "X" + out[5][300:], passage[: len(passage) // 2] * 3]
    return list(enumerate(out))


DOCS = "doc_id long, text string, k string, runs int"


def removed(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(5)
    return parsing.removed(df, **more).collect()


@pytest.mark.parametrize("seen", [40, 2, 0])
def test_repeats_equal_brute_force(spark, monkeypatch, seen):
    monkeypatch.setattr(parsing, "HOT_SEEN", seen)  # low: triggers are split into strings
    monkeypatch.setattr(parsing, "HOT_KEYS", 10_000 * 40 // max(seen, 1))
    rows = texts()
    got = removed(spark, rows, with_text=True, stretch=4_000)
    want = brute_repeats(rows)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want and len(got) == len(rows)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in got)


def test_a_long_text_is_read_in_pieces(spark):
    rng = np.random.default_rng(5)
    whole = prose(rng, 2_000)
    rows = [(1, whole), (2, whole[3_000:9_500]), (3, prose(rng, 50) + whole[:700] + whole[500:900])]
    assert {r["doc_id"]: tuple(r)[1:] for r in removed(spark, rows, piece=1_000)} == brute_repeats(rows)


def test_ids_that_are_null_or_repeated(spark):
    rng = np.random.default_rng(6)
    one, two = prose(rng, 60), prose(rng, 60)
    rows = [(None, one), (7, two), (7, two), (7, one), (8, two), (None, None)]
    got = removed(spark, rows)
    by = lambda i, n: sorted(r["n_removed"] for r in got if r["doc_id"] == i and r["n_bytes"] == n)
    assert len(got) == 6 and by(None, len(one.encode())) == [0] and by(None, 0) == [0]  # NULL is the smallest id
    assert by(8, len(two.encode())) == [len(two.encode())]
    same = sorted((r["n_bytes"], r["n_removed"]) for r in got if r["doc_id"] == 7)
    assert same == sorted([(len(two.encode()), 0), (len(two.encode()), 0), (len(one.encode()), len(one.encode()))])
    assert removed(spark, []) == []
    text_ids = spark.createDataFrame([("b", one), ("a", one)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_removed"] > 0 for r in parsing.removed(text_ids).collect()} == {"a": False, "b": True}


# ---------------------------------------------------------------- ranked search


def brute_search(docs, items, k=20):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: term.findall((t or "").translate(low))
    held = [(i, w) for i, t in docs if (w := words(t))]
    n, total = len(held), sum(len(w) for _, w in held)
    out = []
    for item, t in items:
        asked = words(t)
        df = {w: sum(w in own for _, own in held) for w in set(asked)}
        weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for w, d in df.items()}
        scored = []
        for i, own in held:
            m = 100 - 25 + (25 * len(own) * n) // total
            score = sum(weight[w] * ((10**9 * tf) // (1000 * tf + 12 * m)) for w in asked if (tf := own.count(w)))
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


WORDS = ["Straße", "Ärger", "alpha", "BETA", "gamma7", "été", "日本", "x", "y", "z", "common", "the"]


@pytest.mark.parametrize("documents,width", [(1 << 15, 16), (7, 1)])
def test_search_equals_brute_force(spark, monkeypatch, documents, width):
    monkeypatch.setattr(lexical, "GROUP_BYTES", 200)
    rng = np.random.default_rng(1)
    docs = [(i, " the, ".join(rng.choice(WORDS, int(rng.integers(1, 40)))) + (" rare" if i % 50 == 0 else "")) for i in range(150)]
    docs += [(200 + i, "x y z " * 5) for i in range(40)]  # ties
    docs += [(400, None), (401, ""), (402, "-- !!"), (403, "word " * 20_000 + "rare"), (None, "x y rare")]
    items = [(1, "X y, Z z"), (2, "rare ÉTÉ straße"), (3, None), (4, "..."), (5, "nowhere"), (6, "the " * 30), (7, "alpha beta gamma7 日本 common x"), (6, "the " * 30)]
    d = spark.createDataFrame([(i, t, 0, "q") for i, t in docs], "doc_id long, text string, score int, item string").repartition(4)
    q = spark.createDataFrame([(i, t, 1, "q") for i, t in items], "item_id long, text string, rank int, place string")
    got = lexical.search(d, q, block_documents=documents, width=width).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_search(docs, items[:-1])
    assert lexical.search(d.limit(0), q).count() == 0 and lexical.search(d, q.limit(0)).count() == 0


def test_sparse_table_and_fewer_documents_than_all():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 50, 300)
    levels = lexical.sparse_table(values, 300)
    for a, b in rng.integers(0, 300, (200, 2)):
        a, b = min(a, b), max(a, b) + 1
        j = int(b - a).bit_length() - 1
        x, y = levels[j][a], levels[j][b - (1 << j)]
        assert max(values[x], values[y]) == values[a:b].max()
    n, terms = 2_000, 6
    tf = [np.sort(rng.choice(n, size, False)) for size in (2_000, 900, 300, 40, 9, 3)]
    starts = np.append(0, np.cumsum([len(x) for x in tf]))
    block = lexical.Block(rng.integers(5, 400, n), np.arange(terms), starts, np.concatenate(tf), rng.integers(1, 5, starts[-1]), n, 400_000, np.array([20, 700, 1800, 3900, 5000, 6400]))
    docs, scores, looked = block.best([(t, 1) for t in range(terms)], 20)
    every = block.scores(np.arange(terms), np.ones(terms, np.int64), np.arange(n))
    order = np.lexsort((np.arange(n), -every))[:20]
    assert docs.tolist() == order.tolist() and scores.tolist() == every[order].tolist() and looked < n / 2
