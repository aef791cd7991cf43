"""The training-data operators against brute force, round trips and held-out rows."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskspark.llm import jaccard, language, neighbours, packing, pages, pieces, quality, simple8b, token_files, tokens, topk, toxicity

DOCS = "doc_id long, text string, n int"
TEXTS = ["the cat sat on the mat and looked at the dog", "", None, "  two  spaces\n\nand\tmore ", "é ½ 日本 😀", "word " * 3000,
         "the cat sat on the mat and looked at the dog", "<|endoftext|> a"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "no id", 1), (5, "same id", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def ids(text, end):
    return tokens._tokenizer(tokens.vocabulary_path()).encode(text or "", add_special_tokens=False).ids + [end]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_encoder_equals_the_library():
    odd = ["a  b", "a\n b", "a\n \nb", " x", "x ", "don't 's", "a\tb c", "\n", "a\u0085 b", "x,y 1,2", "", "naïve, Ǆ ß. ×÷ ªº", "a\xa0 b\u2003c", "日本 語",
           "word. (word) [x] _y_ ~~ a-b c--", "<|endoftext|> a", "x <|endoftext|>", "\x1c \x1f a", " ", "A\nB\nC", "é" * 300 + ",;", "'s 't x's", "\u200b a", "😀 😀😀"]
    enc = tokens.Encoder(tokens.vocabulary_path())
    table = enc.encode_units([b"a", b" b", b"\nB"])
    _, _, h = tokens.units(np.frombuffer(b"a b\nB", np.uint8), np.array([0, 5]))
    words = tokens.Words.of(h, table[1], table[0])
    for e in (enc, tokens.Encoder(tokens.vocabulary_path(), words)):
        for texts in (odd, odd[::-1], [], [""], ["", "", "a b"]):
            assert [x.tolist() for x in e.texts(texts)] == [x.tolist() for x in e.whole(texts)]
            ids, n = e.column(pa.array([*texts, None]), 7)
            assert ids.tolist() == [i for t in [*texts, ""] for i in [*e.whole([t])[0], 7]] and len(n) == len(texts) + 1
    wrong = tokens.Words(words.keys, words.starts, words.ids[::-1].copy())  # as if hashes of other words
    with pytest.raises(ValueError):
        tokens.Encoder(tokens.vocabulary_path(), wrong).texts(["a b\nB"])
    lower = tokens.Encoder(tokens.vocabulary_path("word_bpe_49k.json"))
    assert [x.tolist() for x in lower.texts(["A b", "c D."])] == [x.tolist() for x in lower.whole(["A b", "c D."])]


def test_packing(spark, docs, none):
    got = packing.pack(docs, window=64, with_ids=True)
    rows = got.collect()
    want = sorted((r["doc_id"], ids(r["text"], 0)) for r in docs.where("doc_id is not null").collect())
    have = {}
    for r in sorted((r for r in rows if r["doc_id"] is not None), key=lambda r: (r["doc_id"], r["doc_tokens"], r["start"])):
        assert crc(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == r["length"] and r["offset"] + r["length"] <= 64
        have.setdefault((r["doc_id"], r["doc_tokens"]), []).extend(r["ids"])
    assert sorted((k[0], v) for k, v in have.items()) == want
    windows = packing.sequences(got, 64).collect()
    assert sum(r["length"] for r in windows) == sum(r["length"] for r in rows)
    assert sum(len(r["ids"]) != 64 for r in windows) <= 1 and sum(r["length"] < 64 for r in windows) <= 1
    assert packing.pack(none).count() == 0


def test_token_files(spark, docs, none):
    rows = token_files.read_tokens(token_files.write_tokens(docs, shards=3, block_ids=100), with_ids=True).collect()
    want = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), ids(r["text"], 2)) for r in docs.collect())
    assert sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["ids"]) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(r["ids"]), crc(r["ids"]))
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == [None, *sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)]
    assert token_files.read_tokens(token_files.write_tokens(none)).count() == 0


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 239, 240, 241, 5000):
        for v in (np.zeros(n), rng.integers(0, 2, n), rng.integers(0, 50_000, n), rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)):
            v = v.astype(np.uint64)
            assert (simple8b.decode(*simple8b.encode(v)) == v).all()


def test_language(spark, none):
    bag = {"en": "the house is in this town and we are there", "de": "das haus ist in dieser stadt und wir sind dort"}
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.permutation(bag[lang].split())), lang) for i in range(120) for lang in bag] + [(900, None, "en"), (901, "12 ++", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df.where("doc_id % 2 = 0"))
    got = language.predict(df.where("doc_id % 2 = 1"), model).withColumn("n", F.lit(1)).collect()
    assert {r["lang_pred"] for r in got} == {"de", "en", "und"} and all(0 <= r["score"] <= 1 for r in got)
    assert sum(model.predict(t)[0] == lang for i, t, lang in rows if i < 900) > 235
    assert model.predict(None) == ("und", 0.0) == model.predict("½ 3!")
    assert language.known_language(df, model).count() == 240
    assert language.known_language(df, model, margin=1.0).count() == 0
    once = spark.createDataFrame([(1, "house", "en"), (1, "house", "en"), (None, "das haus " * 40_000, None), (3, "", "en")], df.schema)
    kept = language.known_language(once.withColumn("score", F.lit(7)), model).collect()
    assert [(r["doc_id"], r["score"]) for r in kept] == [(1, 7), (1, 7), (None, 7)]
    unlabelled = language.fit(df.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.languages == [] and language.known_language(df, unlabelled).count() == 240
    single = language.fit(df.where("lang = 'en'"))
    assert language.known_language(df, single).count() == 240
    assert language.known_language(none.withColumn("lang", F.lit("x")), model).count() == 0
    assert language.predict(none, language.fit(none.withColumn("lang", F.lit("x")))).count() == 0


def vectors(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(600, 8)).astype(np.float32)
    m[100:300] = m[100]
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    bad = [(1000, None), (1020, [None] * 8), (1040, [float("nan")] * 8), (None, [1.0] * 8), (1050, [1.0]), (100, m[100].tolist())]
    return m.astype(float), spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")


def test_topk_is_exact(spark):
    m, df = vectors(spark)
    whole = np.floor(256 * m).astype(np.int64)
    got = topk.search(df).orderBy("query_id", "rank").collect()
    want = []
    for q in range(0, 600, 50):
        s, at = whole @ whole[q], np.delete(np.arange(600), q)
        want += [(q, r + 1, int(i), int(s[i])) for r, i in enumerate(at[np.lexsort((at, -s[at]))][:5])]
    assert [tuple(r) for r in got] == want
    assert topk.search(df.limit(0)).count() == 0 and topk.search(df.where("vec_id < 3")).count() == 2


def brute(m, every, k):
    """The rows of topk.search over vectors whose ids are their places, in whole numbers of any size."""
    whole, out = np.floor(256 * m).astype(np.int64).astype(object), []
    for q in range(0, len(m), every):
        scores = sorted((-s, i) for i, s in enumerate((whole * whole[q]).sum(1)) if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


def test_topk_copies_queries_once_a_span(spark, monkeypatch):
    """Queries go to few spans of rows, never to a broadcast of a copy for each block, and a span hands on few rows."""
    plans, counts, files, spans, k = {}, {}, {}, 3, 5

    def seen(df, label, *more):
        plans[label] = df._jdf.queryExecution().executedPlan().toString().splitlines()
        out = materialise(df, label, *more)
        counts[label], files[label] = out.count(), out.inputFiles()
        return out

    materialise = topk.materialise
    monkeypatch.setattr(topk, "materialise", seen)
    for name, value in (("BLOCK_ROWS", 8), ("QUERY_ROWS", 4), ("TILE_ROWS", 64), ("LEAST_SPANS", spans), ("GROUP", 4)):
        monkeypatch.setattr(topk, name, value, raising=False)
    m = np.random.default_rng(4).normal(size=(600, 8))
    got = topk.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>"), every=20)
    assert sorted(map(tuple, got.collect())) == brute(m, 20, k)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for label in ("topk-gathered", "topk-collected"):
        for i, line in enumerate(plans[label]):
            below = plans[label][i + 1 :] if "BroadcastExchange" in line else []
            below = below[: next((j for j, x in enumerate(below) if depth(x) <= depth(line)), None)]
            assert not any("Generate" in x for x in below), label
    assert counts["topk-queries"] > 3 and counts["topk-blocks"] > 20 * spans  # so copies by blocks would show
    assert counts["topk-gathered"] <= 30 * spans * topk.LISTS * k and counts["topk-collected"] <= 30 * spans * k
    groups = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata for f in files["topk-blocks"]]
    assert max(x.row_group(i).num_rows for x in groups for i in range(x.num_row_groups)) <= 4


@pytest.mark.parametrize("kind", ["ties", "equal", "longs", "mixed", "few"])
def test_topk_over_spans_is_exact(spark, monkeypatch, kind):
    for name, value in (("BLOCK_ROWS", 16), ("QUERY_ROWS", 8), ("TILE_ROWS", 24), ("LEAST_SPANS", 4)):
        monkeypatch.setattr(topk, name, value, raising=False)
    rng = np.random.default_rng(6)
    m = {"ties": rng.integers(-1, 2, size=(150, 4)) / 256, "equal": np.tile(rng.normal(size=(1, 6)), (150, 1)), "longs": rng.normal(size=(150, 6)) * 2e6,
         "mixed": rng.normal(size=(150, 5)) * 10.0 ** rng.integers(-2, 7, size=(150, 1)), "few": rng.normal(size=(4, 5))}[kind]
    got = topk.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>"), every=2, k=6)
    assert sorted(map(tuple, got.collect())) == brute(m, 2, 6)


def test_neighbours_recall(spark):
    m, df = vectors(spark)
    got = {}
    for r in neighbours.search(df, k=10).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hit = []
    for q in range(0, 600, 20):
        s, at = m @ m[q], np.delete(np.arange(600), q)
        hit.append(len(set(got[q]) & set(at[np.argsort(-s[at], kind="stable")][:10].tolist())) / 10)
    assert np.mean(hit) >= 0.9
    assert neighbours.search(df.limit(0)).count() == 0 and neighbours.search(df.where("vec_id < 3")).count() == 2


def test_neighbours_go_on_where_leaves_are_small(spark):
    m, _ = vectors(spark)
    tree = neighbours.Tree.fit(m)
    every = tree.visit(m[0], tree.leaves)
    sizes = {leaf: 3 for leaf in every}
    assert len(set(every)) == tree.leaves
    assert tree.visit(m[0], 2) == every[:2] == tree.visit(m[0], 2, sizes, 6)
    more = min(5, tree.leaves)
    assert tree.visit(m[0], 1, sizes, 3 * more - 1) == every[:more]
    assert tree.visit(m[0], 1, sizes, 10**6) == every          # fewer rows than asked for: all leaves


def test_jaccard_components(spark, docs, none):
    rng = np.random.default_rng(3)
    base = [[f"w{x}" for x in rng.integers(0, 500, 80)] for _ in range(6)]
    texts = []
    for i in range(150):
        w = list(base[i % 6])
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(0, 80))] = f"x{rng.integers(0, 50)}"
        texts.append(" ".join(w).upper() if i % 7 == 0 else " ".join(w))
    texts += ["one two", "One  TWO", "", None, " \n ", "a b c d", "a b c d a b c d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        before = list(root)
        for a in range(len(texts)):
            for b in range(a):
                n = len(sets[a] & sets[b])
                if n and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                    root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(df).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert jaccard.one_of_each(df).count() == len({*root})
    assert jaccard.classes(docs).count() == docs.count() and jaccard.classes(none).count() == 0


def test_repeated_sets_stay_linear(spark):
    base = " ".join(f"w{i}" for i in range(60))
    df = spark.range(128).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, base).otherwise(base + " more").alias("text")).repartition(64)
    cells = np.zeros(1 << 16, np.uint8)
    sent = jaccard._prefixes(df, "text", spark.sparkContext.broadcast(cells), 16, 4, 85, {})
    assert sent.count() == 2  # one row a set, however many tasks hold it
    got = jaccard.classes(df).collect()
    assert len(got) == 128 and {r["component_id"] for r in got} == {0}


def test_sets_that_share_half_a_digest(spark):
    a, b = np.arange(3, dtype=np.uint64), np.arange(4, dtype=np.uint64)
    (key, check), other = jaccard._digest(a), jaccard._digest(b)
    assert jaccard._key(a, {}) == key == jaccard._key(a, {key: check}) and jaccard._key(b, {key: check}) == other[0]
    assert jaccard._key(a, {key: check - 1}) not in (key, check)  # another set keeps this half
    rows = spark.createDataFrame([(5, 1), (5, 1), (5, -3), (6, 2), (None, None)], "key long, check long")
    assert jaccard._twins(rows) == {5: -3}


def test_one_of_each_judges_rows(spark):
    long, other = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, long, 0, 0, 0), (2, long, 0, 0, 0), (2, other, 0, 0, 0), (3, other, 1, 0, 0), (4, None, 0, 0, 0), (4, "", 0, 0, 0), (None, long, 0, 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int, row_ int, goes_ int")
    got = jaccard.one_of_each(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got.collect()) == sorted([(0, long), (1, long), (2, other), (4, ""), (4, "")])


def test_near_duplicates_of_the_pipeline(spark):
    import corpus_pipeline

    def pair(name, n, more):  # n - 4 sets of five words in both, n - 4 + more in one
        w = [f"{name}{i}" for i in range(n + more)]
        return [" ".join(w[:n]), " ".join(w)]

    texts = pair("a", 44, 10) + pair("b", 44, 11) + pair("c", 300, 53) + pair("d", 300, 74) + pair("e", 300, 75)  # 40/50, 40/51, 296/349, 296/370, 296/371
    edited = [f"f{i}" for i in range(1000)]
    texts += [" ".join(edited), " ".join("x" + w if i % 47 == 9 and i < 990 else w for i, w in enumerate(edited))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()}
    assert got == {0, 2, 3, 4, 6, 8, 9, 10}


def labelled(spark, low, high):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        w = [f"w{x}" for x in rng.integers(0, 300, 40)]
        if i % 4 == 0:
            w[5:8] = rng.choice(["vile", "rotten", "nasty", "awful"], 3)
        rows.append((i, " ".join(w), low if i % 4 == 0 else high))
    return spark.createDataFrame(rows, "doc_id long, text string, y int")


def test_toxicity(spark, docs, none):
    df = labelled(spark, 1, 0)
    model = toxicity.fit(df, df.select("doc_id", F.col("y").alias("toxic")))
    got = toxicity.score(df, model).join(df.select("doc_id", "y"), "doc_id").collect()
    assert sum(r["toxic"] == bool(r["y"]) for r in got) >= 396 and all(0 <= r["expected_severity"] <= 3 for r in got)
    assert toxicity.without_toxic(df, model).columns == df.columns
    empty = toxicity.fit(none, df.select("doc_id", F.col("y").alias("toxic")))
    assert toxicity.score(docs, empty).where("toxic").count() == 0


def test_toxicity_of_copies(spark):
    rng = np.random.default_rng(6)
    plain = lambda: [f"w{x}" for x in rng.integers(0, 300, 40)]
    rows, copy = [(" ".join(plain()), 0) for _ in range(400)], plain()
    for _ in range(60):
        w = plain()
        w[5:8] = rng.choice(["vile", "rotten", "nasty", "awful"], 3)
        rows.append((" ".join(w), 1))
    rows += [(" ".join([*copy, "vile", "rotten", "nasty"]), 1)] * 240
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.select("doc_id", "toxic"))
    got = toxicity.score(df, model).join(df.select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    assert len(model.terms) == 4 and sum(r["toxic"] != bool(r["y"]) for r in got) <= 2

    near = rows[:400] + [(" ".join([*copy[:i % 40], f"x{i % 7}", *copy[i % 40 + 1 :]]), 1) for i in range(200)]
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(near)], "doc_id long, text string, toxic int")
    assert not len(toxicity.fit(df, df.select("doc_id", "toxic")).terms)


def test_quality(spark, docs, none):
    df = labelled(spark, 0, 1)
    labels = df.select("doc_id", F.col("y").alias("quality"))
    got = quality.score(df, labels).join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert np.mean([r["score"] for r in got if r["quality"]]) > np.mean([r["score"] for r in got if not r["quality"]])
    assert {r["score"] for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(none, labels).count() == 0


def test_pages(spark):
    page = ('<html><head><title>t</title></head><body><nav><a href="/">menu</a></nav><div class="side-bar">x</div><article><h1>Head &amp; more</h1>'
            "<p>First <b>bold\n text</b><br><p>Second paragraph &eacute;</p><div id='comments'>no</div></article><footer>f</footer></body></html>")
    rows = [(1, "http://h.example/a", page, 1), (2, "http://h.example/b", page, 1), (3, None, None, 1), (4, "bad url", "", 1), (1, "http://h.example/a", page, 1)]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string, path int")).collect()
    text = "Head & more First bold text Second paragraph é"
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in got) == sorted(
        [(1, text, len(text)), (1, text, len(text)), (2, text, len(text)), (3, "", 0), (4, "", 0)])


def test_pages_keep_the_whole_article(spark):
    long, quote, lede = "long text " * 30, "quoted words " * 30, "A lede of one sentence."
    bodies = {
        "lede": f'<article><h1>Head</h1><p>{lede}</p><div class="body"><p>{long}</p></div></article>',
        "only": f'<main><h1>Head</h1><article><p>{lede}</p><div class="body"><p>{long}</p></div></article></main>',
        "split": f'<div class="wrap"><h1>Head</h1><div class="lead"><p>{lede}</p></div><div class="body"><p>{long}</p></div></div><ul><li><a href="/">more pages</a></li></ul>',
        "quote": f"<article><h1>Head</h1><p>{lede}</p><blockquote>{quote}</blockquote><p>End.</p></article>",
        "cell": f"<article><h1>Head</h1><p>{lede}</p><table><tr><td>{quote}</td></tr></table><p>End.</p></article>",
    }
    end = {"quote": [quote, "End."], "cell": [quote, "End."]}
    want = {h: " ".join(" ".join(["Head", lede, *end.get(h, [long])]).split()) for h in bodies}
    rows = [(f"{h}{i}", f"http://{h}.example/{i}", f"<html><body><nav>menu</nav>{b}<footer>f</footer></body></html>") for h, b in bodies.items() for i in range(2)]
    one = f'<body><article class="story"><p>{long}</p></article></body>'
    two = f'<body><article class="story"><p>A teaser.</p></article><article class="text"><h1>Head</h1><div><p>{quote}</p></div></article></body>'
    rows += [(f"two{i}", f"http://two.example/{i}", two if i == 3 else one) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert got == {f"{h}{i}": t for h, t in want.items() for i in range(2)} | {f"two{i}": f"Head {quote.strip()}" if i == 3 else long.strip() for i in range(4)}


def test_pieces_equal_the_library(spark, docs, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary_path(pieces.MODEL))
    texts = [t or "" for t in TEXTS] + ["lalalala bananananas", "a" + " " * 37 + "b", "nnnnnnn aaaaaaaaa", "......!!!!!"]
    coder = pieces.Pieces(pieces.vocabulary_path(pieces.MODEL))
    coded = coder.encode(texts)
    assert [x.tolist() for x in coded] == [model.encode(t) for t in texts]
    assert [coder.decode(x) for x in coded] == texts
    back = pieces.decode(pieces.encode(docs)).collect()
    assert sorted(r["text"] for r in back) == sorted(r["text"] or "" for r in docs.collect())
    assert pieces.decode(pieces.encode(none)).count() == 0


def test_unigram_pieces_are_the_best_split():
    coder = pieces.Pieces(pieces.vocabulary_path(pieces.MODEL), unigram=True)
    for word, got in coder.walk(sorted(["▁hello", "▁help", "▁hers", "▁thing"])):
        best = [(0.0, [])]
        for i in range(1, len(word) + 1):
            best.append(max((best[j][0] + coder.score[coder.ids[word[j:i]]], best[j][1] + [word[j:i]]) for j in range(i) if word[j:i] in coder.ids))
        assert sum(coder.score[i] for i in got) == best[-1][0]


def test_encoding_holds_small_blocks(monkeypatch):
    """A task that encodes texts holds some numbers a byte of a block of 256 KB, not of 1 MB."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    from pyspark.sql import types as T
    from riskspark.llm import columns, packing

    class Docs:
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
        select = lambda self, *names: self
        mapInArrow = lambda self, run, schema: run

    monkeypatch.setattr(packing, "frequent_words", lambda *_: None)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    run = packing.encode_documents(Docs(), tokens.vocabulary_path(), 0)
    texts = [" ".join(f"word{i % 50}" for i in range(j, j + 200)) for j in range(3_000)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    tokens.encoder(tokens.vocabulary_path())
    columns.give_back()
    tracemalloc.start()
    rows = sum(b.num_rows for b in run([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and peak < 40 << 20
