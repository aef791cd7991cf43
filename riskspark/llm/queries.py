"""The numbered queries and the pipeline, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm import jaccard, language, lexical, neighbours, packing, pages, parsing, pieces, quality, token_files, topk, toxicity, vector_codes

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


@query
def op2_token_files(spark, sf):
    return token_files.read_tokens(token_files.write_tokens(table(spark, sf, "documents")))


@query
def op3_language(spark, sf):
    docs = table(spark, sf, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    found = language.predict(docs, language.fit(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op6_quality(spark, sf):
    return quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op9_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


@query
def op8_pages(spark, sf):
    return pages.extract(table(spark, sf, "pages"))


@query
def op10_pieces(spark, sf):
    back = pieces.decode(pieces.encode(table(spark, sf, "documents")))
    return back.select("doc_id", "n_tokens", "ids_crc32", F.length("text").cast("long").alias("n_chars"), F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"))


@query
def op4_neighbours(spark, sf):
    return neighbours.search(table(spark, sf, "embeddings"))


@query
def op7_topk(spark, sf):
    return topk.search(table(spark, sf, "embeddings"))


CHECKS["op7_topk"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ordered WHERE place <= 5"""


@query
def op5_jaccard(spark, sf):
    return jaccard.classes(table(spark, sf, "documents"), size=4, percent=85)


@query
def op11_codes(spark, sf):
    coded, books = vector_codes.fit_and_code(table(spark, sf, "embeddings"))
    out = vector_codes.with_label_error(coded).withColumn("codebooks_sha256", F.lit(vector_codes.digest(books)))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


CHECKS["op11_codes"] = vector_codes.sql()


@query
def op12_repeats(spark, sf):
    return parsing.removed(table(spark, sf, "documents"))


@query
def op13_ranked(spark, sf):
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


CHECKS["op13_ranked"] = lexical.SQL
