"""From raw documents to packed token windows: language identification, toxicity,
near duplicates by an n-gram Jaccard join, packing.

Each stage takes all rows that the one before kept and, but for the last, returns the
columns of ``documents``. Stages learn from their own input (and the labels). NULL,
empty and repeated rows are treated as the operators' docstrings say: a text without
a letter or a language that shows leaves at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.common import materialise
from riskspark.llm import jaccard, language, packing, toxicity

#: Near copies share this much of their sets of so many words in a row.
WORDS, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.known_language(docs, language.fit(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, size=WORDS, percent=PERCENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: SQL can express neither the fitted models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
