"""Bring drifting article feeds to one schema and drop unusable rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.functions import dates
from riskspark.functions.numeric import clip
from riskspark.schemas import SCORED_NEWS


def rename_drift(df: DataFrame) -> DataFrame:
    """sentiment_* becomes tone_*; of two score columns the second one wins."""
    for old, new in (("sentiment_score", "tone_score"), ("sentiment_label", "tone_label")):
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    if "tone_score.1" in df.columns:
        first = F.col("tone_score") if "tone_score" in df.columns else F.lit(None).cast("double")
        df = df.withColumn("tone_score", F.coalesce(F.col("`tone_score.1`"), first)).drop("tone_score.1")
    return df


def canonical_headline(df: DataFrame) -> DataFrame:
    if "clean_headline" not in df.columns:
        return df
    return df.withColumn("headline", F.coalesce("clean_headline", "headline"))


def derive_probs(label: Column, score: Column) -> dict[str, Column]:
    """Three probabilities from a label and its score."""
    lab = F.coalesce(F.lower(label), F.lit("neutral"))
    s = F.coalesce(score, F.lit(0.0))
    pos = F.when(lab == "positive", s).when(lab == "negative", 1 - s).otherwise(0.33)
    neg = F.when(lab == "negative", s).when(lab == "positive", 1 - s).otherwise(0.33)
    return {"prob_pos": pos, "prob_neg": neg,
            "prob_neu": clip(1.0 - pos - neg, F.lit(0.0), F.lit(1.0))}


def with_probs(df: DataFrame) -> DataFrame:
    if "prob_pos" in df.columns:
        return df
    if {"tone_label", "tone_score"} <= set(df.columns):
        return df.withColumns(derive_probs(F.col("tone_label"), F.col("tone_score")))
    return df.withColumns({"prob_pos": F.lit(0.33), "prob_neg": F.lit(0.33), "prob_neu": F.lit(0.34)})


def fill_missing(df: DataFrame) -> DataFrame:
    """Add absent columns: 0 for probabilities, NULL otherwise; fix order and types."""
    cols = []
    for f in SCORED_NEWS.fields:
        if f.name in df.columns:
            c = F.col(f.name)
        else:
            c = F.lit(0.0) if f.name.startswith("prob_") else F.lit(None)
        if f.name == "date":
            kind = dict(df.dtypes).get("date")
            c = dates.parse_day(c) if kind == "string" else c
        cols.append((c.try_cast(f.dataType) if f.name == "tone_score" else c.cast(f.dataType)).alias(f.name))
    extra = [c for c in df.columns if c == "article_id"]
    return df.select(*extra, *cols)


def standard_feed(df: DataFrame, domain: str) -> DataFrame:
    """One feed in the fixed schema, with its domain forced."""
    df = canonical_headline(rename_drift(df)).withColumn("domain", F.lit(domain))
    return fill_missing(with_probs(df))


def drop_bad(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["date", "tone_score"])


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def source_priority(domains: list[str]) -> Column:
    """Load order of the feeds, used to decide which copy of a headline is first."""
    return F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain"))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in a stated order. min(struct) combines map-side, so a key
    with a third of all rows sends one row per map task, where a window would sort
    the whole group in one task."""
    payload = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *payload))
    out = df.groupBy(*keys).agg(best.alias("_b"))
    return out.select(*keys, *[F.col("_b")[c].alias(c) for c in payload]).select(*df.columns)


def impute_constant(df: DataFrame, cols: list[str], value: float = 0.0) -> DataFrame:
    return df.fillna(value, subset=cols)
