"""Named joins of the study: trading-day master table, resume and dedupe joins,
event windows and weighted stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.functions import dates, text as tx
from riskspark.operators import normalise as nz


def master_table(returns: DataFrame, wide_sentiment: DataFrame) -> DataFrame:
    """Ticker-day rows with the day's sentiment; the trading calendar drives."""
    return returns.join(wide_sentiment, "date", "left")


def inner_align(returns: DataFrame, index: DataFrame) -> DataFrame:
    return returns.join(index, "date").dropna(subset=["ret", "sentiment_avg"])


def full_outer_domains(daily: DataFrame, left: str, right: str) -> DataFrame:
    """Two domains' daily tone and volume side by side, days of either kept."""
    part = lambda d, p: daily.filter(F.col("domain") == d).select(
        "date", F.col("sentiment_score").alias(f"{p}_sentiment"), F.col("article_count").alias(f"{p}_count"))
    return part(left, "geo").join(part(right, "tech"), "date", "full")


def resume(articles: DataFrame, scored: DataFrame, key: str = "url") -> DataFrame:
    """Articles whose key is not stored yet. The stored side is reduced to distinct
    keys; rows without a key can match nothing, so they bypass the shuffle."""
    done = scored.select(key).distinct()
    keyed = articles.filter(F.col(key).isNotNull()).join(done, key, "left_anti")
    return keyed.select(*articles.columns).unionByName(articles.filter(F.col(key).isNull()))


def unseen_headlines(candidates: DataFrame, stored: DataFrame, order: list[str]) -> DataFrame:
    """First candidate per normalised headline that is not stored yet. Copies are
    collapsed before the join, so a headline with very many copies is one row in it."""
    h = F.left(F.md5(tx.normal_headline(F.col("headline"))), F.lit(12))
    first = nz.keep_first(candidates.withColumn("headline_id", h), ["headline_id"], [F.col(c) for c in order])
    seen = stored.select(h.alias("headline_id")).distinct()
    return first.join(seen, "headline_id", "left_anti")


def event_window(series: DataFrame, events: DataFrame, before: int = 7, after: int = 10) -> DataFrame:
    """Business days around each event: the window is unrolled per event (a fixed
    number of days), which turns the range join into an equi-join."""
    days = events.select(F.col("date").alias("event_date"), F.explode(
        F.sequence(F.date_sub("date", before), F.date_add("date", after))).alias("date"))
    return series.join(days.filter(dates.is_weekday(F.col("date"))), "date")


def weight_star(domain_days: DataFrame, weights: DataFrame) -> DataFrame:
    """Each domain-day repeated for every portfolio that weighs it."""
    return domain_days.join(weights, "domain").select(
        "date", "portfolio", "domain", "weight",
        (F.col("weight") * F.col("avg_prob_neg")).alias("weighted_neg"),
        (F.col("weight") * F.col("avg_prob_pos")).alias("weighted_pos"))


def keep_universe(df: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    return df.join(universe.select(key).distinct(), key, "left_semi")
