"""Daily sentiment per domain, outlier clipping and portfolio risk scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.functions.numeric import clip
from riskspark.operators import calendar as cal

MEASURES = ["sentiment_score", "avg_prob_neg", "avg_prob_pos", "avg_prob_neu", "article_count"]


def daily_sentiment(articles: DataFrame) -> DataFrame:
    """Means per (date, domain). A hot domain or day only meets partial sums in the shuffle."""
    agg = articles.groupBy("date", "domain").agg(
        F.avg("prob_pos").alias("avg_prob_pos"), F.avg("prob_neg").alias("avg_prob_neg"),
        F.avg("prob_neu").alias("avg_prob_neu"), F.count("headline").alias("article_count"))
    return agg.withColumn("sentiment_score", F.bround(F.col("avg_prob_pos") - F.col("avg_prob_neg"), 6))


def winsorize(df: DataFrame, value: str, key: str, sigmas: float = 3.0) -> DataFrame:
    """Clip to mean ± k·σ per key, only where σ > 0. The moments are one row per key;
    the optimizer broadcasts them when they are small."""
    moments = df.groupBy(key).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    v, mu, sd = F.col(value), F.col("_mu"), F.col("_sd")
    clipped = F.when(sd > 0, clip(v, mu - sigmas * sd, mu + sigmas * sd)).otherwise(v)
    return df.join(moments, key, "left").withColumn(value, clipped).drop("_mu", "_sd")


def clean_daily(articles: DataFrame) -> DataFrame:
    """Roll weekends, aggregate, clip."""
    return winsorize(daily_sentiment(cal.roll_weekend(articles)), "sentiment_score", "domain")


def on_trading_days(daily: DataFrame, trading_days: DataFrame, domains: list[str]) -> DataFrame:
    """Domain sentiment on the trading calendar: lag 1 on the news calendar, then one
    day of forward fill on the trading calendar."""
    news = cal.domain_grid(daily, domains).withColumn(
        "news_lag1_sentiment_score", F.lag("sentiment_score").over(cal.by_series("domain")))
    out = cal.domain_rows(trading_days, domains).join(news, ["date", "domain"], "left")
    cols = [*MEASURES, "news_lag1_sentiment_score"]
    return out.withColumns({c: cal.ffill_once(c, "domain") for c in cols})


def pivot_domains(daily: DataFrame, domains: list[str], measures: list[str] | None = None,
                  keys: list[str] | None = None) -> DataFrame:
    """Wide form with <measure>_<domain> names; the value list is given, so Spark
    needs no extra pass to discover it."""
    measures = measures or MEASURES
    wide = daily.groupBy(*(keys or ["date"])).pivot("domain", domains).agg(
        *[F.first(m, ignorenulls=True).alias(m) for m in measures])
    if len(measures) == 1:
        return wide.withColumnsRenamed({d: f"{measures[0]}_{d}" for d in domains})
    return wide.withColumnsRenamed({f"{d}_{m}": f"{m}_{d}" for d in domains for m in measures})


def risk_scores(domain_days: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted mean of negative (risk) and positive (safety) probability over the
    domains present that day, weights renormalised; days without any domain stay."""
    both = F.col("avg_prob_neg").isNotNull() & F.col("avg_prob_pos").isNotNull()
    w = F.when(both, F.col("weight"))
    mean = lambda c: F.bround(F.try_divide(F.sum(w * F.col(c)), F.sum(w)) * 100, 4)
    out = domain_days.join(weights, "domain").groupBy("date", "portfolio").agg(
        mean("avg_prob_neg").alias("risk_score"), mean("avg_prob_pos").alias("safety_score"))
    return out.withColumn("sri", F.bround(F.col("risk_score") - F.col("safety_score"), 4))


def daily_index(articles: DataFrame) -> DataFrame:
    """Label index per calendar day; quiet days carry the mood forward with volume 0."""
    score = (F.when(F.lower("tone_label") == "positive", 1.0).when(F.lower("tone_label") == "neutral", 0.0)
              .when(F.lower("tone_label") == "negative", -1.0))
    day = articles.withColumn("_s", score).groupBy("date").agg(
        F.avg("_s").alias("sentiment_avg"), F.stddev_samp("_s").alias("sentiment_volatility"),
        F.count("_s").alias("news_volume"))
    dense = cal.densify_daily(day.withColumn("_k", F.lit(1)), ["_k"])
    return dense.select(
        "date", F.coalesce(cal.ffill("sentiment_avg", "_k"), F.lit(0.0)).alias("sentiment_avg"),
        F.coalesce("sentiment_volatility", F.lit(0.0)).alias("sentiment_volatility"),
        F.coalesce("news_volume", F.lit(0)).cast("long").alias("news_volume"))
