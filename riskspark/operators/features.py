"""Model features in long form: one table per domain-day, one per portfolio-day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from riskspark.functions.numeric import flag
from riskspark.operators import correlation as co, rolling as ro, shocks as sh


def domain_features(domain_days: DataFrame, max_lag: int = 7) -> DataFrame:
    """Lags, velocity, smoothing and article-volume signals per domain."""
    k = ("domain",)
    out = domain_days.withColumns({
        **{f"lag{i}_sentiment_score": ro.lag("sentiment_score", i, *k) for i in range(1, max_lag + 1)},
        "article_zscore": ro.roll_zscore("article_count", 20, 3, *k),
        "news_available": flag(F.col("article_count") > 0),
        "sentiment_velocity": ro.velocity("sentiment_score", *k),
        "sentiment_3d": ro.roll_mean("sentiment_score", 3, 1, *k),
    })
    # Counts are integers, so z = 2 is met exactly; the margin keeps the last bit of a
    # sum from deciding whether such a day is above 2.
    return out.withColumns({"article_spike": flag(F.col("article_zscore") > 2 + 1e-9),
                            "weighted_sentiment": F.col("article_zscore") * F.col("sentiment_score")})


def standardise(df: DataFrame, keys: list[str], cols: list[str], until: str | None = None) -> DataFrame:
    """z_* columns from one aggregate over all listed columns; ``until`` restricts the
    fit to earlier days so that models do not look ahead."""
    fit = df.filter(F.col("date") <= F.lit(until).cast("date")) if until else df
    m = fit.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                               *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    out = df.join(m, keys, "left").withColumns(
        {f"z_{c}": F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")) for c in cols})
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def standardise_at(df: DataFrame, keys: list[str], cols: list[str], until: dict[int, dt.date]) -> DataFrame:
    """Every row once per fold, with z_* columns from that fold's days up to its cutoff
    only. One pass of partial sums over the rows serves all folds; a column that was
    constant until then has z = 0, an unknown value stays unknown."""
    def folds(keep):
        each = [F.when(keep(F.lit(day).cast("date")), F.lit(k)) for k, day in sorted(until.items())]
        return F.explode(F.array_compact(F.array(*each)))

    m = df.withColumn("fold", folds(lambda day: F.col("date") <= day)).groupBy("fold", *keys).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    out = df.withColumn("fold", folds(lambda day: F.lit(True))).join(m, ["fold", *keys], "left")
    z = lambda c: F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).when(
        F.col(c).isNotNull(), 0.0)
    return out.withColumns({f"z_{c}": z(c) for c in cols}).drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def portfolio_features(portfolio_days: DataFrame) -> DataFrame:
    """Rolling return and volatility features per portfolio."""
    k = ("portfolio",)
    return portfolio_days.withColumns({
        "vol10": ro.roll_std("ret", 10, 3, *k), "vol20": ro.roll_std("ret", 20, 5, *k),
        "rolling_mean_return_5d": ro.roll_mean("ret", 5, 2, *k),
        "vol_zscore_5d": ro.roll_zscore("vol5", 20, 5, *k),
        "lagged_vol": ro.lag("vol5", 1, *k), "pre_shock_baseline": ro.roll_mean("vol5", 20, 5, *k)})


def with_shocks(features: DataFrame) -> DataFrame:
    s = sh.shock_days(features).select("portfolio", "date", "threshold", "shock")
    return features.join(s, ["portfolio", "date"], "left")


def with_intra_corr(features: DataFrame, returns: DataFrame, bridge: DataFrame) -> DataFrame:
    return features.join(co.mean_pair_correlation(returns, bridge), ["portfolio", "date"], "left")


def composition(bridge: DataFrame, safe: list[str]) -> DataFrame:
    """Equal-weight concentration and the share of safe-haven members."""
    return bridge.groupBy("portfolio").agg((1.0 / F.count(F.lit(1))).alias("hhi"),
                                           F.avg(F.col("ticker").isin(safe).cast("double")).alias("safe_haven_weight"))


def interactions(wide: DataFrame) -> DataFrame:
    """Cross-domain terms on the pivoted domain row."""
    geo, fin, tech = (F.col(f"sentiment_score_{d}") for d in ("geopolitical", "financial", "technology"))
    return wide.withColumns({"sentiment_interaction_geo_fin": geo * fin, "cross_domain_divergence": geo - tech})


def shock_context(events: DataFrame, domain_feats: DataFrame, regime: DataFrame, domains: list[str]) -> DataFrame:
    """Attach tone, velocity and article spikes per domain, and the market regime."""
    measures = {"sentiment_score": "sentiment", "sentiment_velocity": "sentiment_vel", "article_spike": "spike"}
    wide = domain_feats.groupBy("date").pivot("domain", domains).agg(
        *[F.first(m, ignorenulls=True).alias(a) for m, a in measures.items()])
    wide = wide.withColumnsRenamed({f"{d}_{a}": f"{a}_{d}" for d in domains for a in measures.values()})
    out = events.join(wide, "date", "left").join(
        regime.withColumnRenamed("market_regime_flag", "market_regime"), "date", "left")
    return out.withColumns({"quarter": F.quarter("date"), "year": F.year("date")})
