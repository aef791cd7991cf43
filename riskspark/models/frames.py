"""The day-grained model frame: domain and portfolio features side by side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K
from riskspark.operators import features as fe, sentiment as se

Z_SOURCES = ["sentiment_score", "avg_prob_neg", "avg_prob_pos", "sentiment_3d", "sentiment_velocity",
             "lag1_sentiment_score", "lag2_sentiment_score", "lag3_sentiment_score"]
DOMAIN_COLS = ["sentiment_score", "article_count", "article_spike", "article_zscore", "news_available",
               "sentiment_3d", "sentiment_velocity", "weighted_sentiment"]
PORTFOLIO_COLS = ["ret", "vol5", "vol10", "vol20", "rolling_mean_return_5d", "vol_zscore_5d", "lagged_vol",
                  "intra_corr", "shock"]


def _pivot(df: DataFrame, on: str, values: list[str], measures: list[str], by: tuple[str, ...] = ("date",)) -> DataFrame:
    wide = df.groupBy(*by).pivot(on, values).agg(*[F.first(m, ignorenulls=True).alias(m) for m in measures])
    return wide.withColumnsRenamed({f"{v}_{m}": f"{m}_{v}" for v in values for m in measures})


def day_frame(domain_feats: DataFrame, portfolio_feats: DataFrame, regime: DataFrame, portfolios: list[str],
              until: str | None = None) -> DataFrame:
    """One row per trading day. ``until`` limits the z-score fit to earlier days."""
    z = fe.standardise(domain_feats, ["domain"], Z_SOURCES, until)
    left = fe.interactions(_pivot(z, "domain", K.DOMAINS, DOMAIN_COLS + [f"z_{c}" for c in Z_SOURCES]))
    right = _pivot(portfolio_feats, "portfolio", portfolios, PORTFOLIO_COLS)
    return left.join(right, "date").join(regime, "date", "left")


def day_frame_at(domain_feats: DataFrame, portfolio_feats: DataFrame, regime: DataFrame, portfolios: list[str],
                 until: dict[int, dt.date]) -> DataFrame:
    """One row per fold and trading day, z-scores fitted on the days up to the fold's
    cutoff: what comes later changes nothing in the rows before it."""
    z = fe.standardise_at(domain_feats, ["domain"], Z_SOURCES, until)
    left = fe.interactions(_pivot(z, "domain", K.DOMAINS, DOMAIN_COLS + [f"z_{c}" for c in Z_SOURCES], ("fold", "date")))
    right = _pivot(portfolio_feats, "portfolio", portfolios, PORTFOLIO_COLS)
    return left.join(right, "date").join(regime, "date", "left")


def shock_features(target: str) -> list[str]:
    d, p = K.DOMAINS, list(K.PORTFOLIOS)
    per_domain = ["z_sentiment_score", "z_avg_prob_neg", "z_lag1_sentiment_score", "z_lag2_sentiment_score",
                  "z_lag3_sentiment_score", "article_spike", "article_zscore", "news_available",
                  "z_sentiment_velocity"]
    return ([f"vol_zscore_5d_{x}" for x in p] + [f"{c}_{x}" for c in per_domain for x in d]
            + [f"{c}_{target}" for c in ("vol5", "vol10", "vol20", "ret", "rolling_mean_return_5d")]
            + ["market_regime_flag"])


def risk_features() -> list[str]:
    d, p = K.DOMAINS, list(K.PORTFOLIOS)
    per_domain = ["z_sentiment_score", "z_sentiment_3d", "z_sentiment_velocity", "z_avg_prob_neg", "z_avg_prob_pos",
                  "z_lag1_sentiment_score", "z_lag2_sentiment_score", "article_spike", "article_count",
                  "weighted_sentiment"]
    return ([f"{c}_{x}" for c in per_domain for x in d] + [f"{c}_{x}" for c in ("intra_corr", "lagged_vol") for x in p]
            + ["sentiment_interaction_geo_fin", "cross_domain_divergence", "market_regime_flag"])


def sensitivity_features() -> list[str]:
    d, p = K.DOMAINS, list(K.PORTFOLIOS)
    per_domain = ["sentiment_score", "sentiment_3d", "sentiment_velocity", "z_lag1_sentiment_score", "article_count",
                  "article_zscore", "weighted_sentiment"]
    return ([f"{c}_{x}" for c in per_domain for x in d] + [f"lagged_vol_{x}" for x in p]
            + ["market_regime_flag", "sentiment_interaction_geo_fin"])


def with_target(frame: DataFrame, portfolio_feats: DataFrame, value: str, ahead: int = 0) -> DataFrame:
    """Repeat the day frame for every portfolio with that portfolio's target."""
    from riskspark.operators.rolling import lead
    y = portfolio_feats.withColumn("target", lead(value, ahead, "portfolio") if ahead else F.col(value))
    return y.select("portfolio", "date", "target").join(frame, "date")
