"""Column rules for the older risk and safety scores and their regimes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def legacy_scores(df: DataFrame, vol: str, drawdown: str, geo: str) -> DataFrame:
    """Risk from volatility, drawdown and geopolitical tone; safety as their mirror."""
    v, dd, g = (F.coalesce(F.col(c), F.lit(0.0)) for c in (vol, drawdown, geo))
    risk = F.least(100 * (0.4 * F.abs(v) + 0.35 * F.abs(dd) + 0.25 * F.abs(g)), F.lit(100.0))
    safety = (1 - F.least(F.abs(v) * 20, F.lit(1.0)) + (g + 1) / 2 + 1 - F.least(F.abs(dd), F.lit(1.0))) / 3 * 100
    return df.withColumns({"risk_score": F.bround(risk, 2), "safety_score": F.bround(safety, 2)})


def regime_label(geo: Column, tech: Column) -> Column:
    """0 neutral, 1 geopolitical stress, 2 technology optimism; 2 overrides 1."""
    return F.when(tech > 0.3, 2).when(geo < -0.2, 1).otherwise(0)
