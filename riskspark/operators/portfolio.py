"""Equal-weight portfolio series."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def portfolio_series(returns: DataFrame, bridge: DataFrame) -> DataFrame:
    """Mean return and mean 5-day volatility over member tickers, gaps skipped."""
    return returns.join(bridge, "ticker").groupBy("portfolio", "date").agg(
        F.avg("ret").alias("ret"), F.avg("vol5").alias("vol5"))
