"""Returns, rolling statistics, lags and scores over one series at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.common import pair_count, pearson
from riskspark.functions.numeric import flag
from riskspark.operators.calendar import by_series, densify, ffill, trading_calendar


def _frame(rows: int, keys: tuple[str, ...]):
    return by_series(*keys).rowsBetween(-(rows - 1), 0)


def _gated(stat, c: Column | str, rows: int, least: int, keys: tuple[str, ...]) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    w = _frame(rows, keys)
    return F.when(F.count(c).over(w) >= least, stat(c).over(w))


def roll_std(c, rows: int, least: int, *keys: str) -> Column:
    return _gated(F.stddev_samp, c, rows, max(least, 2), keys)


def roll_mean(c, rows: int, least: int, *keys: str) -> Column:
    return _gated(F.avg, c, rows, least, keys)


def roll_corr(x: Column, y: Column, rows: int, least: int, *keys: str) -> Column:
    w = _frame(rows, keys)
    return F.when(pair_count(x, y).over(w) >= least, pearson(x, y, w))


def roll_zscore(c: str, rows: int, least: int, *keys: str) -> Column:
    sd = F.nullif(roll_std(c, rows, least, *keys), F.lit(0.0))
    return (F.col(c) - roll_mean(c, rows, least, *keys)) / sd


def lag(c: str, k: int, *keys: str) -> Column:
    return F.lag(c, k).over(by_series(*keys))


def lead(c: str, k: int, *keys: str) -> Column:
    return F.lead(c, k).over(by_series(*keys))


def velocity(c: str, *keys: str) -> Column:
    return F.col(c) - lag(c, 1, *keys)


def log_return(c: str, *keys: str) -> Column:
    return F.ln(F.col(c) / lag(c, 1, *keys))


def pct_return(c: str, *keys: str) -> Column:
    return F.col(c) / lag(c, 1, *keys) - 1


def drawdown(c: str, *keys: str) -> Column:
    peak = F.max(c).over(by_series(*keys).rowsBetween(W.unboundedPreceding, 0))
    return (F.col(c) - peak) / peak


def price_panel(prices: DataFrame) -> DataFrame:
    """Every ticker on every trading day, gaps carried forward."""
    grid = densify(prices, ["ticker"], trading_calendar(prices))
    return grid.withColumn("price", ffill("price", "ticker"))


def returns(prices: DataFrame) -> DataFrame:
    """Log return and 5-day volatility per ticker-day."""
    out = price_panel(prices).withColumn("ret", log_return("price", "ticker"))
    return out.withColumn("vol5", roll_std("ret", 5, 2, "ticker"))


def regime_flag(panel: DataFrame, ticker: str) -> DataFrame:
    """1 when the market ticker trades above its 20-day mean. The mean of a flat window
    is its price, whatever the sum rounds to, so a flat price is never above it."""
    one = panel.filter(F.col("ticker") == ticker)
    w = _frame(20, ("ticker",))
    flat = F.min("price").over(w) == F.max("price").over(w)
    above = ~flat & (F.col("price") > roll_mean("price", 20, 5, "ticker"))
    return one.select("date", flag(above).alias("market_regime_flag"))


def zscore_global(df: DataFrame, value: str, keys: list[str], fit_until: str | None = None) -> DataFrame:
    """(x - mean) / σ over the whole series, or over days up to ``fit_until``; series
    without spread get NULL."""
    base = df.filter(F.col("date") <= F.lit(fit_until).cast("date")) if fit_until else df
    moments = base.groupBy(*keys).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    return df.join(moments, keys, "left").withColumn(
        f"z_{value}", F.when(F.col("_sd") > 0, (F.col(value) - F.col("_mu")) / F.col("_sd"))
    ).drop("_mu", "_sd")
