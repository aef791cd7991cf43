"""Tables a dashboard reads: latest rows, recent means, stock table, chart window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from riskspark.common import r


def _latest(key: str):
    return W.partitionBy(key).orderBy(F.desc("date"))


def recent_mean(df: DataFrame, key: str, value: str, rows: int) -> DataFrame:
    """Mean of the last known values per series."""
    known = df.filter(F.col(value).isNotNull()).withColumn("_k", F.row_number().over(_latest(key)))
    return known.filter(F.col("_k") <= rows).groupBy(key).agg(F.avg(value).alias("recent_sentiment"))


def latest_value(df: DataFrame, key: str, order: str, *cols: str) -> DataFrame:
    """Newest row per key by partial aggregation."""
    best = F.max(F.struct(order, *cols)).alias("_b")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_b.{c}").alias(c) for c in (order, *cols)])


def stock_table(panel: DataFrame, bridge: DataFrame, shocks: DataFrame) -> DataFrame:
    """Last price and five-row return per ticker, with its portfolio's latest
    volatility and shock flag; tickers with fewer than six prices are left out."""
    k = panel.filter("price IS NOT NULL").withColumn("_k", F.row_number().over(_latest("ticker"))).filter("_k <= 6")
    p = k.groupBy("ticker").agg(F.max(F.when(F.col("_k") == 1, F.col("price"))).alias("last_price"),
                                F.max(F.when(F.col("_k") == 6, F.col("price"))).alias("_old"))
    now = latest_value(shocks.filter("vol5 IS NOT NULL"), "portfolio", "date", "vol5", "shock")
    out = p.filter("_old IS NOT NULL").join(bridge, "ticker").join(now, "portfolio")
    return out.select(
        "portfolio", "ticker", r("last_price", 2).alias("last_price"),
        r((F.col("last_price") / F.col("_old") - 1) * 100, 2).alias("return_5d"),
        r("vol5", 4).alias("vol5"), F.col("shock").alias("shock_today"))


def tail(df: DataFrame, rows: int) -> DataFrame:
    """Last rows by date; a top-k, not a full sort."""
    return df.orderBy(F.desc("date")).limit(rows)


def chart_window(calendar: DataFrame, panel: DataFrame, domain_days: DataFrame, bridge: DataFrame, rows: int = 60,
                 lines: int = 3) -> DataFrame:
    """One array per portfolio with its last ``rows`` trading days: prices of its first
    ``lines`` members that trade, and every domain's tone. ``bridge`` holds (portfolio, ticker,
    position). Days without a price or tone keep their place."""
    days = tail(calendar.select("date"), rows)
    traded = bridge.join(panel.filter("price IS NOT NULL").select("ticker").distinct(), "ticker", "left_semi")
    first = traded.withColumn("_k", F.row_number().over(W.partitionBy("portfolio").orderBy("position"))).filter(
        F.col("_k") <= lines).select("portfolio", "ticker")
    recent = panel.join(days, "date", "left_semi").select("ticker", "date", r("price", 2).alias("price"))
    entries = lambda *c: F.map_from_entries(F.sort_array(F.collect_list(F.struct(*c))))
    prices = first.join(recent, "ticker").groupBy("portfolio", "date").agg(entries("ticker", "price").alias("prices"))
    tone = domain_days.join(days, "date", "left_semi").select("date", "domain", r("sentiment_score", 4).alias("tone"))
    tone = tone.groupBy("date").agg(entries("domain", "tone").alias("tone"))
    by_date = lambda a, b: F.when(a["date"] < b["date"], -1).when(a["date"] > b["date"], 1).otherwise(0)
    return prices.join(tone, "date", "left").groupBy("portfolio").agg(
        F.array_sort(F.collect_list(F.struct("date", "prices", "tone")), by_date).alias("market_chart"))
