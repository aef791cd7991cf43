"""The driver's tables in the shapes the operators expect.

Tickers come from part brands, prices from line items, articles from orders,
headlines from every line of every document, and web items from whole pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark import constants as K
from riskspark.common import dimension
from riskspark.functions import dates

#: The default polarity words, and frequent ones that the test texts hold.
LEXICON = {**K.LEXICON, "pour": 0.2, "with": 0.1, "was": -0.1, "nicht": -0.4, "pas": -0.4}
TICKERS = sorted({t for members in K.PORTFOLIOS.values() for t in members})


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _ticker():
    number = F.try_element_at(F.split("p_brand", "#"), F.lit(2)).try_cast("int")
    names = F.array(*[F.lit(t) for t in TICKERS])
    return F.coalesce(F.get(names, number - 1), F.col("p_brand"))


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    """One row per trade: ticker, trading day, quantity, amount, trade key. Weekend trades
    count for the next Monday, as articles do."""
    part = table(spark, sf, "part").select("p_partkey", _ticker().alias("ticker"))
    line = table(spark, sf, "lineitem").select(
        "l_partkey", dates.roll_weekend(F.to_date("l_shipdate")).alias("date"), "l_quantity", "l_extendedprice",
        "l_orderkey", "l_linenumber")
    return line.join(part, line.l_partkey == part.p_partkey).select(
        "ticker", "date", F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"), "l_orderkey", "l_linenumber")


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Daily price per ticker: amount-weighted average over the day's trades."""
    return ticks(spark, sf).groupBy("ticker", "date").agg(
        (F.sum("amount") / F.sum("quantity")).alias("price"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Scored articles. The score uses odd moduli so daily means have no decimal ties."""
    rank = F.left("o_orderpriority", F.lit(1))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("article_id"),
        F.to_date("o_orderdate").alias("date"),
        F.concat(F.lit("desk-"), F.col("o_custkey") % 7).alias("source"),
        F.when(rank.isin("1", "2"), "geopolitical").when(rank == "3", "financial")
         .otherwise("technology").alias("domain"),
        F.concat(F.lit("Customer "), "o_custkey", F.lit(" moves the market")).alias("headline"),
        F.concat(F.lit("https://news.example.com/"), "o_orderkey").alias("url"),
        F.when(F.col("o_orderstatus") == "F", "negative").when(F.col("o_orderstatus") == "O", "Neutral")
         .otherwise("positive").alias("tone_label"),
        (F.lit(0.5) + F.col("o_totalprice") % 997 / F.lit(1999)).alias("tone_score"),
    )


def headlines(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document as a raw headline, with desk branding and
    topical openings attached by key so that each filter meets both outcomes."""
    lines = table(spark, sf, "documents").select(
        "doc_id", "source", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    k = (F.col("doc_id") + F.col("line_no")) % 12
    opening = (F.when(k == 3, "Live updates: ").when(k == 4, "AI chips: ").when(k == 5, "Air raid: ")
               .when(k == 6, "software &amp; cloud:  ").when(k == 7, "NATO sanctions: ")
               .when(k == 8, "Sensex today: ").otherwise(""))
    closing = (F.when(k == 0, " | Reuters").when(k == 1, " — BBC News")
               .when(k == 2, " – Moneycontrol Pro").otherwise(""))
    key = F.concat_ws("-", "doc_id", "line_no")
    return lines.select(
        "doc_id", "line_no", "source",
        F.concat(opening, "line", closing).alias("headline"),
        F.when(k % 3 == 0, F.concat(F.lit("/news/"), key))
         .when(k % 3 == 1, F.concat(F.lit("https://www.example.com./markets/"), key))
         .otherwise(F.concat(F.lit("https://www.example.com/video/"), key)).alias("url"),
        F.date_add(F.lit("2021-01-04").cast("date"), (F.col("doc_id") % 1500).cast("int")).alias("date"),
    )


def portfolio_map(spark: SparkSession, portfolios: dict | None = None) -> DataFrame:
    rows = [(p, t) for p, members in (portfolios or K.PORTFOLIOS).items() for t in members]
    return dimension(spark, rows, "portfolio string, ticker string")


def domain_weights(spark: SparkSession, weights: dict | None = None) -> DataFrame:
    rows = [(p, d, w) for p, ws in (weights or K.DOMAIN_WEIGHTS).items() for d, w in ws.items()]
    return dimension(spark, rows, "portfolio string, domain string, weight double")


def cause_effect_pairs(spark: SparkSession) -> DataFrame:
    return dimension(spark, K.CAUSE_EFFECT_PAIRS, "cause string, effect string")

#: Containers of the given pages, which are none of the configured sites.
PAGE_CONTAINERS = {"Pages": "nav li"}
