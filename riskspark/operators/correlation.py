"""Rolling, lagged and pairwise correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from riskspark.common import dimension, pair_count, pearson
from riskspark.operators.calendar import by_series


def listed_pairs(spark: SparkSession, portfolios: dict[str, list[str]]) -> DataFrame:
    """Ticker pairs of the configured portfolios: sized by configuration, not by data."""
    rows = [(p, a, b) for p, members in portfolios.items() for a, b in combinations(sorted(members), 2)]
    return dimension(spark, rows, "portfolio string, a string, b string")


def pair_correlation(returns: DataFrame, pairs: DataFrame) -> DataFrame:
    """Whole-sample correlation of each listed pair, by two equi-joins."""
    a = returns.select(F.col("ticker").alias("a"), "date", F.col("ret").alias("ra"))
    b = returns.select(F.col("ticker").alias("b"), "date", F.col("ret").alias("rb"))
    both = pairs.join(a, "a").join(b, ["b", "date"])
    return both.groupBy("portfolio", "a", "b").agg(
        pair_count(F.col("ra"), F.col("rb")).alias("n"), pearson(F.col("ra"), F.col("rb")).alias("r"))


def mean_pair_correlation(returns: DataFrame, bridge: DataFrame, rows: int = 20, least: int = 5) -> DataFrame:
    """Mean rolling correlation over all ticker pairs of a portfolio, without forming
    the pairs.

    With u the window's returns centred and scaled to unit length, a pair's
    correlation is the dot product of its u's, and the sum over pairs follows from
    the square of their sum. A ticker listed inside the window has a shorter history
    of length L, and a pair uses the shorter of its two histories. So for each
    length l met that day, pairs with min(L) = l are the pairs among L >= l less the
    pairs among L > l, both taken over the last l days. Work is linear in tickers.
    """
    w = by_series("ticker").rowsBetween(-(rows - 1), 0)
    hist = returns.select("ticker", "date", "ret", F.collect_list("ret").over(w).alias("h"))
    hist = hist.filter(F.col("ret").isNotNull() & (F.size("h") >= least)).drop("ret")
    day = hist.join(bridge, "ticker").withColumn("len", F.size("h"))
    lengths = F.collect_set("len").over(W.partitionBy("portfolio", "date"))
    day = day.withColumn("met", lengths).withColumn("l", F.explode("met")).filter(F.col("l") <= F.col("len"))
    day = day.withColumn("h", F.slice("h", F.col("len") - F.col("l") + 1, F.col("l")))
    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)
    day = day.withColumn("m", total(F.col("h")) / F.col("l"))
    day = day.withColumn("h", F.transform("h", lambda v: v - F.col("m")))
    day = day.withColumn("s", F.sqrt(total(F.transform("h", lambda v: v * v)))).filter("s > 0")
    day = day.withColumn("u", F.transform("h", lambda v: v / F.col("s")))
    longer = F.col("len") > F.col("l")
    sums = [F.sum(F.get("u", F.lit(k))).alias(f"a{k}") for k in range(rows)]
    sums += [F.sum(F.when(longer, F.get("u", F.lit(k)))).alias(f"b{k}") for k in range(rows)]
    agg = day.groupBy("portfolio", "date", "l").agg(
        F.count(F.lit(1)).alias("na"), F.count_if(longer).alias("nb"), *sums)
    sq = lambda p: sum((F.coalesce(F.col(f"{p}{k}") * F.col(f"{p}{k}"), F.lit(0.0)) for k in range(rows)), F.lit(0.0))
    na, nb = F.col("na"), F.col("nb")
    part = agg.select("portfolio", "date", ((sq("a") - sq("b") - (na - nb)) / 2).alias("dots"),
                      (na * (na - 1) / 2 - nb * (nb - 1) / 2).alias("pairs"))
    return part.groupBy("portfolio", "date").agg(
        F.try_divide(F.sum("dots"), F.sum("pairs")).alias("intra_corr")).filter("intra_corr IS NOT NULL")


def lagged_correlations(df: DataFrame, keys: list[str], x: str, y: str, max_lag: int, least: int = 0) -> DataFrame:
    """corr(x[t-k], y[t]) for k = 0..max_lag on complete rows of each series, in one
    window and one aggregate; a constant side counts as 0. With ``least``, series of
    fewer complete rows or with a constant side are left out."""
    full = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    w = W.partitionBy(*keys).orderBy("date")
    full = full.withColumns({f"_x{k}": F.lag(x, k).over(w) for k in range(max_lag + 1)})
    agg = full.groupBy(*keys).agg(*[pearson(F.col(f"_x{k}"), F.col(y)).alias(f"_r{k}") for k in range(max_lag + 1)])
    if least:
        sides = full.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), (F.min(x) < F.max(x)).alias("_x"), (F.min(y) < F.max(y)).alias("_y"))
        agg = agg.join(sides.filter((F.col("_n") >= least) & F.col("_x") & F.col("_y")).select(*keys), keys, "left_semi")
    cells = F.array(*[F.struct(F.lit(k).alias("lag"), F.coalesce(f"_r{k}", F.lit(0.0)).alias("r"))
                      for k in range(max_lag + 1)])
    return agg.select(*keys, F.inline(cells))


def peak_lag(ccf: DataFrame, keys: list[str]) -> DataFrame:
    """Lag of the largest |r| per series, the smallest among ties; none if all are 0."""
    best = F.max(F.struct(F.abs("r").alias("_a"), (-F.col("lag")).alias("_l"), "r")).alias("_b")
    return ccf.groupBy(*keys).agg(best).filter("_b._a > 0").select(
        *keys, (-F.col("_b._l")).alias("lag"), F.col("_b.r").alias("r"))


def predictive_power(df: DataFrame, domains: list[str]) -> DataFrame:
    """|corr(previous news day's sentiment, return)| as a portfolio x domain table."""
    r = df.groupBy("portfolio", "domain").agg(
        F.abs(pearson(F.col("news_lag1_sentiment_score"), F.col("ret"))).alias("abs_r"))
    return r.groupBy("portfolio").pivot("domain", domains).agg(F.first("abs_r")).fillna(0.0)


def correlation_table(df: DataFrame, cols: list[str], warn: float = 0.7) -> DataFrame:
    """All column pairs' correlation on complete rows, from one cross-product pass."""
    import numpy as np
    import pandas as pd

    from riskspark.models import gram as gm

    def pairs(_, pdf):
        m = gm.matrix(pdf)
        mean = m[0, 1:] / m[0, 0]
        c = m[1:, 1:] / m[0, 0] - np.outer(mean, mean)
        sd = np.sqrt(np.diag(c))
        return pd.DataFrame([(cols[i], cols[j], float(c[i, j] / (sd[i] * sd[j])) if sd[i] * sd[j] > 0 else None)
                             for i in range(len(cols)) for j in range(i + 1, len(cols))], columns=["a", "b", "r"])

    out = gm.solve_groups(gm.gram(df, [], cols), [], pairs, "a string, b string, r double")
    return out.withColumn("high", F.abs("r") > warn)
