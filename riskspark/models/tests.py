"""Significance tests: data passes are Spark aggregates, tail probabilities are
evaluated on the few resulting rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K
from riskspark.functions import dist
from riskspark.functions.numeric import flag


def with_pearson_p(df: DataFrame) -> DataFrame:
    @F.pandas_udf("double")
    def p(r: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) else dist.pearson_p(a, int(b)) for a, b in zip(r, n)], dtype="float64")
    return df.withColumn("p_value", p("r", "n"))


def news_market_flags(domain_days: DataFrame, returns: DataFrame, domain: str = "geopolitical",
                      ticker: str = K.MARKET_TICKER) -> DataFrame:
    """a: sentiment below its median; b: market return below zero (unknown counts 0)."""
    news = domain_days.filter(F.col("domain") == domain).select("date", "sentiment_score")
    mid = news.select(F.percentile("sentiment_score", F.lit(0.5))).scalar()
    market = returns.filter(F.col("ticker") == ticker).select("date", "ret")
    return market.join(news, "date").select(flag(F.col("sentiment_score") < mid).alias("a"),
                                            flag(F.col("ret") < 0).alias("b"))


def archetype_returns(returns: DataFrame, archetypes: DataFrame) -> DataFrame:
    """Equal-weight daily return of each archetype."""
    return returns.join(archetypes, "ticker").groupBy("archetype", "date").agg(
        F.avg("ret").alias("ret")).filter("ret IS NOT NULL")


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way F from group sums."""
    g = df.groupBy(group).agg(F.count(value).alias("n"), F.sum(value).alias("s"), F.var_pop(value).alias("v"))
    t = g.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"),
              F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"), F.sum(F.col("v") * F.col("n")).alias("within"))
    ss = F.col("between") - F.col("s") * F.col("s") / F.col("n")
    f = F.try_divide(ss / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k")))
    return t.select(f.alias("f_stat"), (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"))


def chi2_yates(df: DataFrame, a, b) -> DataFrame:
    """2x2 independence with continuity correction."""
    n = [F.count_if((a == i) & (b == j)).cast("double").alias(f"n{i}{j}") for i in (0, 1) for j in (0, 1)]
    t = df.agg(*n)
    c = {k: F.col(f"n{k}") for k in ("00", "01", "10", "11")}
    total = c["00"] + c["01"] + c["10"] + c["11"]
    det = F.abs(c["00"] * c["11"] - c["01"] * c["10"])
    gap = F.greatest(det - F.least(total / 2, det), F.lit(0.0))
    den = (c["00"] + c["01"]) * (c["10"] + c["11"]) * (c["00"] + c["10"]) * (c["01"] + c["11"])
    return t.select(F.try_divide(total * gap * gap, den).alias("chi2"), total.alias("n"))


def p_values(rank_sum: DataFrame, anova: DataFrame, chi2: DataFrame) -> DataFrame:
    """(test, statistic, p_value) of the one-row results of the three tests."""
    none = F.lit(None).cast("double")
    rows = [rank_sum.select(F.lit("ranksum").alias("test"), F.col("z").alias("statistic"), none.alias("d1"), none.alias("d2")),
            anova.select(F.lit("anova"), "f_stat", F.col("df_between").cast("double"), F.col("df_within").cast("double")),
            chi2.select(F.lit("chi2"), "chi2", F.lit(1.0), none)]

    @F.pandas_udf("double")
    def tail(test: pd.Series, x: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        by = {"ranksum": lambda v, a, b: dist.normal_sf2(v), "anova": dist.f_sf, "chi2": lambda v, a, b: dist.chi2_sf(v, a)}
        return pd.Series([None if pd.isna(v) else by[t](v, a, b) for t, v, a, b in zip(test, x, d1, d2)], dtype="float64")

    both = rows[0].union(rows[1]).union(rows[2])
    return both.select("test", "statistic", tail("test", "statistic", "d1", "d2").alias("p_value"))


def _squares(x, mean):
    return F.aggregate(x, F.lit(0.0), lambda a, e: a + (e - mean) * (e - mean))


def bootstrap_t(df: DataFrame, group: str, value: str, first: str, second: str, draws: int = 1000, size: int = 5,
                seed: int = 42) -> DataFrame:
    """Repeated small samples: mean t statistic and share with p < .05. Draws are
    hashed row positions, so a retried task draws the same rows, and they meet the
    population by an equi-join on the position."""
    from pyspark.sql import Window as W
    pop = df.filter(F.col(group).isin(first, second)).select(
        F.col(group).alias("arm"), F.col(value).alias("v"),
        F.row_number().over(W.partitionBy(group).orderBy("date")).alias("pos"))
    sizes = pop.groupBy("arm").agg(F.max("pos").alias("n"))
    ask = sizes.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).withColumn(
        "slot", F.explode(F.sequence(F.lit(1), F.lit(size))))
    ask = ask.withColumn("pos", (F.pmod(F.xxhash64("arm", "draw", "slot", F.lit(seed)), F.col("n")) + 1).cast("int"))
    # The few values of a draw are folded in slot order: sums in the order of arrival
    # would differ in their last bit from run to run.
    held = ask.join(pop, ["arm", "pos"]).groupBy("draw").agg(*[
        F.array_sort(F.collect_list(F.when((F.col("arm") == arm) & F.col("v").isNotNull(), F.struct("slot", "v")))).alias(n)
        for arm, n in ((first, "x1"), (second, "x2"))])
    zero, cols = F.lit(0.0), {}
    for i in "12":
        x = F.transform(f"x{i}", lambda e: e["v"])
        mean = F.try_divide(F.aggregate(x, zero, lambda a, e: a + e), F.size(x))
        cols[f"m{i}"] = mean
        cols[f"v{i}"] = F.try_divide(_squares(x, mean), F.nullif(F.size(x) - 1, F.lit(0)))
    s = held.select("draw", *[c.alias(n) for n, c in cols.items()])
    t = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt((F.col("v1") + F.col("v2")) / size))

    @F.pandas_udf("double")
    def p(ts: pd.Series) -> pd.Series:
        return ts.map(lambda x: dist.t_sf2(x, 2 * size - 2) if pd.notna(x) else None)

    return s.select(t.alias("t")).agg(F.avg(F.col("t").cast("decimal(38,18)")).cast("double").alias("mean_t"),
                                      F.avg((p("t") < 0.05).cast("double")).alias("share_significant"),
                                      F.count(F.lit(1)).alias("draws"))
