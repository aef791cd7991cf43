"""Descriptive tables behind the study's figures.

Series here are daily aggregates, so a group holds at most one row per day and
the exact ``percentile`` aggregate stays bounded. Pooled data of unbounded size
goes through :mod:`riskspark.operators.ranking`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.common import pair_count, pearson


def monthly_sum(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sum per month; months without rows count 0."""
    month = df.groupBy(*keys, F.trunc("date", "MM").alias("month")).agg(F.sum(value).alias(value))
    span = month.groupBy(*keys).agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"))
    dense = span.select(*keys, F.explode(F.expr("sequence(_lo, _hi, interval 1 month)")).alias("month"))
    return dense.join(month, [*keys, "month"], "left").fillna(0, subset=[value])


def count_share(df: DataFrame, key: str) -> DataFrame:
    """Rows, share and date range per key."""
    c = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
                            F.max("date").alias("last_date"))
    total = df.select(F.count(F.lit(1))).scalar()
    return c.withColumn("share", F.col("rows") / total)


def label_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("tone_label").agg(F.count(F.lit(1)).alias("rows"),
                                        F.bround(F.avg("tone_score"), 4).alias("mean_score"))


def tail_threshold(df: DataFrame, key: str, value: str, q: float = 0.05) -> DataFrame:
    """Low quantile per key, days strictly below it and their share."""
    cut = df.groupBy(key).agg(F.percentile(value, F.lit(q)).alias("threshold"))
    v = F.col(value)
    return df.join(cut, key).groupBy(key).agg(
        F.first("threshold").alias("threshold"), F.count_if(v < F.col("threshold")).alias("days_below"),
        (F.count_if(v < F.col("threshold")) / F.count(v)).alias("share_below"))


def box_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    q = df.groupBy(key).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"))
    v, q1, q3 = F.col(value), F.col("_q")[0], F.col("_q")[2]
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    return df.join(q, key).groupBy(key).agg(
        F.first(q1).alias("q1"), F.first(F.col("_q")[1]).alias("median"), F.first(q3).alias("q3"),
        F.min(F.when(v >= low, v)).alias("whisker_low"), F.max(F.when(v <= high, v)).alias("whisker_high"),
        F.count_if((v < low) | (v > high)).alias("outliers"))


def dist_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, sample deviation and bias-corrected skewness."""
    n = F.count(value)
    fix = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0))
    return df.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                               (F.skewness(value) * fix).alias("skew"))


def histogram(df: DataFrame, key: str, value: str, bins: int) -> DataFrame:
    """Equal-width density histogram; the last bin is closed and empty bins are kept."""
    rows = df.filter(F.col(value).isNotNull())
    span = rows.groupBy(key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.least(F.floor((F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))
    counts = rows.join(span, key).groupBy(key, idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    slots = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return (slots.join(counts, [key, "bin"], "left").fillna(0, subset=["count"])
            .select(key, "bin", (F.col("_lo") + F.col("bin") * width).alias("left_edge"), "count",
                    (F.col("count") / (F.col("_n") * width)).alias("density")))


def kde_grid(df: DataFrame, key: str, value: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid, Scott bandwidth. Each row adds to
    every grid point inside its own task; only (key, point) sums are shuffled."""
    rows = df.filter(F.col(value).isNotNull())
    span = rows.groupBy(key).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_n"),
        (F.stddev_samp(value) * F.pow(F.count(value).cast("double"), F.lit(-0.2))).alias("_h"))
    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    z = (F.col("x") - F.col(value)) / F.col("_h")
    spread = rows.select(key, value).join(span, key).select(
        key, value, "_lo", "_n", "_h", step.alias("_step"), grid).withColumn(
        "x", F.col("_lo") + F.col("point") * F.col("_step"))
    scale = F.first("_n") * F.first("_h") * F.lit(math.sqrt(2 * math.pi))
    return spread.groupBy(key, "point").agg(F.first("x").alias("x"),
                                            (F.sum(F.exp(-z * z / 2)) / scale).alias("density"))


def corr_by(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Correlation, complete-pair count and t statistic per key."""
    out = df.groupBy(*keys).agg(pearson(F.col(x), F.col(y)).alias("r"),
                                pair_count(F.col(x), F.col(y)).alias("n"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return out.withColumn("t_stat", t)


def ols_line(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x))
    return both.groupBy(*keys).agg(slope.alias("slope"), (F.avg(y) - slope * F.avg(x)).alias("intercept"))


def spike_flag(df: DataFrame, key: str, value: str, q: float = 0.95) -> DataFrame:
    """Days whose |value| reaches the given quantile of |value|."""
    cut = df.groupBy(key).agg(F.percentile(F.abs(F.col(value)), F.lit(q)).alias("threshold"))
    return df.join(cut, key).withColumn("is_spike", F.abs(F.col(value)) >= F.col("threshold"))


def shock_vs_regular(df: DataFrame, keys: list[str], driver: str, value: str, q: float = 0.1) -> DataFrame:
    """Mean value on the lowest-driver days against all other days."""
    cut = df.groupBy(*keys).agg(F.percentile(driver, F.lit(q)).alias("_cut"))
    low = F.col(driver) <= F.col("_cut")
    return df.join(cut, keys).groupBy(*keys).agg(
        F.avg(F.when(low, F.col(value))).alias("shock_mean"),
        F.avg(F.when(~low, F.col(value))).alias("regular_mean"),
        F.count_if(low).alias("shock_days"))


def crosstab(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """2x2 counts of two flags."""
    t = df.select(a.alias("a"), b.alias("b"))
    return t.groupBy("a").agg(F.count_if(F.col("b") == 0).alias("b_0"), F.count_if(F.col("b") == 1).alias("b_1"))


def missing_cells(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL count per column, one row per column, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
                      for i, c in enumerate(cols)])
    return counts.select(F.inline(pairs))


def eval_regression(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    t = df.dropna(subset=[actual, predicted])
    e = F.col(actual) - F.col(predicted)
    return t.groupBy(*keys).agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                                (1 - F.try_divide(F.avg(e * e), F.var_pop(actual))).alias("r2"))
