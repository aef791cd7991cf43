"""Linear rules as tables: one row per key, rule and feature.

A rule's value is its intercept plus the sum of coefficient x (value - mean) / sd over
its features. Several rules of one key (a point and its quartiles) are applied in one pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

COLUMNS = ["rule", "feature", "coefficient", "mean", "sd", "intercept"]


def from_ridge(model: DataFrame, key: str, rule: str) -> DataFrame:
    return model.select(key, F.lit(rule).alias("rule"), *COLUMNS[1:])


def from_quantiles(spark, fits: dict[tuple[str, float], np.ndarray], key: str, features: list[str],
                   names: dict[float, str], scales: DataFrame | None = None) -> DataFrame:
    """Rows of fitted quantiles, whose number is keys x quantiles x features. ``scales``
    gives (key, feature, mean, sd) where the fit saw standardised features."""
    rows = [(g, names[q], f, float(c), float(beta[0]))
            for (g, q), beta in fits.items() for f, c in zip(features, beta[1:])]
    t = spark.createDataFrame(rows, f"{key} string, rule string, feature string, coefficient double, intercept double")
    if scales is None:
        t = t.withColumns({"mean": F.lit(0.0), "sd": F.lit(1.0)})
    else:
        t = t.join(scales.select(key, "feature", "mean", "sd"), [key, "feature"])
    return t.select(key, *COLUMNS)


def apply(rows: DataFrame, rules: DataFrame, key: str, features: list[str], names: list[str],
          pooled: bool = False) -> DataFrame:
    """(key, date) and one column per named rule; NULL where a feature of the row is
    missing or the key has no such rule. Rows are unpivoted and meet the rules in one
    equi-join, so no rule is unrolled into the plan. ``pooled`` rules hold for all keys."""
    long = rows.select(key, "date", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])))
    part = F.col("coefficient") * (F.col("value") - F.col("mean")) / F.col("sd")
    own = lambda n, c: F.when(F.col("rule") == n, c)
    on = ["feature"] if pooled else [key, "feature"]
    return long.join(rules, on, "left").groupBy(key, "date").agg(*[
        F.when(F.count(own(n, F.col("value"))) == len(features),
               F.max(own(n, F.col("intercept"))) + F.sum(own(n, part))).alias(n) for n in names])


def banded(df: DataFrame, low: str, mid: str, high: str) -> DataFrame:
    """Widen a band until it holds its middle; a missing side becomes 0.7 and 1.3 times it."""
    return df.withColumns({
        low: F.when(F.col(mid).isNotNull(), F.least(F.coalesce(low, F.col(mid) * 0.7), F.col(mid))),
        high: F.when(F.col(mid).isNotNull(), F.greatest(F.coalesce(high, F.col(mid) * 1.3), F.col(mid)))})
