"""Ridge models: next-day volatility and domain sensitivity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K
from riskspark.models import gram as gm
from riskspark.operators import calendar as cal


def _folds(folds: int):
    """Contiguous folds over the training rows, -1 for the holdout."""
    cut = F.greatest(F.lit(1), F.floor(F.col("n") * 0.8))
    k = F.least(F.lit(folds), cut)
    size, extra, i = F.floor(cut / k), cut % k, F.col("rn") - 1
    fold = F.when(i < extra * (size + 1), F.floor(i / (size + 1))).otherwise(
        extra + F.floor((i - extra * (size + 1)) / size))
    return F.when(F.col("rn") <= cut, fold).otherwise(-1).cast("int")


def fit(frame: DataFrame, key: str, features: list[str], target: str, alphas: list[float],
        folds: int = 5) -> DataFrame:
    """Cross-validated ridge per key on standardised features, 80% chronological
    training. One row per feature: coefficient, the feature's training mean and
    deviation, and the key's intercept, alpha, holdout R2 and MSE. All folds and
    penalties come from one pass over the rows."""
    cols = [*features, target]
    rows = cal.position(frame.select(key, "date", *cols).dropna(), [key]).filter("n >= 10")
    rows = rows.withColumn("part", _folds(folds))
    g = gm.gram(rows, [key, "part"], cols)

    def one(k, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {int(p): gm.matrix(rest) for p, rest in pdf.groupby("part")}
        train = sum(m for p, m in parts.items() if p >= 0)
        test = parts.get(-1, train)
        mean, sd = gm.moments(train)
        mean[-1], sd[-1] = 0.0, 1.0
        z = {p: gm.scaled(m, mean, sd) for p, m in parts.items()}
        whole, hold = gm.scaled(train, mean, sd), gm.scaled(test, mean, sd)
        alpha = alphas[0]
        if len(alphas) > 1:
            means = [np.mean([gm.r2(z[p], *gm.ridge(whole - z[p], a))[0] for p in z if p >= 0]) for a in alphas]
            alpha = alphas[int(np.nanargmax(means))]
        b0, b = gm.ridge(whole, alpha)
        score, mse = gm.r2(hold, b0, b)
        return pd.DataFrame({key: k[0], "feature": features, "coefficient": b, "mean": mean[:-1], "sd": sd[:-1],
                             "intercept": b0, "alpha": alpha, "r2": score, "mse": mse,
                             "n_train": int(train[0, 0])})

    schema = (f"{key} string, feature string, coefficient double, mean double, sd double, intercept double, "
              "alpha double, r2 double, mse double, n_train long")
    return gm.solve_groups(g, [key], one, schema)


def predict(frame: DataFrame, model: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Apply coefficient rows: features are unpivoted and joined, then summed."""
    long = frame.select(key, "date", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])))
    part = F.col("coefficient") * (F.col("value") - F.col("mean")) / F.col("sd")
    ok = F.count("value") == len(features)
    return long.join(model, [key, "feature"]).groupBy(key, "date").agg(
        F.when(ok, F.first("intercept") + F.sum(part)).alias("prediction"))


def attribution(frame: DataFrame, model: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Per-day contribution of each feature: coefficient times its scaled deviation
    from the mean over all complete rows."""
    full = frame.select(key, "date", *features).dropna()
    long = full.select(key, "date", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])))
    mean = long.groupBy(key, "feature").agg(F.avg("value").alias("_mean"))
    part = F.col("coefficient") * (F.col("value") - F.col("_mean")) / F.col("sd")
    return long.join(model.select(key, "feature", "coefficient", "sd"), [key, "feature"]).join(
        mean, [key, "feature"]).select(key, "date", "feature", part.alias("attribution"))


def domain_coefficients(model: DataFrame, key: str, domains: list[str] | None = None) -> DataFrame:
    """Coefficients on each domain's sentiment, one row per key."""
    domains = domains or K.DOMAINS
    return model.groupBy(key).agg(*[
        F.coalesce(F.max(F.when(F.col("feature") == f"sentiment_score_{d}", F.col("coefficient"))), F.lit(0.0))
        .alias(f"m5_coeff_{d}") for d in domains])
