"""Recovery time after a shock: empirical and regression bands."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window as W, functions as F

from riskspark.models import quantile as qr
from riskspark.operators import ranking as rk

BAND = {0.25: "p25", 0.5: "p50", 0.75: "p75"}


def confident(events: DataFrame, probs: DataFrame, portfolio: str, least: float = 0.75) -> DataFrame:
    """Drop one portfolio's shocks that the classifier does not support."""
    t = events.join(probs.select("date", "p"), "date", "left")
    keep = (F.col("portfolio") != portfolio) | (F.coalesce("p", F.lit(0.0)) >= least)
    return t.filter(keep).drop("p")


def pooled_split(events: DataFrame, order: list[str], share: float = 0.8) -> DataFrame:
    """First 80% of the pool in portfolio order, then date. Positions come from counts
    per portfolio, so the pool is never sorted in one task."""
    e = events.withColumn("sector_label", F.array_position(F.array(*[F.lit(p) for p in order]), F.col("portfolio")) - 1)
    sizes = e.groupBy("portfolio", "sector_label").agg(F.count(F.lit(1)).alias("_c")).withColumn("_g", F.lit(1))
    before = W.partitionBy("_g").orderBy("sector_label").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("portfolio", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                         F.sum("_c").over(W.partitionBy("_g")).alias("_n"))
    pos = F.col("_off") + F.row_number().over(W.partitionBy("portfolio").orderBy("date"))
    return e.join(sizes, "portfolio").withColumn(
        "is_train", pos <= F.greatest(F.lit(1), F.floor(F.col("_n") * share))).drop("_off", "_n")


def impute(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column medians, exact for a pool of any size."""
    out = df
    for c in cols:
        mid = rk.exact_quantiles(df.select(F.col(c).cast("double").alias(c)), [], c, {"m": 0.5}).scalar()
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), mid))
    return out


def band(events: DataFrame, features: list[str], l1: float = 0.1, passes: int = 20) -> DataFrame:
    """P25/P50/P75 days per event, non-crossing, against a boosted point estimate.
    ``events`` is a written table with is_train and complete features."""
    pool = events.withColumn("pool", F.lit("all"))
    models = qr.fit(pool.filter("is_train"), "pool", features, "recovery_days", list(BAND), l1, passes)
    out = qr.ordered(qr.predict(pool, "pool", features, models, BAND), "p25", "p50", "p75", floor=0.0)
    va = VectorAssembler(inputCols=features, outputCol="features")
    gbt = GBTRegressor(maxIter=50, maxDepth=2, stepSize=0.05, seed=42, featuresCol="features",
                       labelCol="recovery_days", predictionCol="gbt")
    model = gbt.fit(va.transform(pool.filter("is_train")))
    return model.transform(va.transform(out)).select(
        "portfolio", "date", "recovery_days", "is_train", "p25", "p50", "p75", "gbt")


def band_quality(scored: DataFrame) -> DataFrame:
    t = scored.filter("NOT is_train")
    err = F.col("recovery_days") - F.col("p50")
    return t.agg(F.avg(F.abs(err)).alias("median_mae"),
                 F.avg(F.abs(F.col("recovery_days") - F.col("gbt"))).alias("boosted_mae"),
                 (1 - F.try_divide(F.sum(err * err), F.var_pop("recovery_days") * F.count(F.lit(1)))).alias("median_r2"),
                 F.avg(F.col("p75") - F.col("p25")).alias("mean_band"), F.count(F.lit(1)).alias("events"))


def empirical_band(events: DataFrame, key: str) -> DataFrame:
    """Observed quartiles of recovery time per key."""
    return rk.exact_quantiles(events, [key], "recovery_days", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
