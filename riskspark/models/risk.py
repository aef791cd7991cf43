"""Tree models beside the linear ones."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from riskspark.models import ridge as rg
from riskspark.operators import calendar as cal
from riskspark.operators.summary import eval_regression


def nonlinear_check(frame: DataFrame, key: str, features: list[str], target: str, groups: list[str],
                    gain: float = 0.05, rounds: int = 20) -> DataFrame:
    """Boosted trees against ridge on the same holdout, per configured group."""
    rows = cal.split_time(frame.select(key, "date", *features, target).dropna(), [key])
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(rows).select(
        key, "date", target, "is_train", "features")
    parts = []
    for g in groups:
        one = rows.filter(F.col(key) == g)
        gbt = GBTRegressor(maxIter=rounds, maxDepth=3, seed=42, labelCol=target, predictionCol="p")
        parts.append(gbt.fit(one.filter("is_train")).transform(one.filter("NOT is_train")).select(key, target, "p"))
    trees = eval_regression(reduce(lambda a, b: a.unionByName(b), parts), [key], target, "p").select(
        key, F.col("r2").alias("tree_r2"))
    linear = rg.fit(frame, key, features, target, [1.0]).groupBy(key).agg(F.first("r2").alias("ridge_r2"))
    return linear.join(trees, key).withColumn("nonlinear", F.col("tree_r2") - F.col("ridge_r2") > gain)


def regime_report(df: DataFrame, features: list[str], label: str = "regime", trees: int = 100) -> DataFrame:
    """Random-forest regimes: precision, recall, F1 and support per class on a 20%
    holdout. The split hashes the row key, so it is the same on every run and retry."""
    t = df.fillna(0.0, subset=features).withColumn("label", F.col(label).cast("double"))
    t = VectorAssembler(inputCols=features, outputCol="features").transform(t)
    test = F.pmod(F.xxhash64("ticker", "date", F.lit(42)), F.lit(100)) >= 80
    model = RandomForestClassifier(numTrees=trees, seed=42).fit(t.filter(~test))
    p = model.transform(t.filter(test)).select("label", "prediction")
    counts = p.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    by_label = counts.groupBy("label").agg(hit.alias("tp"), F.sum("n").alias("support"))
    by_pred = counts.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    out = by_label.join(by_pred, "label", "left")
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.try_divide(F.col("tp"), F.col("support"))
    return out.select(F.col("label").cast("int").alias("regime"), prec.alias("precision"), rec.alias("recall"),
                      F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"), "support")
