"""Next-day shock classifier with walk-forward evaluation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskspark.common import materialise, side_by_side
from riskspark.operators import calendar as cal, ranking as rk, rolling as ro

FrameAt = Callable[[dict[int, dt.date]], DataFrame]


def training_rows(frame: DataFrame, features: list[str], target: str) -> DataFrame:
    """Complete rows with tomorrow's shock as the label."""
    t = frame.select("date", *features, F.col(target).alias("label"), F.lit("all").alias("series"))
    t = t.withColumn("label", ro.lead("label", 1, "series")).dropna()
    return VectorAssembler(inputCols=features, outputCol="features").transform(t).select(
        "series", "date", "label", "features")


def balanced(df: DataFrame) -> DataFrame:
    """Weights n / (2 * class count)."""
    c = df.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p")).first()
    n, p = c["n"], c["p"] or 0
    pos, neg = n / (2.0 * max(p, 1)), n / (2.0 * max(n - p, 1))
    return df.withColumn("weight", F.when(F.col("label") == 1, pos).otherwise(neg))


def classifier(kind: str = "forest", trees: int = 200, depth: int = 4, seed: int = 42):
    """A forest of ``trees`` trees, or ``kind="boosting"`` with as many rounds."""
    common = dict(featuresCol="features", labelCol="label", weightCol="weight", maxDepth=depth, seed=seed)
    if kind == "boosting":
        return GBTClassifier(maxIter=trees, stepSize=0.05, **common)
    return RandomForestClassifier(numTrees=trees, **common)


def score(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("p", F.element_at(vector_to_array("probability"), 2))


def at_cutoffs(split: DataFrame, features: list[str], frame_at: FrameAt) -> DataFrame:
    """The folds' rows with features as they were known at the end of each fold's training
    days; ``frame_at`` maps {fold: last training day} to a frame keyed by (fold, date)."""
    ends = split.filter("is_train").groupBy("fold").agg(F.max("date").alias("until")).collect()
    frame = frame_at({r["fold"]: r["until"] for r in ends}).select("fold", "date", *features)
    rows = split.select("fold", "date", "label", "is_train").join(frame, ["fold", "date"]).dropna(subset=features)
    return VectorAssembler(inputCols=features, outputCol="features").transform(rows).drop(*features)


def walk_forward(rows: DataFrame, folds: int = 3, trees: int = 200, features: list[str] | None = None,
                 frame_at: FrameAt | None = None) -> DataFrame:
    """Out-of-fold shock probabilities; every fold trains on its own past only and, with
    ``frame_at``, on features fitted on that past."""
    split = cal.walk_forward(rows, ["series"], folds)
    if frame_at is not None and not split.isEmpty():
        # A forest draws its samples along the rows of a task, so a fold (one row per day) is one task in order of dates.
        rows = at_cutoffs(split, features, frame_at).repartition(folds, "fold").sortWithinPartitions("fold", "date")
        split = materialise(rows, "fold_rows")

    def scored(k):
        fold = split.filter(F.col("fold") == k).coalesce(1)
        train = fold.filter("is_train")
        seen = {row[0] for row in train.select("label").distinct().collect()}
        if len(seen) < 2:
            return None
        model = classifier(trees=trees).fit(balanced(train))
        return score(model, fold.filter("NOT is_train")).select("fold", "date", "label", "p")

    steps = [lambda k=k: scored(k) for k in range(folds)]
    parts = [part for part in side_by_side(split.sparkSession, *steps) if part is not None]
    if not parts:  # no fold whose past holds both classes
        return split.filter("false").select("fold", "date", "label", F.lit(None).cast("double").alias("p"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def evaluate(scored: DataFrame) -> DataFrame:
    """Per-fold metrics and calibrated threshold, then their mean (median threshold)."""
    lab = scored.withColumn("label", F.col("label").cast("int"))
    m = rk.eval_binary(lab, ["fold"], "p", "label").join(rk.best_threshold(lab, ["fold"], "p", "label"), "fold")
    return m.agg(F.avg("f1").alias("f1"), F.avg("best_f1").alias("f1_calibrated"), F.avg("auc_roc").alias("auc_roc"),
                 F.avg("auc_pr").alias("auc_pr"), F.percentile("threshold", F.lit(0.5)).alias("threshold"),
                 F.count(F.lit(1)).alias("folds"))


def importances(model, features: list[str], spark) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
