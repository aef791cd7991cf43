"""Ordered aggregates that never put one group's rows in one task.

Rows are first combined to distinct values (a value held by a third of all rows
becomes one row) and written once. Values are cut into ordered buckets at approximate
quantiles, as many as keep a bucket near BUCKET_ROWS values; bucket totals are
accumulated over one row per bucket, and running
totals inside a bucket start from the bucket's offset. Results are exact: the
approximation only decides where buckets are cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.common import materialise

BUCKET_ROWS = 200_000


def running_totals(df: DataFrame, keys: list[str], value: str, aggs: dict[str, Column],
                   bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Distinct values per key with their totals and ``cum_*`` totals up to and
    including the value, in ascending order, plus ``all_*`` totals of the key."""
    tag = keys or ["_all"]
    base = df if keys else df.withColumn("_all", F.lit(1))
    base = base.filter(F.col(value).isNotNull())
    distinct = base.groupBy(*tag, value).agg(*[c.alias(n) for n, c in aggs.items()])
    distinct = materialise(distinct, "distinct-values")
    most = distinct.groupBy(*tag).count().agg(F.max("count")).first()[0] or 0
    buckets = max(math.ceil(most / bucket_rows), 2)
    cuts = [F.lit(i / buckets) for i in range(1, buckets)]
    splits = distinct.groupBy(*keys).agg(F.percentile_approx(value, F.array(*cuts), F.lit(max(1000, 16 * buckets))).alias("_cuts"))
    placed = distinct.join(splits, keys) if keys else distinct.withColumn("_cuts", splits.scalar())
    placed = placed.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    names = list(aggs)
    totals = placed.groupBy(*tag, "_b").agg(*[F.sum(n).alias(f"_t_{n}") for n in names])
    before = W.partitionBy(*tag).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*tag)
    offsets = totals.select(
        *tag, "_b", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in names],
        *[F.sum(f"_t_{n}").over(whole).alias(f"all_{n}") for n in names])
    inside = W.partitionBy(*tag, "_b").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    out = placed.join(offsets.drop(*([] if keys else tag)), [*keys, "_b"]).withColumns(
        {f"cum_{n}": F.col(f"_off_{n}") + F.sum(n).over(inside) for n in names})
    return out.select(*keys, value, *names, *[f"cum_{n}" for n in names], *[f"all_{n}" for n in names])


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per key, for groups of any size."""
    ranked = running_totals(df, keys, value, {"n": F.count(F.lit(1))})
    at = lambda i: F.min(F.when(F.col("cum_n") > i, F.col(value)))
    out = []
    for name, p in probs.items():
        pos = (F.col("all_n") - 1) * F.lit(p)
        out += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}"),
                F.max(pos - F.floor(pos)).alias(f"_w_{name}")]
    grouped = ranked.groupBy(*keys).agg(*out)
    return grouped.select(*keys, *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n) for n in probs])


def rank_sum(df: DataFrame, value: str, in_first: Column) -> DataFrame:
    """Two-sample rank-sum z with average ranks and no tie correction."""
    ranked = running_totals(df, [], value, {"n": F.count(F.lit(1)), "n1": F.count_if(in_first)})
    rank = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2
    agg = ranked.agg(F.sum(rank * F.col("n1")).alias("w"), F.max("all_n1").alias("n1"),
                     F.max(F.col("all_n") - F.col("all_n1")).alias("n2"))
    n1, n2 = F.col("n1"), F.col("n2")
    z = (F.col("w") - n1 * (n1 + n2 + 1) / 2) / F.sqrt(n1 * n2 * (n1 + n2 + 1) / F.lit(12.0))
    return agg.select("n1", "n2", z.alias("z"))


def score_curve(df: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """One row per distinct score: positives and negatives at and above it."""
    pos = F.sum(F.col(label).cast("long"))
    curve = running_totals(df, keys, score, {"pos": pos, "neg": F.sum((1 - F.col(label)).cast("long"))})
    return curve.select(
        *keys, F.col(score).alias("threshold"), "pos", "neg", F.col("all_pos").alias("p"),
        F.col("all_neg").alias("q"), (F.col("all_pos") - F.col("cum_pos") + F.col("pos")).alias("tp"),
        (F.col("all_neg") - F.col("cum_neg") + F.col("neg")).alias("fp"))


def eval_binary(df: DataFrame, keys: list[str], score: str, label: str, cut: float = 0.5) -> DataFrame:
    """F1 at a cut, area under the ROC curve and average precision."""
    c = score_curve(df, keys, score, label)
    roc = F.sum(F.col("neg") * (F.col("tp") - F.col("pos")) + F.col("neg") * F.col("pos") / 2)
    hit = F.col("threshold") >= cut
    tp, fp = F.sum(F.when(hit, F.col("pos"))), F.sum(F.when(hit, F.col("neg")))
    out = c.groupBy(*keys).agg(
        F.try_divide(roc, F.max("p") * F.max("q")).alias("auc_roc"),
        F.try_divide(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.max("p")).alias("auc_pr"),
        F.coalesce(F.try_divide(2.0 * tp, tp + fp + F.max("p")), F.lit(0.0)).alias("f1"))
    return out.select(*keys, "f1", "auc_roc", "auc_pr")


def best_threshold(df: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """Threshold with the largest F1 per key; among ties the smallest threshold."""
    f1 = 2.0 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("p"))
    c = score_curve(df, keys, score, label).filter("p > 0 and q > 0").withColumn("f1", f1)
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("_t"))).alias("_b")
    return c.groupBy(*keys).agg(best).select(*keys, (-F.col("_b._t")).alias("threshold"),
                                             F.col("_b.f1").alias("best_f1"))
