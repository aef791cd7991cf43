"""Portfolio profiles and their clustering."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K
from riskspark.common import pearson


def correlation_coefficients(portfolio_days: DataFrame, domain_days: DataFrame, key: str = "portfolio") -> DataFrame:
    """Fallback sensitivities: corr(return, domain sentiment)."""
    both = portfolio_days.select(key, "date", "ret").join(domain_days.select("date", "domain", "sentiment_score"), "date")
    r = both.groupBy(key, "domain").agg(pearson(F.col("ret"), F.col("sentiment_score")).alias("r"))
    wide = r.groupBy(key).pivot("domain", K.DOMAINS).agg(F.first("r"))
    return wide.withColumnsRenamed({d: f"m5_coeff_{d}" for d in K.DOMAINS})


def profile(coef: DataFrame, shocks: DataFrame, intra: DataFrame, composition: DataFrame) -> DataFrame:
    freq = shocks.groupBy("portfolio").agg(F.avg(F.col("shock").cast("double")).alias("mean_shock_frequency"))
    corr = intra.groupBy("portfolio").agg(F.avg("intra_corr").alias("intra_portfolio_correlation"))
    out = coef.join(freq, "portfolio", "left").join(corr, "portfolio", "left").join(composition, "portfolio", "left")
    return out.withColumnRenamed("hhi", "sector_concentration_hhi").fillna(0.0)


def vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """Standardised feature vectors; the sample and population scales differ by one
    common factor, which no cluster assignment depends on."""
    v = VectorAssembler(inputCols=features, outputCol="raw").transform(df)
    return StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(v).transform(v).drop("raw")


def squared_silhouette(df: DataFrame, cluster: str) -> float:
    """Mean silhouette on squared distances: linear in the rows, for any vector table."""
    return ClusteringEvaluator(featuresCol="features", predictionCol=cluster).evaluate(df)


def plain_silhouette(df: DataFrame, cluster: str) -> float:
    """Mean silhouette on plain distances between all pairs, in one task: only for
    portfolio profiles, whose number of rows is that of the configured portfolios."""
    t = df.select(vector_to_array("features").alias("v"), F.col(cluster).cast("int").alias("c"))

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        x, c = np.array(pdf["v"].tolist()), pdf["c"].to_numpy()
        dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        labels = np.unique(c)
        s = []
        for i in range(len(x)):
            own = (c == c[i])
            if own.sum() == 1 or len(labels) < 2:
                s.append(0.0)
                continue
            a = dist[i, own].sum() / (own.sum() - 1)
            b = min(dist[i, c == k].mean() for k in labels if k != c[i])
            s.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
        return pd.DataFrame({"s": [float(np.mean(s))]})

    return t.groupBy(F.lit(0).alias("_g")).applyInPandas(mean, "s double").first()[0]


def choose_k(df: DataFrame, silhouette: Callable[[DataFrame, str], float] = plain_silhouette, limit: int = 4,
             seed: int = 42) -> tuple[list[tuple], int]:
    """(k, silhouette, inertia) for k = 2..min(n - 1, limit), and the best k by the
    silhouette the caller names."""
    n = df.count()
    rows = []
    for k in range(2, min(n - 1, limit) + 1):
        model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="c").fit(df)
        rows.append((k, float(silhouette(model.transform(df), "c")), float(model.summary.trainingCost)))
    best = max(rows, key=lambda r: r[1])[0] if rows else min(2, n)
    return rows, best


def assign(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Flat and top-down clusters with the same k."""
    flat = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="kmeans_cluster").fit(df).transform(df)
    tree = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="hierarchical_cluster")
    return tree.fit(df).transform(flat)


def name_clusters(df: DataFrame, cluster: str, label: str, domains: list[str] | None = None) -> DataFrame:
    """Name each cluster after the domain with the largest |mean coefficient|."""
    domains = domains or K.DOMAINS
    means = df.groupBy(cluster).agg(*[F.abs(F.avg(f"m5_coeff_{d}")).alias(d) for d in domains])
    best = F.array_max(F.array(*[F.struct(F.col(d).alias("a"), F.lit(-i).alias("o"), F.lit(d).alias("d"))
                                 for i, d in enumerate(domains)]))
    names = means.select(cluster, F.concat(F.initcap(best["d"]), F.lit("-Sensitive")).alias(label))
    return df.join(names, cluster)
