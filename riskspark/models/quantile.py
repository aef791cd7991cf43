"""Quantile regression by iteratively reweighted least squares.

Each pass is one weighted cross-product sum over the rows, for all groups and all
quantiles together; the driver keeps one coefficient vector per group and quantile.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskspark.models import gram as gm


def fit(rows: DataFrame, key: str, features: list[str], target: str, probs: list[float],
        l1: float = 0.1, passes: int = 20, floor: float = 1e-6) -> dict[tuple[str, float], np.ndarray]:
    """{(key, q): (intercept, coefficients...)}. ``rows`` should be a written table:
    it is scanned once per pass."""
    k = len(features) + 1
    cols = [*features, target]
    state: dict = {}
    data = rows.select(key, *[F.col(c).cast("double").alias(c) for c in cols])
    iu, ju = np.triu_indices(k + 1)

    def sums(current):
        def partial(batches):
            acc: dict = {}
            for pdf in batches:
                for name, part in pdf.groupby(key, sort=False):
                    v = part[cols].to_numpy(dtype=float)
                    v = v[~np.isnan(v).any(axis=1)]
                    z = np.column_stack([np.ones(len(v)), v])
                    for q in probs:
                        beta = current.get((name, q))
                        if beta is None:
                            w = np.ones(len(z))
                        else:
                            e = z[:, -1] - z[:, :-1] @ beta
                            w = np.where(e > 0, q, 1 - q) / np.maximum(np.abs(e), floor)
                        old = acc.get((name, q), (0.0, 0))
                        acc[name, q] = (old[0] + (z * w[:, None]).T @ z, old[1] + len(z))
            for (name, q), (g, n) in acc.items():
                yield pd.DataFrame({key: name, "q": q, "i": iu, "j": ju, "v": g[iu, ju], "n": n})

        out = data.mapInPandas(partial, f"{key} string, q double, i int, j int, v double, n long")
        return out.groupBy(key, "q", "i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toPandas()

    for _ in range(passes + 1):
        step = {}
        for (name, q), part in sums(state).groupby([key, "q"]):
            g, n = gm.matrix(part), int(part["n"].iloc[0])
            a, b = g[:-1, :-1].copy(), g[:-1, -1]
            old = state.get((name, q))
            if old is not None and l1:
                idx = np.arange(1, k)
                a[idx, idx] += n * l1 / np.maximum(np.abs(old[1:]), floor)
            step[name, q] = np.linalg.lstsq(a, b, rcond=None)[0]
        state = step
    return state


def standardised(split: DataFrame, key: str, features: list[str]) -> DataFrame:
    """The features less their training mean, over their training deviation where that
    is not zero. ``split`` has is_train; the other columns stay."""
    m = split.filter("is_train").groupBy(key).agg(*[F.avg(c).alias(f"_m_{c}") for c in features],
                                                  *[F.stddev_pop(c).alias(f"_s_{c}") for c in features])
    scale = lambda c: F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)
    return split.join(m, key).select(*[
        ((F.col(c) - F.col(f"_m_{c}")) / scale(c)).alias(c) if c in features else c for c in split.columns])


def predict(df: DataFrame, key: str, features: list[str], models: dict, names: dict[float, str]) -> DataFrame:
    """Add one column per quantile. Coefficients become literals of the plan."""
    out = df
    for q, name in names.items():
        col = F.lit(None).cast("double")
        for (group, p), beta in models.items():
            if p == q:
                lin = F.lit(float(beta[0]))
                for f, b in zip(features, beta[1:]):
                    lin = lin + F.lit(float(b)) * F.col(f)
                col = F.when(F.col(key) == group, lin).otherwise(col)
        out = out.withColumn(name, col)
    return out


def ordered(df: DataFrame, low: str, mid: str, high: str, floor: float | None = None) -> DataFrame:
    """Keep low <= mid <= high (and low >= floor)."""
    lo = F.least(F.col(low), F.col(mid))
    if floor is not None:
        lo = F.greatest(lo, F.lit(floor))
    return df.withColumns({low: lo, high: F.greatest(F.col(high), F.col(mid))})
