"""Least squares from cross-product sums.

One pass adds up z·zᵀ per group, with z = (1, columns...), inside the tasks; only
k x k partial sums are shuffled. Every fit in this package (ridge, cross-validated
ridge, lag regressions, unit-root and causality tests, vector autoregression) is a
small solve on such a matrix, done per group in parallel, never on the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

_FLUSH = 2_000  # groups held by one task before it emits its partial sums


def gram(df: DataFrame, keys: list[str], cols: list[str], zero: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """(keys, i, j, v) for i <= j; index 0 is the constant, i >= 1 is cols[i - 1].
    Rows with a missing value are left out, but columns in ``zero`` count as 0 there.
    Both rules run on the arrays: stating them as filters over dozens of columns makes
    the optimizer derive constraints without end."""
    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    k = len(cols) + 1
    filled = [i for i, c in enumerate(cols) if c in set(zero)]
    iu, ju = np.triu_indices(k)

    def emit(acc):
        frames = []
        for key, g in acc.items():
            f = pd.DataFrame({"i": iu, "j": ju, "v": g[iu, ju]})
            for name, value in zip(keys, key):
                f[name] = value
            frames.append(f)
        return pd.concat(frames)[[*keys, "i", "j", "v"]]

    def partial(batches):
        acc: dict = {}
        for pdf in batches:
            groups = pdf.groupby(keys, sort=False, dropna=False) if keys else [((), pdf)]
            for key, part in groups:
                v = part[cols].to_numpy(dtype=float)
                v[:, filled] = np.nan_to_num(v[:, filled])
                v = v[~np.isnan(v).any(axis=1)]
                z = np.column_stack([np.ones(len(v)), v])
                acc[key] = acc.get(key, 0.0) + z.T @ z
            if len(acc) >= _FLUSH:
                yield emit(acc)
                acc = {}
        if acc:
            yield emit(acc)

    types = dict(rows.dtypes)
    schema = ", ".join([*[f"{c} {types[c]}" for c in keys], "i int", "j int", "v double"])
    return rows.mapInPandas(partial, schema).groupBy(*keys, "i", "j").agg(F.sum("v").alias("v"))


def matrix(pdf: pd.DataFrame) -> np.ndarray:
    """Symmetric matrix of one group's (i, j, v) rows."""
    k = int(pdf["j"].max()) + 1
    g = np.zeros((k, k))
    g[pdf["i"], pdf["j"]] = pdf["v"]
    return g + np.triu(g, 1).T


def solve_groups(g: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """Apply fn(key tuple, k x k rows) per group; a group holds k(k+1)/2 rows."""
    if keys:
        return g.groupBy(*keys).applyInPandas(lambda key, pdf: fn(key, pdf), schema)
    return g.groupBy(F.lit(0).alias("_g")).applyInPandas(lambda key, pdf: fn((), pdf), schema)


def ols(g: np.ndarray, x: list[int], y: int) -> dict:
    """Coefficients, residual sum of squares and standard errors from a matrix.
    Index 0 (constant) must be listed in x to be fitted."""
    a, b = g[np.ix_(x, x)], g[x, y]
    scale = np.sqrt(np.clip(np.diag(a), 1e-300, None))
    inv = np.linalg.pinv(a / np.outer(scale, scale), rcond=1e-12) / np.outer(scale, scale)
    coef = inv @ b
    rss = max(float(g[y, y] - coef @ b), 0.0)
    df = g[0, 0] - len(x)
    s2 = rss / df if df > 0 else float("nan")
    se = np.sqrt(np.clip(np.diag(inv) * s2, 0, None))
    return {"coef": coef, "rss": rss, "n": float(g[0, 0]), "se": se, "df": df}


def scaled(g: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """The matrix the same rows would give after (x - mean) / sd on every column."""
    t = np.eye(len(g))
    t[1:, 0] = -mean / sd
    t[1:, 1:] = np.diag(1.0 / sd)
    return t @ g @ t.T


def moments(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column means and population deviations (0 becomes 1, as a scaler does)."""
    mean = g[0, 1:] / g[0, 0]
    var = np.clip(np.diag(g)[1:] / g[0, 0] - mean ** 2, 0, None)
    sd = np.sqrt(var)
    return mean, np.where(sd <= 1e-12 * np.maximum(np.abs(mean), 1e-12), 1.0, sd)


def ridge(g: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """Intercept and coefficients, last column the target; the intercept is free."""
    n = g[0, 0]
    mean = g[0, 1:] / n
    c = g[1:, 1:] - n * np.outer(mean, mean)
    b = np.linalg.solve(c[:-1, :-1] + alpha * np.eye(len(c) - 1), c[:-1, -1])
    return float(mean[-1] - mean[:-1] @ b), b


def r2(g: np.ndarray, intercept: float, coef: np.ndarray) -> tuple[float, float]:
    """R squared and mean squared error of a linear rule on the matrix's rows."""
    v = np.concatenate([[-intercept], -coef, [1.0]])
    sse = float(v @ g @ v)
    n = g[0, 0]
    sst = float(g[-1, -1] - g[0, -1] ** 2 / n)
    return (1 - sse / sst if sst > 0 else float("nan")), sse / n
