"""Regression on an outside driver with autoregressive moving-average errors.

y = beta x + u (+ constant), u[t] = phi u[t-1] + e[t] + theta e[t-1]. The likelihood is the exact one of
the Kalman recursion for a stationary start: for one lag each, the variance of the next value (over that
of e) and the gain follow from a scalar recursion that does not depend on the data. Driver, constant and
variance are solved in closed form for each (phi, theta), and the two are found on grids that close in on
the best point; all points of a grid share one pass over the days.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskspark.functions import dist
from riskspark.operators import calendar as cal

#: |phi| and |theta| stay below this: stationary and invertible.
EDGE = 0.995
Z95 = 1.959963984540054
FIT = "const double, beta double, t_stat double, p_value double, phi double, theta double, sigma2 double, " \
      "log_likelihood double, n_train long"


def filtered(columns: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-step errors of every column of a days x columns table under each of p parameter
    pairs (days x p x columns), and their relative variances (days x p)."""
    days = len(columns)
    v, r = np.empty((days, len(phi), columns.shape[1])), np.empty((days, len(phi)))
    for t in range(days):
        if t == 0:
            v[0], r[0] = columns[0], (1 + 2 * theta * phi + theta ** 2) / (1 - phi ** 2)
        else:
            gain = (theta / r[t - 1])[:, None]
            v[t] = columns[t] - phi[:, None] * columns[t - 1] - gain * v[t - 1]
            r[t] = 1 + theta ** 2 - theta ** 2 / r[t - 1]
    return v, r


def profile(y: np.ndarray, x: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> dict[str, np.ndarray]:
    """Log-likelihood of each pair at its best coefficients on x (days x k) and variance."""
    v, r = filtered(np.column_stack([y, x]), phi, theta)
    w = v / np.sqrt(r)[:, :, None]
    a = np.einsum("tpi,tpj->pij", w, w)
    inv = np.linalg.pinv(a[:, 1:, 1:], rcond=1e-12, hermitian=True)
    coef = np.einsum("pij,pj->pi", inv, a[:, 1:, 0])
    rss = np.maximum(a[:, 0, 0] - np.einsum("pi,pi->p", coef, a[:, 1:, 0]), 1e-300)
    n = len(y)
    value = -0.5 * (n * (np.log(2 * np.pi * rss / n) + 1) + np.log(r).sum(axis=0))
    return {"loglik": value, "coef": coef, "sigma2": rss / n, "cov": inv, "v": v[-1], "r": r[-1]}


def fit(y: np.ndarray, x: np.ndarray, points: int = 9, tolerance: float = 1e-6) -> dict:
    """The best pair with its profile. Each grid spans the neighbours of the last one's best point."""
    center, half = np.zeros(2), EDGE
    while True:
        axes = [np.clip(np.linspace(c - half, c + half, points), -EDGE, EDGE) for c in center]
        phi, theta = (g.ravel() for g in np.meshgrid(*axes, indexing="ij"))
        p = profile(y, x, phi, theta)
        i = int(np.argmax(p["loglik"]))
        center = np.array([phi[i], theta[i]])
        if half < tolerance:
            return {"phi": phi[i], "theta": theta[i], **{k: a[i] for k, a in p.items()}}
        half *= 3 / (points - 1)


def forecast(model: dict, last_y: float, last_x: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and variances of the days after the last one, given their drivers."""
    phi, theta = model["phi"], model["theta"]
    u = last_y - last_x @ model["coef"]
    error = model["v"][0] - model["v"][1:] @ model["coef"]
    nxt, var = phi * u + theta / model["r"] * error, 1 + theta ** 2 - theta ** 2 / model["r"]
    mean, spread = np.empty(len(ahead)), np.empty(len(ahead))
    for h in range(len(ahead)):
        mean[h], spread[h] = nxt, var
        nxt, var = phi * nxt, phi ** 2 * var + 2 * phi * theta + theta ** 2 + 1
    return mean + ahead @ model["coef"], spread * model["sigma2"]


def armax(rows: DataFrame, key: str, y: str, x: str, constant: bool = False, least: int = 10) -> DataFrame:
    """Fit on the first 80 % of each series and forecast the rest from its drivers: one row
    per forecast day with the mean, its 95 % interval and the fit's figures. Days with a
    missing side and series with fewer than ``least`` training days are left out. A task
    holds one series, which has at most one row a day."""
    t = rows.select(key, "date", F.col(y).alias("y"), F.col(x).alias("x")).dropna()
    t = cal.position(t, [key]).withColumn("cut", F.floor(F.col("n") * 0.8)).filter(F.col("cut") >= least)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn", ignore_index=True)
        cut = int(pdf["cut"].iloc[0])
        yy, xx = pdf["y"].to_numpy(float), pdf[["x"]].to_numpy(float)
        if constant:
            xx = np.column_stack([xx, np.ones(len(xx))])
        m = fit(yy[:cut], xx[:cut])
        mean, var = forecast(m, yy[cut - 1], xx[cut - 1], xx[cut:])
        se = float(np.sqrt(max(m["sigma2"] * m["cov"][0, 0], 0.0)))
        tv = float(m["coef"][0] / se) if se > 0 else 0.0
        half = Z95 * np.sqrt(var)
        return pd.DataFrame({
            key: pdf[key].iloc[cut:], "date": pdf["date"].iloc[cut:], "actual": yy[cut:], "forecast": mean,
            "lower": mean - half, "upper": mean + half, "const": float(m["coef"][1]) if constant else 0.0,
            "beta": float(m["coef"][0]), "t_stat": tv, "p_value": dist.normal_sf2(tv), "phi": float(m["phi"]),
            "theta": float(m["theta"]), "sigma2": float(m["sigma2"]), "log_likelihood": float(m["loglik"]),
            "n_train": cut})

    return t.groupBy(key).applyInPandas(
        one, f"{key} string, date date, actual double, forecast double, lower double, upper double, {FIT}")


def report(path: DataFrame, key: str) -> DataFrame:
    """One row per series: the fit, the driver's verdict, holdout error and interval coverage."""
    names = [c.split()[0] for c in FIT.split(", ")]
    verdict = F.when(F.col("p_value") < 0.05, "significant").when(F.col("p_value") < 0.10, "borderline").otherwise(
        "not significant")
    return path.groupBy(key, *names).agg(
        F.avg(F.pow(F.col("actual") - F.col("forecast"), 2)).alias("mse"),
        F.avg(F.col("actual").between(F.col("lower"), F.col("upper")).cast("double")).alias("coverage"),
        F.count(F.lit(1)).alias("n_test")).withColumn("verdict", verdict)
