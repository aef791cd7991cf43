"""Lag regressions: unit-root test, causality tests, vector autoregression, and an
autoregression with an outside driver. All from cross-product sums."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from riskspark.functions import dist
from riskspark.models import gram as gm


def _with_lags(df: DataFrame, keys: list[str], col: str, lags: int, prefix: str) -> DataFrame:
    w = W.partitionBy(*keys).orderBy("date")
    return df.withColumns({f"{prefix}{k}": F.lag(col, k).over(w) for k in range(1, lags + 1)})


def _bic(rss: float, n: float, params: int) -> float:
    return n * (math.log(2 * math.pi) + math.log(max(rss, 1e-300) / n) + 1) + math.log(n) * params


def adf(series: DataFrame, key: str, value: str, max_lag: int | None = None) -> DataFrame:
    """Unit-root test with a constant per series; lag order by BIC on a common sample,
    then a refit on the order's own sample. Series with fewer than 12 rows are left
    out; a constant one is reported stationary with p = 1."""
    rows = series.select(key, "date", F.col(value).alias("y")).filter("y IS NOT NULL")
    w = W.partitionBy(key).orderBy("date")
    stats = rows.groupBy(key).agg(F.count("y").alias("n"), (F.min("y") == F.max("y")).alias("constant"))
    rule = F.least(F.ceil(12 * F.pow(F.col("n") / 100, F.lit(0.25))), F.floor(F.col("n") / 2) - 2).cast("int")
    stats = stats.filter("n >= 12").withColumn("cap", rule if max_lag is None else F.least(rule, F.lit(max_lag)))
    top = stats.agg(F.max("cap")).first()[0] or 0
    base = rows.withColumns({"y1": F.lag("y", 1).over(w), "rn": F.row_number().over(w)})
    base = _with_lags(base.withColumn("dy", F.col("y") - F.col("y1")), [key], "dy", top, "d")
    lagged = [f"d{k}" for k in range(1, top + 1)]
    base = base.join(stats.filter("NOT constant"), key)
    cols = ["dy", "y1", *lagged]

    def search(k, pdf):
        g, cap = gm.matrix(pdf), int(pdf["cap"].iloc[0])
        best = min(range(cap + 1), key=lambda p: _bic(
            gm.ols(g, [0, 2, *range(3, 3 + p)], 1)["rss"], g[0, 0], p + 2))
        return pd.DataFrame({key: [k[0]], "lag": [best]})

    common = gm.gram(base.filter("rn > cap + 1"), [key, "cap"], cols, zero=lagged)
    order = gm.solve_groups(common, [key], search, f"{key} string, lag int")

    def final(k, pdf):
        g, p = gm.matrix(pdf), int(pdf["lag"].iloc[0])
        fit = gm.ols(g, [0, 2, *range(3, 3 + p)], 1)
        t = float(fit["coef"][1] / fit["se"][1])
        return pd.DataFrame({key: [k[0]], "lag": [p], "n_obs": [int(g[0, 0])], "statistic": [t],
                             "p_value": [dist.adf_p(t)]})

    own = gm.gram(base.join(order, key).filter("rn > lag + 1"), [key, "lag"], cols, zero=lagged)
    out = gm.solve_groups(own, [key], final, f"{key} string, lag int, n_obs long, statistic double, p_value double")
    flat = stats.filter("constant").select(key, F.lit(0).alias("lag"), F.col("n").alias("n_obs"),
                                           F.lit(None).cast("double").alias("statistic"), F.lit(1.0).alias("p_value"))
    done = out.withColumn("stationary", F.col("p_value") < 0.05)
    return done.unionByName(flat.withColumn("stationary", F.lit(True)))


def make_stationary(series: DataFrame, key: str, value: str, test: DataFrame) -> DataFrame:
    """Difference the series the unit-root test did not clear."""
    w = W.partitionBy(key).orderBy("date")
    out = series.join(test.select(key, "stationary"), key, "left")
    diff = F.col(value) - F.lag(value, 1).over(w)
    return out.withColumn(value, F.when(F.coalesce("stationary", F.lit(True)), F.col(value)).otherwise(diff)).drop(
        "stationary")


def granger(pairs: DataFrame, keys: list[str], y: str, x: str, control: str | None = None,
            max_lag: int = 5, least: int = 20) -> DataFrame:
    """F test of x's lags 1..p on y for every pair and p, given y's own lags and, if
    named, the control's lags."""
    names = [y, x, *([control] if control else [])]
    rows = pairs.select(*keys, "date", *names).dropna()
    w = W.partitionBy(*keys)
    rows = rows.withColumns({"n": F.count(F.lit(1)).over(w), "rn": F.row_number().over(w.orderBy("date"))})
    rows = rows.filter(F.col("n") >= least)
    for c in names:
        rows = _with_lags(rows, keys, c, max_lag, f"{c}_")
    lagged = [f"{c}_{k}" for c in names for k in range(1, max_lag + 1)]
    rows = rows.withColumn("lag", F.explode(F.sequence(F.lit(1), F.lit(max_lag))))
    g = gm.gram(rows.filter("rn > lag"), [*keys, "lag"], [y, *lagged], zero=lagged)

    def test(key, pdf):
        m, p = gm.matrix(pdf), int(key[-1])
        block = lambda i: list(range(2 + i * max_lag, 2 + i * max_lag + p))
        own = [0, *block(0), *(block(2) if control else [])]
        small, full = gm.ols(m, own, 1), gm.ols(m, own + block(1), 1)
        df = full["df"]
        if df <= 0 or full["rss"] <= 0:
            return pd.DataFrame(columns=[*keys, "lag", "n_obs", "rss_own", "rss_full", "f_stat", "p_value"])
        f = (small["rss"] - full["rss"]) / p / (full["rss"] / df)
        row = {**dict(zip(keys, key)), "lag": p, "n_obs": int(m[0, 0]), "rss_own": small["rss"],
               "rss_full": full["rss"], "f_stat": f, "p_value": dist.f_sf(f, p, df)}
        return pd.DataFrame([row])

    schema = ", ".join([*[f"{k} string" for k in keys],
                        "lag int, n_obs long, rss_own double, rss_full double, f_stat double, p_value double"])
    out = gm.solve_groups(g, [*keys, "lag"], test, schema)
    return out.withColumns({"significant": F.col("p_value") < 0.05, "controlled_for_fin": F.lit(bool(control))})


def var_fit(wide: DataFrame, cols: list[str], max_lag: int = 5) -> DataFrame:
    """Joint lag model of a few series: order by BIC on a common sample, coefficients
    of the chosen order on its own sample. One row per (equation, term)."""
    rows = wide.select("date", *cols).dropna().withColumn("_s", F.lit(1))
    rows = rows.withColumn("rn", F.row_number().over(W.partitionBy("_s").orderBy("date")))
    for i, c in enumerate(cols):
        rows = _with_lags(rows, ["_s"], c, max_lag, f"l{i}_")
    k = len(cols)
    lagged = [f"l{i}_{p}" for p in range(1, max_lag + 1) for i in range(k)]
    rows = rows.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(max_lag))))
    rows = rows.withColumn("common", F.explode(F.array(F.lit(False), F.lit(True))))
    rows = rows.filter(F.col("rn") > F.when(F.col("common"), F.lit(max_lag)).otherwise(F.col("p")))
    g = gm.gram(rows, ["p", "common"], [*cols, *lagged], zero=lagged)
    terms = ["const"] + [f"{c}_lag{p}" for p in range(1, max_lag + 1) for c in cols]

    def resid(m, p):
        x = [0, *range(1 + k, 1 + k + p * k)]
        y = list(range(1, 1 + k))
        coef = np.linalg.pinv(m[np.ix_(x, x)]) @ m[np.ix_(x, y)]
        return coef, m[np.ix_(y, y)] - coef.T @ m[np.ix_(x, y)]

    def solve(_, pdf):
        mats = {(int(p), bool(c)): gm.matrix(part) for (p, c), part in pdf.groupby(["p", "common"])}
        bic = {}
        for p in range(max_lag + 1):
            m = mats[p, True]
            n = m[0, 0]
            bic[p] = np.linalg.slogdet(resid(m, p)[1] / n)[1] + math.log(n) / n * (p * k * k + k)
        best = min(bic, key=bic.get)
        m = mats[best, False]
        coef, _r = resid(m, best)
        return pd.DataFrame([{"order": best, "bic": float(bic[best]), "n_obs": int(m[0, 0]), "equation": cols[e],
                              "term": terms[t], "coefficient": float(coef[t, e])}
                             for e in range(k) for t in range(coef.shape[0])])

    return gm.solve_groups(g, [], solve, "order int, bic double, n_obs long, equation string, term string, "
                                         "coefficient double")


def arx(rows: DataFrame, key: str, y: str, x: str) -> DataFrame:
    """y on its own lag and an outside driver, for every series at once: driver
    coefficient with its p-value and verdict, and the error of a holdout forecast
    that feeds on its own predictions."""
    w = W.partitionBy(key).orderBy("date")
    t = rows.select(key, "date", F.col(y).alias("y"), F.col(x).alias("x")).dropna()
    t = t.withColumns({"rn": F.row_number().over(w), "n": F.count(F.lit(1)).over(W.partitionBy(key)),
                       "y1": F.lag("y", 1).over(w)})
    t = t.withColumn("cut", F.floor(F.col("n") * 0.8)).filter("cut >= 10")
    g = gm.gram(t.filter("rn <= cut"), [key], ["y", "y1", "x"])

    def fit(k, pdf):
        m = gm.matrix(pdf)
        f = gm.ols(m, [0, 2, 3], 1)
        c = f["coef"]
        tv = float(c[2] / f["se"][2]) if f["se"][2] > 0 else 0.0
        return pd.DataFrame([{key: k[0], "const": c[0], "phi": c[1], "beta": c[2], "t_stat": tv,
                              "p_value": dist.normal_sf2(tv), "sigma2": f["rss"] / f["df"],
                              "n_train": int(m[0, 0])}])

    model = gm.solve_groups(g, [key], fit, f"{key} string, const double, phi double, beta double, t_stat double, "
                                           "p_value double, sigma2 double, n_train long")
    verdict = F.when(F.col("p_value") < 0.05, "significant").when(F.col("p_value") < 0.10, "borderline").otherwise(
        "not significant")
    return model.withColumn("verdict", verdict), t


def arx_forecast(model: DataFrame, t: DataFrame, key: str) -> DataFrame:
    """Holdout path with a 95% interval. The recursion runs along one series, which
    holds at most one row per day."""
    last = F.max(F.when(F.col("rn") == F.col("cut"), F.col("y"))).over(W.partitionBy(key))
    test = t.withColumn("last", last).filter("rn > cut").select(key, "date", "rn", "y", "x", "last")
    rows = test.join(model.select(key, "const", "phi", "beta", "sigma2"), key)

    def path(pdf):
        pdf = pdf.sort_values("rn", ignore_index=True)
        c, phi, beta, s2, prev = (float(pdf[n].iloc[0]) for n in ("const", "phi", "beta", "sigma2", "last"))
        mean, var, v = [], [], 0.0
        for x in pdf["x"].to_numpy():
            prev = c + phi * prev + beta * x
            v = s2 + phi * phi * v
            mean.append(prev)
            var.append(v)
        half = 1.959963984540054 * np.sqrt(var)
        return pd.DataFrame({key: pdf[key], "date": pdf["date"], "actual": pdf["y"], "forecast": mean,
                             "lower": np.array(mean) - half, "upper": np.array(mean) + half})

    return rows.groupBy(key).applyInPandas(
        path, f"{key} string, date date, actual double, forecast double, lower double, upper double")
