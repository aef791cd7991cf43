"""Moving-average errors against dense normal densities and simulated series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from riskspark.models import statespace as ss

START = dt.date(2019, 1, 1)


def covariance(n, phi, theta):
    """Of a stationary series with unit innovations, from its autocovariances."""
    g = [(1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2), (1 + phi * theta) * (phi + theta) / (1 - phi ** 2)]
    while len(g) < n:
        g.append(phi * g[-1])
    return np.array([[g[abs(i - j)] for j in range(n)] for i in range(n)])


def simulate(n, phi, theta, beta, seed, const=0.0):
    rng = np.random.default_rng(seed)
    e, x = rng.normal(size=n + 50), rng.normal(size=n)
    u = np.zeros(n + 50)
    for t in range(1, n + 50):
        u[t] = phi * u[t - 1] + e[t] + theta * e[t - 1]
    return const + beta * x + u[50:], x


@pytest.mark.parametrize("phi,theta", [(0.6, 0.3), (-0.4, 0.8), (0.0, -0.5), (0.9, 0.0)])
def test_likelihood_is_the_normal_density(phi, theta):
    y, x = simulate(40, 0.5, 0.2, 1.5, 1)
    p = ss.profile(y, x[:, None], np.array([phi]), np.array([theta]))
    c = covariance(40, phi, theta)
    inv = np.linalg.inv(c)
    beta = x @ inv @ y / (x @ inv @ x)
    res = y - beta * x
    s2 = res @ inv @ res / 40
    want = -0.5 * (40 * np.log(2 * np.pi * s2) + np.linalg.slogdet(c)[1] + res @ inv @ res / s2)
    assert p["loglik"][0] == pytest.approx(want) and p["coef"][0, 0] == pytest.approx(beta)
    assert p["sigma2"][0] == pytest.approx(s2)


def test_forecast_is_the_conditional_normal():
    y, x = simulate(60, 0.7, 0.4, 0.8, 2)
    m = ss.fit(y[:50], x[:50, None])
    mean, var = ss.forecast(m, y[49], x[49:50], x[50:, None])
    c = covariance(60, m["phi"], m["theta"])
    w = c[50:, :50] @ np.linalg.inv(c[:50, :50])
    beta = m["coef"][0]
    assert np.allclose(mean, beta * x[50:] + w @ (y[:50] - beta * x[:50]))
    assert np.allclose(var, m["sigma2"] * np.diag(c[50:, 50:] - w @ c[:50, 50:]))


def test_fit_reaches_the_optimum_and_the_truth():
    y, x = simulate(2000, 0.6, 0.3, 1.2, 3)
    m = ss.fit(y, x[:, None])
    assert m["phi"] == pytest.approx(0.6, abs=0.08) and m["theta"] == pytest.approx(0.3, abs=0.08)
    assert m["coef"][0] == pytest.approx(1.2, abs=0.06) and m["sigma2"] == pytest.approx(1.0, abs=0.08)
    fine = np.linspace(-0.98, 0.98, 41)
    phi, theta = (g.ravel() for g in np.meshgrid(fine, fine))
    assert m["loglik"] >= ss.profile(y[:, ], x[:, None], phi, theta)["loglik"].max() - 1e-6


def test_all_series_at_once(spark):
    parts = []
    for k, (n, phi, theta, beta, const) in {"a": (400, 0.5, 0.3, 1.0, 2.0), "b": (400, 0.2, -0.6, 0.0, 2.0),
                                            "flat": (100, 0, 0, 0, 0), "short": (8, 0.5, 0.0, 1.0, 0.0)}.items():
        y, x = simulate(n, phi, theta, beta, 5, const)
        if k == "flat":
            y, x = np.zeros(n), np.zeros(n)
        parts.append(pd.DataFrame({"ticker": k, "date": [START + dt.timedelta(days=i) for i in range(n)], "y": y, "x": x}))
    t = pd.concat(parts, ignore_index=True)
    t.loc[5, "x"] = np.nan
    df = spark.createDataFrame(t).replace(float("nan"), None)
    path = ss.armax(df, "ticker", "y", "x", constant=True)
    got = ss.report(path, "ticker").toPandas().set_index("ticker")
    assert set(got.index) == {"a", "b", "flat"}
    assert (got.loc["a", "n_train"], got.loc["a", "n_test"]) == (319, 80)
    assert got.loc["a", "verdict"] == "significant" and got.loc["a", "const"] == pytest.approx(2.0, abs=0.4)
    assert got.loc["b", "theta"] + got.loc["b", "phi"] == pytest.approx(-0.4, abs=0.15)
    assert got.loc["a", "coverage"] > 0.85 and got.loc["flat", "mse"] == pytest.approx(0.0)
    own = t[(t["ticker"] == "b")]
    m = ss.fit(own["y"].to_numpy()[:320], np.column_stack([own["x"], np.ones(400)])[:320])
    assert got.loc["b", "log_likelihood"] == pytest.approx(m["loglik"])
