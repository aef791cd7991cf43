"""Fits against closed forms computed with numpy on the same rows."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.models import gram as gm, lags as lg, quantile as qr, ridge as rg, shock as sk, tests as ts
from riskspark.operators import calendar as cal

START = dt.date(2020, 1, 1)


def frame(spark, pdf, key="g"):
    pdf = pdf.assign(k=key, date=[START + dt.timedelta(days=i) for i in range(len(pdf))])
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = x @ [0.5, -1.0, 0.0] + 2 + rng.normal(scale=0.3, size=300)
    return pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "y"])


def test_gram_and_ols(spark, data):
    g = gm.gram(frame(spark, data), ["k"], ["a", "b", "y"]).toPandas()
    m = gm.matrix(g)
    z = np.column_stack([np.ones(300), data[["a", "b", "y"]]])
    assert np.allclose(m, z.T @ z)
    fit = gm.ols(m, [0, 1, 2], 3)
    want, rss, *_ = np.linalg.lstsq(z[:, :3], z[:, 3], rcond=None)
    assert np.allclose(fit["coef"], want) and fit["rss"] == pytest.approx(rss[0])


def test_ridge_holdout(spark, data):
    got = rg.fit(frame(spark, data), "k", ["a", "b", "c"], "y", [1.0]).toPandas().set_index("feature")
    tr, te = data.iloc[:240], data.iloc[240:]
    mu, sd = tr[["a", "b", "c"]].mean(), tr[["a", "b", "c"]].std(ddof=0)
    z = ((tr[["a", "b", "c"]] - mu) / sd).to_numpy()
    b = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (tr["y"] - tr["y"].mean()))
    assert np.allclose(got.loc[["a", "b", "c"], "coefficient"], b)
    p = ((te[["a", "b", "c"]] - mu) / sd).to_numpy() @ b + tr["y"].mean()
    assert got["r2"].iloc[0] == pytest.approx(1 - ((te["y"] - p) ** 2).sum() / ((te["y"] - te["y"].mean()) ** 2).sum())


def test_ridge_picks_the_best_penalty(spark, data):
    alphas = [0.01, 1.0, 100.0]
    got = rg.fit(frame(spark, data), "k", ["a", "b", "c"], "y", alphas).first()["alpha"]
    tr = data.iloc[:240]
    z = (tr[["a", "b", "c"]] - tr[["a", "b", "c"]].mean()) / tr[["a", "b", "c"]].std(ddof=0)
    scores = []
    for a in alphas:
        r2 = []
        for f in np.array_split(np.arange(240), 5):
            rest = np.setdiff1d(np.arange(240), f)
            x, y = z.to_numpy()[rest], tr["y"].to_numpy()[rest]
            xm, ym = x.mean(0), y.mean()
            b = np.linalg.solve((x - xm).T @ (x - xm) + a * np.eye(3), (x - xm).T @ (y - ym))
            p = (z.to_numpy()[f] - xm) @ b + ym
            t = tr["y"].to_numpy()[f]
            r2.append(1 - ((t - p) ** 2).sum() / ((t - t.mean()) ** 2).sum())
        scores.append(np.mean(r2))
    assert got == alphas[int(np.argmax(scores))]


def test_quantile_fit_reaches_the_lowest_pinball_loss(spark, data):
    models = qr.fit(frame(spark, data), "k", ["a", "b"], "y", [0.25, 0.75], l1=0.0)
    z, y = np.column_stack([np.ones(300), data[["a", "b"]]]), data["y"].to_numpy()
    for q in (0.25, 0.75):
        loss = lambda b: np.where(y > z @ b, q * (y - z @ b), (q - 1) * (y - z @ b)).mean()
        b = np.linalg.lstsq(z, y, rcond=None)[0]
        for _ in range(500):
            e = y - z @ b
            w = np.where(e > 0, q, 1 - q) / np.maximum(np.abs(e), 1e-9)
            b = np.linalg.solve((z * w[:, None]).T @ z, (z * w[:, None]).T @ y)
        assert loss(models["g", q]) <= loss(b) * 1.002


def test_unit_root(spark):
    rng = np.random.default_rng(9)
    noise = rng.normal(size=400)
    walk, calm = noise.cumsum(), pd.Series(noise).ewm(alpha=0.7).mean().to_numpy()
    rows = [(n, START + dt.timedelta(days=i), float(v)) for n, s in (("walk", walk), ("calm", calm), ("flat", np.ones(400)))
            for i, v in enumerate(s)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    got = {r["k"]: r for r in lg.adf(df, "k", "v").collect()}
    assert got["calm"]["p_value"] < 0.01 and got["walk"]["p_value"] > 0.05
    assert got["flat"]["stationary"] and got["flat"]["statistic"] is None
    k = got["walk"]["lag"]
    dy = np.diff(walk)
    y = dy[k:]
    x = np.column_stack([np.ones(len(y)), walk[k:-1], *[dy[k - j:len(dy) - j] for j in range(1, k + 1)]])
    b, rss, *_ = np.linalg.lstsq(x, y, rcond=None)
    se = math.sqrt(rss[0] / (len(y) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    assert got["walk"]["statistic"] == pytest.approx(b[1] / se, rel=1e-6)


def test_granger_finds_the_driver(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=300)
    y = np.zeros(300)
    for t in range(2, 300):
        y[t] = 0.3 * y[t - 1] + 0.8 * x[t - 2] + rng.normal(scale=0.5)
    df = frame(spark, pd.DataFrame({"y": y, "x": x, "z": rng.normal(size=300)}))
    got = {r["lag"]: r for r in lg.granger(df, ["k"], "y", "x").collect()}
    assert got[1]["p_value"] > got[2]["p_value"] and got[2]["p_value"] < 1e-10
    yy = y[2:]
    own = np.column_stack([np.ones(298), y[1:-1], y[:-2]])
    full = np.column_stack([own, x[1:-1], x[:-2]])
    rss = [np.linalg.lstsq(m, yy, rcond=None)[1][0] for m in (own, full)]
    assert got[2]["f_stat"] == pytest.approx((rss[0] - rss[1]) / 2 / (rss[1] / (298 - 5)), rel=1e-6)
    back = {r["lag"]: r for r in lg.granger(df, ["k"], "x", "y", "z").collect()}
    assert back[1]["p_value"] > 0.001 and back[1]["controlled_for_fin"]


def test_var_order(spark):
    rng = np.random.default_rng(4)
    a, b = np.zeros(500), np.zeros(500)
    for t in range(2, 500):
        a[t] = 0.5 * a[t - 2] + rng.normal()
        b[t] = 0.4 * a[t - 1] + rng.normal()
    got = lg.var_fit(frame(spark, pd.DataFrame({"a": a, "b": b})), ["a", "b"]).toPandas()
    assert got["order"].unique().tolist() == [2]
    c = got.set_index(["equation", "term"])["coefficient"]
    assert c["a", "a_lag2"] == pytest.approx(0.5, abs=0.12) and c["b", "a_lag1"] == pytest.approx(0.4, abs=0.12)


def test_walk_forward_never_trains_ahead(spark):
    df = frame(spark, pd.DataFrame({"v": np.arange(50.0)}))
    rows = cal.walk_forward(df, ["k"]).collect()
    for f in {r["fold"] for r in rows}:
        train = [r["date"] for r in rows if r["fold"] == f and r["is_train"]]
        test = [r["date"] for r in rows if r["fold"] == f and not r["is_train"]]
        assert max(train) < min(test)


def test_bootstrap_is_repeatable(spark):
    rows = [(a, START + dt.timedelta(days=i), float(i % 7 + (a == "tech"))) for a in ("tech", "defensive") for i in range(50)]
    df = spark.createDataFrame(rows, "archetype string, date date, ret double")
    run = lambda: ts.bootstrap_t(df, "archetype", "ret", "tech", "defensive", draws=200).collect()[0]
    assert run() == run() and run()["draws"] == 200


def test_risk_band_sees_all_scaled_features(spark, monkeypatch):
    from riskspark.models import frames as fr
    from riskspark.plans import modelling as md

    class Seen(Exception):
        pass

    def fit(rows, key, features, target, probs):
        raise Seen(features, rows.groupBy(key).agg(*[F.avg(c).alias(c) for c in features]).collect(),
                   rows.groupBy(key).agg(*[F.stddev_pop(c).alias(c) for c in features]).collect())

    f, rng = fr.risk_features(), np.random.default_rng(7)
    days = pd.DataFrame(rng.normal(3, 2, (60, len(f) + 1)), columns=[*f, "target"])
    monkeypatch.setattr(md, "m3_frame", lambda s, d: frame(spark, days, "a").withColumnRenamed("k", "portfolio"))
    monkeypatch.setattr(md.qr, "fit", fit)
    with pytest.raises(Seen) as got:
        md.m3_risk_ridge(spark, "")
    features, mean, sd = got.value.args
    assert features == f
    assert np.allclose([mean[0][c] for c in f], 0) and np.allclose([sd[0][c] for c in f], 1)


def test_recovery_band_drops_unsupported_tech_shocks(spark, monkeypatch):
    from riskspark.models import frames as fr
    from riskspark.plans import modelling as md

    class Seen(Exception):
        pass

    def split(events, order):
        raise Seen({(r["portfolio"], r["date"]) for r in events.collect()})

    f, rng = fr.shock_features("tech"), np.random.default_rng(8)
    days = pd.DataFrame(rng.normal(size=(60, len(f))), columns=f)
    high = days[f[0]] > 0.5
    days["shock_tech"] = high.shift(1, fill_value=False).astype(int)
    days.loc[[10, 20], f[1]] = None
    days = frame(spark, days).drop("k").replace(float("nan"), None)
    events = days.select("date").crossJoin(spark.createDataFrame([("tech",), ("balanced",)], "portfolio string"))
    monkeypatch.setattr(md, "day_frame", lambda s, d: days)
    monkeypatch.setattr(md, "shock_events", lambda s, d: events)
    monkeypatch.setattr(md.rc, "pooled_split", split)
    with pytest.raises(Seen) as got:
        md.recovery_bands(spark, "")
    kept = got.value.args[0]
    sure = {r["date"] for r in md.m1_probabilities(spark, "").collect() if r["p"] >= 0.75}
    assert 0 < len(sure) < 60 and len({x for p, x in kept if p == "balanced"}) == 60
    assert {x for p, x in kept if p == "tech"} == sure <= {START + dt.timedelta(days=int(i)) for i in np.flatnonzero(high)}
