"""The model store, rules applied from it, and the tables served."""

import datetime as dt
import threading
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskspark import constants as K
from riskspark.common import side_by_side
from riskspark.models import frames as fr, linear as ln, scoring as sc, shock as sk, training as tr
from riskspark.models.store import Store
from riskspark.operators import serving as sv

START = dt.date(2021, 1, 4)
DAYS = [START + dt.timedelta(days=i) for i in range(40)]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / uuid.uuid4().hex))


def rules(spark, rows):
    return spark.createDataFrame(rows, "portfolio string, rule string, feature string, coefficient double, mean double, "
                                       "sd double, intercept double")


def test_only_committed_versions_are_seen(spark, store):
    assert store.latest() is None and store.versions().isEmpty()
    broken = store.draft()
    broken.values("v", a=1.0)
    assert store.latest() is None
    first = store.draft()
    first.values("v", a=2.0, b=None)
    first.commit()
    assert store.latest().values("v") == {"a": 2.0, "b": None}
    second = store.draft()
    second.values("v", a=3.0)
    second.commit()
    assert store.latest().name == second.name and store.latest().values("v") == {"a": 3.0}
    assert store.version(first.name).values("v")["a"] == 2.0
    assert [r["version"] for r in store.versions().collect()] == [second.name, first.name]
    with pytest.raises(LookupError):
        store.version(broken.name)
    with pytest.raises(LookupError):
        store.latest().table("missing")
    with pytest.raises(ValueError):
        store.draft().commit()


def test_an_item_is_saved_once(store):
    draft = store.draft()
    draft.values("v", a=1.0)
    with pytest.raises(ValueError):
        draft.values("v", a=2.0)


def test_one_portfolio_reads_its_own_files(spark, store):
    draft = store.draft()
    draft.table("risk_rules", rules(spark, [(p, "point", "a", 1.0, 0.0, 1.0, 0.0) for p in "xyz"]), "portfolio")
    df = draft.commit().table("risk_rules", portfolio="y")
    assert "PartitionFilters: [isnotnull(portfolio" in df._jdf.queryExecution().executedPlan().toString()
    assert len(df.inputFiles()) == 3 and df.count() == 1
    assert df.select(F.input_file_name()).distinct().count() == 1


def test_a_forest_scores_the_same_after_loading(spark, store):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 2))
    rows = spark.createDataFrame([(Vectors.dense(v), float(v[0] > 0)) for v in x], ["features", "label"])
    model = RandomForestClassifier(numTrees=5, seed=1).fit(rows)
    draft = store.draft()
    draft.model("forest", model)
    loaded = draft.commit().model("forest", RandomForestClassificationModel)
    p = lambda m: [r["p"] for r in sk.score(m, rows).select("p").collect()]
    assert p(model) == p(loaded)


def test_rules_equal_their_sum(spark):
    rng = np.random.default_rng(4)
    x = pd.DataFrame(rng.normal(size=(40, 2)), columns=["a", "b"])
    df = spark.createDataFrame(x.assign(portfolio=["x", "y"] * 20, date=DAYS))
    gap = spark.createDataFrame([(None, 1.0, "x", START - dt.timedelta(days=1))], df.schema)
    t = rules(spark, [("x", "point", "a", 2.0, 0.5, 2.0, 1.0), ("x", "point", "b", -1.0, 0.0, 1.0, 1.0),
                      ("x", "p25", "a", 1.0, 0.0, 1.0, 0.0), ("x", "p25", "b", 0.0, 0.0, 1.0, 0.0)])
    got = ln.apply(df.unionByName(gap), t, "portfolio", ["a", "b"], ["point", "p25"]).toPandas().set_index("date")
    assert len(got) == 41
    for i, day in enumerate(DAYS):
        if i % 2:
            assert got.loc[day, ["point", "p25"]].isna().all()      # no rule for y
        else:
            a, b = x.iloc[i]
            assert got.loc[day, "point"] == pytest.approx(1 + 2 * (a - 0.5) / 2 - b)
            assert got.loc[day, "p25"] == pytest.approx(a)
    assert np.isnan(got.loc[START - dt.timedelta(days=1), "point"])  # a missing feature


def test_pooled_rules_hold_for_every_key(spark):
    df = spark.createDataFrame([("x", START, 1.0), ("y", START, 3.0)], "portfolio string, date date, a double")
    t = rules(spark, [("all", "p50", "a", 2.0, 0.0, 1.0, 1.0)]).drop("portfolio")
    got = ln.apply(df, t, "portfolio", ["a"], ["p50"], pooled=True).collect()
    assert {r["portfolio"]: r["p50"] for r in got} == {"x": 3.0, "y": 7.0}


def test_bands_hold_their_middle(spark):
    df = spark.createDataFrame([(2.0, 1.0, 0.5), (None, 1.0, None), (0.1, None, 0.2), (0.5, 1.0, 2.0)],
                               "lo double, mid double, hi double")
    got = [tuple(r) for r in ln.banded(df, "lo", "mid", "hi").collect()]
    assert got == [(1.0, 1.0, 1.0), (0.7, 1.0, 1.3), (None, None, None), (0.5, 1.0, 2.0)]


@pytest.fixture
def fitted(spark, store):
    """A version written by hand, so that every score is known."""
    draft = store.draft()
    f = fr.risk_features()
    draft.table("risk_rules", rules(spark, [(p, r, c, 0.0, 0.0, 1.0, v) for p in K.PORTFOLIOS for c in f for r, v in
                                            (("point", 0.02), ("p25", 0.03), ("p75", 0.05))]), "portfolio")
    cols = [*tr.RECOVERY, "tone"]
    draft.table("recovery_rules", spark.createDataFrame(
        [("all", r, c, 1.0 if c == "vol5" else 0.0, 0.0, 1.0, v) for c in cols
         for r, v in (("p25", -9.0), ("p50", 1.999999), ("p75", 1.0))],
        "pool string, rule string, feature string, coefficient double, mean double, sd double, intercept double"))
    draft.values("recovery_medians", **{c: 0.0 for c in cols})
    draft.table("domain_coefficients", spark.createDataFrame(
        [(p, *[0.1, -0.5, 0.2]) for p in K.PORTFOLIOS], ["portfolio", *[f"m5_coeff_{g}" for g in K.DOMAINS]]), "portfolio")
    draft.table("causes", spark.createDataFrame([(K.DOMAINS[0], "tech", 3, 0.01), (K.DOMAINS[1], "tech", 1, 0.04),
                                                 (K.DOMAINS[0], "balanced", 1, 0.2)],
                                                "cause string, effect string, lag int, p_value double"), "effect")
    return draft.commit()


def test_signals_come_from_the_stored_version_without_a_fit(spark, fitted, monkeypatch):
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: pytest.fail("fitted while scoring"))
    f = list(dict.fromkeys([*fr.risk_features(), *fr.shock_features("tech")]))
    days = spark.createDataFrame([(d, *[1.0] * len(f)) for d in DAYS[:3]], ["date", *f])
    days = days.withColumn(fr.risk_features()[0], F.when(F.col("date") > DAYS[0], 1.0))
    pf = spark.createDataFrame([(p, d, None if d == DAYS[0] else 2.0) for p in K.PORTFOLIOS for d in DAYS[:3]],
                               "portfolio string, date date, vol5 double")
    context = pf.withColumns({c: F.lit(None).cast("double") for c in
                              ("pre_shock_baseline", "market_regime", "quarter", "year", "tone")})
    dom = spark.createDataFrame([(g, d, 0.1) for g in K.DOMAINS for d in DAYS[:3]],
                                "domain string, date date, sentiment_score double")
    recent = sv.recent_mean(dom, "domain", "sentiment_score", 7)
    run = lambda p=None: sc.signal_days(fitted, days, pf, context, dom, recent, list(K.PORTFOLIOS), K.DOMAINS, "tech", p)
    got = run().toPandas().set_index(["portfolio", "date"]).sort_index()
    assert len(got) == 3 * len(K.PORTFOLIOS)
    gap, full = got.loc[("tech", DAYS[0])], got.loc[("tech", DAYS[1])]
    assert np.isnan(gap["predicted_vol"]) and gap["risk_label"] is None and gap["threshold"] == 0.5
    assert (full["predicted_vol"], full["p25"], full["p75"], full["risk_label"]) == (0.02, 0.02, 0.05, "ELEVATED")
    assert (gap["p25_days"], gap["p50_days"], gap["p75_days"]) == (1.0, 2.0, 2.0)      # vol5 filled with its median
    assert "1–2 days (median 2 days)" in gap["recovery"]
    assert (full["p25_days"], full["p50_days"], full["p75_days"]) == (1.0, 4.0, 4.0)
    assert full["dominant_domain"] == K.DOMAINS[1] and full["action"] == "HOLD / MONITOR"
    one = run("tech").toPandas().set_index(["portfolio", "date"]).sort_index()
    pd.testing.assert_frame_equal(one, got.loc[["tech"]])


def inputs(**given):
    none = dict.fromkeys(("days", "portfolio_feats", "events", "profile", "causes", "order", "penalties", "context"))
    return tr.Inputs(**{**none, "shock_portfolio": "tech", **given})


def test_independent_fits_run_side_by_side(store, monkeypatch):
    meet = threading.Barrier(4)  # passed only when all four fits are under way

    def fit(name):
        def run(draft, t):
            meet.wait(20)
            draft.values(name, v=1.0)
        return run

    names = ["shock_model", "risk_rules", "recovery_rules", "domain_coefficients"]
    for name in names:
        monkeypatch.setattr(tr, name, fit(name))
    assert tr.train(store, inputs(events="some")).items == set(names)


def test_a_failed_fit_commits_nothing(store, monkeypatch):
    for name in ("shock_model", "risk_rules", "domain_coefficients"):
        monkeypatch.setattr(tr, name, lambda draft, t, name=name: draft.values(name, v=1.0))
    monkeypatch.setattr(tr, "risk_rules", lambda draft, t: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tr.train(store, inputs())
    assert store.latest() is None


def test_each_step_has_its_own_copy_of_the_job_settings(spark):
    sc_, meet = spark.sparkContext, threading.Barrier(2)

    def step(name):
        seen = sc_.getLocalProperty("note")
        meet.wait(20)
        sc_.setLocalProperty("note", name)
        meet.wait(20)
        return seen, sc_.getLocalProperty("note")

    sc_.setLocalProperty("note", "caller")
    try:
        assert side_by_side(spark, lambda: step("a"), lambda: step("b")) == [("caller", "a"), ("caller", "b")]
        assert sc_.getLocalProperty("note") == "caller"
    finally:
        sc_.setLocalProperty("note", None)


def test_sensitivities_and_causes(spark, fitted):
    recent = spark.createDataFrame([(K.DOMAINS[1], -0.2)], "domain string, recent_sentiment double")
    row = sc.sensitivities(fitted, recent, K.DOMAINS, "tech").first()
    assert (row["dominant_domain"], row["dominant_coeff"], row["direction"]) == (K.DOMAINS[1], -0.5, "decreasing")
    assert [e["domain"] for e in row["ranked_domains"]] == [K.DOMAINS[1], K.DOMAINS[2], K.DOMAINS[0]]
    assert row["recent_by_domain"] == {K.DOMAINS[0]: 0.0, K.DOMAINS[1]: -0.2, K.DOMAINS[2]: 0.0}
    notes = {r["portfolio"]: r["granger_note"] for r in sc.confirmed_causes(fitted, K.DOMAINS).collect()}
    assert set(notes) == {"tech"} and "by 3 day(s) (p=0.0100)" in notes["tech"]


def test_chart_window(spark):
    panel = spark.createDataFrame([(t, d, None if (t, i) == ("b", 39) else i + 0.5) for t in ("a", "b", "d", "e")
                                   for i, d in enumerate(DAYS)], "ticker string, date date, price double")
    dom = spark.createDataFrame([("news", d, 0.25) for d in DAYS[:-1]], "domain string, date date, sentiment_score double")
    bridge = spark.createDataFrame([("p", t, i) for i, t in enumerate("abcde")] + [("q", "c", 0)],
                                   "portfolio string, ticker string, position int")
    got = sv.chart_window(panel.select("date").distinct(), panel, dom, bridge, rows=5).collect()
    assert [r["portfolio"] for r in got] == ["p"]                   # c never trades
    chart = got[0]["market_chart"]
    assert [e["date"] for e in chart] == DAYS[-5:]
    assert chart[0]["prices"] == {"a": 35.5, "b": 35.5, "d": 35.5} and chart[0]["tone"] == {"news": 0.25}
    assert chart[-1]["prices"] == {"a": 39.5, "b": None, "d": 39.5} and chart[-1]["tone"] is None
