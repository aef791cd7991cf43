"""Fits every model of the study once and puts the results into a store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riskspark.common import materialise, side_by_side
from riskspark.models import frames as fr, linear as ln, profiles as pr, quantile as qr, recovery as rc, ridge as rg, \
    shock as sk
from riskspark.models.store import Store, Version
from riskspark.operators import calendar as cal

POINT = "point"
RISK_BAND = {0.25: "p25", 0.75: "p75"}
RECOVERY = ["vol5", "sector_label", "pre_shock_baseline", "market_regime", "quarter", "year"]
ITEMS = ["shock_model", "shock_values", "risk_rules", "recovery_rules", "recovery_medians", "domain_coefficients",
         "clusters", "causes"]


@dataclass
class Inputs:
    """Tables the fits read. All are bounded by days x portfolios (or domains)."""

    days: DataFrame             # day frame: one row per trading day
    portfolio_feats: DataFrame  # portfolio features with shock flags
    events: DataFrame | None    # shocks with recovery time and context
    profile: DataFrame | None   # portfolio profile columns, without domain coefficients
    causes: DataFrame | None    # cause, effect, lag, p_value of the causality tests
    shock_portfolio: str        # whose next-day shock is classified
    order: list[str]            # the portfolios
    penalties: list[float]      # for the domain sensitivities
    context: list[str]          # further columns of the events
    days_at: sk.FrameAt | None = None  # the day frame as known at each fold's cutoff


def train(store: Store, t: Inputs) -> Version:
    """One committed version with all items that the tables allow: without both
    classes of days there is no shock model, without events no recovery rules. The
    models don't read each other, so they are fitted side by side."""
    draft = store.draft()

    def sensitivities():
        coef = domain_coefficients(draft, t)
        if t.profile is not None:
            clusters(draft, coef, t.profile)

    steps = [lambda: shock_model(draft, t), lambda: risk_rules(draft, t), sensitivities]
    if t.events is not None:
        steps.append(lambda: recovery_rules(draft, t))
    if t.causes is not None:
        steps.append(lambda: draft.table("causes", t.causes, "effect"))
    side_by_side(store.spark, *steps)
    return draft.commit()


def shock_model(draft, t: Inputs) -> None:
    """The classifier on all complete rows, and the threshold calibrated on its walk-forward folds."""
    features = fr.shock_features(t.shock_portfolio)
    rows = materialise(sk.training_rows(t.days, features, f"shock_{t.shock_portfolio}"), "train_shock")
    if rows.select("label").distinct().count() < 2:
        return
    report, model = side_by_side(
        rows.sparkSession,
        lambda: sk.evaluate(materialise(sk.walk_forward(rows, features=features, frame_at=t.days_at), "train_folds")).first(),
        lambda: sk.classifier().fit(sk.balanced(rows)))
    draft.model("shock_model", model)
    draft.values("shock_values", threshold=0.5 if report["threshold"] is None else report["threshold"],
                 f1=report["f1_calibrated"], auc_roc=report["auc_roc"], folds=report["folds"])


def risk_rules(draft, t: Inputs) -> None:
    """Next-day volatility per portfolio: ridge point and quartiles on the same scaled features."""
    f = fr.risk_features()
    frame = materialise(fr.with_target(t.days, t.portfolio_feats, "vol5", ahead=1), "train_risk")
    model = materialise(rg.fit(frame, "portfolio", f, "target", [1.0]), "train_ridge")
    split = cal.split_time(frame.dropna(subset=[*f, "target"]), ["portfolio"]).filter("is_train")
    scaled = materialise(qr.standardised(split, "portfolio", f), "train_scaled")
    fits = qr.fit(scaled, "portfolio", f, "target", list(RISK_BAND))
    band = ln.from_quantiles(frame.sparkSession, fits, "portfolio", f, RISK_BAND, model)
    draft.table("risk_rules", ln.from_ridge(model, "portfolio", POINT).unionByName(band), "portfolio")


def recovery_rules(draft, t: Inputs) -> None:
    """Quartiles of recovery days from the pooled shocks, and the medians that fill gaps."""
    cols = [*RECOVERY, *t.context]
    pool = materialise(rc.pooled_split(t.events, t.order), "train_pool").filter("is_train")
    if pool.isEmpty():
        return
    middle = pool.agg(*[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(c) for c in cols]).first()
    mids = {c: 0.0 if middle[c] is None else middle[c] for c in cols}
    filled = pool.select(F.lit("all").alias("pool"), "recovery_days", *[
        F.coalesce(F.col(c).cast("double"), F.lit(m)).alias(c) for c, m in mids.items()])
    fits = qr.fit(materialise(filled, "train_filled"), "pool", cols, "recovery_days", list(rc.BAND))
    draft.table("recovery_rules", ln.from_quantiles(t.days.sparkSession, fits, "pool", cols, rc.BAND))
    draft.values("recovery_medians", **mids)


def domain_coefficients(draft, t: Inputs) -> DataFrame:
    frame = fr.with_target(t.days, t.portfolio_feats, "vol5")
    model = rg.fit(frame, "portfolio", fr.sensitivity_features(), "target", t.penalties)
    coef = materialise(rg.domain_coefficients(model, "portfolio"), "train_domains")
    draft.table("domain_coefficients", coef, "portfolio")
    return coef


def clusters(draft, coef: DataFrame, profile: DataFrame) -> None:
    """Profiles with the names of their flat and top-down clusters."""
    rows = materialise(profile.join(coef, "portfolio", "right").fillna(0.0).orderBy("portfolio"), "train_profiles")
    numbers = [c for c in rows.columns if c != "portfolio"]
    v = pr.vectors(rows, numbers)
    out = pr.assign(v, pr.choose_k(v)[1]) if rows.count() > 2 else v.withColumns(
        {"kmeans_cluster": F.lit(0), "hierarchical_cluster": F.lit(0)})
    out = pr.name_clusters(out, "kmeans_cluster", "kmeans_label")
    out = pr.name_clusters(out, "hierarchical_cluster", "hierarchical_label")
    draft.table("clusters", out.select("portfolio", *numbers, "kmeans_label", "hierarchical_label"), "portfolio")
