"""Signals, sensitivities and the per-portfolio serving record."""

import hashlib

from pyspark.sql import Window as W, functions as F

from riskspark import constants as K, fixtures as fx
from riskspark.common import dimension, materialise, r, rounded, shared_path, side_by_side
from riskspark.models import profiles as pr, recovery as rc, scoring as sc, training as tr
from riskspark.models.store import Store
from riskspark.operators import rules as ru, serving as sv, shocks as sh
from riskspark.plans import inputs as x
from riskspark.plans.aggregates import R
from riskspark.plans.ordering import domain_ranks
from riskspark.plans.registry import query
from riskspark.plans.shared_sql import CTES
from riskspark.plans.windows import dom_feats, feats

# Signals need a probability and a predicted volatility per day. Here they are the
# share of shock days in the last 20 rows times 5, and volatility over 20.
CTES["c_sig"] = """
    SELECT portfolio, date, least(avg(shock) OVER (PARTITION BY portfolio ORDER BY date
           ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * 5, 1) AS p, 0.3::DOUBLE AS threshold,
           vol5 / 20 AS predicted_vol, pre_shock_baseline / 22 AS p25, pre_shock_baseline / 18 AS p75 FROM c_shock"""


def signals(s, d):
    f = feats(s, d)
    t = sh.shock_days(f).join(f.select("portfolio", "date", "pre_shock_baseline"), ["portfolio", "date"])
    w = W.partitionBy("portfolio").orderBy("date").rowsBetween(-19, 0)
    return t.select("portfolio", "date", F.least(F.avg(F.col("shock").cast("double")).over(w) * 5, F.lit(1.0)).alias("p"),
                    F.lit(0.3).alias("threshold"), (F.col("vol5") / 20).alias("predicted_vol"),
                    (F.col("pre_shock_baseline") / 22).alias("p25"), (F.col("pre_shock_baseline") / 18).alias("p75"))


@query("signal_shock", f"""SELECT portfolio, date, {R('p')} AS p, p >= threshold AS is_shock,
    CASE WHEN p >= 0.75 THEN 'HIGH' WHEN p >= threshold THEN 'ELEVATED' ELSE 'NORMAL' END AS signal FROM c_sig""")
def signal_shock(s, d):
    t = signals(s, d)
    return t.select("portfolio", "date", r("p").alias("p"), (F.col("p") >= F.col("threshold")).alias("is_shock"),
                    ru.shock_signal(F.col("p"), F.col("threshold")).alias("signal"))


_LABEL = "CASE WHEN predicted_vol > 0.025 THEN 'HIGH RISK' WHEN predicted_vol > 0.015 THEN 'ELEVATED' ELSE 'NORMAL' END"


@query("signal_risk_band", f"""SELECT portfolio, date, {R('predicted_vol')} AS predicted_vol,
    {R('least(p25, predicted_vol)')} AS p25, {R('greatest(p75, predicted_vol)')} AS p75, {_LABEL} AS risk_label FROM c_sig""")
def signal_risk_band(s, d):
    t = ru.risk_band(signals(s, d), "predicted_vol", "p25", "p75")
    return rounded(t.select("portfolio", "date", "predicted_vol", "p25", "p75", "risk_label"), "predicted_vol", "p25", "p75")


CTES["c_sens"] = """
    SELECT portfolio, domain AS dominant_domain, r AS dominant_coeff, coalesce(recent_sentiment, 0) AS recent_sentiment,
           CASE WHEN coalesce(recent_sentiment, 0) > 0 THEN 'increasing' ELSE 'decreasing' END AS direction
    FROM c_rankdom LEFT JOIN c_recent USING (domain) WHERE rank = 1"""


@query("domain_sensitivity", f"""SELECT portfolio, dominant_domain, {R('dominant_coeff')} AS dominant_coeff,
    {R('recent_sentiment')} AS recent_sentiment, direction FROM c_sens""")
def domain_sensitivity(s, d):
    t = ru.sensitivity(domain_ranks(s, d), sv.recent_mean(x.domain_days(s, d), "domain", "sentiment_score", 7))
    return rounded(t, "dominant_coeff", "recent_sentiment")


CTES["c_act0"] = f"""
    SELECT portfolio, c_sig.date, coalesce(p, 0.5) AS p, {_LABEL} AS risk, dominant_domain AS dom,
           coalesce(sentiment_score, 0) AS mood,
           printf('Recovery expected in %d–%d days (median %d days)', q25::INT, q75::INT, q50::INT) AS rec
    FROM c_sig JOIN (SELECT portfolio, dominant_domain FROM c_sens) USING (portfolio)
    LEFT JOIN c_dom ON c_dom.domain = dominant_domain AND c_dom.date = c_sig.date
    JOIN (SELECT portfolio, floor(quantile_cont(recovery_days, 0.25)) AS q25,
                 floor(quantile_cont(recovery_days, 0.5)) AS q50,
                 floor(quantile_cont(recovery_days, 0.75)) AS q75 FROM c_recovery GROUP BY 1) USING (portfolio)"""
CTES["c_act"] = """
    SELECT *, CASE WHEN p >= 0.75 AND risk <> 'NORMAL' THEN 1 WHEN p < 0.35 AND risk = 'NORMAL' AND mood > 0.05 THEN 2
           WHEN p >= 0.35 OR risk = 'ELEVATED' THEN 3 ELSE 4 END AS branch, printf('%.0f%%', p * 100 + 1e-7) AS pct
    FROM c_act0"""


@query("signal_buysell", """
    SELECT portfolio, date, CASE branch WHEN 1 THEN 'REDUCE / HEDGE' WHEN 2 THEN 'BUY / ADD' WHEN 3 THEN 'HOLD / MONITOR'
           ELSE 'HOLD' END AS action,
           CASE branch WHEN 1 THEN 'High' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Moderate' ELSE 'Low' END AS confidence,
           CASE branch
             WHEN 1 THEN 'Shock probability ' || pct || ' and risk level ' || risk ||
                         ': reduce the most volatile holdings or add a hedge. ' || rec
             WHEN 2 THEN 'Shock probability ' || pct || ', normal risk and improving ' || dom || ' tone (' ||
                         printf('%+.3f', mood + 1.3e-9) || '): a favourable entry. ' || rec
             WHEN 3 THEN 'Mixed signals: shock probability ' || pct || ', risk level ' || risk || '. Watch ' || dom ||
                         ' headlines. ' || rec
             ELSE 'Stable: shock probability ' || pct || ', risk level ' || risk || '. ' || rec END AS reasoning
    FROM c_act""")
def signal_buysell(s, d):
    t = signals(s, d).withColumn("risk", ru.risk_label(F.col("predicted_vol")))
    dom = x.domain_days(s, d)
    sens = ru.sensitivity(domain_ranks(s, d), sv.recent_mean(dom, "domain", "sentiment_score", 7))
    band = rc.empirical_band(sh.recovery_days(sh.shock_days(x.portfolio_days(s, d))), "portfolio")
    band = band.select("portfolio", ru.recovery_text(F.col("p25"), F.col("p50"), F.col("p75")).alias("recovery"))
    mood = dom.select(F.col("domain").alias("dominant_domain"), "date", F.col("sentiment_score").alias("mood"))
    t = t.join(sens.select("portfolio", "dominant_domain"), "portfolio").join(
        mood, ["dominant_domain", "date"], "left").join(band, "portfolio")
    return ru.action(t, "p", "risk", "dominant_domain", "mood", "recovery").select(
        "portfolio", "date", "action", "confidence", "reasoning")


def _profile(s, d):
    from riskspark.operators import features as fe
    from riskspark.plans.modelling import portfolio_feats
    coef = pr.correlation_coefficients(x.portfolio_days(s, d), x.domain_days(s, d))
    pf = portfolio_feats(s, d)
    return pr.profile(coef, pf, pf, fe.composition(x.traded_members(s, d), K.SAFE_HAVEN))


@query("expansion_suggestions")
def expansion_suggestions(s, d):
    t = _profile(s, d)
    return t.select("portfolio", "safe_haven_weight", "intra_portfolio_correlation",
                    ru.expansion(F.col("safe_haven_weight"), F.col("intra_portfolio_correlation")).alias("suggestions"))


# --- scored by stored models ------------------------------------------------------

def model_store(s, d):
    """The store named by ``spark.riskspark.models``; if unset, one on shared storage for
    this application and these tables."""
    own = f"models/{s.sparkContext.applicationId}/{hashlib.md5(d.encode()).hexdigest()}"
    return Store(s, s.conf.get("spark.riskspark.models", None) or shared_path(s, own))


def train(s, d, store):
    from riskspark.plans.joins import _CTX, shock_events
    from riskspark.plans.modelling import PORTFOLIOS, causality, day_frame, day_frame_at, portfolio_feats
    x.reductions(s, d)
    days, events, causes = side_by_side(
        s, lambda: day_frame(s, d), lambda: materialise(shock_events(s, d), "events"), lambda: causality(s, d))
    prof = _profile(s, d).select("portfolio", "mean_shock_frequency", "intra_portfolio_correlation",
                                 "sector_concentration_hhi", "safe_haven_weight")
    return tr.train(store, tr.Inputs(
        days=days, portfolio_feats=portfolio_feats(s, d), events=events,
        profile=prof, causes=causes.groupBy("cause", "effect").agg(
            F.min_by("lag", "p_value").alias("lag"), F.min("p_value").alias("p_value")),
        shock_portfolio=K.SHOCK_PORTFOLIO, order=PORTFOLIOS, penalties=K.RIDGE_ALPHAS, context=_CTX,
        days_at=day_frame_at(s, d)))


def trained(s, d):
    """The newest version of the store; a first one is trained where there is none."""
    store = model_store(s, d)
    return store.latest() or train(s, d, store)


def scored_days(s, d, version, portfolio=None):
    from riskspark.operators import features as fe, rolling as ro
    from riskspark.plans.modelling import PORTFOLIOS, day_frame, portfolio_feats
    f, dom = portfolio_feats(s, d), x.domain_days(s, d)
    context = fe.shock_context(f.select("portfolio", "date", "vol5", "pre_shock_baseline"), dom_feats(s, d),
                               ro.regime_flag(x.panel(s, d), K.MARKET_TICKER), K.DOMAINS)
    recent = sv.recent_mean(dom, "domain", "sentiment_score", 7)
    return sc.signal_days(version, day_frame(s, d), f, context, dom, recent, PORTFOLIOS, K.DOMAINS, K.SHOCK_PORTFOLIO,
                          portfolio)


@query("signal_model_days")
def signal_model_days(s, d):
    """Shock, risk and action signals of every portfolio-day, on the models' output."""
    return scored_days(s, d, trained(s, d))


def serving_record(s, d, version, portfolio=None):
    """One record per portfolio (or of the named one) from a stored version: each model's
    latest scorable day, sensitivities, category, action, stock table and chart window."""
    from riskspark.plans.modelling import portfolio_feats
    dom, f = x.domain_days(s, d), portfolio_feats(s, d)
    days = materialise(scored_days(s, d, version, portfolio), "scored_days")
    shock = sv.latest_value(days.filter("p IS NOT NULL"), "portfolio", "date", "p", "threshold").withColumnRenamed(
        "date", "shock_date")
    risk = sv.latest_value(days.filter("predicted_vol IS NOT NULL"), "portfolio", "date", "predicted_vol", "p25", "p75",
                           "risk_label")
    recovery = sv.latest_value(days, "portfolio", "date", "p25_days", "p50_days", "p75_days", "recovery").drop("date")
    sens = sc.sensitivities(version, sv.recent_mean(dom, "domain", "sentiment_score", 7), K.DOMAINS, portfolio)
    members = dimension(s, [(p, t, i) for p, ts in K.PORTFOLIOS.items() for i, t in enumerate(ts)],
                        "portfolio string, ticker string, position int")
    members = members if portfolio is None else members.filter(F.col("portfolio") == portfolio)
    stocks = sv.stock_table(x.returns(s, d), members.select("portfolio", "ticker"), f).groupBy("portfolio").agg(
        F.sort_array(F.collect_list(F.struct("ticker", "last_price", "return_5d", "vol5", "shock_today"))).alias("stock_table"))
    chart = sv.chart_window(x.trading_days(s, d), x.panel(s, d), dom, members)
    category = version.table("clusters", portfolio=portfolio).select(
        "portfolio", "kmeans_label", "mean_shock_frequency", "safe_haven_weight", "sector_concentration_hhi",
        F.col("intra_portfolio_correlation").alias("intra"))
    out = members.select("portfolio").distinct()
    for part in (shock, risk, recovery, sens, sc.confirmed_causes(version, K.DOMAINS, portfolio), category, stocks, chart):
        out = out.join(part, "portfolio", "left")
    out = ru.action(out, "p", "risk_label", "dominant_domain", "recent_sentiment", "recovery")
    limit, label = F.coalesce("threshold", F.lit(sc.NO_THRESHOLD)), F.coalesce("risk_label", F.lit("NORMAL"))
    return out.select(
        "portfolio", "date", label.alias("status"), "action", "confidence", "reasoning",
        F.round(F.coalesce("p", F.lit(0.0)) * 20, 2).alias("sri_value"),
        F.coalesce("kmeans_label", F.lit("Unknown")).alias("category"),
        F.struct(F.col("shock_date").alias("date"), F.round("p", 4).alias("probability"),
                 F.when(F.col("p").isNotNull(), ru.shock_signal(F.col("p"), limit)).alias("signal"),
                 F.round(limit, 3).alias("optimal_threshold")).alias("shock"),
        F.struct(F.round("p25_days", 1).alias("p25_days"), F.round("p50_days", 1).alias("p50_days"),
                 F.round("p75_days", 1).alias("p75_days"), F.col("recovery").alias("band_label")).alias("recovery"),
        F.struct(*[F.round(c, 6).alias(a) for c, a in (("predicted_vol", "predicted_vol"), ("p25", "p25_vol"),
                                                       ("p75", "p75_vol"))], "risk_label").alias("risk_score"),
        F.struct("dominant_domain", "dominant_coeff", "ranked_domains", F.col("recent_by_domain").alias("recent_sentiment"),
                 "direction", F.initcap("dominant_domain").alias("news_to_watch"), "granger_note").alias("domain_sensitivity"),
        F.struct(F.col("kmeans_label").alias("label"), F.round(F.col("mean_shock_frequency") * 100, 1).alias("shock_frequency_pct"),
                 F.round("intra", 3).alias("intra_correlation"), F.round(F.col("safe_haven_weight") * 100, 1).alias("safe_haven_pct"),
                 F.round("sector_concentration_hhi", 3).alias("concentration_hhi"),
                 ru.expansion(F.col("safe_haven_weight"), F.col("intra")).alias("expansion")).alias("portfolio_category"),
        "stock_table", "market_chart")


@query("serving_view")
def serving_view(s, d):
    """The records of all portfolios."""
    return serving_record(s, d, trained(s, d))
