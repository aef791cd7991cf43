"""Models and significance tests."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskspark import constants as K, fixtures as fx
from riskspark.common import dimension, materialise, r, rounded
from riskspark.models import (frames as fr, gram as gm, lags as lg, profiles as pr, quantile as qr, recovery as rc,
                              ridge as rg, shock as sk, statespace as ss, tests as ts)
from riskspark.operators import (calendar as cal, correlation as co, features as fe, ranking as rk, rolling as ro,
                                 scores as sc, sentiment as se, shocks as sh, summary as sm, textscore as tsx)
from riskspark.plans import inputs as x
from riskspark.plans.aggregates import MARKET_NEWS_SQL, R
from riskspark.plans.joins import _CTX, shock_events
from riskspark.plans.registry import query
from riskspark.plans.shared_sql import CTES, std_gate
from riskspark.plans.windows import dom_feats, feats, pair_series

PORTFOLIOS = list(K.PORTFOLIOS)


# --- feature tables -------------------------------------------------------------

def portfolio_feats(s, d):
    return x._once("pf_features", s, d, lambda: fe.with_intra_corr(
        fe.with_shocks(feats(s, d)), x.returns(s, d), fx.portfolio_map(s)))


def day_frame(s, d, until=None):
    return x._once("day_frame", s, d, lambda: fr.day_frame(
        dom_feats(s, d), portfolio_feats(s, d), ro.regime_flag(x.panel(s, d), K.MARKET_TICKER), PORTFOLIOS, until))


def day_frame_at(s, d):
    """{fold: cutoff} -> the day frame as known at each cutoff."""
    dom, regime = dom_feats(s, d), ro.regime_flag(x.panel(s, d), K.MARKET_TICKER)
    return lambda until: fr.day_frame_at(dom, portfolio_feats(s, d), regime, PORTFOLIOS, until)


CTES["c_pffull"] = "SELECT s.*, i.intra_corr FROM c_shock s LEFT JOIN c_intra i USING (portfolio, date)"


@query("ml_features", f"""SELECT portfolio, date, {', '.join(f'{R(c)} AS {c}' for c in
    ('ret', 'vol5', 'vol10', 'vol20', 'vol_zscore_5d', 'intra_corr'))}, shock FROM c_pffull""")
def ml_features(s, d):
    t = fe.with_intra_corr(fe.with_shocks(feats(s, d)), x.returns(s, d), fx.portfolio_map(s))
    cols = ["ret", "vol5", "vol10", "vol20", "vol_zscore_5d", "intra_corr"]
    return rounded(t.select("portfolio", "date", *cols, "shock"), *cols)


# --- splits, scaling, evaluation --------------------------------------------------

_SCALE = ["ret", "vol5", "vol20"]


@query("scale_standard", f"""
    WITH v AS (SELECT *, row_number() OVER (PARTITION BY portfolio ORDER BY date) AS rn,
                      count(*) OVER (PARTITION BY portfolio) AS n FROM c_pff),
    m AS (SELECT portfolio, {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALE)}
          FROM v WHERE rn <= floor(n * 0.8::DOUBLE) GROUP BY 1)
    SELECT portfolio, date, {', '.join(f"{R(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in _SCALE)}
    FROM c_pff JOIN m USING (portfolio)""")
def scale_standard(s, d):
    t = cal.split_time(feats(s, d).select("portfolio", "date", *_SCALE), ["portfolio"])
    m = t.filter("is_train").groupBy("portfolio").agg(*[F.avg(c).alias(f"m_{c}") for c in _SCALE],
                                                      *[F.stddev_pop(c).alias(f"s_{c}") for c in _SCALE])
    return t.join(m, "portfolio").select("portfolio", "date", *[
        r(F.try_divide(F.col(c) - F.col(f"m_{c}"), F.col(f"s_{c}"))).alias(c) for c in _SCALE])


@query("eval_regression", f"""
    WITH e AS (SELECT portfolio, vol5 AS y, lagged_vol AS p FROM c_pff WHERE vol5 IS NOT NULL AND lagged_vol IS NOT NULL)
    SELECT portfolio, {R('avg(abs(y - p))')} AS mae, {R('avg((y - p) * (y - p))')} AS mse,
           {R('1 - avg((y - p) * (y - p)) / var_pop(y)')} AS r2 FROM e GROUP BY 1""")
def eval_regression(s, d):
    from riskspark.operators.summary import eval_regression as ev
    t = feats(s, d).select("portfolio", F.col("vol5").alias("y"), F.col("lagged_vol").alias("p"))
    return rounded(ev(t, ["portfolio"], "y", "p"), "mae", "mse", "r2")


# --- M1 ---------------------------------------------------------------------------

def _m1_rows(s, d):
    f = fr.shock_features("tech")
    return materialise(sk.training_rows(day_frame(s, d), f, "shock_tech"), "m1"), f


@query("m1_shock_classifier")
def m1_shock_classifier(s, d):
    rows, f = _m1_rows(s, d)
    return sk.evaluate(materialise(sk.walk_forward(rows, features=f, frame_at=day_frame_at(s, d)), "m1_scores"))


@query("m1_importance")
def m1_importance(s, d):
    rows, f = _m1_rows(s, d)
    model = sk.classifier().fit(sk.balanced(rows))
    return sk.importances(model, f, s)


def m1_probabilities(s, d):
    """(date, p) of every day from the classifier fitted on all complete rows, gaps filled
    with medians; None where the rows don't hold both classes."""
    rows, f = _m1_rows(s, d)
    if rows.select("label").distinct().count() < 2:
        return None
    days = day_frame(s, d)
    mid = days.agg(*[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(c) for c in f]).first()
    filled = days.select("date", *[F.coalesce(F.col(c).cast("double"), F.lit(mid[c])).alias(c) for c in f])
    model = sk.classifier().fit(sk.balanced(rows))
    return sk.score(model, VectorAssembler(inputCols=f, outputCol="features").transform(filled)).select("date", "p")


# --- M2 ---------------------------------------------------------------------------

@query("m2_shock_pool", f"""SELECT portfolio, date, {R('vol5')} AS shock_magnitude,
    {R('pre_shock_baseline')} AS pre_shock_baseline, recovery_days, censored, market_regime, quarter, year,
    {', '.join(f"{R(c)} AS {c}" if not c.startswith('spike') else c for c in _CTX)} FROM c_events""")
def m2_shock_pool(s, d):
    t = shock_events(s, d).select("portfolio", "date", F.col("vol5").alias("shock_magnitude"), "pre_shock_baseline",
                                  "recovery_days", "censored", "market_regime", "quarter", "year", *_CTX)
    return rounded(t, "shock_magnitude", "pre_shock_baseline", *[c for c in _CTX if not c.startswith("spike")])


def recovery_bands(s, d):
    cols = ["vol5", "sector_label", "pre_shock_baseline", "market_regime", "quarter", "year", *_CTX]
    events, probs = materialise(shock_events(s, d), "shocks"), m1_probabilities(s, d)
    if probs is not None:
        events = materialise(rc.confident(events, probs, "tech"), "confident")
    pool = rc.pooled_split(events, PORTFOLIOS)
    pool = materialise(rc.impute(materialise(pool, "pool"), cols), "pool_full")
    return rc.band(pool, cols)


@query("m2_recovery_band")
def m2_recovery_band(s, d):
    return rc.band_quality(materialise(recovery_bands(s, d), "bands"))


@query("m2_empirical_band", f"""SELECT portfolio, {', '.join(f"{R(f'quantile_cont(recovery_days, {q})')} AS {n}"
    for q, n in ((0.25, 'p25'), (0.5, 'p50'), (0.75, 'p75')))} FROM c_recovery GROUP BY 1""")
def m2_empirical_band(s, d):
    rec = sh.recovery_days(sh.shock_days(x.portfolio_days(s, d)))
    return rounded(rc.empirical_band(rec, "portfolio"), "p25", "p50", "p75")


# --- M3, M5 -----------------------------------------------------------------------

def m3_frame(s, d):
    return x._once("m3_frame", s, d, lambda: fr.with_target(day_frame(s, d), portfolio_feats(s, d), "vol5", ahead=1))


@query("m3_risk_ridge")
def m3_risk_ridge(s, d):
    """Holdout quality and the quartile band of next-day volatility."""
    f = fr.risk_features()
    frame = m3_frame(s, d)
    model = materialise(rg.fit(frame, "portfolio", f, "target", [1.0]), "m3_model")
    split = cal.split_time(frame.dropna(subset=[*f, "target"]), ["portfolio"])
    names = {0.25: "p25", 0.75: "p75"}
    scaled = materialise(qr.standardised(split, "portfolio", f), "m3_scaled")
    bands = qr.fit(scaled.filter("is_train"), "portfolio", f, "target", list(names))
    point = rg.predict(split.filter("NOT is_train"), model, "portfolio", f)
    test = qr.predict(scaled.filter("NOT is_train"), "portfolio", f, bands, names)
    test = test.join(point, ["portfolio", "date"])
    test = qr.ordered(test, "p25", "prediction", "p75")
    quality = model.groupBy("portfolio").agg(F.first("r2").alias("r2"))
    return test.groupBy("portfolio").agg(F.avg(F.abs(F.col("target") - F.col("prediction"))).alias("mae"),
                                         F.avg(F.col("p75") - F.col("p25")).alias("band_width"),
                                         F.count(F.lit(1)).alias("n_test")).join(quality, "portfolio")


@query("m3_nonlinear_check")
def m3_nonlinear_check(s, d):
    from riskspark.models.risk import nonlinear_check
    f = fr.risk_features()
    return nonlinear_check(m3_frame(s, d), "portfolio", f, "target", PORTFOLIOS)


def m5_model(s, d):
    return x._once("m5_model", s, d, lambda: rg.fit(
        fr.with_target(day_frame(s, d), portfolio_feats(s, d), "vol5"), "portfolio", fr.sensitivity_features(),
        "target", K.RIDGE_ALPHAS))


@query("m5_ridge_cv")
def m5_ridge_cv(s, d):
    return m5_model(s, d).select("portfolio", "feature", "coefficient", "alpha", "r2", "n_train")


@query("m5_domain_coef")
def m5_domain_coef(s, d):
    return rg.domain_coefficients(m5_model(s, d), "portfolio")


@query("m5_linear_attribution")
def m5_linear_attribution(s, d):
    frame = fr.with_target(day_frame(s, d), portfolio_feats(s, d), "vol5")
    return rg.attribution(frame, m5_model(s, d), "portfolio", fr.sensitivity_features())


@query("slope_attribution", f"""
    WITH v AS (SELECT portfolio, domain, date, sentiment_score AS x, vol5 AS y FROM c_pf JOIN c_dom USING (date)
               WHERE sentiment_score IS NOT NULL AND vol5 IS NOT NULL),
    m AS (SELECT portfolio, domain, regr_slope(y, x) AS b, avg(x) AS mx FROM v GROUP BY 1, 2)
    SELECT portfolio, domain, date, {R('b * (x - mx)')} AS attribution FROM v JOIN m USING (portfolio, domain)""")
def slope_attribution(s, d):
    v = x.portfolio_days(s, d).join(x.domain_days(s, d).select("date", "domain", "sentiment_score"), "date").dropna(
        subset=["sentiment_score", "vol5"])
    line = sm.ols_line(v, ["portfolio", "domain"], "sentiment_score", "vol5")
    mean = v.groupBy("portfolio", "domain").agg(F.avg("sentiment_score").alias("mx"))
    t = v.join(line, ["portfolio", "domain"]).join(mean, ["portfolio", "domain"])
    return t.select("portfolio", "domain", "date",
                    r(F.col("slope") * (F.col("sentiment_score") - F.col("mx"))).alias("attribution"))


_CORR = [f"sentiment_score_{g}" for g in K.DOMAINS] + [f"avg_prob_neg_{g}" for g in K.DOMAINS] + [
    f"news_lag1_sentiment_score_{g}" for g in K.DOMAINS] + [f"ret_{p}" for p in PORTFOLIOS]
_CORR_SQL = "SELECT date, " + ", ".join(
    f"max(CASE WHEN domain = '{g}' THEN {m} END) AS {m}_{g}" for g in K.DOMAINS
    for m in ("sentiment_score", "avg_prob_neg", "news_lag1_sentiment_score")) + " FROM c_dom GROUP BY 1"
_PFW_SQL = "SELECT date, " + ", ".join(f"max(CASE WHEN portfolio = '{p}' THEN ret END) AS ret_{p}"
                                       for p in PORTFOLIOS) + " FROM c_pf GROUP BY 1"


@query("corr_matrix", f"""
    WITH w AS (SELECT * FROM ({_CORR_SQL}) JOIN ({_PFW_SQL}) USING (date) WHERE
               {' AND '.join(f'{c} IS NOT NULL' for c in _CORR)}),
    p AS ({' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM w"
                              for i, a in enumerate(_CORR) for b in _CORR[i + 1:])})
    SELECT a, b, {R('r')} AS r, abs(r) > 0.7 AS high FROM p""")
def corr_matrix(s, d):
    measures = ["sentiment_score", "avg_prob_neg", "news_lag1_sentiment_score"]
    wide = se.pivot_domains(x.domain_days(s, d), K.DOMAINS, measures)
    pf = x.portfolio_days(s, d).groupBy("date").pivot("portfolio", PORTFOLIOS).agg(F.first("ret"))
    pf = pf.withColumnsRenamed({p: f"ret_{p}" for p in PORTFOLIOS})
    return rounded(co.correlation_table(wide.join(pf, "date"), _CORR), "r")


# --- M4 ---------------------------------------------------------------------------

def _all_series(s, d):
    dom = x.domain_days(s, d).select(F.concat(F.lit("sentiment_"), "domain").alias("series"), "date",
                                     F.col("sentiment_score").alias("value"))
    pf = x.portfolio_days(s, d).select(F.concat(F.lit("vol5_"), "portfolio").alias("series"), "date",
                                       F.col("vol5").alias("value"))
    return x._once("series", s, d, lambda: dom.unionByName(pf))


def _stationary(s, d):
    ser = _all_series(s, d)
    return x._once("stationary", s, d, lambda: lg.make_stationary(ser, "series", "value", lg.adf(ser, "series", "value")))


@query("m4_adf")
def m4_adf(s, d):
    return lg.adf(_all_series(s, d), "series", "value")


def stationary_pairs(s, d):
    t = _stationary(s, d)
    name = F.substring_index
    cause = t.filter(t.series.startswith("sentiment_")).select(
        F.replace("series", F.lit("sentiment_"), F.lit("")).alias("cause"), "date", F.col("value").alias("x"))
    effect = t.filter(t.series.startswith("vol5_")).select(
        F.replace("series", F.lit("vol5_"), F.lit("")).alias("effect"), "date", F.col("value").alias("y"))
    control = cause.filter("cause = 'financial'").select("date", F.col("x").alias("z"))
    return fx.cause_effect_pairs(s).join(cause, "cause").join(effect, ["effect", "date"]).join(control, "date", "left")


def causality(s, d):
    rows = materialise(stationary_pairs(s, d), "pairs")
    plain = lg.granger(rows, ["cause", "effect"], "y", "x")
    given = lg.granger(rows.filter("cause <> 'financial'"), ["cause", "effect"], "y", "x", "z")
    return plain.unionByName(given)


@query("m4_granger")
def m4_granger(s, d):
    return causality(s, d)


@query("m4_granger_lag1", f"""
    WITH t AS (SELECT cause, effect, y, lag(y) OVER w AS y1, lag(x) OVER w AS x1 FROM c_pairts
               WINDOW w AS (PARTITION BY cause, effect ORDER BY date)),
    m AS (SELECT cause, effect, count(*) AS n, var_pop(y) AS syy, var_pop(y1) AS s11, var_pop(x1) AS s22,
                 covar_pop(y, y1) AS sy1, covar_pop(y, x1) AS sy2, covar_pop(y1, x1) AS s12
          FROM t WHERE y1 IS NOT NULL GROUP BY 1, 2),
    f AS (SELECT *, n * (syy - sy1 * sy1 / s11) AS rss_own,
                 n * (syy - (sy1 * (s22 * sy1 - s12 * sy2) + sy2 * (s11 * sy2 - s12 * sy1)) / (s11 * s22 - s12 * s12))
                   AS rss_full FROM m)
    SELECT cause, effect, n AS n_obs, {R('rss_own', 4)} AS rss_own, {R('rss_full', 4)} AS rss_full,
           {R('(rss_own - rss_full) / (rss_full / (n - 3))', 4)} AS f_stat FROM f""")
def m4_granger_lag1(s, d):
    t = lg.granger(pair_series(s, d), ["cause", "effect"], "y", "x", max_lag=1)
    return rounded(t.select("cause", "effect", "n_obs", "rss_own", "rss_full", "f_stat"), "rss_own", "rss_full",
                   "f_stat", digits=4)


@query("m4_var_bic")
def m4_var_bic(s, d):
    t = _stationary(s, d)
    names = [f"sentiment_{g}" for g in K.DOMAINS] + [f"vol5_{p}" for p in PORTFOLIOS]
    return lg.var_fit(t.groupBy("date").pivot("series", names).agg(F.first("value")), names)


def _arx_rows(s, d):
    idx = se.daily_index(fx.articles(s, d)).withColumn("_k", F.lit("all"))
    idx = idx.withColumn("sentiment_avg", F.lag("sentiment_avg", 1).over(cal.by_series("_k"))).dropna(subset=["sentiment_avg"])
    z = ro.zscore_global(idx, "sentiment_avg", ["_k"]).select("date", F.col("z_sentiment_avg").alias("sentiment"))
    ret = x.panel(s, d).withColumn("returns", ro.pct_return("price", "ticker"))
    return materialise(ret.select("ticker", "date", "returns").join(z, "date").dropna(), "arx")


@query("arx_forecast")
def arx_forecast(s, d):
    rows = _arx_rows(s, d)
    model, t = lg.arx(rows, "ticker", "returns", "sentiment")
    model = materialise(model, "arx_model")
    path = lg.arx_forecast(model, t, "ticker")
    err = path.groupBy("ticker").agg(F.avg(F.pow(F.col("actual") - F.col("forecast"), 2)).alias("mse"),
                                     F.avg(F.col("actual").between(F.col("lower"), F.col("upper")).cast("double"))
                                     .alias("coverage"), F.count(F.lit(1)).alias("n_test"))
    return model.select("ticker", "beta", "p_value", "verdict", "n_train").join(err, "ticker")


@query("armax_forecast")
def armax_forecast(s, d):
    """The same regression with moving-average errors, by exact likelihood."""
    return ss.report(materialise(ss.armax(_arx_rows(s, d), "ticker", "returns", "sentiment"), "armax"), "ticker")


# --- M6 ---------------------------------------------------------------------------

_PROFILE = [f"m5_coeff_{g}" for g in K.DOMAINS] + ["mean_shock_frequency", "intra_portfolio_correlation",
                                                  "sector_concentration_hhi", "safe_haven_weight"]


def _profiles(s, d, coef):
    return pr.profile(coef, portfolio_feats(s, d), portfolio_feats(s, d), fe.composition(fx.portfolio_map(s), K.SAFE_HAVEN))


@query("m6_profile", f"""
    WITH c AS (SELECT portfolio, domain, corr(ret, sentiment_score) AS r FROM c_pf JOIN c_dom USING (date) GROUP BY 1, 2)
    SELECT portfolio, {', '.join(f"(SELECT {R('r')} FROM c WHERE c.portfolio = b.portfolio AND domain = '{g}') AS m5_coeff_{g}" for g in K.DOMAINS)},
           (SELECT {R('avg(shock)')} FROM c_shock s WHERE s.portfolio = b.portfolio) AS mean_shock_frequency,
           (SELECT {R('avg(intra_corr)')} FROM c_intra i WHERE i.portfolio = b.portfolio) AS intra_portfolio_correlation,
           {R('1.0 / count(*)')} AS sector_concentration_hhi,
           {R(f"avg((ticker IN ({', '.join(chr(39) + t + chr(39) for t in K.SAFE_HAVEN)}))::INT)")} AS safe_haven_weight
    FROM c_bridge b GROUP BY 1""")
def m6_profile(s, d):
    coef = pr.correlation_coefficients(x.portfolio_days(s, d), x.domain_days(s, d))
    return rounded(_profiles(s, d, coef).select("portfolio", *_PROFILE), *_PROFILE)


def _clusters(s, d):
    coef = rg.domain_coefficients(m5_model(s, d), "portfolio")
    v = pr.vectors(materialise(_profiles(s, d, coef), "profiles"), _PROFILE).cache()
    rows, best = pr.choose_k(v)
    return rows, best, pr.assign(v, best)


@query("m6_kmeans")
def m6_kmeans(s, d):
    rows, best, _ = _clusters(s, d)
    return s.createDataFrame([(*row, row[0] == best) for row in rows],
                             "k int, silhouette double, inertia double, chosen boolean")


@query("m6_hierarchical")
def m6_hierarchical(s, d):
    return _clusters(s, d)[2].select("portfolio", "kmeans_cluster", "hierarchical_cluster")


@query("m6_cluster_names")
def m6_cluster_names(s, d):
    t = pr.name_clusters(_clusters(s, d)[2], "kmeans_cluster", "kmeans_label")
    t = pr.name_clusters(t, "hierarchical_cluster", "hierarchical_label")
    return t.select("portfolio", "kmeans_label", "hierarchical_label")


@query("m6_kmeans_vectors")
def m6_kmeans_vectors(s, d):
    """The same clustering on a vector table of any size."""
    from pyspark.ml.functions import array_to_vector
    v = fx.table(s, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    rows, best = pr.choose_k(materialise_vectors(v), pr.squared_silhouette)
    return s.createDataFrame([(*row, row[0] == best) for row in rows],
                             "k int, silhouette double, inertia double, chosen boolean")


def materialise_vectors(v):
    return materialise(v, "vectors")


# --- regimes ----------------------------------------------------------------------

def _regime_rows(s, d):
    p = x.prices(s, d).withColumn("ret", ro.pct_return("price", "ticker"))
    p = p.withColumns({"vol": ro.roll_std("ret", 20, 5, "ticker"), "drawdown": ro.drawdown("price", "ticker")})
    wide = se.pivot_domains(x.domain_days(s, d), K.DOMAINS, ["sentiment_score"])
    t = p.join(wide, "date").select("ticker", "date", "vol", "drawdown", F.col("sentiment_score_geopolitical").alias("geo"),
                                    F.col("sentiment_score_technology").alias("tech")).dropna(subset=["vol", "geo", "tech"])
    return t.withColumn("regime", sc.regime_label(F.col("geo"), F.col("tech")))


CTES["c_vol20"] = f"""
    SELECT *, {std_gate('ret', 20, 5, 'ticker')} AS vol FROM (
        SELECT ticker, date, price / lag(price) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM c_prices)"""


@query("regime_label", f"""
    SELECT v.ticker, v.date, {R('vol')} AS vol, CASE WHEN t.sentiment_score > 0.3 THEN 2 WHEN g.sentiment_score < -0.2 THEN 1
           ELSE 0 END AS regime FROM c_vol20 v
    JOIN (SELECT date, sentiment_score FROM c_dom WHERE domain = 'geopolitical') g USING (date)
    JOIN (SELECT date, sentiment_score FROM c_dom WHERE domain = 'technology') t USING (date)
    WHERE vol IS NOT NULL AND g.sentiment_score IS NOT NULL AND t.sentiment_score IS NOT NULL""")
def regime_label(s, d):
    return rounded(_regime_rows(s, d).select("ticker", "date", "vol", "regime"), "vol")


@query("rf_regime")
def rf_regime(s, d):
    from riskspark.models.risk import regime_report
    return regime_report(materialise(_regime_rows(s, d), "regimes"), ["vol", "drawdown", "geo", "tech"])


# --- significance tests -------------------------------------------------------------

def _arch(s, d):
    rows = [(a, t) for a, members in K.ARCHETYPES.items() for t in members]
    return ts.archetype_returns(x.returns(s, d), dimension(s, rows, "archetype string, ticker string"))


CTES["c_archret"] = """SELECT archetype, date, avg(ret) AS ret FROM c_ret JOIN c_arch USING (ticker)
    GROUP BY 1, 2 HAVING avg(ret) IS NOT NULL"""


@query("test_ranksum", f"""
    WITH v AS (SELECT archetype, ret FROM c_archret WHERE archetype IN ('tech', 'defensive')),
    k AS (SELECT archetype, rank() OVER (ORDER BY ret) + (count(*) OVER (PARTITION BY ret) - 1) / 2 AS rk FROM v),
    w AS (SELECT sum(rk) FILTER (archetype = 'tech') AS w, count(*) FILTER (archetype = 'tech') AS n1,
                 count(*) FILTER (archetype <> 'tech') AS n2 FROM k)
    SELECT n1, n2, {R('(w - n1 * (n1 + n2 + 1) / 2) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0::DOUBLE)')} AS z FROM w""")
def test_ranksum(s, d):
    v = _arch(s, d).filter(F.col("archetype").isin("tech", "defensive"))
    return rounded(rk.rank_sum(v, "ret", F.col("archetype") == "tech"), "z")


@query("test_bootstrap_t")
def test_bootstrap_t(s, d):
    return ts.bootstrap_t(_arch(s, d), "archetype", "ret", "tech", "defensive")


@query("test_anova", f"""
    WITH g AS (SELECT archetype, count(*) AS n, avg(ret) AS m, var_pop(ret) AS v FROM c_archret GROUP BY 1),
    t AS (SELECT count(*) AS k, sum(n) AS n, sum(n * v) AS w, sum(n * m) / sum(n) AS mm FROM g),
    b AS (SELECT sum(g.n * (g.m - t.mm) * (g.m - t.mm)) AS b FROM g, t)
    SELECT {R('(b / (k - 1)) / (w / (n - k))')} AS f_stat, k - 1 AS df_between, (n - k)::BIGINT AS df_within FROM t, b""")
def test_anova(s, d):
    return rounded(ts.anova(_arch(s, d), "archetype", "ret"), "f_stat")


@query("test_chi2", f"""
    WITH c AS (SELECT count(*) FILTER (a = 0 AND b = 0)::DOUBLE AS p, count(*) FILTER (a = 0 AND b = 1)::DOUBLE AS q,
                      count(*) FILTER (a = 1 AND b = 0)::DOUBLE AS r, count(*) FILTER (a = 1 AND b = 1)::DOUBLE AS t
               FROM ({MARKET_NEWS_SQL}))
    SELECT {R('(p + q + r + t) * pow(greatest(abs(p * t - q * r) - (p + q + r + t) / 2, 0), 2) / ((p + q) * (r + t) * (p + r) * (q + t))')}
             AS chi2, p + q + r + t AS n FROM c""")
def test_chi2(s, d):
    flags = ts.news_market_flags(x.domain_days(s, d), x.returns(s, d))
    return rounded(ts.chi2_yates(flags, F.col("a"), F.col("b")), "chi2")


@query("test_p_values")
def test_p_values(s, d):
    """Statistic and tail probability of the three tests above."""
    return ts.p_values(rk.rank_sum(_arch(s, d).filter(F.col("archetype").isin("tech", "defensive")), "ret", F.col("archetype") == "tech"),
                       ts.anova(_arch(s, d), "archetype", "ret"),
                       ts.chi2_yates(ts.news_market_flags(x.domain_days(s, d), x.returns(s, d)), F.col("a"), F.col("b")))


# --- text scores --------------------------------------------------------------------

@query("score_text_lexicon", f"""
    WITH l AS (SELECT * FROM (VALUES {', '.join(f"('{w}', {v}::DOUBLE)" for w, v in fx.LEXICON.items())}) v(word, valence)),
    w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS word FROM documents),
    c AS (SELECT doc_id, sum(valence) AS s FROM w JOIN l USING (word) GROUP BY 1)
    SELECT doc_id, source, {R('coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15)')} AS compound
    FROM documents LEFT JOIN c USING (doc_id)""")
def score_text_lexicon(s, d):
    t = tsx.lexicon_score(fx.table(s, d, "documents"), ["doc_id", "source"], "text", fx.LEXICON)
    return rounded(t, "compound")


@query("score_text_batch")
def score_text_batch(s, d):
    h = fx.headlines(s, d).select("doc_id", "line_no", "headline")
    return tsx.score_texts(h, "headline").select("doc_id", "line_no", *tsx.LABELS_OUT)
