"""Window operators, each over one series of daily rows."""

from pyspark.sql import functions as F

from riskspark import constants as K, fixtures as fx
from riskspark.common import r, rounded
from riskspark.operators import (calendar as cal, correlation as co, features as fe, normalise as nz, rolling as ro,
                                 shocks as sh, sentiment as se)
from riskspark.plans import inputs as x
from riskspark.plans.aggregates import R
from riskspark.plans.registry import query
from riskspark.plans.shared_sql import CTES, avg_gate, std_gate

_W = "OVER (PARTITION BY {} ORDER BY date)"
PF, DM, TK = (_W.format(k) for k in ("portfolio", "domain", "ticker"))


def _pick(df, keys, *cols):
    return rounded(df.select(*keys, *cols), *cols)


TKEY, PKEY, DKEY = ["ticker", "date"], ["portfolio", "date"], ["domain", "date"]

CTES["c_pff"] = f"""
    SELECT portfolio, date, ret, vol5, {std_gate('ret', 10, 3, 'portfolio')} AS vol10,
           {std_gate('ret', 20, 5, 'portfolio')} AS vol20,
           {avg_gate('ret', 5, 2, 'portfolio')} AS rolling_mean_return_5d,
           (vol5 - {avg_gate('vol5', 20, 5, 'portfolio')}) / nullif({std_gate('vol5', 20, 5, 'portfolio')}, 0)
             AS vol_zscore_5d,
           lag(vol5) {PF} AS lagged_vol, {avg_gate('vol5', 20, 5, 'portfolio')} AS pre_shock_baseline,
           CASE WHEN count(vol5) {PF} >= 10 THEN quantile_cont(vol5, 0.95) {PF} END AS threshold
    FROM c_pf"""
CTES["c_shock"] = "SELECT *, coalesce((vol5 > threshold * (1 + 1e-9))::INT, 0) AS shock FROM c_pff"
CTES["c_domf0"] = f"""
    SELECT *, {', '.join(f'lag(sentiment_score, {i}) {DM} AS lag{i}_sentiment_score' for i in range(1, 8))},
           (article_count - {avg_gate('article_count', 20, 3, 'domain')})
             / nullif({std_gate('article_count', 20, 3, 'domain')}, 0) AS article_zscore,
           coalesce((article_count > 0)::INT, 0) AS news_available,
           sentiment_score - lag(sentiment_score) {DM} AS sentiment_velocity,
           {avg_gate('sentiment_score', 3, 1, 'domain')} AS sentiment_3d
    FROM c_dom"""
CTES["c_domf"] = """SELECT *, coalesce((article_zscore > 2 + 1e-9)::INT, 0) AS article_spike,
    article_zscore * sentiment_score AS weighted_sentiment FROM c_domf0"""
# A window of one repeated price has that price as its mean; DuckDB's sum may round below it.
CTES["c_regime"] = f"""
    SELECT date, CASE WHEN count(DISTINCT price) OVER w = 1 THEN 0
           ELSE coalesce((price > {avg_gate('price', 20, 5, 'ticker')})::INT, 0) END AS market_regime_flag
    FROM c_panel WHERE ticker = '{K.MARKET_TICKER}'
    WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""
CTES["c_work"] = f"""
    SELECT *, row_number() {PF} AS rn, count(*) OVER (PARTITION BY portfolio) AS n,
           coalesce((vol5 < threshold * (1 - 1e-9))::INT, 0) AS calm FROM c_shock WHERE vol5 IS NOT NULL"""
CTES["c_calm"] = f"""
    SELECT *, calm * coalesce(lead(calm) {PF}, 0) * coalesce(lead(calm, 2) {PF}, 0) AS run FROM c_work"""
CTES["c_recovery"] = """
    SELECT portfolio, date, vol5, threshold, pre_shock_baseline,
           (coalesce(nxt, n) - rn)::INT AS recovery_days, nxt IS NULL AS censored
    FROM (SELECT *, min(CASE WHEN run = 1 THEN rn END) OVER (PARTITION BY portfolio ORDER BY date
          ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM c_calm) WHERE shock = 1"""


def feats(s, d):
    return fe.portfolio_features(x.portfolio_days(s, d))


def dom_feats(s, d):
    return fe.domain_features(x.domain_days(s, d))


@query("log_return", f"SELECT ticker, date, {R('ret')} AS ret FROM c_ret0")
def log_return(s, d):
    return _pick(x.returns(s, d), TKEY, "ret")


@query("pct_return", f"SELECT ticker, date, {R(f'price / lag(price) {TK} - 1')} AS ret FROM c_panel")
def pct_return(s, d):
    return _pick(x.panel(s, d).withColumn("ret", ro.pct_return("price", "ticker")), TKEY, "ret")


@query("roll_std_5", f"SELECT ticker, date, {R('vol5')} AS vol5 FROM c_ret")
def roll_std_5(s, d):
    return _pick(x.returns(s, d), TKEY, "vol5")


@query("roll_std_10_20", f"SELECT portfolio, date, {R('vol10')} AS vol10, {R('vol20')} AS vol20 FROM c_pff")
def roll_std_10_20(s, d):
    return _pick(feats(s, d), PKEY, "vol10", "vol20")


@query("roll_mean", f"""SELECT portfolio, date, {R('rolling_mean_return_5d')} AS rolling_mean_return_5d,
    {R('pre_shock_baseline')} AS pre_shock_baseline FROM c_pff""")
def roll_mean(s, d):
    return _pick(feats(s, d), PKEY, "rolling_mean_return_5d", "pre_shock_baseline")


@query("roll_mean_sentiment", f"SELECT domain, date, {R('sentiment_3d')} AS sentiment_3d FROM c_domf")
def roll_mean_sentiment(s, d):
    return _pick(dom_feats(s, d), DKEY, "sentiment_3d")


@query("roll_zscore", f"SELECT portfolio, date, {R('vol_zscore_5d')} AS vol_zscore_5d FROM c_pff")
def roll_zscore(s, d):
    return _pick(feats(s, d), PKEY, "vol_zscore_5d")


@query("article_zscore_spike", f"""SELECT domain, date, {R('article_zscore')} AS article_zscore, article_spike,
    news_available FROM c_domf""")
def article_zscore_spike(s, d):
    t = dom_feats(s, d).select("domain", "date", "article_zscore", "article_spike", "news_available")
    return rounded(t, "article_zscore")


_LAGS = [f"lag{i}_sentiment_score" for i in range(1, 8)]


@query("lag_features", "SELECT domain, date, " + ", ".join(f"{R(c)} AS {c}" for c in _LAGS) + " FROM c_domf")
def lag_features(s, d):
    return _pick(dom_feats(s, d), DKEY, *_LAGS)


@query("lag1_news_calendar", f"SELECT domain, date, {R('news_lag1_sentiment_score')} AS lag1 FROM c_news")
def lag1_news_calendar(s, d):
    news = cal.domain_grid(x.daily(s, d), K.DOMAINS)
    return _pick(news.withColumn("lag1", F.lag("sentiment_score").over(cal.by_series("domain"))), DKEY, "lag1")


@query("velocity", f"SELECT domain, date, {R('sentiment_velocity')} AS sentiment_velocity FROM c_domf")
def velocity(s, d):
    return _pick(dom_feats(s, d), DKEY, "sentiment_velocity")


@query("lead_target", f"SELECT portfolio, date, {R(f'lead(vol5) {PF}')} AS next_vol5 FROM c_pf")
def lead_target(s, d):
    return _pick(x.portfolio_days(s, d).withColumn("next_vol5", ro.lead("vol5", 1, "portfolio")), PKEY, "next_vol5")


@query("lagged_vol", f"SELECT portfolio, date, {R('lagged_vol')} AS lagged_vol FROM c_pff")
def lagged_vol(s, d):
    return _pick(feats(s, d), PKEY, "lagged_vol")


@query("ffill", f"SELECT ticker, date, {R('price')} AS price FROM c_panel")
def ffill(s, d):
    return _pick(x.panel(s, d), TKEY, "price")


@query("ffill_limit1", f"""SELECT domain, date, {R('sentiment_score')} AS sentiment_score,
    {R('news_lag1_sentiment_score')} AS news_lag1_sentiment_score, article_count FROM c_dom""")
def ffill_limit1(s, d):
    t = x.domain_days(s, d).select("domain", "date", "sentiment_score", "news_lag1_sentiment_score", "article_count")
    return rounded(t, "sentiment_score", "news_lag1_sentiment_score")


@query("expanding_q95_shock", f"SELECT portfolio, date, {R('threshold')} AS threshold, shock FROM c_shock")
def expanding_q95_shock(s, d):
    return rounded(sh.shock_days(x.portfolio_days(s, d)).select("portfolio", "date", "threshold", "shock"), "threshold")


@query("regime_flag", "SELECT date, market_regime_flag FROM c_regime")
def regime_flag(s, d):
    return ro.regime_flag(x.panel(s, d), K.MARKET_TICKER)


CTES["c_pairret"] = """
    SELECT p.portfolio, p.a, p.b, x.date, x.ret AS ra, y.ret AS rb
    FROM (SELECT m.portfolio, m.ticker AS a, n.ticker AS b FROM c_bridge m JOIN c_bridge n
          ON m.portfolio = n.portfolio AND m.ticker < n.ticker) p
    JOIN c_ret x ON x.ticker = p.a JOIN c_ret y ON y.ticker = p.b AND y.date = x.date"""
CTES["c_intra"] = """
    SELECT portfolio, date, avg(CASE WHEN n >= 5 AND NOT isnan(r) THEN r END) AS intra_corr FROM (
        SELECT portfolio, date, corr(ra, rb) OVER w AS r,
               count(CASE WHEN ra IS NOT NULL AND rb IS NOT NULL THEN 1 END) OVER w AS n
        FROM c_pairret WINDOW w AS (PARTITION BY portfolio, a, b ORDER BY date
                                    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) GROUP BY 1, 2"""


@query("roll_corr_pairs", f"""SELECT portfolio, date, {R('intra_corr')} AS intra_corr FROM c_intra
    WHERE intra_corr IS NOT NULL""")
def roll_corr_pairs(s, d):
    return _pick(co.mean_pair_correlation(x.returns(s, d), fx.portfolio_map(s)), PKEY, "intra_corr")


@query("roll_corr_60", f"""
    WITH v AS (SELECT date, ret, sentiment_score AS y, 1 AS k FROM c_pf JOIN c_dom USING (date)
               WHERE portfolio = 'tech' AND domain = 'technology' AND ret IS NOT NULL AND sentiment_score IS NOT NULL),
    c AS (SELECT date, CASE WHEN count(*) OVER w >= 60 THEN corr(ret, y) OVER w END AS r FROM v
          WINDOW w AS (ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
    SELECT date, {R('r')} AS r, {R('(SELECT max(r) FROM c)')} AS peak, {R('(SELECT min(r) FROM c)')} AS trough FROM c""")
def roll_corr_60(s, d):
    tech = x.portfolio_days(s, d).filter("portfolio = 'tech'").select("portfolio", "date", "ret")
    news = x.domain_days(s, d).filter("domain = 'technology'").select("date", "sentiment_score")
    both = tech.join(news, "date").dropna(subset=["ret", "sentiment_score"])
    c = both.select("portfolio", "date",
                    ro.roll_corr(F.col("ret"), F.col("sentiment_score"), 60, 60, "portfolio").alias("r"))
    ends = c.groupBy("portfolio").agg(F.max("r").alias("peak"), F.min("r").alias("trough"))
    return rounded(c.join(ends, "portfolio").drop("portfolio"), "r", "peak", "trough")


@query("drawdown", f"""SELECT ticker, date, {R(f'(price - max(price) {TK}) / (max(price) {TK})')} AS drawdown
    FROM c_panel""")
def drawdown(s, d):
    return _pick(x.panel(s, d).withColumn("drawdown", ro.drawdown("price", "ticker")), TKEY, "drawdown")


_ZCOLS = ["sentiment_score", "avg_prob_neg", "avg_prob_pos", "avg_prob_neu", "sentiment_3d", "sentiment_velocity",
          *_LAGS]


@query("zscore_global", "SELECT domain, date, " + ", ".join(
    R(f"({c} - avg({c}) OVER (PARTITION BY domain)) / nullif(stddev_samp({c}) OVER (PARTITION BY domain), 0)")
    + f" AS z_{c}" for c in _ZCOLS) + " FROM c_domf")
def zscore_global(s, d):
    return _pick(fe.standardise(dom_feats(s, d), ["domain"], _ZCOLS), DKEY, *[f"z_{c}" for c in _ZCOLS])


_WIDE = ("SELECT date, " + ", ".join(f"max(CASE WHEN domain = '{g}' THEN {c} END) AS {c}_{g}"
         for g in K.DOMAINS for c in ("sentiment_score", "weighted_sentiment")) + " FROM c_domf GROUP BY 1")


@query("interaction_terms", f"""
    SELECT date, {R('sentiment_score_geopolitical * sentiment_score_financial')} AS sentiment_interaction_geo_fin,
           {R('sentiment_score_geopolitical - sentiment_score_technology')} AS cross_domain_divergence,
           {', '.join(f"{R(f'weighted_sentiment_{g}')} AS weighted_sentiment_{g}" for g in K.DOMAINS)} FROM ({_WIDE})""")
def interaction_terms(s, d):
    wide = fe.interactions(se.pivot_domains(dom_feats(s, d), K.DOMAINS, ["sentiment_score", "weighted_sentiment"]))
    return _pick(wide, ["date"], "sentiment_interaction_geo_fin", "cross_domain_divergence",
                 *[f"weighted_sentiment_{g}" for g in K.DOMAINS])


_TRADED = "SELECT * FROM c_bridge WHERE ticker IN (SELECT ticker FROM c_prices)"
_SAFE = ", ".join(f"'{t}'" for t in K.SAFE_HAVEN)


@query("hhi", f"SELECT portfolio, {R('1.0 / count(*)')} AS hhi FROM ({_TRADED}) GROUP BY 1")
def hhi(s, d):
    return _pick(fe.composition(x.traded_members(s, d), K.SAFE_HAVEN), ["portfolio"], "hhi")


@query("safe_haven_weight", f"""SELECT portfolio, {R(f'avg((ticker IN ({_SAFE}))::INT)')} AS safe_haven_weight
    FROM ({_TRADED}) GROUP BY 1""")
def safe_haven_weight(s, d):
    return _pick(fe.composition(x.traded_members(s, d), K.SAFE_HAVEN), ["portfolio"], "safe_haven_weight")


@query("recovery_days", f"""SELECT portfolio, date, {R('vol5')} AS vol5, {R('threshold')} AS threshold,
    recovery_days, censored FROM c_recovery""")
def recovery_days(s, d):
    return rounded(sh.recovery_days(sh.shock_days(x.portfolio_days(s, d))), "vol5", "threshold")


@query("post_shock_norm", f"""
    WITH s AS (SELECT date AS d0 FROM c_dom WHERE domain = 'geopolitical' AND sentiment_score IS NOT NULL
        ORDER BY sentiment_score, date LIMIT 1),
    a AS (SELECT portfolio, date, vol5, row_number() {PF} - 1 AS day, first_value(vol5) {PF} AS base
          FROM c_pf, s WHERE date >= d0)
    SELECT portfolio, day::INT AS day, date, {R('vol5 / base')} AS relative FROM a WHERE day < 15""")
def post_shock_norm(s, d):
    geo = x.domain_days(s, d).filter("domain = 'geopolitical' AND sentiment_score IS NOT NULL")
    start = geo.select(F.min(F.struct("sentiment_score", "date"))["date"]).scalar()
    return rounded(sh.post_shock_norm(x.portfolio_days(s, d), start), "relative")


def pair_series(s, d):
    """Cause sentiment and effect volatility of each listed pair, by date."""
    cause = x.domain_days(s, d).select(F.col("domain").alias("cause"), "date", F.col("sentiment_score").alias("x"))
    effect = x.portfolio_days(s, d).select(F.col("portfolio").alias("effect"), "date", F.col("vol5").alias("y"))
    return fx.cause_effect_pairs(s).join(cause, "cause").join(effect, ["effect", "date"]).dropna(subset=["x", "y"])


CTES["c_pairts"] = """
    SELECT cause, effect, x.date, x.sentiment_score AS x, y.vol5 AS y FROM c_pairs
    JOIN c_dom x ON x.domain = cause JOIN c_pf y ON y.portfolio = effect AND y.date = x.date
    WHERE x.sentiment_score IS NOT NULL AND y.vol5 IS NOT NULL"""
# Series that a unit-root test does not clear are differenced. The check tests without
# lagged differences: t of the level in a regression of the change on it, 5 % level.
CTES["c_rawts"] = """
    SELECT 'x ' || domain AS series, date, sentiment_score AS v FROM c_dom UNION ALL SELECT 'y ' || portfolio, date, vol5 FROM c_pf"""
CTES["c_unit"] = """
    SELECT series, b / sqrt((syy - b * b * sxx) / (n - 2) / sxx) < -2.8634 AS stationary FROM (
        SELECT series, regr_slope(d, l) AS b, regr_syy(d, l) AS syy, regr_sxx(d, l) AS sxx, regr_count(d, l) AS n FROM (
            SELECT series, v - lag(v) OVER w AS d, lag(v) OVER w AS l FROM c_rawts WHERE v IS NOT NULL
            WINDOW w AS (PARTITION BY series ORDER BY date)) GROUP BY 1) WHERE n >= 11 AND sxx > 0"""
CTES["c_stat"] = """
    SELECT series, date, CASE WHEN coalesce(stationary, TRUE) THEN v
           ELSE v - lag(v) OVER (PARTITION BY series ORDER BY date) END AS v FROM c_rawts LEFT JOIN c_unit USING (series)"""
CTES["c_statts"] = """
    SELECT cause, effect, x.date, x.v AS x, y.v AS y FROM c_pairs
    JOIN c_stat x ON x.series = 'x ' || cause JOIN c_stat y ON y.series = 'y ' || effect AND y.date = x.date
    WHERE x.v IS NOT NULL AND y.v IS NOT NULL"""
CTES["c_ccf"] = """
    SELECT cause, effect, k::INT AS lag, round_even(coalesce(corr(xk, y), 0), 4) + 0.0 AS r FROM (
        SELECT cause, effect, k, y, lag(x, k) OVER (PARTITION BY cause, effect, k ORDER BY date) AS xk
        FROM c_statts CROSS JOIN (SELECT unnest(range(6)) AS k))
    WHERE (cause, effect) IN (SELECT (cause, effect) FROM c_statts GROUP BY cause, effect
                              HAVING count(*) >= 10 AND min(x) < max(x) AND min(y) < max(y)) GROUP BY 1, 2, 3"""
#: Fewer complete rows than this tell nothing about lags.
LEAST_PAIR_ROWS = 10


def ccf(s, d):
    """Lag correlations of the pairs' stationary series."""
    from riskspark.plans.modelling import stationary_pairs
    t = co.lagged_correlations(stationary_pairs(s, d), ["cause", "effect"], "x", "y", K.MAX_LAG, LEAST_PAIR_ROWS)
    return t.withColumn("r", F.bround("r", 4) + F.lit(0.0))


@query("lead_lag_ccf", "SELECT * FROM c_ccf")
def lead_lag_ccf(s, d):
    return ccf(s, d)


@query("argmax_abs", """SELECT cause, effect, lag, r FROM (SELECT *, row_number() OVER (PARTITION BY cause, effect
    ORDER BY abs(r) DESC, lag) AS k FROM c_ccf WHERE r <> 0) WHERE k = 1""")
def argmax_abs(s, d):
    return co.peak_lag(ccf(s, d), ["cause", "effect"])


@query("lag_analysis", f"""
    SELECT portfolio, domain, k::INT AS lag, {R('coalesce(corr(xk, y), 0)')} AS r FROM (
        SELECT portfolio, domain, k, vol5 AS y,
               lag(article_count, k) OVER (PARTITION BY portfolio, domain, k ORDER BY date) AS xk
        FROM c_pf JOIN c_dom USING (date) CROSS JOIN (SELECT unnest(range(6)) AS k)
        WHERE vol5 IS NOT NULL AND article_count IS NOT NULL) GROUP BY 1, 2, 3""")
def lag_analysis(s, d):
    both = x.portfolio_days(s, d).join(x.domain_days(s, d).select("date", "domain", "article_count"), "date")
    return rounded(co.lagged_correlations(both, ["portfolio", "domain"], "article_count", "vol5", 5), "r")


@query("predictive_power", f"""
    WITH c AS (SELECT portfolio, domain, abs(corr(news_lag1_sentiment_score, ret)) AS v
               FROM c_pf JOIN c_dom USING (date) GROUP BY 1, 2)
    SELECT portfolio, {', '.join(f"{R(f'coalesce(max(CASE WHEN domain = {chr(39)}{g}{chr(39)} THEN v END), 0)')} AS {g}"
                                 for g in K.DOMAINS)} FROM c GROUP BY 1""")
def predictive_power(s, d):
    both = x.portfolio_days(s, d).join(x.domain_days(s, d).select("date", "domain", "news_lag1_sentiment_score"), "date")
    return rounded(co.predictive_power(both, K.DOMAINS), *K.DOMAINS)


@query("keep_first_dedupe", f"""SELECT article_id, headline, date, domain, {R('tone_score')} AS tone_score
    FROM c_unique""")
def keep_first_dedupe(s, d):
    t = x.unique_articles(s, d).select("article_id", "headline", "date", "domain", "tone_score")
    return rounded(t, "tone_score")


@query("nearest_snapshot", f"""
    SELECT source, day, target_hour, ts, abs(hour(ts) - target_hour)::INT AS hour_distance FROM (
        SELECT event_type AS source, CAST(ts AS DATE) AS day, h AS target_hour, ts,
               row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), h ORDER BY abs(hour(ts) - h), ts) AS k
        FROM events CROSS JOIN (SELECT unnest({K.SNAPSHOT_HOURS})::INT AS h)) WHERE k = 1""")
def nearest_snapshot(s, d):
    from riskspark.sources.readers import nearest_snapshots
    e = fx.table(s, d, "events").select(F.col("event_type").alias("source"), "ts")
    return nearest_snapshots(e, K.SNAPSHOT_HOURS)


CTES["c_recent"] = """
    SELECT domain, avg(sentiment_score) AS recent_sentiment FROM (
        SELECT domain, sentiment_score, row_number() OVER (PARTITION BY domain ORDER BY date DESC) AS k
        FROM c_dom WHERE sentiment_score IS NOT NULL) WHERE k <= 7 GROUP BY 1"""


@query("recent_mean_7", f"SELECT domain, {R('recent_sentiment')} AS recent_sentiment FROM c_recent")
def recent_mean_7(s, d):
    from riskspark.operators.serving import recent_mean
    return rounded(recent_mean(x.domain_days(s, d), "domain", "sentiment_score", 7), "recent_sentiment")


CTES["c_stock"] = f"""
    WITH l AS (SELECT ticker, price, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS k FROM c_panel
               WHERE price IS NOT NULL),
    p AS (SELECT ticker, max(CASE WHEN k = 1 THEN price END) AS last_price,
                 max(CASE WHEN k = 6 THEN price END) AS old FROM l WHERE k <= 6 GROUP BY 1 HAVING count(*) = 6),
    v AS (SELECT portfolio, arg_max(vol5, date) AS vol5, arg_max(shock, date) AS shock_today FROM c_shock
          WHERE vol5 IS NOT NULL GROUP BY 1)
    SELECT portfolio, ticker, {R('last_price', 2)} AS last_price,
           {R('(last_price / old - 1) * 100', 2)} AS return_5d, {R('vol5', 4)} AS vol5, shock_today
    FROM p JOIN c_bridge USING (ticker) JOIN v USING (portfolio)"""


@query("stock_table", "SELECT * FROM c_stock")
def stock_table(s, d):
    from riskspark.operators.serving import stock_table as build
    ret = x.returns(s, d)
    shocks = sh.shock_days(x.portfolio_days(s, d))
    return build(ret, fx.portfolio_map(s), shocks)
