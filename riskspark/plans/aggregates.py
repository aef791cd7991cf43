"""Aggregations: daily sentiment, risk scores, summaries behind the figures."""

from pyspark.sql import functions as F

from riskspark import constants as K, fixtures as fx
from riskspark.common import r, rounded
from riskspark.operators import calendar as cal, ranking as rk, rolling as ro, sentiment as se, summary as sm
from riskspark.plans import inputs as x
from riskspark.plans.registry import query
from riskspark.plans.shared_sql import std_gate

PROBS = ["avg_prob_pos", "avg_prob_neg", "avg_prob_neu", "sentiment_score"]


def R(expr, digits=6):
    return f"round(({expr}) + 1.3e-9, {digits}) + 0.0"


_DAILY = f"""date, domain, {R('avg_prob_pos')} AS avg_prob_pos, {R('avg_prob_neg')} AS avg_prob_neg,
    {R('avg_prob_neu')} AS avg_prob_neu, article_count, {R('sentiment_score')} AS sentiment_score"""


@query("risk_scores", """
    SELECT date, portfolio, risk_score + 0.0 AS risk_score, safety_score + 0.0 AS safety_score,
           round_even(risk_score - safety_score, 4) + 0.0 AS sri FROM c_sri""")
def risk_scores(s, d):
    return rounded(se.risk_scores(x.domain_days(s, d), fx.domain_weights(s)),
                   "risk_score", "safety_score", "sri", digits=4)


@query("agg_daily_sentiment", f"SELECT {_DAILY} FROM c_daily0")
def agg_daily_sentiment(s, d):
    return rounded(x.daily_raw(s, d), *PROBS)


@query("winsorize_3sigma", f"SELECT {_DAILY} FROM c_daily")
def winsorize_3sigma(s, d):
    return rounded(x.daily(s, d), *PROBS)


@query("agg_daily_index", f"""SELECT date, {R('sentiment_avg')} AS sentiment_avg,
    {R('sentiment_volatility')} AS sentiment_volatility, news_volume FROM c_index""")
def agg_daily_index(s, d):
    return rounded(se.daily_index(fx.articles(s, d)), "sentiment_avg", "sentiment_volatility")


@query("pivot_domains", "SELECT date, " + ", ".join(
    f"max(CASE WHEN domain = '{g}' THEN {R('sentiment_score')} END) AS sentiment_score_{g}, "
    f"max(CASE WHEN domain = '{g}' THEN article_count END) AS article_count_{g}" for g in K.DOMAINS)
    + " FROM c_daily GROUP BY 1")
def pivot_domains(s, d):
    wide = se.pivot_domains(x.daily(s, d), K.DOMAINS, ["sentiment_score", "article_count"])
    return rounded(wide, *[f"sentiment_score_{g}" for g in K.DOMAINS])


@query("resample_month_sum", """
    WITH m AS (SELECT domain, date_trunc('month', date) AS month, sum(article_count) AS n FROM c_daily GROUP BY 1, 2),
    g AS (SELECT domain, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
          FROM m GROUP BY domain)
    SELECT domain, g.month, CAST(coalesce(n, 0) AS BIGINT) AS article_count
    FROM g LEFT JOIN m USING (domain, month)""")
def resample_month_sum(s, d):
    return sm.monthly_sum(x.daily(s, d), ["domain"], "article_count")


@query("count_share", f"""
    SELECT source, count(*) AS rows, min(date) AS first_date, max(date) AS last_date,
           {R('count(*) / (SELECT count(*) FROM c_articles)')} AS share FROM c_articles GROUP BY 1""")
def count_share(s, d):
    return rounded(sm.count_share(fx.articles(s, d), "source"), "share")


@query("label_summary", """
    SELECT tone_label, count(*) AS rows, round_even(avg(tone_score), 4) + 0.0 AS mean_score
    FROM c_articles GROUP BY 1""")
def label_summary(s, d):
    return rounded(sm.label_summary(fx.articles(s, d)), "mean_score", digits=4)


@query("sri_summary", """
    SELECT portfolio, round_even(avg(risk_score), 2) + 0.0 AS risk_score,
           round_even(avg(safety_score), 2) + 0.0 AS safety_score,
           round_even(avg(round_even(risk_score - safety_score, 4)), 2) + 0.0 AS sri FROM c_sri GROUP BY 1""")
def sri_summary(s, d):
    t = se.risk_scores(x.domain_days(s, d), fx.domain_weights(s)).groupBy("portfolio").agg(
        *[F.bround(F.avg(c), 2).alias(c) for c in ("risk_score", "safety_score", "sri")])
    return rounded(t, "risk_score", "safety_score", "sri", digits=2)


@query("legacy_risk_safety", f"""
    WITH t AS (SELECT ticker, date, price, price / lag(price) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret,
                      max(price) OVER (PARTITION BY ticker ORDER BY date) AS peak FROM c_prices),
    v AS (SELECT ticker, date, {std_gate('ret', 20, 5, 'ticker')} AS vol, (price - peak) / peak AS dd FROM t),
    g AS (SELECT date, sentiment_score AS geo FROM c_daily WHERE domain = 'geopolitical'),
    a AS (SELECT v.*, coalesce(g.geo, 0) AS geo FROM v ASOF LEFT JOIN g ON v.date >= g.date)
    SELECT ticker, date,
           round_even(least(100 * (0.4 * abs(coalesce(vol, 0)) + 0.35 * abs(dd) + 0.25 * abs(geo)), 100), 2) + 0.0
             AS risk_score,
           round_even((1 - least(abs(coalesce(vol, 0)) * 20, 1) + (geo + 1) / 2 + 1 - least(abs(dd), 1)) / 3 * 100, 2)
             + 0.0 AS safety_score FROM a""")
def legacy_risk_safety(s, d):
    from riskspark.operators.scores import legacy_scores
    p = x.prices(s, d).withColumn("ret", ro.pct_return("price", "ticker"))
    p = p.withColumns({"vol": ro.roll_std("ret", 20, 5, "ticker"), "dd": ro.drawdown("price", "ticker")})
    geo = x.daily(s, d).filter("domain = 'geopolitical'").select("date", F.col("sentiment_score").alias("geo"))
    on_days = cal.asof_values(x.trading_days(s, d).withColumn("_k", F.lit(1)), geo.withColumn("_k", F.lit(1)),
                              ["_k"], ["geo"]).drop("_k")
    out = legacy_scores(p.join(on_days, "date", "left"), "vol", "dd", "geo")
    return rounded(out.select("ticker", "date", "risk_score", "safety_score"), "risk_score", "safety_score", digits=2)


@query("portfolio_return", f"SELECT portfolio, date, {R('ret')} AS ret FROM c_pf")
def portfolio_return(s, d):
    return rounded(x.portfolio_days(s, d).select("portfolio", "date", "ret"), "ret")


@query("portfolio_vol", f"SELECT portfolio, date, {R('vol5')} AS vol5 FROM c_pf")
def portfolio_vol(s, d):
    return rounded(x.portfolio_days(s, d).select("portfolio", "date", "vol5"), "vol5")


@query("quantile_threshold", f"""
    WITH q AS (SELECT domain, quantile_cont(sentiment_score, 0.05) AS t FROM c_dom GROUP BY 1)
    SELECT domain, {R('any_value(t)')} AS threshold, count(*) FILTER (sentiment_score < t) AS days_below,
           {R('count(*) FILTER (sentiment_score < t) / count(sentiment_score)')} AS share_below
    FROM c_dom JOIN q USING (domain) GROUP BY 1""")
def quantile_threshold(s, d):
    return rounded(sm.tail_threshold(x.domain_days(s, d), "domain", "sentiment_score"), "threshold", "share_below")


@query("box_stats", f"""
    WITH q AS (SELECT portfolio, quantile_cont(vol5, 0.25) AS q1, quantile_cont(vol5, 0.5) AS q2,
                      quantile_cont(vol5, 0.75) AS q3 FROM c_pf GROUP BY 1)
    SELECT portfolio, {R('any_value(q1)')} AS q1, {R('any_value(q2)')} AS median, {R('any_value(q3)')} AS q3,
           {R('min(vol5) FILTER (vol5 >= q1 - 1.5 * (q3 - q1))')} AS whisker_low,
           {R('max(vol5) FILTER (vol5 <= q3 + 1.5 * (q3 - q1))')} AS whisker_high,
           count(*) FILTER (vol5 < q1 - 1.5 * (q3 - q1) OR vol5 > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM c_pf JOIN q USING (portfolio) GROUP BY 1""")
def box_stats(s, d):
    t = sm.box_stats(x.portfolio_days(s, d), "portfolio", "vol5")
    return rounded(t, "q1", "median", "q3", "whisker_low", "whisker_high")


@query("dist_stats", f"""SELECT portfolio, {R('avg(ret)')} AS mean, {R('stddev_samp(ret)')} AS std,
    {R('skewness(ret)')} AS skew FROM c_pf GROUP BY 1""")
def dist_stats(s, d):
    return rounded(sm.dist_stats(x.portfolio_days(s, d), "portfolio", "ret"), "mean", "std", "skew")


def _hist_sql(table, key, value, bins):
    return f"""
    WITH v AS (SELECT {key}, {value} AS v FROM {table} WHERE {value} IS NOT NULL),
    sp AS (SELECT {key}, min(v) AS lo, max(v) AS hi, count(*) AS n FROM v GROUP BY 1),
    c AS (SELECT {key}, least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1})::INT AS bin, count(*) AS c
          FROM v JOIN sp USING ({key}) GROUP BY 1, 2)
    SELECT sp.{key}, b.bin, {R(f'lo + b.bin * ((hi - lo) / {bins})')} AS left_edge, coalesce(c, 0) AS count,
           {R(f'coalesce(c, 0) / (n * ((hi - lo) / {bins}))')} AS density
    FROM sp CROSS JOIN (SELECT unnest(range({bins}))::INT AS bin) b
    LEFT JOIN c ON c.{key} = sp.{key} AND c.bin = b.bin"""


@query("histogram", _hist_sql("c_pf", "portfolio", "ret", 30))
def histogram(s, d):
    return rounded(sm.histogram(x.portfolio_days(s, d), "portfolio", "ret", 30), "left_edge", "density")


@query("histogram_sentiment", _hist_sql("c_dom", "domain", "sentiment_score", 25))
def histogram_sentiment(s, d):
    return rounded(sm.histogram(x.domain_days(s, d), "domain", "sentiment_score", 25), "left_edge", "density")


@query("kde_grid", f"""
    WITH v AS (SELECT portfolio, ret AS v FROM c_pf WHERE ret IS NOT NULL),
    sp AS (SELECT portfolio, min(v) AS lo, max(v) AS hi, count(*) AS n,
                  stddev_samp(v) * pow(count(*)::DOUBLE, -0.2) AS h FROM v GROUP BY 1),
    g AS (SELECT portfolio, p.point, lo + p.point * ((hi - lo) / 199) AS x, n, h
          FROM sp CROSS JOIN (SELECT unnest(range(200))::INT AS point) p)
    SELECT portfolio, point, {R('any_value(x)')} AS x,
           {R('sum(exp(-((x - v) / h) * ((x - v) / h) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi()))')}
             AS density
    FROM g JOIN v USING (portfolio) GROUP BY 1, 2""")
def kde_grid(s, d):
    return rounded(sm.kde_grid(x.portfolio_days(s, d), "portfolio", "ret"), "x", "density")


def _geo_returns(s, d):
    geo = x.domain_days(s, d).filter("domain = 'geopolitical'").select("date", "avg_prob_neg")
    return x.portfolio_days(s, d).join(geo, "date")


_GEO = "c_pf JOIN (SELECT date, avg_prob_neg FROM c_dom WHERE domain = 'geopolitical') USING (date)"


@query("corr_pearson", f"""
    WITH c AS (SELECT portfolio, corr(avg_prob_neg, ret) AS r, count(*) FILTER (ret IS NOT NULL
               AND avg_prob_neg IS NOT NULL) AS n FROM {_GEO} GROUP BY 1)
    SELECT portfolio, {R('r')} AS r, n, {R('r * sqrt((n - 2) / (1 - r * r))')} AS t_stat FROM c""")
def corr_pearson(s, d):
    return rounded(sm.corr_by(_geo_returns(s, d), ["portfolio"], "avg_prob_neg", "ret"), "r", "t_stat")


@query("corr_pearson_p")
def corr_pearson_p(s, d):
    from riskspark.models.tests import with_pearson_p
    return with_pearson_p(sm.corr_by(_geo_returns(s, d), ["portfolio"], "avg_prob_neg", "ret"))


@query("ols_line", f"""
    SELECT portfolio, {R('regr_slope(ret, avg_prob_neg)')} AS slope,
           {R('regr_intercept(ret, avg_prob_neg)')} AS intercept FROM {_GEO} GROUP BY 1""")
def ols_line(s, d):
    return rounded(sm.ols_line(_geo_returns(s, d), ["portfolio"], "avg_prob_neg", "ret"), "slope", "intercept")


@query("spike_flag", f"""
    WITH q AS (SELECT domain, quantile_cont(abs(sentiment_score), 0.95) AS t FROM c_dom GROUP BY 1)
    SELECT domain, date, {R('sentiment_score')} AS sentiment_score, {R('t')} AS threshold,
           abs(sentiment_score) >= t AS is_spike FROM c_dom JOIN q USING (domain)""")
def spike_flag(s, d):
    t = sm.spike_flag(x.domain_days(s, d).select("domain", "date", "sentiment_score"), "domain", "sentiment_score")
    return rounded(t, "sentiment_score", "threshold")


def _sentiment_vol(s, d):
    dom = x.domain_days(s, d).select("date", "domain", "sentiment_score")
    return x.portfolio_days(s, d).join(dom, "date").dropna(subset=["sentiment_score", "vol5"])


@query("shock_vs_regular_vol", f"""
    WITH v AS (SELECT portfolio, domain, sentiment_score AS x, vol5 FROM c_pf JOIN c_dom USING (date)
               WHERE sentiment_score IS NOT NULL AND vol5 IS NOT NULL),
    q AS (SELECT portfolio, domain, quantile_cont(x, 0.1) AS t FROM v GROUP BY 1, 2)
    SELECT portfolio, domain, {R('avg(vol5) FILTER (x <= t)')} AS shock_mean,
           {R('avg(vol5) FILTER (NOT x <= t)')} AS regular_mean, count(*) FILTER (x <= t) AS shock_days
    FROM v JOIN q USING (portfolio, domain) GROUP BY 1, 2""")
def shock_vs_regular_vol(s, d):
    t = sm.shock_vs_regular(_sentiment_vol(s, d), ["portfolio", "domain"], "sentiment_score", "vol5")
    return rounded(t, "shock_mean", "regular_mean")


MARKET_NEWS_SQL = f"""
    SELECT coalesce((n.sentiment_score < (SELECT quantile_cont(sentiment_score, 0.5) FROM c_dom
                     WHERE domain = 'geopolitical'))::INT, 0) AS a, coalesce((m.ret < 0)::INT, 0) AS b
    FROM (SELECT date, ret FROM c_ret WHERE ticker = '{K.MARKET_TICKER}') m
    JOIN (SELECT date, sentiment_score FROM c_dom WHERE domain = 'geopolitical') n USING (date)"""


@query("crosstab", f"""
    SELECT a, count(*) FILTER (b = 0) AS b_0, count(*) FILTER (b = 1) AS b_1 FROM ({MARKET_NEWS_SQL}) GROUP BY 1""")
def crosstab(s, d):
    from riskspark.models.tests import news_market_flags
    return sm.crosstab(news_market_flags(x.domain_days(s, d), x.returns(s, d)), F.col("a"), F.col("b"))


@query("argmin_date", """
    SELECT domain, date, round(sentiment_score, 6) + 0.0 AS sentiment_score FROM (
        SELECT *, row_number() OVER (PARTITION BY domain ORDER BY sentiment_score, date) AS place
        FROM c_dom WHERE sentiment_score IS NOT NULL) WHERE place = 1""")
def argmin_date(s, d):
    first = F.min(F.when(F.col("sentiment_score").isNotNull(), F.struct("sentiment_score", "date"))).alias("m")
    t = x.domain_days(s, d).groupBy("domain").agg(first)
    return t.select("domain", F.col("m.date").alias("date"), r("m.sentiment_score").alias("sentiment_score"))


@query("distinct_guard", """
    SELECT domain, count(DISTINCT sentiment_score) <= 1 AS is_constant, count(sentiment_score) AS n
    FROM c_dom0 GROUP BY 1""")
def distinct_guard(s, d):
    dom = cal.domain_rows(x.trading_days(s, d), K.DOMAINS).join(x.daily(s, d), ["date", "domain"], "left")
    return dom.groupBy("domain").agg((F.min("sentiment_score") == F.max("sentiment_score")).alias("is_constant"),
                                     F.count("sentiment_score").alias("n"))


@query("missing_cells", """
    SELECT * FROM (SELECT 'ret' AS column, count(*) FILTER (ret IS NULL) AS missing FROM c_ret
    UNION ALL SELECT 'vol5', count(*) FILTER (vol5 IS NULL) FROM c_ret
    UNION ALL SELECT 'price', count(*) FILTER (price IS NULL) FROM c_ret)""")
def missing_cells(s, d):
    return sm.missing_cells(x.returns(s, d), ["ret", "vol5", "price"])


def _article_scores(s, d):
    a = fx.articles(s, d)
    return a.select(F.year("date").alias("fold"), "tone_score",
                    (F.col("tone_label") == "positive").cast("int").alias("label"))


_SCORES = "SELECT year(date)::INT AS fold, tone_score AS s, (tone_label = 'positive')::INT AS y FROM c_articles"


@query("eval_binary", f"""
    WITH sc AS ({_SCORES}),
    cur AS (SELECT fold, s, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY 1, 2),
    cum AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY s DESC) AS tp,
                   sum(neg) OVER (PARTITION BY fold ORDER BY s DESC) AS fp,
                   sum(pos) OVER (PARTITION BY fold) AS p, sum(neg) OVER (PARTITION BY fold) AS q FROM cur)
    SELECT fold, {R('2.0 * sum(CASE WHEN s >= 0.75 THEN pos END) / (sum(CASE WHEN s >= 0.75 THEN pos + neg END) + max(p))')}
             AS f1,
           {R('sum(neg * (tp - pos) + neg * pos / 2) / (max(p) * max(q))')} AS auc_roc,
           {R('sum(pos * tp / (tp + fp)) / max(p)')} AS auc_pr FROM cum GROUP BY 1""")
def eval_binary(s, d):
    return rounded(rk.eval_binary(_article_scores(s, d), ["fold"], "tone_score", "label", 0.75),
                   "f1", "auc_roc", "auc_pr")


@query("best_f1_threshold", f"""
    WITH sc AS ({_SCORES}),
    cur AS (SELECT fold, s, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY 1, 2),
    cum AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY s DESC) AS tp,
                   sum(neg) OVER (PARTITION BY fold ORDER BY s DESC) AS fp,
                   sum(pos) OVER (PARTITION BY fold) AS p FROM cur),
    best AS (SELECT fold, s, 2.0 * tp / (tp + fp + p) AS f1,
                    row_number() OVER (PARTITION BY fold ORDER BY 2.0 * tp / (tp + fp + p) DESC, s) AS k FROM cum)
    SELECT fold, {R('s')} AS threshold, {R('f1')} AS best_f1,
           {R('(SELECT quantile_cont(s, 0.5) FROM best WHERE k = 1)')} AS median_threshold FROM best WHERE k = 1""")
def best_f1_threshold(s, d):
    best = rk.best_threshold(_article_scores(s, d), ["fold"], "tone_score", "label")
    mid = best.select(F.percentile("threshold", F.lit(0.5))).scalar()
    return rounded(best.withColumn("median_threshold", mid), "threshold", "best_f1", "median_threshold")
