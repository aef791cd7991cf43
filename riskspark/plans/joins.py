"""Joins and set operations."""

from pyspark.sql import functions as F

from riskspark import constants as K, fixtures as fx
from riskspark.common import dimension, r, rounded
from riskspark.functions import text as tx
from riskspark.operators import (calendar as cal, correlation as co, features as fe, joins as jn, normalise as nz,
                                 rolling as ro, sentiment as se, shocks as sh)
from riskspark.plans import inputs as x
from riskspark.plans.aggregates import R
from riskspark.plans.registry import query
from riskspark.plans.shared_sql import CTES
from riskspark.plans.windows import dom_feats, feats, pair_series

_WIDE_COLS = [f"{m}_{g}" for g in K.DOMAINS for m in ("sentiment_score", "article_count")]
CTES["c_wide"] = "SELECT date, " + ", ".join(
    f"max(CASE WHEN domain = '{g}' THEN {m} END) AS {m}_{g}" for g in K.DOMAINS
    for m in ("sentiment_score", "article_count")) + " FROM c_dom GROUP BY 1"


def _rows(*cols):
    return ", ".join(f"{R(c)} AS {c}" for c in cols)


@query("join_master_left", f"""SELECT ticker, date, {_rows('price', 'ret', 'vol5')},
    {', '.join(f"{R(c)} AS {c}" if c.startswith('sent') else c for c in _WIDE_COLS)}
    FROM c_ret LEFT JOIN c_wide USING (date)""")
def join_master_left(s, d):
    wide = se.pivot_domains(x.domain_days(s, d), K.DOMAINS, ["sentiment_score", "article_count"])
    t = jn.master_table(x.returns(s, d), wide).select("ticker", "date", "price", "ret", "vol5", *_WIDE_COLS)
    return rounded(t, "price", "ret", "vol5", *[c for c in _WIDE_COLS if c.startswith("sent")])


@query("join_inner_align", f"""SELECT ticker, date, {_rows('ret', 'sentiment_avg')}
    FROM c_ret JOIN c_index USING (date) WHERE ret IS NOT NULL AND sentiment_avg IS NOT NULL""")
def join_inner_align(s, d):
    t = jn.inner_align(x.returns(s, d).select("ticker", "date", "ret"),
                       se.daily_index(fx.articles(s, d)).select("date", "sentiment_avg"))
    return rounded(t, "ret", "sentiment_avg")


@query("join_full_outer", f"""
    SELECT coalesce(g.date, t.date) AS date, {R('g.sentiment_score')} AS geo_sentiment, g.article_count AS geo_count,
           {R('t.sentiment_score')} AS tech_sentiment, t.article_count AS tech_count
    FROM (SELECT * FROM c_daily WHERE domain = 'geopolitical') g
    FULL JOIN (SELECT * FROM c_daily WHERE domain = 'technology') t ON g.date = t.date""")
def join_full_outer(s, d):
    return rounded(jn.full_outer_domains(x.daily(s, d), "geopolitical", "technology"), "geo_sentiment", "tech_sentiment")


@query("join_asof_ffill", f"""
    SELECT g.domain, c.date, {R('n.sentiment_score')} AS sentiment_score FROM c_cal c CROSS JOIN c_domains g
    ASOF LEFT JOIN c_daily n ON n.domain = g.domain AND c.date >= n.date""")
def join_asof_ffill(s, d):
    left = cal.domain_rows(x.trading_days(s, d), K.DOMAINS)
    right = x.daily(s, d).select("domain", "date", "sentiment_score")
    return rounded(cal.asof_values(left, right, ["domain"], ["sentiment_score"]), "sentiment_score")


@query("join_anti_resume", f"""SELECT article_id, date, domain, url FROM c_articles WHERE url NOT IN
    (SELECT 'https://news.example.com/' || l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def join_anti_resume(s, d):
    done = fx.table(s, d, "lineitem").filter("l_returnflag = 'R'").select(
        F.concat(F.lit("https://news.example.com/"), "l_orderkey").alias("url"))
    return jn.resume(fx.articles(s, d).select("article_id", "date", "domain", "url"), done)


CTES["c_hid"] = """SELECT *, left(md5(lower(trim(trim(trim(headline), '"'), ''''))), 12) AS headline_id
    FROM c_headlines"""


@query("join_anti_seen_headline", """
    SELECT headline_id, doc_id, line_no::INT AS line_no, headline FROM (
        SELECT *, row_number() OVER (PARTITION BY headline_id ORDER BY doc_id, line_no) AS k FROM c_hid) WHERE k = 1
    AND headline_id NOT IN (SELECT headline_id FROM c_hid WHERE doc_id IN (SELECT doc_id FROM labels))""")
def join_anti_seen_headline(s, d):
    h = fx.headlines(s, d)
    stored = h.join(fx.table(s, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return jn.unseen_headlines(h.select("doc_id", "line_no", "headline"), stored, ["doc_id", "line_no"])


@query("join_calendar_densify", f"""
    WITH g AS (SELECT domain, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
               FROM c_daily GROUP BY domain)
    SELECT domain, date, article_count, {R('sentiment_score')} AS sentiment_score
    FROM g LEFT JOIN c_daily USING (domain, date)""")
def join_calendar_densify(s, d):
    t = cal.densify_daily(x.daily(s, d).select("domain", "date", "article_count", "sentiment_score"), ["domain"])
    return rounded(t, "sentiment_score")


def worst_days(s, d, n=3):
    geo = x.domain_days(s, d).filter("domain = 'geopolitical' AND sentiment_score IS NOT NULL")
    return geo.orderBy("sentiment_score", "date").limit(n).select("date", "sentiment_score")


CTES["c_worst"] = """SELECT date, sentiment_score FROM c_dom WHERE domain = 'geopolitical'
    AND sentiment_score IS NOT NULL ORDER BY sentiment_score, date LIMIT 3"""


@query("join_event_window", f"""
    SELECT p.portfolio, p.date, w.date AS event_date, {R('p.ret')} AS ret FROM c_pf p JOIN c_worst w
    ON p.date BETWEEN w.date - 7 AND w.date + 10 AND isodow(p.date) < 6""")
def join_event_window(s, d):
    t = jn.event_window(x.portfolio_days(s, d).select("portfolio", "date", "ret"), worst_days(s, d))
    return rounded(t, "ret")


_CTX = [f"{a}_{g}" for g in K.DOMAINS for a in ("sentiment", "sentiment_vel", "spike")]
CTES["c_ctx"] = "SELECT date, " + ", ".join(
    f"max(CASE WHEN domain = '{g}' THEN {m} END) AS {a}_{g}" for g in K.DOMAINS
    for m, a in (("sentiment_score", "sentiment"), ("sentiment_velocity", "sentiment_vel"), ("article_spike", "spike"))
) + " FROM c_domf GROUP BY 1"
CTES["c_events"] = """SELECT r.*, c.* EXCLUDE (date), market_regime_flag AS market_regime,
    quarter(r.date)::INT AS quarter, year(r.date)::INT AS year
    FROM c_recovery r LEFT JOIN c_ctx c USING (date) LEFT JOIN c_regime USING (date)"""


def shock_events(s, d):
    """Pooled shocks with recovery time and context."""
    f = feats(s, d)
    shocks = sh.shock_days(f)
    rec = sh.recovery_days(shocks).join(f.select("portfolio", "date", "pre_shock_baseline"), ["portfolio", "date"])
    regime = ro.regime_flag(x.panel(s, d), K.MARKET_TICKER)
    return fe.shock_context(rec, dom_feats(s, d), regime, K.DOMAINS)


@query("join_event_context", f"""SELECT portfolio, date, market_regime, quarter, year,
    {', '.join(f"{R(c)} AS {c}" if not c.startswith('spike') else c for c in _CTX)} FROM c_events""")
def join_event_context(s, d):
    t = shock_events(s, d).select("portfolio", "date", "market_regime", "quarter", "year", *_CTX)
    return rounded(t, *[c for c in _CTX if not c.startswith("spike")])


@query("join_weight_star", f"""SELECT date, portfolio, domain, weight::DOUBLE AS weight,
    {R('weight * avg_prob_neg')} AS weighted_neg, {R('weight * avg_prob_pos')} AS weighted_pos
    FROM c_dom JOIN c_weights USING (domain)""")
def join_weight_star(s, d):
    return rounded(jn.weight_star(x.domain_days(s, d), fx.domain_weights(s)), "weighted_neg", "weighted_pos")


@query("join_ticker_pairs", f"""SELECT portfolio, a, b, count(CASE WHEN ra IS NOT NULL AND rb IS NOT NULL THEN 1 END)
    AS n, {R('corr(ra, rb)')} AS r FROM c_pairret GROUP BY 1, 2, 3""")
def join_ticker_pairs(s, d):
    return rounded(co.pair_correlation(x.returns(s, d), co.listed_pairs(s, K.PORTFOLIOS)), "r")


@query("join_domain_portfolio_pairs", f"SELECT cause, effect, date, {_rows('x', 'y')} FROM c_pairts")
def join_domain_portfolio_pairs(s, d):
    return rounded(pair_series(s, d).select("cause", "effect", "date", "x", "y"), "x", "y")


@query("join_semi_universe", f"""SELECT ticker, date, {R('price')} AS price FROM c_prices
    WHERE ticker IN (SELECT ticker FROM c_arch)""")
def join_semi_universe(s, d):
    rows = sorted({(t,) for ts in K.ARCHETYPES.values() for t in ts})
    return rounded(jn.keep_universe(fx.prices(s, d), dimension(s, rows, "ticker string"), "ticker"), "price")


# --- set operations -----------------------------------------------------------

def _feed(s, d, domain):
    """A source as it lands, in that source's own columns."""
    a = fx.articles(s, d).filter(F.col("domain") == domain).drop("domain")
    if domain == "financial":
        return a.withColumnsRenamed({"tone_score": "sentiment_score", "tone_label": "sentiment_label"})
    return nz.with_probs(a).withColumnsRenamed({"tone_score": "tone_score.1"}).withColumn(
        "tone_score", F.lit(None).cast("double"))


@query("union_sources", f"""SELECT article_id, date, domain, headline, tone_label, {_rows('tone_score', 'prob_pos',
    'prob_neg', 'prob_neu')} FROM c_scored""")
def union_sources(s, d):
    t = nz.union_feeds([nz.standard_feed(_feed(s, d, g), g) for g in K.DOMAINS])
    t = t.select("article_id", "date", "domain", "headline", "tone_label", "tone_score", "prob_pos", "prob_neg", "prob_neu")
    return rounded(t, "tone_score", "prob_pos", "prob_neg", "prob_neu")


@query("distinct_key", "SELECT headline, min(article_id) AS article_id FROM c_articles GROUP BY 1")
def distinct_key(s, d):
    return nz.keep_first(fx.articles(s, d).select("headline", "article_id"), ["headline"], [F.col("article_id")])


@query("array_overlap", f"""SELECT portfolio, coalesce(array_to_string(list_sort(list(ticker) FILTER (ticker IN
    ({', '.join("'" + t + "'" for t in K.SAFE_HAVEN)}))), ','), '') AS safe, count(*) AS members FROM c_bridge
    WHERE ticker IN (SELECT ticker FROM c_prices) GROUP BY 1""")
def array_overlap(s, d):
    g = x.traded_members(s, d).groupBy("portfolio").agg(F.collect_set("ticker").alias("m"))
    both = F.array_sort(F.array_intersect("m", F.array(*[F.lit(t) for t in K.SAFE_HAVEN])))
    return g.select("portfolio", F.array_join(both, ",").alias("safe"), F.size("m").cast("long").alias("members"))
