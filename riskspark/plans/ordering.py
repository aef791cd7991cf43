"""Sort, limit and top-k reports, and chronological splits."""

from pyspark.sql import Window as W, functions as F

from riskspark import constants as K, fixtures as fx
from riskspark.common import r, rounded
from riskspark.operators import calendar as cal, serving as sv, sentiment as se
from riskspark.plans import inputs as x
from riskspark.plans.aggregates import R
from riskspark.plans.joins import worst_days
from riskspark.plans.registry import query
from riskspark.plans.shared_sql import CTES
from riskspark.plans.windows import feats


@query("sort_output", f"""SELECT date, portfolio, {R('risk_score', 4)} AS risk_score FROM c_sri
    ORDER BY date, portfolio""")
def sort_output(s, d):
    t = se.risk_scores(x.domain_days(s, d), fx.domain_weights(s)).select("date", "portfolio", r("risk_score", 4)
                                                                         .alias("risk_score"))
    return t.orderBy("date", "portfolio")


@query("limit_head", f"SELECT article_id, date, {R('tone_score')} AS tone_score FROM c_articles ORDER BY article_id LIMIT 100")
def limit_head(s, d):
    return rounded(fx.articles(s, d).select("article_id", "date", "tone_score").orderBy("article_id").limit(100),
                   "tone_score")


_MEMBERS = fx.TICKERS  # of all portfolios
_TAIL = ", ".join([f"max(CASE WHEN ticker = '{t}' THEN {R('price', 2)} END) AS \"{t}\"" for t in _MEMBERS])


@query("tail_60", f"""
    WITH p AS (SELECT date, {_TAIL} FROM c_panel GROUP BY 1)
    SELECT p.*, {', '.join(f"{R(f'sentiment_score_{g}', 4)} AS sent_{g}" for g in K.DOMAINS)}
    FROM p LEFT JOIN c_wide USING (date) ORDER BY date DESC LIMIT 60""")
def tail_60(s, d):
    from riskspark.operators import rolling as ro
    price = x.panel(s, d).filter(F.col("ticker").isin(_MEMBERS))
    wide = price.groupBy("date").pivot("ticker", _MEMBERS).agg(F.first("price"))
    sent = se.pivot_domains(x.domain_days(s, d), K.DOMAINS, ["sentiment_score"])
    t = sv.tail(wide.join(sent, "date", "left"), 60)
    return t.select("date", *[r(c, 2).alias(c) for c in _MEMBERS],
                    *[r(f"sentiment_score_{g}", 4).alias(f"sent_{g}") for g in K.DOMAINS])


_COMPLETE = ["ret", "vol5", "vol10", "vol20", "vol_zscore_5d", "lagged_vol"]


@query("latest_complete_row", f"""SELECT portfolio, date, {', '.join(f'{R(c)} AS {c}' for c in _COMPLETE)} FROM (
    SELECT *, row_number() OVER (PARTITION BY portfolio ORDER BY date DESC) AS k FROM c_pff
    WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _COMPLETE)}) WHERE k = 1""")
def latest_complete_row(s, d):
    t = sv.latest_value(feats(s, d).dropna(subset=_COMPLETE), "portfolio", "date", *_COMPLETE)
    return rounded(t, *_COMPLETE)


@query("topk_smallest", f"SELECT date, {R('sentiment_score')} AS sentiment_score FROM c_worst")
def topk_smallest(s, d):
    return rounded(worst_days(s, d), "sentiment_score")


CTES["c_rankdom"] = """
    SELECT portfolio, domain, r, row_number() OVER (PARTITION BY portfolio ORDER BY abs(r) DESC, domain) AS rank
    FROM (SELECT portfolio, domain, corr(sentiment_score, ret) AS r FROM c_pf JOIN c_dom USING (date) GROUP BY 1, 2)"""


def domain_ranks(s, d):
    """Domains by |correlation| with the portfolio's return."""
    from riskspark.operators.summary import corr_by
    both = x.portfolio_days(s, d).join(x.domain_days(s, d).select("date", "domain", "sentiment_score"), "date")
    c = corr_by(both, ["portfolio", "domain"], "sentiment_score", "ret")
    w = W.partitionBy("portfolio").orderBy(F.desc(F.abs("r")), "domain")
    return c.select("portfolio", "domain", "r", F.row_number().over(w).alias("rank"))


@query("topk_abs", f"SELECT portfolio, domain, {R('r')} AS r, rank::INT AS rank FROM c_rankdom WHERE rank <= 2")
def topk_abs(s, d):
    return rounded(domain_ranks(s, d).filter("rank <= 2"), "r")


@query("split_time", """
    WITH v AS (SELECT portfolio, date, row_number() OVER (PARTITION BY portfolio ORDER BY date) AS rn,
                      count(*) OVER (PARTITION BY portfolio) AS n FROM c_pf)
    SELECT portfolio, date, rn <= greatest(1, floor(n * 0.8::DOUBLE)) AS is_train FROM v""")
def split_time(s, d):
    return cal.split_time(x.portfolio_days(s, d).select("portfolio", "date"), ["portfolio"])


@query("split_walk_forward", """
    WITH v AS (SELECT portfolio, date, row_number() OVER (PARTITION BY portfolio ORDER BY date) AS rn,
                      count(*) OVER (PARTITION BY portfolio) AS n FROM c_pf),
    f AS (SELECT *, greatest(5, n // 4) AS base, greatest(1, (n - greatest(5, n // 4)) // 3) AS step FROM v),
    e AS (SELECT *, base + fold * step AS cut FROM f CROSS JOIN (SELECT unnest(range(3))::INT AS fold))
    SELECT portfolio, date, fold, rn <= cut AS is_train FROM e WHERE cut < n AND rn <= least(cut + step, n)""")
def split_walk_forward(s, d):
    return cal.walk_forward(x.portfolio_days(s, d).select("portfolio", "date"), ["portfolio"])
