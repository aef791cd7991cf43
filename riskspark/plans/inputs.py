"""Stages shared by the registered queries.

Two reductions read the large tables: trades to daily prices, and articles to daily
sentiment. Both are written once per query call and rescanned from there, because
what follows (calendars, windows, joins) reads each of them several times; without
the cut every one of those reads would scan the raw tables again. Their size is
bounded by days x tickers and days x domains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K, fixtures as fx
from riskspark.common import materialise, side_by_side
from riskspark.operators import calendar as cal, normalise as nz, rolling as ro, sentiment as se
from riskspark.operators.portfolio import portfolio_series

_CALL: dict = {}


def new_call() -> None:
    """Forget the stages of the previous query call."""
    _CALL.clear()


def _once(name, s, d, build) -> DataFrame:
    if (name, d) not in _CALL:
        _CALL[name, d] = materialise(build(), name)
    return _CALL[name, d]


def prices(s, d) -> DataFrame:
    return _once("prices", s, d, lambda: fx.prices(s, d))


def scored(s, d) -> DataFrame:
    """Articles with probabilities."""
    return nz.with_probs(fx.articles(s, d))


def unique_articles(s, d) -> DataFrame:
    """Clean feed: bad rows dropped, first copy of each headline per day kept."""
    kept = nz.drop_bad(fx.articles(s, d)).select("article_id", "headline", "date", "domain", "tone_label", "tone_score")
    first = nz.keep_first(kept, ["headline", "date"], [nz.source_priority(K.DOMAINS), F.col("article_id")])
    return nz.with_probs(first)


def daily_raw(s, d) -> DataFrame:
    """Daily sentiment before clipping."""
    return _once("daily", s, d, lambda: se.daily_sentiment(cal.roll_weekend(unique_articles(s, d))))


def daily(s, d) -> DataFrame:
    return se.winsorize(daily_raw(s, d), "sentiment_score", "domain")


def reductions(s, d) -> None:
    """Write both reductions side by side, for queries that need the two."""
    side_by_side(s, lambda: prices(s, d), lambda: daily_raw(s, d))


def trading_days(s, d) -> DataFrame:
    return cal.trading_calendar(prices(s, d))


def domain_days(s, d) -> DataFrame:
    return se.on_trading_days(daily(s, d), trading_days(s, d), K.DOMAINS)


def panel(s, d) -> DataFrame:
    return ro.price_panel(prices(s, d))


def returns(s, d) -> DataFrame:
    return ro.returns(prices(s, d))


def portfolio_days(s, d) -> DataFrame:
    return portfolio_series(returns(s, d), fx.portfolio_map(s))


def traded_members(s, d) -> DataFrame:
    """Portfolio members that trade in the given data."""
    return fx.portfolio_map(s).join(prices(s, d).select("ticker").distinct(), "ticker", "left_semi")
