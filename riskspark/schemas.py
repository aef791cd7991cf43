"""Explicit table schemas; no reader infers types."""

from pyspark.sql import types as T


def _s(**cols):
    return T.StructType([T.StructField(k, v, True) for k, v in cols.items()])


D, S, F8, I8 = T.DateType(), T.StringType(), T.DoubleType(), T.LongType()

RAW_NEWS = _s(date=S, source=S, domain=S, headline=S, tone_score=F8, url=S)
SCORED_NEWS = _s(date=D, source=S, domain=S, headline=S, url=S, tone_label=S,
                 tone_score=F8, prob_pos=F8, prob_neg=F8, prob_neu=F8)
STANDARD_COLUMNS = SCORED_NEWS.fieldNames()
PRICES = _s(ticker=S, date=D, price=F8)
OHLCV = _s(ticker=S, date=D, open=F8, high=F8, low=F8, close=F8, adj_close=F8, volume=F8)
DAILY_SENTIMENT = _s(date=D, domain=S, avg_prob_pos=F8, avg_prob_neg=F8, avg_prob_neu=F8,
                     article_count=I8, sentiment_score=F8)
SRI = _s(date=D, portfolio=S, risk_score=F8, safety_score=F8, sri=F8)
HITS = T.StructType([
    T.StructField("hits", T.ArrayType(_s(title=S, story_title=S, url=S, created_at_i=I8))),
])
MANIFEST = "array<array<string>>"
