"""Incremental and streaming jobs over the given tables' files."""

from pyspark.sql import functions as F, types as T

from riskspark import fixtures as fx
from riskspark.common import rounded, scratch_path
from riskspark.functions import dates
from riskspark.operators import normalise as nz
from riskspark.plans.aggregates import R
from riskspark.plans.registry import query
from riskspark.plans.shared_sql import CTES
from riskspark.streaming import dedupe as dd, incremental as inc, keyindex as ki, prices as ps, upsert as up

#: How far behind the newest event a day may still change.
LATE = "30 days"


def _events(s, d):
    schema = fx.table(s, d, "events").schema
    e = inc.read_landed(s, d, schema, "events")
    score = F.least(F.abs(F.col("value")) / 101, F.lit(1.0))
    label = F.when(F.col("event_type") == "click", "positive").when(F.col("event_type") == "error", "negative").otherwise("neutral")
    probs = nz.derive_probs(label, score)
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
                    F.concat(F.lit("desk-"), F.col("user_id") % 3).alias("domain"),
                    probs["prob_pos"].alias("prob_pos"), probs["prob_neg"].alias("prob_neg"))


CTES["c_events_scored"] = """
    SELECT *, 'desk-' || (user_id % 3) AS domain,
           CASE event_type WHEN 'click' THEN s WHEN 'error' THEN 1 - s ELSE 0.33::DOUBLE END AS prob_pos,
           CASE event_type WHEN 'error' THEN s WHEN 'click' THEN 1 - s ELSE 0.33::DOUBLE END AS prob_neg
    FROM (SELECT *, least(abs(value) / 101, 1) AS s FROM events)"""


@query("stream_daily_sentiment", f"""
    SELECT CAST(ts AS DATE) AS date, domain, {R('avg(prob_pos)')} AS avg_prob_pos, {R('avg(prob_neg)')} AS avg_prob_neg,
           count(*) AS article_count FROM c_events_scored GROUP BY 1, 2""")
def stream_daily_sentiment(s, d):
    """All days, the open ones included: changed days are upserted by (date, domain)."""
    path, ck = scratch_path(s, "daily_stream"), scratch_path(s, "ck")
    up.write_updates(up.daily_sentiment(_events(s, d), "ts", LATE), path, ck)
    return rounded(up.latest(s, path, ["date", "domain"]), "avg_prob_pos", "avg_prob_neg")


CTES["c_inc0"] = "SELECT ticker, date, price, ln(price / lag(price) OVER (PARTITION BY ticker ORDER BY date)) AS ret FROM c_prices"
CTES["c_inc"] = """SELECT * FROM (SELECT ticker, date, price, CASE WHEN count(ret) OVER w >= 2 THEN stddev_samp(ret) OVER w END AS vol5
    FROM c_inc0 WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""


@query("inc_update_prices", f"SELECT ticker, date, {R('price')} AS price, {R('vol5')} AS vol5 FROM c_inc")
def inc_update_prices(s, d):
    """Landed trades merged into months of prices, windows continued from stored tails."""
    root, ck = scratch_path(s, "price_store"), scratch_path(s, "ck")
    part = fx.table(s, d, "part").select("p_partkey", fx._ticker().alias("ticker"))
    stream = inc.read_landed(s, d, fx.table(s, d, "lineitem").schema, "lineitem")

    def shape(batch):
        day = dates.roll_weekend(F.to_date("l_shipdate")).alias("date")
        t = batch.select("l_partkey", day, "l_quantity", "l_extendedprice").join(part, F.col("l_partkey") == F.col("p_partkey"))
        return t.groupBy("ticker", "date").agg(F.sum("l_extendedprice").alias("amount"), F.sum("l_quantity").alias("quantity"))

    stored = ps.update_prices(s, stream, shape, root, ck)
    return rounded(stored.select("ticker", "date", "price", "vol5"), "price", "vol5")


def _headlines(s, d):
    """Landed orders as headlines."""
    t = inc.read_landed(s, d, fx.table(s, d, "orders").schema, "orders")
    return t.select(F.concat(F.lit("Customer "), "o_custkey", F.lit(" moves the market")).alias("headline"),
                    F.col("o_orderkey").alias("article_id"), F.to_date("o_orderdate").alias("date"))


@query("inc_update_news", """
    SELECT headline, f.date AS date, f.article_id AS article_id FROM (
      SELECT 'Customer ' || o_custkey || ' moves the market' AS headline,
             min(struct_pack(date := CAST(o_orderdate AS DATE), article_id := o_orderkey)) AS f FROM orders GROUP BY 1)""")
def inc_update_news(s, d):
    """First copy of each headline over all batches, by state per bucket of headlines."""
    path, ck = scratch_path(s, "news_stream"), scratch_path(s, "ck")
    out = dd.first_copies(_headlines(s, d), order=("date", "article_id"))
    inc.write_append(out, path, ck)
    return s.read.schema(out.schema).parquet(path)


@query("inc_resume", """SELECT headline, min(article_id) AS article_id FROM c_articles GROUP BY 1""")
def inc_resume(s, d):
    """The job runs twice on one checkpoint: the second run finds nothing left to do,
    and headlines stored by the first are not appended again."""
    sink, ck = scratch_path(s, "resume_sink"), scratch_path(s, "ck")
    schema = T.StructType([T.StructField("headline", T.StringType()), T.StructField("article_id", T.LongType())])
    store = lambda spark: ki.IndexedSink(spark, sink, ["headline"], schema)
    each = lambda batch, number: store(batch.sparkSession).append(batch.select("headline", "article_id"), number, [F.col("article_id")])
    for _ in range(2):
        inc.run_once(_headlines(s, d), ck, each)
    return store(s).read()


@query("inc_month_buckets", """
    WITH m AS (SELECT domain, min(date) AS lo, max(date) AS hi FROM c_articles GROUP BY 1),
    g AS (SELECT domain, lo, hi, CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) AS m0 FROM m)
    SELECT domain, strftime(m0, '%Y-%m') AS month, greatest(m0, lo) AS first_day, least(last_day(m0), hi) AS last_day FROM g""")
def inc_month_buckets(s, d):
    span = fx.articles(s, d).groupBy("domain").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return span.select("domain", F.inline(inc.month_buckets(F.col("lo"), F.col("hi"))))
