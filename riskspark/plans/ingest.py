"""Sources and sinks. Landed files are derived from the given tables first, then
read back through the reader under test."""

from pyspark.sql import functions as F, types as T

from riskspark import constants as K, fixtures as fx
from riskspark.common import r, rounded, scratch_path
from riskspark.plans import inputs as x
from riskspark.plans.aggregates import R
from riskspark.plans.registry import query
from riskspark.plans.shared_sql import CTES
from riskspark.sources import readers as rd, sinks

_CSV = T.StructType([T.StructField("date", T.DateType()), T.StructField("domain", T.StringType()),
                     T.StructField("headline", T.StringType()), T.StructField("tone_score", T.DoubleType())])


@query("src_scored_csv", f"SELECT date, domain, headline, {R('tone_score')} AS tone_score FROM c_articles")
def src_scored_csv(s, d):
    path = scratch_path(s, "csv")
    fx.articles(s, d).select(*_CSV.fieldNames()).write.csv(path, header=True, dateFormat="yyyy-MM-dd")
    return rounded(rd.read_csv(s, path, _CSV), "tone_score")


@query("src_price_wide_to_long", f"SELECT ticker, date, {R('price')} AS price FROM c_prices")
def src_price_wide_to_long(s, d):
    return rounded(rd.wide_to_long(sinks.wide_panel(fx.prices(s, d), fx.TICKERS)), "price")


def raw_ohlcv(s, d):
    """Day bars per ticker as a vendor sends them; one adjusted close in three is missing."""
    t = fx.ticks(s, d).withColumn("p", F.col("amount") / F.col("quantity"))
    key = F.struct("l_orderkey", "l_linenumber", "p")
    bars = t.groupBy("ticker", "date").agg(
        F.min(key)["p"].alias("Open"), F.max("p").alias("High"), F.min("p").alias("Low"),
        F.max(key)["p"].alias("Close"), F.sum("quantity").alias("Volume"))
    adj = F.when(F.dayofmonth("date") % 3 != 0, F.col("Close") * 0.97)
    return bars.withColumn("Adj Close", adj).withColumnRenamed("date", "Date").withColumn(
        "Date", F.to_timestamp("Date"))


@query("src_ohlcv_normalise", f"""
    WITH b AS (SELECT ticker, date, first(p ORDER BY l_orderkey, l_linenumber, p) AS open, max(p) AS high,
                      min(p) AS low, last(p ORDER BY l_orderkey, l_linenumber, p) AS close, sum(quantity) AS volume
               FROM (SELECT *, amount / quantity AS p FROM c_ticks) GROUP BY 1, 2)
    SELECT ticker, date, {', '.join(f'{R(c)} AS {c}' for c in ('open', 'high', 'low', 'close'))},
           {R('CASE WHEN day(date) % 3 <> 0 THEN close * 0.97::DOUBLE ELSE close END')} AS adj_close,
           volume::DOUBLE AS volume FROM b""")
def src_ohlcv_normalise(s, d):
    return rounded(rd.normalise_ohlcv(raw_ohlcv(s, d)), "open", "high", "low", "close", "adj_close")


_TOL = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@query("src_tolerant_csv", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 10 <> 3")
def src_tolerant_csv(s, d):
    path = scratch_path(s, "lines")
    n = F.when(F.col("doc_id") % 10 == 3, F.lit("n/a")).otherwise(F.col("n_chars").cast("string"))
    fx.table(s, d, "documents").select("doc_id", "lang", n.alias("n_chars")).write.csv(path, header=True)
    return rd.read_csv_tolerant(s, path, _TOL)


@query("src_json_hits", """
    SELECT CASE WHEN article_id % 4 = 1 THEN DATE '2000-01-01' ELSE date END AS date, 'search' AS source,
           'technology' AS domain, headline, url FROM c_articles WHERE article_id % 9 <> 2""")
def src_json_hits(s, d):
    path = scratch_path(s, "hits")
    a = fx.articles(s, d)
    i = F.col("article_id")
    hit = F.struct(
        F.when(i % 3 == 0, F.lit(" ")).when(i % 9 != 2, F.col("headline")).alias("title"),
        F.when(i % 3 == 0, F.col("headline")).alias("story_title"), "url",
        F.when(i % 4 != 1, F.unix_timestamp(F.to_timestamp("date"))).otherwise(0).alias("created_at_i"))
    a.groupBy(F.floor(i / 50).alias("page")).agg(F.collect_list(hit).alias("hits")).select("hits").write.json(path)
    return rd.read_hits(s, path, "technology", "search", "2000-01-01")


@query("src_manifest_rows", """SELECT event_type AS source, strftime(ts, '%Y%m%d%H%M%S') AS timestamp,
    'https://example.com/' || event_id AS url FROM events""")
def src_manifest_rows(s, d):
    e = fx.table(s, d, "events").select("event_type", "event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("t"))
    row = F.array(F.lit("key"), "t", F.concat(F.lit("https://example.com/"), "event_id"))
    head = F.array(F.array(F.lit("urlkey"), F.lit("timestamp"), F.lit("original")))
    pages = e.groupBy(F.col("event_type").alias("source"), F.floor(F.col("event_id") / 100).alias("page")).agg(
        F.to_json(F.concat(head, F.collect_list(row))).alias("payload"))
    return rd.manifest_rows(pages, "payload", "source")


def _clean_sql(x):
    ws = r"[\s\x{85}\p{Z}]"
    brands = "|".join(K.BRANDING["financial"])
    return (f"trim(regexp_replace(regexp_replace(replace(replace(replace({x}, '&amp;', '&'), '&quot;', '\"'), "
            f"'&#39;', ''''), '(?i){ws}*[|—–]{ws}*({brands}).*$', '', 'g'), '{ws}+', ' ', 'g'))")


def _strip_sql(x):
    return rf"trim(regexp_replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '[\s\x{{85}}\p{{Z}}]+', ' ', 'g'))"


@query("src_html_headlines", f"""
    SELECT page_id, (pos - 1)::INT AS pos, url AS link, {_clean_sql(_strip_sql('inner_html'))} AS headline
    FROM (SELECT page_id, url, unnest(m) AS inner_html, generate_subscripts(m, 1) AS pos
          FROM (SELECT page_id, url, regexp_extract_all(html, '{rd.HEADING}', 1) AS m FROM pages))""")
def src_html_headlines(s, d):
    return rd.page_headings(fx.table(s, d, "pages"))


CTES["c_links"] = f"""
    SELECT page_id, url, (pos - 1)::INT AS pos, href, inner_html FROM (
        SELECT page_id, url, unnest(h) AS href, unnest(t) AS inner_html, generate_subscripts(h, 1) AS pos
        FROM (SELECT page_id, url, regexp_extract_all(html, '{rd.ANCHOR}', 1) AS h,
                     regexp_extract_all(html, '{rd.ANCHOR}', 2) AS t FROM pages))"""
CTES["c_abs"] = """SELECT *, replace(replace(CASE WHEN starts_with(href, 'http') THEN href
    ELSE 'https://' || split_part(url, '/', 3) || href END, '.com./', '.com/'), '.co./', '.co/') AS link FROM c_links"""


@query("src_html_links", f"SELECT page_id, pos, link, {_clean_sql(_strip_sql('inner_html'))} AS headline FROM c_abs")
def src_html_links(s, d):
    return rd.page_links(fx.table(s, d, "pages"))


CTES["c_nav"] = r"""
    SELECT page_id, url, (row_number() OVER (PARTITION BY page_id ORDER BY p, i) - 1)::INT AS pos, item FROM (
        SELECT page_id, url, p, unnest(items) AS item, generate_subscripts(items, 1) AS i FROM (
            SELECT page_id, url, p, regexp_extract_all(nav, '(?is)<li[^>]*>(.*?)</li>', 1) AS items FROM (
                SELECT page_id, url, unnest(n) AS nav, generate_subscripts(n, 1) AS p
                FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<nav[ >].*?</nav>') AS n FROM pages))))"""
CTES["c_navlinks"] = f"""
    SELECT page_id, pos, url, regexp_extract(item, '{rd.ANCHOR}', 1) AS href, regexp_extract(item, '{rd.ANCHOR}', 2) AS inner_html
    FROM c_nav WHERE regexp_matches(item, '{rd.ANCHOR}')"""


@query("src_html_containers", f"""
    SELECT page_id, 'Pages' AS site, pos, link, headline FROM (
        SELECT page_id, pos, replace(replace(CASE WHEN starts_with(href, 'http') THEN href
            ELSE 'https://' || split_part(url, '/', 3) || href END, '.com./', '.com/'), '.co./', '.co/') AS link,
            {_clean_sql(_strip_sql('inner_html'))} AS headline FROM c_navlinks)
    WHERE NOT regexp_matches(headline, '{"(?i)" + "|".join(K.JUNK_PATTERNS)}')""")
def src_html_containers(s, d):
    """Containers of all configured sites, and of the given pages, in one reading of each page."""
    return rd.container_headlines(fx.table(s, d, "pages"), {**K.SITE_CONTAINERS, **fx.PAGE_CONTAINERS})


@query("src_rss_entry", """
    SELECT CASE doc_id % 3 WHEN 0 THEN DATE '2024-05-01' WHEN 1 THEN DATE '2024-06-01' ELSE DATE '2024-07-01' END AS date,
           left(lang || ' ' || source || '. ' || text, 500) AS headline, 'https://example.com/' || doc_id AS url
    FROM documents""")
def src_rss_entry(s, d):
    k = F.col("doc_id") % 3
    day = lambda v: F.lit(v).cast("date")
    return rd.feed_entries(
        fx.table(s, d, "documents"), F.when(k == 0, day("2024-05-01")), F.when(k < 2, day("2024-06-01")),
        F.concat_ws(" ", "lang", "source"), F.col("text"), F.concat(F.lit("https://example.com/"), "doc_id"),
        day("2024-07-01"))


@query("sink_append", f"""SELECT domain, count(*) AS rows, {R('avg(tone_score)')} AS mean_score
    FROM c_articles GROUP BY 1""")
def sink_append(s, d):
    path = scratch_path(s, "append")
    a = fx.articles(s, d)
    sinks.append(a, path)
    return s.read.schema(a.schema).parquet(path).groupBy("domain").agg(
        F.count(F.lit(1)).alias("rows"), r(F.avg("tone_score")).alias("mean_score"))


@query("sink_partitioned", f"SELECT replace(ticker, '=', '_') AS ticker, date, {R('price')} AS price FROM c_prices")
def sink_partitioned(s, d):
    path = scratch_path(s, "tickers")
    p = fx.prices(s, d)
    sinks.by_ticker(p, path)
    return s.read.schema(p.schema).parquet(path).select("ticker", "date", r("price").alias("price"))


@query("sink_wide_export", "SELECT strftime(date, '%Y-%m-%d') AS date, " + ", ".join(
    f"""max(CASE WHEN ticker = '{t}' THEN {R('price')} END) AS "{t}" """ for t in fx.TICKERS) + " FROM c_prices GROUP BY 1")
def sink_wide_export(s, d):
    wide = sinks.wide_panel(fx.prices(s, d), fx.TICKERS)
    return wide.select("date", *[r(F.col(f"`{t}`")).alias(t) for t in fx.TICKERS])


@query("dim_portfolio_map", "SELECT portfolio, ticker FROM c_bridge WHERE ticker IN (SELECT ticker FROM c_prices)")
def dim_portfolio_map(s, d):
    return x.traded_members(s, d)
