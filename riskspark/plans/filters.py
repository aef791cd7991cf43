"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from riskspark import constants as K, fixtures as fx
from riskspark.common import r, rounded
from riskspark.functions import dates, numeric as nu, text as tx
from riskspark.operators import calendar as cal, normalise as nz, ranking as rk
from riskspark.plans import inputs as x
from riskspark.plans.aggregates import R
from riskspark.plans.joins import _feed
from riskspark.plans.registry import query
from riskspark.plans.windows import feats


@query("norm_schema_drift", f"""SELECT article_id, lower(tone_label) AS tone_label, {R('tone_score')} AS tone_score
    FROM c_articles""")
def norm_schema_drift(s, d):
    t = nz.union_feeds([nz.rename_drift(_feed(s, d, g)).select("article_id", F.lower("tone_label").alias("tone_label"),
                                                               "tone_score") for g in K.DOMAINS])
    return rounded(t, "tone_score")


@query("norm_force_domain", "SELECT article_id, domain FROM c_articles")
def norm_force_domain(s, d):
    return nz.union_feeds([nz.standard_feed(_feed(s, d, g), g).select("article_id", "domain") for g in K.DOMAINS])


@query("norm_canonical_headline", """SELECT article_id, CASE WHEN article_id % 2 = 0 THEN upper(headline)
    ELSE headline END AS headline FROM c_articles""")
def norm_canonical_headline(s, d):
    a = fx.articles(s, d).withColumn("clean_headline", F.when(F.col("article_id") % 2 == 0, F.upper("headline")))
    return nz.canonical_headline(a).select("article_id", "headline")


@query("derive_probs", f"""SELECT article_id, {', '.join(f'{R(c)} AS {c}' for c in ('prob_pos', 'prob_neg', 'prob_neu'))}
    FROM c_scored""")
def derive_probs(s, d):
    return rounded(x.scored(s, d).select("article_id", "prob_pos", "prob_neg", "prob_neu"),
                   "prob_pos", "prob_neg", "prob_neu")


@query("norm_missing_cols", """SELECT article_id, date, domain, headline, NULL::VARCHAR AS url,
    NULL::VARCHAR AS tone_label, NULL::DOUBLE AS tone_score, 0.0::DOUBLE AS prob_pos, NULL::VARCHAR AS source
    FROM c_articles""")
def norm_missing_cols(s, d):
    t = nz.fill_missing(fx.articles(s, d).select("article_id", "date", "domain", "headline"))
    return t.select("article_id", "date", "domain", "headline", "url", "tone_label", "tone_score", "prob_pos", "source")


@query("coerce_drop_bad", f"""SELECT article_id, date, {R('tone_score')} AS tone_score FROM c_articles
    WHERE article_id % 7 NOT IN (1, 2, 3, 4)""")
def coerce_drop_bad(s, d):
    k = F.col("article_id") % 7
    raw = fx.articles(s, d).select(
        "article_id",
        F.when(k == 1, "2024-01-XX").when(k == 2, "2024-2026").when(k == 3, "2024")
         .otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        F.when(k == 4, "n/a").otherwise(F.col("tone_score").cast("string")).alias("tone_score"))
    return rounded(nz.drop_bad(nz.fill_missing(raw)).select("article_id", "date", "tone_score"), "tone_score")


_ROLL = "CAST(date + CASE isodow(date) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE)"


@query("filter_date_window", f"""SELECT article_id, {_ROLL} AS date FROM c_articles
    WHERE {_ROLL} BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def filter_date_window(s, d):
    return cal.filter_window(cal.roll_weekend(fx.articles(s, d)), "1996-01-01", "1999-12-31").select("article_id", "date")


@query("study_window", f"""SELECT ticker, date, {R('price')} AS price FROM c_prices
    WHERE date >= DATE '1996-01-01' AND date < DATE '2000-01-01'""")
def study_window(s, d):
    start, end = dates.study_window("1996-01-01", "1999-12-31")
    return rounded(fx.prices(s, d).filter((F.col("date") >= start) & (F.col("date") < end)), "price")


@query("roll_weekend", f"SELECT article_id, {_ROLL} AS date FROM c_articles")
def roll_weekend(s, d):
    return cal.roll_weekend(fx.articles(s, d)).select("article_id", "date")


def _clean(s, d):
    return fx.headlines(s, d).withColumn("headline", tx.clean_headline(F.col("headline")))


_KEYS = "doc_id, line_no::INT AS line_no"


@query("clean_headline", f"SELECT {_KEYS}, headline FROM c_clean")
def clean_headline(s, d):
    return _clean(s, d).select("doc_id", "line_no", "headline")


_JUNK = "(?i)" + "|".join(K.JUNK_PATTERNS)


@query("filter_junk", f"SELECT {_KEYS}, headline FROM c_clean WHERE NOT regexp_matches(headline, '{_JUNK}')")
def filter_junk(s, d):
    return _clean(s, d).filter(~tx.is_junk(F.col("headline"))).select("doc_id", "line_no", "headline")


@query("filter_junk_short", f"""SELECT {_KEYS}, headline FROM c_clean
    WHERE length(headline) >= 30 AND NOT regexp_matches(headline, '(?i)({K.JUNK_SHORT})')""")
def filter_junk_short(s, d):
    return _clean(s, d).filter(~tx.is_junk_short(F.col("headline"))).select("doc_id", "line_no", "headline")


@query("filter_relevant_word", rf"""SELECT {_KEYS}, headline FROM c_clean WHERE regexp_matches(headline,
    '(?i)(^|[^\p{{L}}\p{{N}}\p{{M}}_])({'|'.join(K.TECH_WORDS)})($|[^\p{{L}}\p{{N}}\p{{M}}_])')""")
def filter_relevant_word(s, d):
    return _clean(s, d).filter(tx.is_relevant(F.col("headline"), K.TECH_WORDS)).select("doc_id", "line_no", "headline")


@query("filter_relevant_substring", f"""SELECT {_KEYS}, headline FROM c_clean
    WHERE regexp_matches(headline, '(?i)({'|'.join(K.GEO_WORDS)})')""")
def filter_relevant_substring(s, d):
    hit = tx.is_relevant(F.col("headline"), K.GEO_WORDS, whole_word=False)
    return _clean(s, d).filter(hit).select("doc_id", "line_no", "headline")


@query("filter_min_length", f"SELECT {_KEYS}, length(headline)::INT AS n FROM c_clean WHERE length(headline) >= 40")
def filter_min_length(s, d):
    return _clean(s, d).select("doc_id", "line_no", F.length("headline").alias("n")).filter("n >= 40")


@query("filter_url_path", f"SELECT {_KEYS}, url FROM c_headlines WHERE contains(url, '/news/') OR contains(url, '/markets/')")
def filter_url_path(s, d):
    u = F.col("url")
    return fx.headlines(s, d).filter(u.contains("/news/") | u.contains("/markets/")).select("doc_id", "line_no", "url")


@query("absolutise_url", f"""SELECT {_KEYS}, replace(replace(CASE WHEN starts_with(url, 'http') THEN url
    ELSE 'https://desk.example.org' || url END, '.com./', '.com/'), '.co./', '.co/') AS url FROM c_headlines""")
def absolutise_url(s, d):
    page = F.lit("https://desk.example.org/list?page=1")
    return fx.headlines(s, d).select("doc_id", "line_no", tx.absolute_url(F.col("url"), page).alias("url"))


@query("article_id", "SELECT doc_id, line_no::INT AS line_no, left(md5(url), 12) AS url_id, headline_id FROM c_hid")
def article_id(s, d):
    return fx.headlines(s, d).select("doc_id", "line_no", tx.short_md5(F.col("url")).alias("url_id"),
                                     tx.short_md5(tx.normal_headline(F.col("headline"))).alias("headline_id"))


@query("parse_date_heuristic", """
    SELECT article_id, CASE WHEN article_id % 4 IN (0, 1, 2) THEN CAST(date + INTERVAL 10 YEAR AS DATE) END AS day
    FROM c_articles""")
def parse_date_heuristic(s, d):
    k, day = F.col("article_id") % 4, F.add_months("date", 120)
    attr = F.when(k == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm")).when(k == 1, F.lit("2024-01-XX"))
    words = F.when(k < 3, F.concat(F.lit("Posted "), F.date_format(day, "MMM d, yyyy"), F.lit(" by desk"))).otherwise(
        F.lit("Posted yesterday"))
    return fx.articles(s, d).select("article_id", dates.heuristic_day(attr, words).alias("day"))


@query("date_from_snapshot_ts", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def date_from_snapshot_ts(s, d):
    ts = F.date_format("ts", "yyyyMMddHHmmss")
    return fx.table(s, d, "events").select("event_id", dates.snapshot_day(ts).alias("day"))


@query("sanitize_numeric", f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN NULL
      ELSE {R('o_totalprice')} END AS v, CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN 1 ELSE 2 END AS known FROM orders""")
def sanitize_numeric(s, d):
    k = F.col("o_orderkey") % 5
    inf = float("inf")
    v = (F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(inf)).when(k == 2, F.lit(-inf))
          .otherwise(F.col("o_totalprice")))
    raw = fx.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), v.alias("v"), F.array(v, F.lit(1.0)).alias("vs"))
    t = nu.finite_columns(raw)
    return t.select("id", r("v").alias("v"), F.size(F.filter("vs", lambda c: c.isNotNull())).alias("known"))


@query("impute_zero", f"SELECT portfolio, date, {R('coalesce(vol20, 0)')} AS vol20 FROM c_pff")
def impute_zero(s, d):
    return rounded(nz.impute_constant(feats(s, d).select("portfolio", "date", "vol20"), ["vol20"]), "vol20")


@query("impute_median", f"""SELECT portfolio, date,
    {R('coalesce(vol20, (SELECT quantile_cont(vol20, 0.5) FROM c_pff))')} AS vol20 FROM c_pff""")
def impute_median(s, d):
    f = feats(s, d).select("portfolio", "date", "vol20")
    mid = rk.exact_quantiles(f, [], "vol20", {"mid": 0.5}).select("mid").scalar()
    return f.select("portfolio", "date", r(F.coalesce("vol20", mid)).alias("vol20"))


@query("drop_all_null_rows", f"""SELECT portfolio, date, {R('ret')} AS ret, {R('vol5')} AS vol5 FROM c_pf
    WHERE ret IS NOT NULL OR vol5 IS NOT NULL""")
def drop_all_null_rows(s, d):
    return rounded(x.portfolio_days(s, d).dropna("all", subset=["ret", "vol5"]), "ret", "vol5")
