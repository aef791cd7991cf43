"""CTEs shared by the check queries, written independently of the Spark plans."""

from riskspark import constants as K
from riskspark.fixtures import TICKERS


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _values(rows) -> str:
    cell = lambda v: "'" + v + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


BRIDGE_ROWS = [(p, t) for p, ts in K.PORTFOLIOS.items() for t in ts]
WEIGHT_ROWS = [(p, d, w) for p, ws in K.DOMAIN_WEIGHTS.items() for d, w in ws.items()]
ARCHETYPE_ROWS = [(a, t) for a, ts in K.ARCHETYPES.items() for t in ts]


def std_gate(x: str, rows: int, least: int, part: str) -> str:
    w = f"OVER (PARTITION BY {part} ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {w} >= {max(least, 2)} THEN stddev_samp({x}) {w} END"


def avg_gate(x: str, rows: int, least: int, part: str) -> str:
    w = f"OVER (PARTITION BY {part} ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {w} >= {least} THEN avg({x}) {w} END"


def once(x: str) -> str:
    return f"coalesce({x}, lag({x}) OVER (PARTITION BY domain ORDER BY date)) AS {x}"


CTES = {
    "c_ticks": f"""
        SELECT coalesce(([{_list(TICKERS)}])[CAST(split_part(p_brand, '#', 2) AS INT)], p_brand) AS ticker,
               CAST(l_shipdate AS DATE) + CASE isodow(l_shipdate) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS date, l_quantity AS quantity, l_extendedprice AS amount,
               l_orderkey, l_linenumber
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "c_prices": "SELECT ticker, date, sum(amount) / sum(quantity) AS price FROM c_ticks GROUP BY 1, 2",
    "c_cal": "SELECT DISTINCT date FROM c_prices",
    "c_panel": """
        SELECT t.ticker, c.date,
               last_value(p.price IGNORE NULLS) OVER (PARTITION BY t.ticker ORDER BY c.date) AS price
        FROM c_cal c CROSS JOIN (SELECT DISTINCT ticker FROM c_prices) t
        LEFT JOIN c_prices p ON p.date = c.date AND p.ticker = t.ticker""",
    "c_ret0": """
        SELECT ticker, date, price,
               ln(price / lag(price) OVER (PARTITION BY ticker ORDER BY date)) AS ret FROM c_panel""",
    "c_ret": f"SELECT *, {std_gate('ret', 5, 2, 'ticker')} AS vol5 FROM c_ret0",
    "c_bridge": f"SELECT * FROM (VALUES {_values(BRIDGE_ROWS)}) v(portfolio, ticker)",
    "c_arch": f"SELECT * FROM (VALUES {_values(ARCHETYPE_ROWS)}) v(archetype, ticker)",
    "c_weights": f"SELECT * FROM (VALUES {_values(WEIGHT_ROWS)}) v(portfolio, domain, weight)",
    "c_pairs": f"SELECT * FROM (VALUES {_values(K.CAUSE_EFFECT_PAIRS)}) v(cause, effect)",
    "c_domains": f"SELECT unnest([{_list(K.DOMAINS)}]) AS domain",
    "c_pf": """
        SELECT portfolio, date, avg(ret) AS ret, avg(vol5) AS vol5
        FROM c_ret JOIN c_bridge USING (ticker) GROUP BY 1, 2""",
    "c_articles": """
        SELECT o_orderkey AS article_id, CAST(o_orderdate AS DATE) AS date,
               'desk-' || (o_custkey % 7) AS source,
               CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'geopolitical'
                    WHEN o_orderpriority[1] = '3' THEN 'financial' ELSE 'technology' END AS domain,
               'Customer ' || o_custkey || ' moves the market' AS headline,
               'https://news.example.com/' || o_orderkey AS url,
               CASE o_orderstatus WHEN 'F' THEN 'negative' WHEN 'O' THEN 'Neutral' ELSE 'positive' END
                 AS tone_label,
               0.5 + CAST(o_totalprice AS DOUBLE) % 997 / 1999 AS tone_score
        FROM orders""",
    "c_probs": """
        SELECT *, CASE lower(tone_label) WHEN 'positive' THEN tone_score WHEN 'negative' THEN 1 - tone_score
                  ELSE 0.33::DOUBLE END AS prob_pos,
               CASE lower(tone_label) WHEN 'negative' THEN tone_score WHEN 'positive' THEN 1 - tone_score
                  ELSE 0.33::DOUBLE END AS prob_neg FROM c_articles""",
    "c_scored": "SELECT *, greatest(least(1.0::DOUBLE - prob_pos - prob_neg, 1), 0) AS prob_neu FROM c_probs",
    "c_unique": f"""
        SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY headline, date
            ORDER BY list_position([{_list(K.DOMAINS)}], domain), article_id) AS k FROM c_scored) WHERE k = 1""",
    "c_rolled": """
        SELECT * REPLACE (CAST(date + CASE isodow(date) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AS date)
        FROM c_unique""",
    "c_daily0": """
        SELECT date, domain, avg(prob_pos) AS avg_prob_pos, avg(prob_neg) AS avg_prob_neg,
               avg(prob_neu) AS avg_prob_neu, count(headline) AS article_count,
               round_even(avg(prob_pos) - avg(prob_neg), 6) AS sentiment_score
        FROM c_rolled GROUP BY 1, 2""",
    "c_daily": """
        SELECT d.* REPLACE (CASE WHEN sd > 0 THEN least(greatest(sentiment_score, mu - 3 * sd), mu + 3 * sd)
                                 ELSE sentiment_score END AS sentiment_score)
        FROM c_daily0 d JOIN (SELECT domain, avg(sentiment_score) AS mu, stddev_samp(sentiment_score) AS sd
                              FROM c_daily0 GROUP BY 1) USING (domain)""",
    "c_news": """
        SELECT n.date, g.domain, avg_prob_pos, avg_prob_neg, avg_prob_neu, article_count, sentiment_score,
               lag(sentiment_score) OVER (PARTITION BY g.domain ORDER BY n.date) AS news_lag1_sentiment_score
        FROM (SELECT DISTINCT date FROM c_daily) n CROSS JOIN c_domains g
        LEFT JOIN c_daily d ON d.date = n.date AND d.domain = g.domain""",
    "c_dom0": """
        SELECT c.date, g.domain, n.* EXCLUDE (date, domain) FROM c_cal c CROSS JOIN c_domains g
        LEFT JOIN c_news n ON n.date = c.date AND n.domain = g.domain""",
    "c_dom": f"""
        SELECT date, domain, {once('sentiment_score')}, {once('avg_prob_neg')}, {once('avg_prob_pos')},
               {once('avg_prob_neu')}, {once('article_count')}, {once('news_lag1_sentiment_score')} FROM c_dom0""",
    "c_sri": """
        SELECT date, portfolio,
               round_even(sum(weight * avg_prob_neg) / sum(CASE WHEN avg_prob_neg IS NOT NULL
                          AND avg_prob_pos IS NOT NULL THEN weight END) * 100, 4) AS risk_score,
               round_even(sum(weight * avg_prob_pos) / sum(CASE WHEN avg_prob_neg IS NOT NULL
                          AND avg_prob_pos IS NOT NULL THEN weight END) * 100, 4) AS safety_score
        FROM c_dom JOIN c_weights USING (domain) GROUP BY 1, 2""",
    "c_index0": """
        SELECT date, avg(s) AS a, stddev_samp(s) AS v, count(s) AS n FROM (
            SELECT date, CASE lower(tone_label) WHEN 'positive' THEN 1.0 WHEN 'neutral' THEN 0.0
                         WHEN 'negative' THEN -1.0 END::DOUBLE AS s FROM c_scored) GROUP BY 1""",
    "c_index": """
        SELECT g.date, coalesce(last_value(a IGNORE NULLS) OVER (ORDER BY g.date), 0) AS sentiment_avg,
               coalesce(v, 0) AS sentiment_volatility, coalesce(n, 0) AS news_volume
        FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
              FROM c_index0) g LEFT JOIN c_index0 USING (date)""",
    "c_lines": """
        SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents""",
    "c_headlines": """
        SELECT doc_id, line_no, source,
               CASE k WHEN 3 THEN 'Live updates: ' WHEN 4 THEN 'AI chips: ' WHEN 5 THEN 'Air raid: '
                      WHEN 6 THEN 'software &amp; cloud:  ' WHEN 7 THEN 'NATO sanctions: '
                      WHEN 8 THEN 'Sensex today: ' ELSE '' END || line ||
               CASE k WHEN 0 THEN ' | Reuters' WHEN 1 THEN ' — BBC News' WHEN 2 THEN ' – Moneycontrol Pro'
                      ELSE '' END AS headline,
               CASE k % 3 WHEN 0 THEN '/news/' WHEN 1 THEN 'https://www.example.com./markets/'
                      ELSE 'https://www.example.com/video/' END || doc_id || '-' || line_no AS url,
               CAST(DATE '2021-01-04' + CAST(doc_id % 1500 AS INT) AS DATE) AS date
        FROM (SELECT *, (doc_id + line_no) % 12 AS k FROM c_lines)""",
    "c_clean": r"""
        SELECT doc_id, line_no, source, date, url, trim(regexp_replace(regexp_replace(
            replace(replace(replace(headline, '&amp;', '&'), '&quot;', '"'), '&#39;', ''''),
            '(?i)[\s\x{85}\p{Z}]*[|—–][\s\x{85}\p{Z}]*(ET Markets?|Moneycontrol|Livemint|BSE|NSE|Reuters|NYT|BBC|CNN|AP|Guardian).*$',
            '', 'g'), '[\s\x{85}\p{Z}]+', ' ', 'g')) AS headline FROM c_headlines""",
}
