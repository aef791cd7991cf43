"""Hand-made frames for the rules that random data seldom reaches."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark import constants as K
from riskspark.functions import dates, dist, numeric, text as tx
from riskspark.sources import readers as rd
from riskspark.operators import (calendar as cal, correlation as co, joins as jn, normalise as nz, ranking as rk,
                                 rolling as ro, rules as ru, sentiment as se, shocks as sh, textscore as tsx)

D = dt.date


def one(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def day(i):
    return D(2024, 1, 1) + dt.timedelta(days=i)


def series(spark, values, key="a", name="x"):
    rows = [(key, day(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"k string, date date, {name} double")


def test_weekend_roll_then_window(spark):
    df = spark.createDataFrame([(D(2024, 5, 3),), (D(2024, 5, 4),), (D(2024, 5, 5),)], "date date")
    rolled = cal.roll_weekend(df)
    assert sorted(one(rolled, "date")) == [(D(2024, 5, 3),), (D(2024, 5, 6),), (D(2024, 5, 6),)]
    assert cal.filter_window(rolled, "2024-05-06", "2024-05-06").count() == 2


def test_bad_dates(spark):
    df = spark.createDataFrame([("2024-01-XX",), ("2024-2026",), ("2024",), ("2024-01-02",)], "s string")
    assert one(df, dates.parse_day(F.col("s"))) == [(None,), (None,), (None,), (D(2024, 1, 2),)]
    with pytest.raises(ValueError):
        dates.study_window("2024-01-02", "2024-01-02")


def test_keep_first_prefers_financial(spark):
    rows = [("h", D(2024, 1, 2), d, i) for i, d in enumerate(["technology", "geopolitical", "financial"])]
    df = spark.createDataFrame(rows, "headline string, date date, domain string, article_id long")
    out = nz.keep_first(df, ["headline", "date"], [nz.source_priority(K.DOMAINS), F.col("article_id")])
    assert one(out, "domain") == [("financial",)]


def test_keep_first_with_one_hot_headline(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("hot").alias("h"), "id")
    out = nz.keep_first(df, ["h"], [F.col("id")])
    assert out.filter("h = 'hot'").collect()[0]["id"] == 0
    assert out.count() == df.select("h").distinct().count()


def test_fills(spark):
    df = series(spark, [1, None, None, None, 5])
    assert [v for (v,) in one(df.withColumn("y", cal.ffill("x", "k")).orderBy("date"), "y")] == [1, 1, 1, 1, 5]
    assert [v for (v,) in one(df.withColumn("y", cal.ffill_once("x", "k")).orderBy("date"), "y")] == [1, 1, None, None, 5]


def test_rolling_std_minimum(spark):
    got = one(series(spark, [1, 2, 4]).withColumn("s", ro.roll_std("x", 5, 2, "k")).orderBy("date"), "s")
    assert got[0] == (None,)
    assert got[1][0] == pytest.approx(np.std([1, 2], ddof=1))


def test_rolling_zscore_matches_pandas(spark):
    x = np.random.default_rng(1).normal(size=80)
    got = [v for (v,) in one(series(spark, x).withColumn("z", ro.roll_zscore("x", 20, 5, "k")).orderBy("date"), "z")]
    s = pd.Series(x)
    want = (s - s.rolling(20, min_periods=5).mean()) / s.rolling(20, min_periods=5).std()
    for g, w in zip(got, want):
        assert (g is None and math.isnan(w)) or g == pytest.approx(w)


def test_constant_series(spark):
    df = series(spark, [3] * 8)
    assert all(v is None for (v,) in one(ro.zscore_global(df, "x", ["k"]), "z_x"))
    assert set(one(se.winsorize(df, "x", "k"), "x")) == {(3.0,)}
    y = df.withColumn("y", F.col("x") + 1)
    assert all(v is None for (v,) in one(y.withColumn("c", ro.roll_corr(F.col("x"), F.col("y"), 5, 2, "k")), "c"))


def test_risk_weights_renormalise_and_keep_empty_days(spark):
    rows = [(day(0), "financial", 0.2, 0.6), (day(0), "technology", None, None), (day(0), "geopolitical", 0.4, 0.1),
            (day(1), "financial", None, None), (day(1), "technology", None, None), (day(1), "geopolitical", None, None)]
    dom = spark.createDataFrame(rows, "date date, domain string, avg_prob_neg double, avg_prob_pos double")
    w = spark.createDataFrame([("p", "financial", 0.3), ("p", "technology", 0.6), ("p", "geopolitical", 0.1)],
                              "portfolio string, domain string, weight double")
    got = {r["date"]: r for r in se.risk_scores(dom, w).collect()}
    assert got[day(0)]["risk_score"] == pytest.approx((0.3 * 0.2 + 0.1 * 0.4) / 0.4 * 100)
    assert got[day(1)]["risk_score"] is None and got[day(1)]["sri"] is None


def test_lag_on_dense_news_calendar(spark):
    rows = [(day(0), "financial", 0.1), (day(1), "technology", 0.5), (day(2), "financial", 0.3)]
    daily = spark.createDataFrame(rows, "date date, domain string, sentiment_score double")
    grid = cal.domain_grid(daily, K.DOMAINS).withColumn("l", F.lag("sentiment_score").over(cal.by_series("domain")))
    assert one(grid.filter((F.col("domain") == "financial") & (F.col("date") == day(2))), "l") == [(None,)]


def _shock_reference(vol):
    s = pd.Series(vol)
    q = s.expanding(min_periods=10).quantile(0.95)
    flag = (s > q).astype(int)
    out = {}
    for i in np.flatnonzero(flag):
        days, censored = 0, True
        for j in range(i + 1, len(s)):
            days += 1
            if j + 2 < len(s) and all(s[j + k] < q[j + k] for k in range(3)):
                censored = False
                break
        out[int(i)] = (days, censored)
    return flag, out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_shocks_and_recovery_against_loops(spark, seed):
    vol = np.abs(np.random.default_rng(seed).normal(size=200)).cumsum() % 3 + np.linspace(0, 1, 200)
    df = series(spark, vol, name="vol5").withColumnRenamed("k", "portfolio")
    shocks = sh.shock_days(df)
    flag, want = _shock_reference(vol)
    got = {r["date"]: r["shock"] for r in shocks.collect()}
    assert [got[day(i)] for i in range(200)] == list(flag)
    rec = {(r["date"] - day(0)).days: (r["recovery_days"], r["censored"]) for r in sh.recovery_days(shocks).collect()}
    assert rec == want


def test_mean_pair_correlation_with_late_listings(spark):
    rng = np.random.default_rng(3)
    first = {"a": 0, "b": 0, "c": 4, "d": 17, "e": 30}
    wide = pd.DataFrame({t: rng.normal(size=60) for t in first})
    for t, f in first.items():
        wide.loc[: f - 1, t] = np.nan
    rows = [(t, day(i), None if math.isnan(v) else float(v)) for t in wide for i, v in enumerate(wide[t])]
    ret = spark.createDataFrame(rows, "ticker string, date date, ret double")
    bridge = spark.createDataFrame([("p", t) for t in first] + [("q", "a"), ("q", "e")], "portfolio string, ticker string")
    got = {(r["portfolio"], r["date"]): r["intra_corr"] for r in co.mean_pair_correlation(ret, bridge).collect()}
    for p, members in (("p", list(first)), ("q", ["a", "e"])):
        pairs = [wide[x].rolling(20, min_periods=5).corr(wide[y]) for i, x in enumerate(members) for y in members[i + 1:]]
        want = pd.concat(pairs, axis=1).mean(axis=1)
        for i, w in enumerate(want):
            assert (p, day(i)) not in got if math.isnan(w) else got[p, day(i)] == pytest.approx(w)


def test_densify_equals_cross_product(spark):
    rows = [("a", day(0), 1.0), ("a", day(3), 2.0), ("b", day(3), 5.0), ("b", day(7), 6.0)]
    p = spark.createDataFrame(rows, "ticker string, date date, price double")
    got = set(one(ro.price_panel(p), "ticker", "date", "price"))
    assert got == {("a", day(0), 1.0), ("a", day(3), 2.0), ("a", day(7), 2.0),
                   ("b", day(0), None), ("b", day(3), 5.0), ("b", day(7), 6.0)}


def test_relevance_word_and_substring(spark):
    df = spark.createDataFrame([("Air raid on Tehran",), ("AI chip surge",), ("new software",), (None,)], "h string")
    assert [v for (v,) in one(df, tx.is_relevant(F.col("h"), K.TECH_WORDS))] == [False, True, False, False]
    assert [v for (v,) in one(df, tx.is_relevant(F.col("h"), K.GEO_WORDS, False))] == [False, False, True, False]
    assert [v for (v,) in one(df, tx.is_junk(F.col("h")))] == [False, False, False, True]


def test_clean_headline(spark):
    df = spark.createDataFrame([("A &amp; B  rise | Reuters India",), ("Plain – nothing",)], "h string")
    assert one(df, tx.clean_headline(F.col("h"))) == [("A & B rise",), ("Plain – nothing",)]


def test_flag_treats_unknown_as_zero(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert [v for (v,) in one(df, numeric.flag(F.col("x") > 2))] == [0, 0, 1]


def test_exact_quantiles_and_hot_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 0.37 % 101).alias("x"))
    x = df.toPandas()["x"]
    got = rk.exact_quantiles(df, [], "x", {"a": 0.05, "b": 0.5, "c": 0.95}).collect()[0]
    assert [got["a"], got["b"], got["c"]] == pytest.approx(list(x.quantile([0.05, 0.5, 0.95])))


def test_tied_scores_make_one_threshold(spark):
    rows = [(0.9, 1), (0.9, 0), (0.5, 1), (0.5, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "s double, y int")
    assert rk.score_curve(df, [], "s", "y").count() == 3
    got = rk.eval_binary(df, [], "s", "y").collect()[0]
    assert got["auc_roc"] == pytest.approx(3.5 / 6)
    assert rk.best_threshold(df, [], "s", "y").collect()[0]["threshold"] == 0.5


def test_distributions_match_published_values():
    assert dist.chi2_sf(1.1077, 1) == pytest.approx(0.2926, abs=5e-5)
    assert dist.normal_sf2(1.3261) == pytest.approx(0.1848, abs=5e-5)
    assert dist.t_sf2(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert dist.f_sf(4.9646027, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert dist.adf_p(-2.86) == pytest.approx(0.05, abs=1e-3)


def test_chi2_with_correction(spark):
    from riskspark.models.tests import chi2_yates
    cells = {(0, 0): 8, (0, 1): 1, (1, 0): 5, (1, 1): 4}
    df = spark.createDataFrame([k for k, n in cells.items() for _ in range(n)], "a int, b int")
    assert chi2_yates(df, F.col("a"), F.col("b")).collect()[0]["chi2"] == pytest.approx(1.1077, abs=5e-5)


def test_p_values_of_one_row_results(spark):
    from riskspark.models.tests import p_values
    z = spark.createDataFrame([(3, 4, 1.3261)], "n1 int, n2 int, z double")
    f = spark.createDataFrame([(4.9646027, 1, 10)], "f_stat double, df_between long, df_within long")
    c = spark.createDataFrame([(1.1077, 18.0)], "chi2 double, n double")
    got = {r["test"]: r["p_value"] for r in p_values(z, f, c).collect()}
    assert got["ranksum"] == pytest.approx(0.1848, abs=5e-5)
    assert got["anova"] == pytest.approx(0.05, abs=1e-6)
    assert got["chi2"] == pytest.approx(0.2926, abs=5e-5)
    assert p_values(z, f, c.withColumn("chi2", F.lit(None).cast("double"))).where("test = 'chi2'").collect()[0]["p_value"] is None


def test_lexicon_score_needs_no_shuffle(spark):
    from riskspark.operators.textscore import lexicon_score
    df = spark.createDataFrame([(1, "Good, good WAR"), (2, ""), (3, None), (4, "unknown words")], "id int, text string")
    out = lexicon_score(df, ["id"], "text", {"good": 1.5, "war": -1.0})
    got = {r["id"]: r["compound"] for r in out.collect()}
    assert got == {1: pytest.approx(2 / 19 ** 0.5), 2: 0.0, 3: 0.0, 4: 0.0}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_rank_buckets_do_not_change_results(spark):
    from riskspark.operators.ranking import running_totals
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 37 % 301).cast("double").alias("v"))
    rows = lambda n: sorted(map(tuple, running_totals(df, ["g"], "v", {"n": F.count(F.lit(1))}, bucket_rows=n).collect()))
    assert rows(5) == rows(1_000_000)
    empty = running_totals(df.limit(0), ["g"], "v", {"n": F.count(F.lit(1))})
    assert empty.collect() == []


def test_resume_keeps_rows_without_key(spark):
    a = spark.createDataFrame([(1, "u"), (2, None), (3, "v")], "id int, url string")
    done = spark.createDataFrame([("u",), ("u",)], "url string")
    assert sorted(one(jn.resume(a, done), "id")) == [(2,), (3,)]


def test_actions_cover_all_branches(spark):
    rows = [(0.8, "HIGH RISK", 0.0), (0.2, "NORMAL", 0.1), (0.5, "NORMAL", 0.0), (0.2, "NORMAL", 0.0), (None, None, None)]
    df = spark.createDataFrame([(*r, "technology", "") for r in rows],
                               "p double, l string, m double, d string, r string")
    got = [v for (v,) in one(ru.action(df, "p", "l", "d", "m", "r"), "action")]
    assert got == ["REDUCE / HEDGE", "BUY / ADD", "HOLD / MONITOR", "HOLD", "HOLD / MONITOR"]


def test_batch_scorer_keeps_rows_and_sums_to_one(spark):
    df = spark.createDataFrame([(1, "strong growth"), (2, "fraud and crisis"), (3, None)], "id int, t string")
    got = {r["id"]: r for r in tsx.score_texts(df, "t").collect()}
    assert (got[1]["tone_label"], got[2]["tone_label"]) == ("positive", "negative")
    for r in got.values():
        assert r["prob_pos"] + r["prob_neg"] + r["prob_neu"] == pytest.approx(1, abs=2e-4)


def test_flat_price_is_not_above_its_mean(spark):
    rows = [("m", day(i), 0.1 if i < 30 else 0.1 + i) for i in range(32)]
    panel = spark.createDataFrame(rows, "ticker string, date date, price double")
    got = [v for (v,) in one(ro.regime_flag(panel, "m").orderBy("date"), "market_regime_flag")]
    assert got == [0] * 30 + [1, 1]


def test_score_of_exactly_two_is_no_spike(spark):
    from itertools import combinations_with_replacement

    from riskspark.operators import features as fe

    def is_tie(c):
        n, s, q = len(c), sum(c), sum(v * v for v in c)
        return n * c[-1] > s and (n * c[-1] - s) ** 2 * (n - 1) == 4 * n * (n * q - s * s)

    ties = [c for n in range(6, 10) for c in combinations_with_replacement(range(1, 6), n) if is_tie(c)]
    assert ties
    rows = [(str(k), day(i), v) for k, c in enumerate(ties) for i, v in enumerate(c)] + [
        ("above", day(i), v) for i, v in enumerate([1, 1, 1, 1, 1, 6])]
    df = spark.createDataFrame(rows, "domain string, date date, article_count long").withColumn(
        "sentiment_score", F.lit(0.1))
    got = {(r["domain"], r["date"]): r["article_spike"] for r in fe.domain_features(df).collect()}
    assert got["above", day(5)] == 1
    assert all(got[str(k), day(len(c) - 1)] == 0 for k, c in enumerate(ties))


def test_nested_containers_of_all_sites(spark):
    html = """<div class="main-content x"><ul><li><a name="top"></a><a href="/one"><b>Shares of the bank</b> rise</a><a href="/two">two</a></li>
      <li>no link</li><li><div class="eachStory big"><p><a href="http://x.com./three">Oil prices fall again today</a></p></div></li></ul></div>
      <li><a href="/out">Outside of the content block</a></li><ul class="content"><div><li><a href="/four">Rates are held by the bank</a></li></div></ul>
      <h2><a href="/five">Gold prices jump in Asia</a></h2><li class="a clearfix"><h3>x<a href="/six">Six firms report profits</a></h3></li>
      <div class="listing_row"><br><img src="x"><span>text</span><a href="/seven">Seven stocks to look at now</a></div><a href="/eight">none"""
    pages = spark.createDataFrame([(1, "https://site.com/p", html), (2, "https://site.com/q", None), (3, "https://site.com/r", "")], "page_id long, url string, html string")
    got = lambda sites: [(r["site"], r["pos"], r["link"], r["headline"]) for r in rd.container_headlines(pages, sites).orderBy("site", "pos").collect()]
    assert got(K.SITE_CONTAINERS) == [
        ("EconomicTimes", 0, "https://site.com/one", "Shares of the bankrise"), ("EconomicTimes", 2, "http://x.com/three", "Oil prices fall again today"),
        ("EconomicTimes", 3, "http://x.com/three", "Oil prices fall again today"), ("Livemint", 0, "https://site.com/seven", "Seven stocks to look at now"),
        ("Moneycontrol", 0, "https://site.com/five", "Gold prices jump in Asia"), ("Moneycontrol", 1, "https://site.com/six", "Six firms report profits"),
        ("Moneycontrol", 2, "https://site.com/six", "Six firms report profits")]
    assert [x[2] for x in got({"ET": K.LISTING_CONTAINERS["EconomicTimes"]})] == ["http://x.com/three", "https://site.com/four"]
    deep = "<div>" * 20_000 + "<li class='clearfix'><a href='/deep'>A headline far below all</a>"
    far = spark.createDataFrame([(1, "https://site.com/p", deep)], "page_id long, url string, html string")
    assert rd.container_headlines(far, K.SITE_CONTAINERS).count() == 1


def test_lexicon_of_any_size_and_empty_texts(spark):
    lexicon = {f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghijklmn'[i // 1000]}": (i % 7) - 3.0 for i in range(4_000)}
    words = list(lexicon)
    rows = [(i, " ".join(words[i * 3:i * 3 + 5]).upper() + "!? 12") for i in range(700)] + [(9_000, None), (9_001, ""), (9_002, "nothing known")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, t int")
    got = {r["doc_id"]: r["compound"] for r in tsx.lexicon_score(df, ["doc_id"], "text", lexicon).collect()}
    for i, text in rows:
        s = sum(lexicon.get(w, 0.0) for w in (text or "").lower().replace("!?", "").split())
        assert abs(got[i] - s / (s * s + 15) ** 0.5) < 1e-12
    z = tsx.lexicon_scorer({"good": 2.0, "bad": -1.5})(pd.Series(["Good, \"bad\" GOOD!", "", None, "x"]))
    assert z.tolist() == [[4.0, 1.5, 0.5], [0.0, 0.0, 0.5], [0.0, 0.0, 0.5], [0.0, 0.0, 0.5]]


def test_order_statistics_equal_a_sorted_list():
    rng = np.random.default_rng(0)
    values = np.round(rng.normal(size=400), 1)
    values[::17] = np.nan
    seen, want = [], []
    for v in values:
        if v == v:
            seen = sorted([*seen, v])
        h = (len(seen) - 1) * 0.95
        want.append(None if len(seen) < 10 else seen[int(h)] + (seen[min(int(h) + 1, len(seen) - 1)] - seen[int(h)]) * (h - int(h)))
    got = sh._running_quantile(values, 0.95, 10)
    assert all((a is None and b is None) or abs(a - b) < 1e-12 for a, b in zip(got, want))
    assert sh._running_quantile([np.nan] * 3, 0.95, 1) == [None] * 3


def test_lag_correlation_leaves_out_short_and_constant_pairs(spark):
    rows = [("a", "b", i, float(i * i % 7), float(i % 5)) for i in range(30)] + [("c", "b", i, 1.0, float(i)) for i in range(30)] + [("d", "b", i, float(i), float(-i)) for i in range(9)]
    df = spark.createDataFrame(rows, "cause string, effect string, date int, x double, y double")
    got = co.lagged_correlations(df, ["cause", "effect"], "x", "y", 5, 10).collect()
    assert {r["cause"] for r in got} == {"a"} and len(got) == 6
    assert {r["cause"] for r in co.lagged_correlations(df, ["cause", "effect"], "x", "y", 5).collect()} == {"a", "c", "d"}
