"""Scores from a stored version: nothing is fitted here.

Every function takes ``portfolio``: a name restricts the read to that portfolio's
partitions, None scores all of them in one job.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window as W, functions as F

from riskspark.models import frames as fr, linear as ln, shock as sk, training as tr
from riskspark.models.store import Version
from riskspark.operators import rules as ru

NO_THRESHOLD = 0.5


def _only(df: DataFrame, portfolio: str | None) -> DataFrame:
    return df if portfolio is None else df.filter(F.col("portfolio") == portfolio)


def shock_days(version: Version, days: DataFrame, shock_portfolio: str) -> DataFrame:
    """(date, p, threshold) of the days whose features are complete; no row without a stored model."""
    empty = days.filter("false").select("date", F.lit(None).cast("double").alias("p"),
                                        F.lit(NO_THRESHOLD).alias("threshold"))
    if "shock_model" not in version.items:
        return empty
    features = fr.shock_features(shock_portfolio)
    model = version.model("shock_model", RandomForestClassificationModel)
    rows = days.select("date", *features).dropna()
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
    return sk.score(model, rows).select("date", "p", F.lit(version.values("shock_values")["threshold"]).alias("threshold"))


def risk_days(version: Version, days: DataFrame, portfolio_feats: DataFrame, portfolio: str | None = None) -> DataFrame:
    """Predicted next-day volatility with its band and label, per portfolio and day."""
    f = fr.risk_features()
    keys = _only(portfolio_feats, portfolio).select("portfolio", "date")
    rules = version.table("risk_rules", portfolio=portfolio)
    out = ln.apply(keys.join(days.select("date", *f), "date"), rules, "portfolio", f, [tr.POINT, "p25", "p75"])
    out = ln.banded(out.withColumnRenamed(tr.POINT, "predicted_vol"), "p25", "predicted_vol", "p75")
    return out.withColumns({"risk_label": F.when(F.col("predicted_vol").isNotNull(), ru.risk_label(F.col("predicted_vol")))})


def recovery_days(version: Version, context: DataFrame, order: list[str], portfolio: str | None = None) -> DataFrame:
    """Days until volatility settles if a shock came on that day: quartiles that do not
    cross, one day at least, and their wording. Gaps take the stored medians."""
    names = ["p25", "p50", "p75"]
    rows = _only(context, portfolio)
    if "recovery_rules" not in version.items:
        return rows.select("portfolio", "date", *[F.lit(None).cast("double").alias(f"{n}_days") for n in names],
                           F.lit(None).cast("string").alias("recovery"))
    mids = version.values("recovery_medians")
    rows = rows.withColumn("sector_label", F.array_position(F.array(*[F.lit(p) for p in order]), F.col("portfolio")) - 1)
    filled = rows.select("portfolio", "date", *[F.coalesce(F.col(c).cast("double"), F.lit(m)).alias(c) for c, m in mids.items()])
    out = ln.apply(filled, version.table("recovery_rules").drop("pool"), "portfolio", list(mids), names, pooled=True)
    # The quartile fits end within a millionth of whole days; unrounded, 1.999999 would read as one day.
    days = lambda c: F.round(c, 4)
    low = F.greatest(F.lit(1.0), days("p25"))
    mid = F.greatest(low, days("p50"))
    high = F.greatest(mid, days("p75"))
    return out.select("portfolio", "date", low.alias("p25_days"), mid.alias("p50_days"), high.alias("p75_days"),
                      ru.recovery_text(low, mid, high).alias("recovery"))


def sensitivities(version: Version, recent: DataFrame, domains: list[str], portfolio: str | None = None) -> DataFrame:
    """Dominant domain per portfolio by stored coefficients, all domains ranked, and
    the recent tone of each. ``recent`` holds (domain, recent_sentiment)."""
    coef = version.table("domain_coefficients", portfolio=portfolio)
    long = coef.select("portfolio", F.inline(F.array(*[
        F.struct(F.lit(g).alias("domain"), F.col(f"m5_coeff_{g}").alias("r")) for g in domains])))
    long = long.withColumn("rank", F.row_number().over(W.partitionBy("portfolio").orderBy(F.desc(F.abs("r")), "domain")))
    tone = F.coalesce("recent_sentiment", F.lit(0.0))
    every = long.join(recent, "domain", "left").groupBy("portfolio").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "domain", "r"))),
                    lambda e: F.struct(e["domain"].alias("domain"), e["r"].alias("coefficient"))).alias("ranked_domains"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("domain", tone)))).alias("recent_by_domain"))
    return ru.sensitivity(long, recent).join(every, "portfolio")


def confirmed_causes(version: Version, domains: list[str], portfolio: str | None = None, level: float = 0.05) -> DataFrame:
    """The clearest causality test of each portfolio as a sentence; no row where none is
    significant."""
    if "causes" not in version.items:
        return version.table("domain_coefficients", portfolio=portfolio).filter("false").select(
            "portfolio", F.lit(None).cast("string").alias("granger_note"))
    t = version.table("causes", effect=portfolio).filter((F.col("p_value") < level) & F.col("cause").isin(domains))
    best = t.groupBy(F.col("effect").alias("portfolio")).agg(F.min(F.struct("p_value", "lag", "cause")).alias("b"))
    return best.select("portfolio", F.format_string(
        "%s sentiment leads %s volatility by %d day(s) (p=%.4f)", F.initcap("b.cause"), "portfolio", "b.lag",
        "b.p_value").alias("granger_note"))


def signal_days(version: Version, days: DataFrame, portfolio_feats: DataFrame, context: DataFrame,
                domain_days: DataFrame, recent: DataFrame, order: list[str], domains: list[str], shock_portfolio: str,
                portfolio: str | None = None) -> DataFrame:
    """Every portfolio-day with model probability, predicted volatility, recovery band and
    the action they lead to. Days the models can't score keep their row; the rules then
    use their defaults."""
    base = _only(portfolio_feats, portfolio).select("portfolio", "date")
    out = base.join(shock_days(version, days, shock_portfolio), "date", "left").join(
        risk_days(version, days, portfolio_feats, portfolio), ["portfolio", "date"], "left").join(
        recovery_days(version, context, order, portfolio), ["portfolio", "date"], "left").join(
        sensitivities(version, recent, domains, portfolio).select("portfolio", "dominant_domain"), "portfolio", "left")
    mood = domain_days.select(F.col("domain").alias("dominant_domain"), "date", F.col("sentiment_score").alias("mood"))
    out = out.join(mood, ["dominant_domain", "date"], "left")
    limit = F.coalesce("threshold", F.lit(NO_THRESHOLD))
    out = out.withColumns({"threshold": limit, "signal": F.when(F.col("p").isNotNull(), ru.shock_signal(F.col("p"), limit))})
    return ru.action(out, "p", "risk_label", "dominant_domain", "mood", "recovery").select(
        "portfolio", "date", "p", "threshold", "signal", "predicted_vol", "p25", "p75", "risk_label", "p25_days", "p50_days",
        "p75_days", "recovery", "dominant_domain", "mood", "action", "confidence", "reasoning")
