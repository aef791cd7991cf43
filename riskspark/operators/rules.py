"""Decision tables as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def shock_signal(p: Column, threshold: Column) -> Column:
    return F.when(p >= 0.75, "HIGH").when(p >= threshold, "ELEVATED").otherwise("NORMAL")


def risk_label(vol: Column) -> Column:
    return F.when(vol > 0.025, "HIGH RISK").when(vol > 0.015, "ELEVATED").otherwise("NORMAL")


def risk_band(df: DataFrame, point: str, low: str, high: str) -> DataFrame:
    """Label the point and widen the band until it holds the point."""
    return df.withColumns({low: F.least(F.col(low), F.col(point)), high: F.greatest(F.col(high), F.col(point)),
                           "risk_label": risk_label(F.col(point))})


def recovery_text(p25: Column, p50: Column, p75: Column) -> Column:
    whole = lambda c: c.cast("int")
    return F.format_string("Recovery expected in %d–%d days (median %d days)", whole(p25), whole(p75), whole(p50))


def action(df: DataFrame, p: str, label: str, domain: str, tone: str, recovery: str) -> DataFrame:
    """Four-branch action with its confidence and wording. Unknown inputs fall back to
    p = .5, NORMAL and a neutral tone."""
    prob = F.coalesce(F.col(p), F.lit(0.5))
    risk = F.coalesce(F.col(label), F.lit("NORMAL"))
    dom = F.coalesce(F.col(domain), F.lit("unknown"))
    mood = F.coalesce(F.col(tone), F.lit(0.0))
    tail = F.coalesce(F.col(recovery), F.lit(""))
    reduce_ = (prob >= 0.75) & risk.isin("HIGH RISK", "ELEVATED")
    buy = (prob < 0.35) & (risk == "NORMAL") & (mood > 0.05)
    watch = (prob >= 0.35) | (risk == "ELEVATED")
    pick = lambda a, b, c, d: F.when(reduce_, a).when(buy, b).when(watch, c).otherwise(d)
    pct = F.format_string("%.0f%%", prob * 100 + 1e-7)
    text = pick(
        F.concat(F.lit("Shock probability "), pct, F.lit(" and risk level "), risk,
                 F.lit(": reduce the most volatile holdings or add a hedge. "), tail),
        F.concat(F.lit("Shock probability "), pct, F.lit(", normal risk and improving "), dom, F.lit(" tone ("),
                 F.format_string("%+.3f", mood + 1.3e-9), F.lit("): a favourable entry. "), tail),
        F.concat(F.lit("Mixed signals: shock probability "), pct, F.lit(", risk level "), risk, F.lit(". Watch "),
                 dom, F.lit(" headlines. "), tail),
        F.concat(F.lit("Stable: shock probability "), pct, F.lit(", risk level "), risk, F.lit(". "), tail))
    return df.withColumns({
        "action": pick(F.lit("REDUCE / HEDGE"), F.lit("BUY / ADD"), F.lit("HOLD / MONITOR"), F.lit("HOLD")),
        "confidence": pick(F.lit("High"), F.lit("Moderate"), F.lit("Moderate"), F.lit("Low")),
        "reasoning": F.trim(text)})


def expansion(safe_haven: Column, intra_corr: Column) -> Column:
    """Tickers that would widen a concentrated portfolio, with the reason."""
    item = lambda t, why: F.struct(F.lit(t).alias("ticker"), F.lit(why).alias("rationale"))
    none = F.array().cast("array<struct<ticker:string,rationale:string>>")
    hedges = F.array(item("GLD", "geopolitical hedge"), item("TLT", "lowers volatility in shock events"))
    return F.concat(F.when(safe_haven < 0.2, hedges).otherwise(none),
                    F.when(intra_corr > 0.5, F.array(item("EEM", "lower correlation among holdings"))).otherwise(none))


def sensitivity(ranked: DataFrame, recent: DataFrame) -> DataFrame:
    """Dominant domain per portfolio with its recent tone and direction; ``ranked``
    holds (portfolio, domain, r, rank)."""
    top = ranked.filter("rank = 1").join(recent, "domain", "left")
    tone = F.coalesce("recent_sentiment", F.lit(0.0))
    return top.select("portfolio", F.col("domain").alias("dominant_domain"), F.col("r").alias("dominant_coeff"),
                      tone.alias("recent_sentiment"),
                      F.when(tone > 0, "increasing").otherwise("decreasing").alias("direction"))
