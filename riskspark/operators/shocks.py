"""Volatility shocks and how long they last."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.functions.numeric import flag
from riskspark.operators.calendar import by_series

#: Relative distance below which a volatility counts as equal to its threshold: a value
#: carried on from the day that set the threshold may differ in the last bit.
TOLERANCE = 1e-9


def above(value: Column, threshold: Column) -> Column:
    return value > threshold * (1 + TOLERANCE)


def below(value: Column, threshold: Column) -> Column:
    return value < threshold * (1 - TOLERANCE)


class OrderStatistics:
    """Counts of seen values by rank in a binary indexed tree: adding a value and finding
    the k-th smallest take logarithmic time."""

    def __init__(self, values: np.ndarray):
        self.ranked = np.unique(values)
        self.size = len(self.ranked)
        self.tree = [0] * (self.size + 1)
        self.top = 1 << max(self.size.bit_length() - 1, 0)
        self.n = 0

    def add(self, value: float) -> None:
        i = int(np.searchsorted(self.ranked, value)) + 1
        self.n += 1
        while i <= self.size:
            self.tree[i] += 1
            i += i & -i

    def kth(self, k: int) -> float:
        """The k-th smallest value seen, from 0."""
        at, step = 0, self.top
        while step:
            if at + step <= self.size and self.tree[at + step] <= k:
                at += step
                k -= self.tree[at]
            step >>= 1
        return float(self.ranked[at])


def _running_quantile(values, q: float, least: int) -> list:
    """Expanding interpolated quantile of one day-grained series (NaN = missing)."""
    values = np.asarray(values, float)
    seen, out = OrderStatistics(values[~np.isnan(values)]), []
    for v in values:
        if v == v:
            seen.add(v)
        if seen.n < max(least, 1):
            out.append(None)
            continue
        h = (seen.n - 1) * q
        i = int(h)
        low = seen.kth(i)
        out.append(low if i + 1 >= seen.n else low + (seen.kth(i + 1) - low) * (h - i))
    return out


def expanding_quantile(df: DataFrame, key: str, value: str, q: float = 0.95, least: int = 10) -> DataFrame:
    """Quantile of each series' own past, the current day included. A windowed
    percentile re-sorts the whole past on every row; here each series (one row per
    day, so bounded by the calendar) keeps counts by rank and looks the k-th value up."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date", ignore_index=True)
        return pdf.assign(threshold=pd.Series(_running_quantile(pdf[value].to_numpy(), q, least), dtype="float64"))

    schema = f"{key} string, date date, {value} double, threshold double"
    out = df.select(key, "date", value).groupBy(key).applyInPandas(one, schema)
    clean = {c: F.when(~F.isnan(c), F.col(c)) for c in (value, "threshold")}
    return out.withColumns(clean)


def shock_days(df: DataFrame, key: str = "portfolio", value: str = "vol5") -> DataFrame:
    """1 on days above the series' own expanding 95th percentile."""
    out = expanding_quantile(df, key, value)
    return out.withColumn("shock", flag(above(F.col(value), F.col("threshold"))))


def recovery_days(shocks: DataFrame, key: str = "portfolio", value: str = "vol5", sustain: int = 3) -> DataFrame:
    """Days from each shock to the first later day that opens ``sustain`` calm days;
    without one, the days left in the series, flagged censored. Running upward from
    the end of the series keeps the next calm day in one growing frame."""
    w = by_series(key)
    work = shocks.filter(F.col(value).isNotNull())
    calm = flag(below(F.col(value), F.col("threshold")))
    work = work.withColumns({"rn": F.row_number().over(w), "n": F.count(F.lit(1)).over(W.partitionBy(key)),
                             "calm": calm})
    run = F.col("calm")
    for k in range(1, sustain):
        run = run * F.coalesce(F.lead("calm", k).over(w), F.lit(0))
    later = W.partitionBy(key).orderBy(F.desc("date")).rowsBetween(W.unboundedPreceding, -1)
    work = work.withColumn("run", run)
    nxt = F.min(F.when(F.col("run") == 1, F.col("rn"))).over(later)
    return work.withColumn("_next", nxt).filter("shock = 1").select(
        key, "date", value, "threshold",
        (F.coalesce("_next", "n") - F.col("rn")).cast("int").alias("recovery_days"),
        F.col("_next").isNull().alias("censored"))


def post_shock_norm(vol: DataFrame, shock_date, days: int = 15, key: str = "portfolio",
                    value: str = "vol5") -> DataFrame:
    """Volatility of the first days from a shock on, relative to the shock day."""
    w = by_series(key)
    after = vol.filter(F.col("date") >= shock_date).withColumn("day", F.row_number().over(w) - 1)
    base = F.first(value).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return (after.filter(F.col("day") < days).withColumn("relative", F.try_divide(F.col(value), base))
            .select(key, "day", "date", "relative"))
