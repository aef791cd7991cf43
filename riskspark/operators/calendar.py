"""Calendars: densify, forward fill, as-of, chronological splits.

A series holds one row per day after aggregation, so a window over one series is
bounded by the calendar (about 260 rows a year), whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.common import domain_rows
from riskspark.functions import dates


def trading_calendar(prices: DataFrame) -> DataFrame:
    return prices.select("date").distinct()


def densify(series: DataFrame, keys: list[str], calendar: DataFrame) -> DataFrame:
    """Every series on every calendar day. Each series unrolls a day sequence over
    the calendar's span and keeps the days the calendar holds (an equi semi-join),
    so no cross join is planned."""
    low, high = calendar.select(F.min("date")).scalar(), calendar.select(F.max("date")).scalar()
    grid = series.select(*keys).distinct().withColumn("date", F.explode(F.sequence(low, high)))
    grid = grid.join(calendar, "date", "left_semi")
    return grid.join(series, [*keys, "date"], "left")


def densify_daily(series: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Every calendar day between each series' first and last day."""
    keys = keys or []
    span = series.groupBy(*keys).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    grid = span.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias("date"))
    return grid.join(series, [*keys, "date"], "left")


def domain_grid(daily: DataFrame, domains: list[str]) -> DataFrame:
    """The news calendar (days with an article in any domain) times the domains."""
    return domain_rows(daily.select("date").distinct(), domains).join(daily, ["date", "domain"], "left")


def by_series(*keys: str):
    return W.partitionBy(*keys).orderBy("date")


def ffill(c: Column | str, *keys: str) -> Column:
    """Last known value, unlimited."""
    c = F.col(c) if isinstance(c, str) else c
    return F.last(c, ignorenulls=True).over(by_series(*keys).rowsBetween(W.unboundedPreceding, 0))


def ffill_once(c: Column | str, *keys: str) -> Column:
    """Fill only the first day of a gap."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lag(c, 1).over(by_series(*keys)))


def asof_values(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """For each left row the latest right values dated on or before it: one union
    and one window per key, instead of an inequality join."""
    tagged = left.select(*left.columns, F.lit(1).alias("_left"), *[F.lit(None).cast(right.schema[c].dataType)
                                                                  .alias(c) for c in columns])
    source = right.select(
        *[F.col(c) if c in right.columns else F.lit(None).cast(left.schema[c].dataType).alias(c)
          for c in left.columns], F.lit(0).alias("_left"), *columns)
    w = W.partitionBy(*keys).orderBy("date", "_left").rowsBetween(W.unboundedPreceding, 0)
    filled = tagged.unionByName(source).withColumns(
        {c: F.last(c, ignorenulls=True).over(w) for c in columns})
    return filled.filter("_left = 1").drop("_left")


def position(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row number and series length, for chronological splits."""
    return (df.withColumn("rn", F.row_number().over(by_series(*keys)))
              .withColumn("n", F.count(F.lit(1)).over(W.partitionBy(*keys))))


def split_time(df: DataFrame, keys: list[str], train_share: float = 0.8) -> DataFrame:
    """Chronological split with at least one training row."""
    cut = F.greatest(F.lit(1), F.floor(F.col("n") * train_share))
    return position(df, keys).withColumn("is_train", F.col("rn") <= cut).drop("rn", "n")


def walk_forward(df: DataFrame, keys: list[str], folds: int = 3) -> DataFrame:
    """Expanding folds: each row once per fold it takes part in."""
    base = F.greatest(F.lit(5), F.floor(F.col("n") / (folds + 1)))
    step = F.greatest(F.lit(1), F.floor((F.col("n") - base) / folds))
    rows = position(df, keys).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    start = base + F.col("fold") * step
    return (rows.filter((start < F.col("n")) & (F.col("rn") <= F.least(start + step, F.col("n"))))
                .withColumn("is_train", F.col("rn") <= start).drop("rn", "n"))


def roll_weekend(articles: DataFrame) -> DataFrame:
    return articles.withColumn("date", dates.roll_weekend(F.col("date")))


def filter_window(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df
