"""Writers. All are plain Spark writes, so they commit per task and retry safely."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def by_ticker(df: DataFrame, path: str) -> None:
    """One folder per ticker; '=' is not kept in folder names. Rows of a ticker are
    split by year first, so a very large ticker is not written by one task."""
    safe = df.withColumn("ticker", F.replace("ticker", F.lit("="), F.lit("_")))
    safe.repartition("ticker", F.year("date")).write.mode("overwrite").partitionBy("ticker").parquet(path)


def wide_panel(df: DataFrame, tickers: list[str], value: str = "price") -> DataFrame:
    """Date x ticker table with ISO day strings, for export."""
    wide = df.groupBy("date").pivot("ticker", tickers).agg(F.first(value, ignorenulls=True))
    return wide.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
