"""Prices kept up to date month by month.

``sums``      per batch and month: amount and quantity per ticker and day; a repeated
              batch replaces its folder
``base``      months whose older batches are merged into one row per ticker and day
``features``  price, return, rolling volatilities, peak and drawdown
``tails``     each ticker's last rows as of a month's end, from which the windows of
              the next month continue

A batch reads and rewrites the months from its first trade on, and one month of tails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from riskspark.common import materialise
from riskspark.operators import rolling as ro
from riskspark.streaming.incremental import run_once

TAIL_ROWS = 20
SUMS = "ticker string, date date, amount double, quantity double"
FEATURES = "ticker string, date date, price double, ret double, vol5 double, vol20 double, peak double, drawdown double"
_TAIL = "ticker string, date date, price double, ret double, peak double"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    exists = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def _replace_months(df: DataFrame, path: str) -> None:
    """Months in ``df`` take the place of the stored ones, others stay. ``df`` must not
    read the table itself."""
    df.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


class PriceStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _of(self, name: str, schema: str) -> DataFrame:
        return _table(self.spark, f"{self.root}/{name}", schema)

    def rows(self, since: str, before: int | None = None) -> DataFrame:
        """Merged months from ``since`` on plus the batches after them, not yet summed. Both
        filters are on folder names, so other folders are not read."""
        base = self._of("base", SUMS + ", upto long, month string").where(F.col("month") >= since)
        upto = {r["month"]: r["upto"] for r in base.groupBy("month").agg(F.max("upto").alias("upto")).collect()}
        sums = self._of("sums", SUMS + ", batch long, month string").where(F.col("month") >= since)
        for month, batch in upto.items():
            sums = sums.where((F.col("month") != month) | (F.col("batch") > batch))
        if before is not None:
            sums = sums.where(F.col("batch") < before)
        names = ["ticker", "date", "amount", "quantity", "month"]
        return base.select(names).union(sums.select(names))

    def sums(self, since: str, before: int | None = None) -> DataFrame:
        """(ticker, date, month, amount, quantity) of the months from ``since`` on."""
        return self.rows(since, before).groupBy("ticker", "date", "month").agg(F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity"))

    def tail(self, since: str) -> DataFrame:
        """Each ticker's last rows before a month."""
        tails = self._of("tails", _TAIL + ", month string").where(F.col("month") < since)
        last = tails.agg(F.max("month").alias("m")).collect()[0]["m"]
        return tails.where(F.col("month") == last).drop("month") if last else self.spark.createDataFrame([], _TAIL)

    def refresh(self, since: str) -> None:
        """Prices and windows of the months from ``since`` on, continued from the tail."""
        price = self.sums(since).select("ticker", "date", F.try_divide("amount", "quantity").alias("price"), F.lit(None).cast("double").alias("known"))
        old = self.tail(since).select("ticker", "date", "price", F.col("peak").alias("known"))
        w = W.partitionBy("ticker").orderBy("date")
        t = old.union(price).withColumn("ret", ro.log_return("price", "ticker"))
        t = t.withColumns({"vol5": ro.roll_std("ret", 5, 2, "ticker"), "vol20": ro.roll_std("ret", 20, 5, "ticker"),
                           "peak": F.max(F.greatest(F.coalesce("known", "price"), F.col("price"))).over(w.rowsBetween(W.unboundedPreceding, 0))})
        t = t.withColumns({"drawdown": F.try_divide(F.col("price") - F.col("peak"), F.col("peak")), "month": F.date_format("date", "yyyy-MM")})
        t = materialise(t, "price-windows")
        names = [f.split()[0] for f in FEATURES.split(", ")]
        _replace_months(t.where(F.col("month") >= since).select(*names, "month"), f"{self.root}/features")
        # A row is among the last of every month from its own to the one before the row
        # that follows TAIL_ROWS later.
        start = F.trunc("date", "MM")
        newest = t.agg(F.max(start)).collect()[0][0]
        if newest is None:
            return
        end = F.coalesce(F.add_months(F.trunc(F.lead("date", TAIL_ROWS).over(w), "MM"), -1), F.lit(newest))
        first = F.greatest(start, F.to_date(F.lit(f"{since}-01")))
        spans = t.withColumns({"_a": first, "_b": end}).where("_b >= _a")
        tails = spans.withColumn("_m", F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))))
        _replace_months(tails.select("ticker", "date", "price", "ret", "peak", F.date_format("_m", "yyyy-MM").alias("month")), f"{self.root}/tails")

    def compact(self, since: str, before: int) -> None:
        """Merge the batches before ``before``, which are never repeated, into the base."""
        merged = self.sums(since, before)
        rows = merged.select("ticker", "date", "amount", "quantity", F.lit(before - 1).cast("long").alias("upto"), "month")
        _replace_months(materialise(rows, "price-base"), f"{self.root}/base")

    def add(self, sums: DataFrame, batch: int) -> None:
        """Take in one batch of (ticker, date, amount, quantity)."""
        folder = f"{self.root}/sums/batch={batch}"
        sums.withColumn("month", F.date_format("date", "yyyy-MM")).repartition("month").write.mode("overwrite").partitionBy("month").parquet(folder)
        since = _table(self.spark, folder, SUMS + ", month string").agg(F.min("month")).collect()[0][0]
        if since is None:
            return
        if batch:
            self.compact(since, batch)
        self.refresh(since)

    def read(self) -> DataFrame:
        return self._of("features", FEATURES + ", month string").drop("month")


def update_prices(spark: SparkSession, stream: DataFrame, shape, root: str, checkpoint: str) -> DataFrame:
    """Take in everything landed so far and return the price table."""
    store = PriceStore(spark, root)
    run_once(stream, checkpoint, lambda batch, number: PriceStore(batch.sparkSession, root).add(shape(batch), number))
    return store.read()
