"""Incremental jobs on Structured Streaming. Every job reads landed files once
(availableNow), keeps its progress in a checkpoint, and can be restarted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def read_landed(spark: SparkSession, folder: str, schema: T.StructType, table: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream a landed table, which may be one file ``<table>.parquet`` or a folder of
    files of that name (a pattern, as a plain path would have to be a folder)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(f"{folder}/{table}.parque[t]"))


def run_once(stream: DataFrame, checkpoint: str, each) -> None:
    """Process everything landed so far, batch by batch, then stop."""
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def write_append(df: DataFrame, path: str, checkpoint: str) -> None:
    q = (df.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def month_buckets(start: Column, end: Column) -> Column:
    """Month ranges of a backfill as (month, first day, last day)."""
    months = F.sequence(F.trunc(start, "MM"), end, F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.struct(
        F.date_format(m, "yyyy-MM").alias("month"), F.greatest(m, start).alias("first_day"),
        F.least(F.last_day(m), end).alias("last_day")))
