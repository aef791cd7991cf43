"""Update-mode aggregates upserted by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_updates(updates: DataFrame, path: str, checkpoint: str) -> None:
    """Store each micro-batch's changed keys under their batch number. A repeated batch
    replaces its own folder, so replays change nothing."""
    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    q = updates.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest version of each key; versions meet as partial maxima, not in a window."""
    stored = spark.read.parquet(path)
    values = [c for c in stored.columns if c not in (*keys, "batch")]
    best = stored.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return best.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def daily_sentiment(stream: DataFrame, time: str, late: str) -> DataFrame:
    """Tumbling days per domain, to be written in update mode: a day comes out with its
    first event and again whenever it changes. ``late`` bounds the state: days end that
    much behind the newest event are closed."""
    day = F.window(time, "1 day")
    w = stream.withWatermark(time, late).groupBy(day, "domain").agg(
        F.avg("prob_pos").alias("avg_prob_pos"), F.avg("prob_neg").alias("avg_prob_neg"), F.count(F.lit(1)).alias("article_count"))
    return w.select(F.to_date("window.start").alias("date"), "domain", "avg_prob_pos", "avg_prob_neg", "article_count")
