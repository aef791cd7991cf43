"""Batch and stream agree over several files, one a batch; restarts and repeated batches
change nothing; reads touch what they have to."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import rolling as ro
from riskspark.streaming import dedupe as dd, incremental as inc, keyindex as ki, prices as ps, upsert as up

SUMS = "ticker string, date date, amount double, quantity double"
DAY = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)


def trades(spark, days, tickers=("a", "b"), shift=0.0):
    rows = [(t, DAY(i), 10.0 * (1 + i % 7 + k) + shift, 1.0 + k) for t in tickers for i in days for k in range(3)]
    return spark.createDataFrame(rows, SUMS)


def sums(batch):
    return batch.groupBy("ticker", "date").agg(F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity"))


def land(df, folder, table):
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{table}.parquet")


def batch_features(df):
    t = sums(df).select("ticker", "date", (F.col("amount") / F.col("quantity")).alias("price"))
    t = t.withColumn("ret", ro.log_return("price", "ticker"))
    t = t.withColumns({"vol5": ro.roll_std("ret", 5, 2, "ticker"), "vol20": ro.roll_std("ret", 20, 5, "ticker"), "drawdown": ro.drawdown("price", "ticker")})
    return {(r["ticker"], r["date"]): tuple(None if r[c] is None else round(r[c], 9) for c in ("price", "ret", "vol5", "vol20", "drawdown")) for r in t.collect()}


def stored_features(df):
    return {(r["ticker"], r["date"]): tuple(None if r[c] is None else round(r[c], 9) for c in ("price", "ret", "vol5", "vol20", "drawdown")) for r in df.collect()}


def test_prices_over_four_files(spark, tmp_path):
    folder, root, ck = str(tmp_path), str(tmp_path / "store"), str(tmp_path / "ck")
    parts = [trades(spark, range(0, 70)), trades(spark, range(70, 100)), trades(spark, range(95, 130), ("a",), 4.0), trades(spark, range(60, 66), ("b", "c"), 9.0)]
    schema, seen = parts[0].schema, None
    for part in parts:  # days come back in later files, and old months change
        land(part, folder, "trades")
        seen = part if seen is None else seen.union(part)
        stored = ps.update_prices(spark, inc.read_landed(spark, folder, schema, "trades", 1), sums, root, ck)
        assert stored_features(stored) == batch_features(seen)
    assert stored_features(ps.update_prices(spark, inc.read_landed(spark, folder, schema, "trades", 1), sums, root, ck)) == batch_features(seen)


def test_a_repeated_price_batch_and_open_months(spark, tmp_path):
    store = ps.PriceStore(spark, str(tmp_path / "store"))
    store.add(sums(trades(spark, range(0, 80))), 0)
    for _ in range(2):
        store.add(sums(trades(spark, range(80, 90))), 1)
    assert stored_features(store.read()) == batch_features(trades(spark, range(0, 90)))
    files = {r[0] for r in store.rows("2024-03").select(F.input_file_name()).distinct().collect()}
    assert {re.search(r"month=([\d-]+)", f)[1] for f in files} == {"2024-03"}
    assert any("/base/" in f for f in files) and not any("batch=0" in f for f in files)  # merged batches are not read again
    for df in (store.rows("2024-03"), store.tail("2024-03")):  # folders are left out by their names
        scans = re.findall(r"PartitionFilters: \[(.*?)\]", df._jdf.queryExecution().executedPlan().toString())
        assert scans and all("month" in s for s in scans)
    assert store.tail("2024-03").groupBy("ticker").count().where("count <> 20").count() == 0
    store.add(sums(trades(spark, [])), 2)  # an empty batch
    assert stored_features(store.read()) == batch_features(trades(spark, range(0, 90)))


NEWS = "headline string, article_id long, date date"


def news(spark, rows):
    return spark.createDataFrame(rows, NEWS)


def test_headlines_over_four_files(spark, tmp_path):
    folder, path, ck = str(tmp_path), str(tmp_path / "out"), str(tmp_path / "ck")
    files = [[("A", 1, DAY(0)), ("b", 2, DAY(0)), ("A ", 3, DAY(0))], [("a", 4, DAY(1)), ("C", 5, DAY(1)), (None, 6, DAY(1))],
             [("'C'", 7, DAY(2)), ("D", 9, DAY(2)), ("D", 8, DAY(2))] + [("hot", 100 + i, DAY(2)) for i in range(500)], [("e", 500, DAY(3)), ("hot", 10, DAY(0))]]
    schema = news(spark, files[0]).schema
    for rows in files:
        land(news(spark, rows), folder, "news")
        stream = inc.read_landed(spark, folder, schema, "news", 1)
        inc.write_append(dd.first_copies(stream, order=("date", "article_id")), path, ck)
    got = sorted((r["headline"], r["article_id"]) for r in spark.read.schema(NEWS).parquet(path).collect())
    assert got == [("A", 1), ("C", 5), ("D", 8), ("b", 2), ("e", 500), ("hot", 100)]


def test_headline_state_is_dropped_after_its_time(spark, tmp_path):
    folder, path, ck = str(tmp_path), str(tmp_path / "out"), str(tmp_path / "ck")
    for i in range(3):
        land(news(spark, [("A", i, DAY(i))]), folder, "news")
        stream = inc.read_landed(spark, folder, news(spark, [("A", i, DAY(i))]).schema, "news", 1)
        inc.write_append(dd.first_copies(stream, order=("date",), keep_ms=1), path, ck)
    assert spark.read.schema(NEWS).parquet(path).count() == 3


def test_headlines_share_states(spark, tmp_path):
    folder, path, ck = str(tmp_path), str(tmp_path / "out"), str(tmp_path / "ck")
    ids = [range(0, 6000), range(3000, 9000)]  # twice in each file, the later day first
    for f in ids:
        rows = spark.range(f.start, f.stop).withColumn("n", F.explode(F.array(F.lit(1), F.lit(0))))
        land(rows.select(F.concat(F.lit("headline "), "id").alias("headline"), (F.col("id") * 2 + F.col("n")).alias("article_id"),
                         F.date_add(F.lit(DAY(0)), F.col("n")).alias("date")), folder, "news")
    stream = dd.first_copies(inc.read_landed(spark, folder, T._parse_datatype_string(NEWS), "news", 1), order=("date",))
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= dd.BUCKETS
    got = sorted((int(r["headline"][9:]), r["article_id"]) for r in spark.read.schema(NEWS).parquet(path).collect())
    assert got == [(i, 2 * i) for i in range(9000)]


def test_a_bucket_drops_only_headlines_past_their_time(spark, tmp_path):
    folder, path, ck = str(tmp_path), str(tmp_path / "out"), str(tmp_path / "ck")
    schema = T._parse_datatype_string(NEWS)
    run = lambda rows, keep: (land(news(spark, rows), folder, "news"), inc.write_append(
        dd.first_copies(inc.read_landed(spark, folder, schema, "news", 1), keep_ms=keep, buckets=1), path, ck))
    run([("long", 1, DAY(0))], dd.DAY_MS)
    run([("short", 2, DAY(0)), ("long", 3, DAY(1))], 1)
    run([("short", 4, DAY(2)), ("long", 5, DAY(2))], 1)
    assert sorted(r["article_id"] for r in spark.read.schema(NEWS).parquet(path).collect()) == [1, 2, 4]


def test_sink_reads_only_folders_that_may_hold_its_keys(spark, tmp_path):
    schema = T.StructType([T.StructField("headline", T.StringType()), T.StructField("article_id", T.LongType())])
    sink = ki.IndexedSink(spark, str(tmp_path / "sink"), ["headline"], schema)
    rows = lambda ids, shift=0: spark.createDataFrame([(f"headline {i:05d}", i + shift) for i in ids], schema)
    for b in range(4):
        assert sink.append(rows(range(b * 500, b * 500 + 500)), b, [F.col("article_id")]) == []
    # Keys of batch 2 and new ones between the others' ranges: ranges meet, filters tell.
    assert sink.append(rows([1100, 1101, 9000, 9000], 7), 4, [F.col("article_id")]) == [2]
    assert sorted(r["article_id"] for r in sink.stored([4]).collect()) == [9007]
    for _ in range(2):  # a repeated batch replaces itself, and does not read itself
        assert 3 not in sink.append(rows(range(1500, 2000)), 3, [F.col("article_id")])
    assert sink.read().count() == 2001 and sink.read().select("headline").distinct().count() == 2001
    assert sink.append(rows([]), 5, [F.col("article_id")]) == [] and sink.append(rows([9000]), 6, [F.col("article_id")]) == [4]


def test_bloom_has_no_false_negative():
    h = np.random.default_rng(0).integers(0, 2**63, 50_000).astype(np.uint64)
    bits = ki.bloom(h[:20_000])
    assert ki.may_hold(bits, h[:20_000]).all() and ki.may_hold(bits, h[20_000:]).mean() < 0.02


def test_daily_upsert_over_four_files_and_a_repeated_batch(spark, tmp_path):
    folder, path, ck = str(tmp_path), str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "ts timestamp, domain string, prob_pos double, prob_neg double"
    at = lambda day, hour: dt.datetime(2024, 1, 1 + day, hour)
    rows = [(at(i % 9, i % 24), f"d{i % 2}", (i * 7 % 10) / 10, (i * 3 % 10) / 10) for i in range(200)]
    for part in (rows[:60], rows[60:130], rows[130:131], rows[131:]):  # days come back in later files
        land(spark.createDataFrame(part, schema), folder, "events")
    frame = spark.createDataFrame(rows, schema)
    stream = inc.read_landed(spark, folder, frame.schema, "events", 1)
    up.write_updates(up.daily_sentiment(stream, "ts", "30 days"), path, ck)
    assert len([1 for f in (tmp_path / "out").iterdir() if f.name.startswith("batch=")]) >= 4
    want = frame.groupBy(F.to_date("ts").alias("date"), "domain").agg(F.avg("prob_pos"), F.avg("prob_neg"), F.count(F.lit(1)))
    as_set = lambda df: {(r[0], r[1], round(r[2], 9), round(r[3], 9), r[4]) for r in df.collect()}
    latest = lambda: up.latest(spark, path, ["date", "domain"]).select("date", "domain", "avg_prob_pos", "avg_prob_neg", "article_count")
    assert as_set(latest()) == as_set(want)
    again = spark.read.parquet(f"{path}/batch=3").collect()
    spark.createDataFrame(again, spark.read.parquet(f"{path}/batch=3").schema).write.mode("overwrite").parquet(f"{path}/batch=3")
    assert as_set(latest()) == as_set(want) and latest().count() == 18
