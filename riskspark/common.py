"""Helpers used across operators: small dimensions, lineage cuts, rounding."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

BROADCAST_ROW_LIMIT = 10_000


def dimension(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A configuration table as a DataFrame. The row count is known here, so the
    broadcast hint is given only under the limit; a larger table is left to the
    optimizer, which picks a shuffle join by its own size check."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= BROADCAST_ROW_LIMIT else df


def domain_rows(df: DataFrame, domains: list[str], name: str = "domain") -> DataFrame:
    """Repeat each row once per configured domain (a literal array, no join)."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(d) for d in domains])))


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="riskspark-")


def _local_root(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def shared_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder named by ``spark.checkpoint.dir``.
    Only a local session may fall back to a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_root(spark)
    return f"{root.rstrip('/')}/riskspark/{label}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return shared_path(spark, f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str = "stage", group: int | None = None) -> DataFrame:
    """Write a stage once to shared storage and read it back: later passes rescan
    the columns they need and survive the loss of executors. Readers hold up to 4096
    rows at a time, but none past a row group: ``group`` is its rows where rows are large."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.option("parquet.block.row.count.limit", group) if group else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *steps: Callable) -> list:
    """Results of independent steps, each run in a thread of its own: rows of small jobs
    that one after another leave most cores idle. Every thread gets its own copy of the
    caller's job settings. An error is raised once all steps have ended."""
    def own(step):
        wrap = inheritable_thread_target(spark)
        return wrap(step) if callable(wrap) else step  # not callable: threads are not pinned, nothing to copy

    with ThreadPoolExecutor(len(steps)) as pool:
        runs = [pool.submit(own(step)) for step in steps]
    return [run.result() for run in runs]


# Sums of money are exact decimals, so ratios often sit on a rounding tie that the
# last bit of a sum decides; the offset moves them off the tie.
ROUND_OFFSET = 1.3e-9


def r(col: Column | str, digits: int = 6) -> Column:
    """Round for output; adding 0.0 turns -0.0 into 0.0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c + F.lit(ROUND_OFFSET), digits) + F.lit(0.0)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in cols})


def pearson(x: Column, y: Column, window=None) -> Column:
    """Correlation over complete pairs; NULL when a side is constant (the built-in
    raises a division error there in ANSI mode)."""
    both = x.isNotNull() & y.isNotNull()
    parts = [F.covar_pop(x, y), F.stddev_pop(F.when(both, x)), F.stddev_pop(F.when(both, y))]
    if window is not None:
        parts = [p.over(window) for p in parts]
    return F.try_divide(parts[0], parts[1] * parts[2])


def pair_count(x: Column, y: Column) -> Column:
    return F.count(F.when(x.isNotNull() & y.isNotNull(), F.lit(1)))
