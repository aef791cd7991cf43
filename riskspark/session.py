"""Session settings shared by the benchmark and the tests."""

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, name: str = "riskspark") -> SparkSession:
    """A local session. On a cluster the caller brings its own session: the
    library reads settings from it and never overrides them."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
