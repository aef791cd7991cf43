"""Versioned fits: trained models and coefficient tables, written once and loaded to score.

A store is a folder that all executors share. A version is a folder below it with Spark
ML models and tables. Its row in the list of commits is written last, so a run that
breaks off leaves nothing that a reader sees, and readers of an older version are not
disturbed. Coefficient tables are partitioned by the key they are looked up with:
scoring one portfolio reads that portfolio's files only.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

COMMITS = "version string, committed_at timestamp, kind string, item string"
VALUES = "name string, value double"


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def draft(self) -> Draft:
        return Draft(self, uuid.uuid4().hex)

    def commits(self) -> DataFrame:
        """One row per item of every committed version; empty for a new store."""
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMITS)

    def versions(self) -> DataFrame:
        """Committed versions with the names of their items, newest first."""
        return self.commits().groupBy("version").agg(
            F.max("committed_at").alias("committed_at"), F.sort_array(F.collect_set("item")).alias("items")).orderBy(
            F.desc("committed_at"), F.desc("version"))

    def latest(self) -> Version | None:
        row = self.versions().select("version").first()
        return Version(self, row["version"]) if row else None

    def version(self, name: str) -> Version:
        if self.commits().filter(F.col("version") == name).isEmpty():
            raise LookupError(f"no committed version {name} in {self.root}")
        return Version(self, name)

    def status(self, expected: list[str]) -> DataFrame:
        """Which of the expected items the newest version holds."""
        last = self.latest()
        held = last.items if last else set()
        rows = [(n, n in held, last.name if last else None) for n in expected]
        return self.spark.createDataFrame(rows, "item string, present boolean, version string")


class Draft:
    """A version that is being written."""

    def __init__(self, store: Store, name: str):
        self.store, self.name, self._items = store, name, []

    def _path(self, kind: str, item: str) -> str:
        if item in [i for _, i in self._items]:
            raise ValueError(f"{item} was saved twice")
        self._items.append((kind, item))
        return f"{self.store.root}/versions/{self.name}/{kind}/{item}"

    def model(self, item: str, model) -> None:
        """A Spark ML model, through its own writer."""
        model.write().save(self._path("model", item))

    def table(self, item: str, df: DataFrame, by: str | None = None) -> None:
        """A table, partitioned by the column it is looked up with. Rows are brought
        together by that column first, so each value gets one file."""
        w = df.repartition(by).write.partitionBy(by) if by else df.coalesce(1).write
        w.parquet(self._path("table", item))

    def values(self, item: str, **values: float | None) -> None:
        """A handful of named numbers, such as thresholds."""
        rows = [(k, None if v is None else float(v)) for k, v in values.items()]
        self.table(item, self.store.spark.createDataFrame(rows, VALUES))

    def commit(self) -> Version:
        rows = [(self.name, kind, item) for kind, item in self._items]
        if not rows:
            raise ValueError("nothing was saved")
        df = self.store.spark.createDataFrame(rows, "version string, kind string, item string")
        df.select("version", F.current_timestamp().alias("committed_at"), "kind", "item").coalesce(1).write.mode(
            "append").parquet(f"{self.store.root}/commits")
        return Version(self.store, self.name)


class Version:
    """A committed version; nothing in it changes any more."""

    def __init__(self, store: Store, name: str):
        self.store, self.name = store, name
        rows = store.commits().filter(F.col("version") == name).select("kind", "item").collect()
        self._kinds = {r["item"]: r["kind"] for r in rows}

    @property
    def items(self) -> set[str]:
        return set(self._kinds)

    def _path(self, kind: str, item: str) -> str:
        if self._kinds.get(item) != kind:
            raise LookupError(f"version {self.name} holds no {kind} {item}")
        return f"{self.store.root}/versions/{self.name}/{kind}/{item}"

    def model(self, item: str, loader):
        """``loader`` is the model's class."""
        return loader.load(self._path("model", item))

    def table(self, item: str, **equal) -> DataFrame:
        """``equal`` keeps the rows with these values (None: all); on the partition
        column it prunes files."""
        df = self.store.spark.read.parquet(self._path("table", item))
        for name, value in equal.items():
            df = df if value is None else df.filter(F.col(name) == value)
        return df

    def values(self, item: str) -> dict[str, float | None]:
        return {r["name"]: r["value"] for r in self.table(item).collect()}
