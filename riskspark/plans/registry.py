"""Registry of queries and the SQL each is checked against.

A check's SQL may name shared CTEs (``c_...``); :func:`full_sql` adds them.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.plans import inputs
from riskspark.plans.shared_sql import CTES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

_NAME = re.compile(r"\bc_[a-z0-9_]+\b")


def _needs(sql: str) -> list[str]:
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in CTES and name not in order:
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def full_sql(sql: str) -> str:
    parts = [f"{n} AS ({CTES[n].strip()})" for n in _needs(sql)]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def call(spark, sf_dir):
            inputs.new_call()
            return fn(spark, sf_dir)

        QUERIES[name] = call
        if sql is not None:
            CHECKS[name] = full_sql(sql)
        return call
    return add
