"""Numeric expressions with the missing-value rules of a float column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def finite(c: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def finite_columns(df: DataFrame) -> DataFrame:
    """Apply :func:`finite` to doubles and to arrays of doubles."""
    changes = {}
    for name, kind in df.dtypes:
        if kind == "double":
            changes[name] = finite(F.col(name))
        elif kind == "array<double>":
            changes[name] = F.transform(name, finite)
    return df.withColumns(changes) if changes else df


def clip(c: Column, low: Column, high: Column) -> Column:
    """least/greatest skip NULLs, so a missing value is passed through by hand."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def flag(condition: Column) -> Column:
    """0/1; an unknown comparison counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)
