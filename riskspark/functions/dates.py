"""Date expressions. Inputs are columns; nothing here triggers a job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def parse_day(c: Column) -> Column:
    """ISO day or NULL. The format is fixed so '2024' and '2024-01-XX' give NULL."""
    return F.try_to_date(c, "yyyy-MM-dd")


def roll_weekend(day: Column) -> Column:
    """Saturday and Sunday move to the next Monday."""
    dow = F.weekday(day)
    return F.date_add(day, F.when(dow == 5, 2).when(dow == 6, 1).otherwise(0))


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def snapshot_day(ts: Column) -> Column:
    """yyyyMMddHHmmss -> day."""
    return F.try_to_date(F.left(ts, F.lit(8)), "yyyyMMdd")


def heuristic_day(attr: Column, text: Column) -> Column:
    """The date attribute if it parses, else the first 'Mon D, 20YY' in the text."""
    found = F.regexp_extract(text, r"([A-Z][a-z]{2} \d{1,2}, 20\d{2})", 1)
    return F.coalesce(parse_day(F.left(attr, F.lit(10))), F.try_to_date(found, "MMM d, yyyy"))


def study_window(start: str, end: str) -> tuple[dt.date, dt.date]:
    """Check start < end and return the half-open window [start, end + 1 day)."""
    s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if s >= e:
        raise ValueError(f"start {s} must be before end {e}")
    return s, e + dt.timedelta(days=1)
