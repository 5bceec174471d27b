"""Calendar helpers: generated date and month series, year ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def year_bounds(year: int) -> tuple[dt.date, dt.date]:
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def in_year(date_col: Column, year: int) -> Column:
    """Range predicate (prunes date partitions, unlike year(d) = Y)."""
    lo, hi = year_bounds(year)
    return (date_col >= F.lit(lo)) & (date_col < F.lit(hi))


def day_series(start: Column, stop: Column) -> Column:
    """Array of days start..stop; empty when start > stop or either is NULL."""
    return F.when(start <= stop, F.sequence(start, stop, F.expr("INTERVAL 1 DAY"))) \
        .otherwise(F.array().cast("array<date>"))


def explode_days(bounds: DataFrame, start: str, stop: str, out: str) -> DataFrame:
    """One row per day between two date columns of a (one-row) bounds frame."""
    return bounds.select(F.explode(day_series(F.col(start), F.col(stop))).alias(out))
