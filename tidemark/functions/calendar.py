"""Years, seasons and months of a date column."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SEASON_NAMES = ("DJF", "MAM", "JJA", "SON")


def season_year(date: Column) -> Column:
    """December counts to the winter of the following year."""
    return F.year(F.add_months(date, 1))


def season(date: Column) -> Column:
    """Shifted by one month, meteorological seasons are calendar quarters."""
    names = F.array(*[F.lit(n) for n in SEASON_NAMES])
    return F.element_at(names, F.quarter(F.add_months(date, 1)))


def water_year(date: Column) -> Column:
    """October to December count to the following year."""
    return F.year(F.add_months(date, 3))


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def month_index(date: Column) -> Column:
    """Months since year 0: an even x axis for monthly trends."""
    return F.year(date) * 12 + F.month(date) - 1


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def in_dates(column: Column, start: str, end: str) -> Column:
    """Half-open range ``[start, end)``.

    Written on the bare column, so that it reaches the Parquet scan and prunes
    row groups; a condition on ``year(column)`` would not.
    """
    day = datetime.date.fromisoformat
    return (column >= F.lit(day(start))) & (column < F.lit(day(end)))


def in_years(year: Column, first: int, last: int) -> Column:
    """Inclusive at both ends."""
    return year.between(first, last)
