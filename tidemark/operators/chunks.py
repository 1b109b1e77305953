"""Splitting date ranges into whole-year chunks, and merging overlapping fetches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def year_chunks(start: Column, end: Column, years: int = 5) -> Column:
    """Array of half-open ``(chunk_start, chunk_end)`` dates covering whole years."""
    first, last = F.year(start), F.year(end)
    return F.transform(
        F.sequence(first, last, F.lit(years)),
        lambda y: F.struct(
            F.make_date(y, F.lit(1), F.lit(1)).alias("chunk_start"),
            F.make_date(F.least(y + years - 1, last) + 1, F.lit(1), F.lit(1)).alias("chunk_end"),
        ),
    )


def explode_chunks(
    ranges: DataFrame, keep: Sequence[str], start: str = "start", end: str = "end", years: int = 5
) -> DataFrame:
    """A row per chunk of each range; a range that ends before it starts has none."""
    valid = ranges.where(F.year(start) <= F.year(end))
    return valid.select(*keep, F.inline(year_chunks(F.col(start), F.col(end), years)))


def first_fetch_wins(
    fetched: DataFrame, keys: Sequence[str], order: Sequence[str], date: str = "date"
) -> DataFrame:
    """One row per series and date: the earliest fetch in ``order``.

    An aggregate, not a window: copies of a row are merged before the shuffle, so a
    date with very many copies costs no sort and fills no task.
    """
    others = [c for c in fetched.columns if c not in {*keys, date}]
    rank = F.struct(*order)
    kept = F.min_by(F.struct(*others), rank)
    return fetched.groupBy(*keys, date).agg(kept.alias("_kept")).select(*keys, date, "_kept.*")
