"""The quality audit over all keys: four checks and their counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregate import to_long
from tidemark.operators.canonical import merge_sources
from tidemark.operators.qc import (
    check_consistency,
    check_external,
    check_ranges,
    check_recompute,
)
from tidemark.spec import MIN_DAYS_PER_YEAR, RANGE_BANDS


def audit(
    daily: DataFrame,
    annual: DataFrame,
    trend_rows: DataFrame,
    bounds: DataFrame,
    bands: Mapping[str, tuple[float, float]] = RANGE_BANDS,
    min_rows: int = MIN_DAYS_PER_YEAR,
    part_daily: DataFrame | None = None,
    part_annual: DataFrame | None = None,
) -> DataFrame:
    """All findings. ``daily`` and ``annual`` are wide, with one row per key and date or year.

    The recompute check reads the days, so it runs for the keys with bounds alone. Given ``part_daily`` and
    ``part_annual`` (with a column ``part``), it runs for every part of these keys as well, named ``key/part``.
    """
    sample = daily.join(bounds.select("key"), "key", "left_semi")
    of_parts = []
    if part_daily is not None and part_annual is not None:
        one = F.concat_ws("/", "key", "part")
        days = part_daily.join(bounds.select("key"), "key", "left_semi")
        of_parts = [check_recompute(days.withColumn("key", one).drop("part"), part_annual.withColumn("key", one).drop("part"), min_rows=min_rows)]
    return merge_sources(
        [
            *of_parts,
            check_ranges(to_long(annual, ["key", "year"]), bands=bands),
            check_recompute(sample, annual, min_rows=min_rows),
            check_consistency(trend_rows),
            check_external(trend_rows, bounds, annual),
        ]
    )
