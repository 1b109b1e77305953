"""Boundaries of all keys with their headline slopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.boundary import headline_slopes, is_real, with_fallback, with_slopes
from tidemark.session import materialise
from tidemark.sources.documents import feature_polygons

PROPERTIES = (
    "key", "unit_name", "state", "area_km2", "approximate",
    "tmean_slope", "tmean_sig", "prcp_slope", "prcp_sig",
)


def boundaries_with_slopes(registry: DataFrame, files: DataFrame, trend_rows: DataFrame) -> DataFrame:
    """A row per key: real outline or circle, and slopes.

    ``files`` is what ``read_boundaries`` returns; the first feature stands for its file.
    """
    real = files.where(is_real(F.col("features")))
    first = feature_polygons(real).where(F.col("feature") == 0).select("key", "polygons")
    outlines = with_fallback(registry, first)
    marked = outlines.withColumn("approximate", F.col("boundary_source") == "circle")
    return with_slopes(marked, headline_slopes(trend_rows))


def numbered_parts(features: DataFrame, order: Sequence[str], key: str = "key", part: str = "part_index") -> DataFrame:
    """Features of a key as parts numbered from 0 in the order of some columns, alike in every run.

    Rows are sorted by range and stored; a number is a row's place in its task and key, plus the rows of the key in the
    tasks before. So a key of any number of features is spread over tasks and never in one row. Rows equal in
    ``order`` are told apart by their polygons.
    """
    by = [key, *order, F.xxhash64("polygons").alias("_same")]
    placed = features.withColumn("_same", by[-1]).repartitionByRange(key, *order, "_same").sortWithinPartitions(key, *order, "_same")
    row = F.monotonically_increasing_id()
    placed = materialise(placed.drop("_same").select("*", F.shiftright(row, 33).alias("_task"), row.alias("_row")), "placed-parts")
    counts = placed.groupBy(key, "_task").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(key, "_task", "_first", before.alias("_before"))  # a row for each key and task
    number = (F.col("_row") - F.col("_first") + F.col("_before")).cast("int").alias(part)
    return placed.join(starts, [key, "_task"]).select(*features.columns, number)
