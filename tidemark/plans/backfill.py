"""Months kept up to date as days arrive.

A store holds days and monthly sums and counts, both in a folder per month. Appending days touches only the
months they lie in: their days are read, merged and written again, and so are their sums. Years,
seasons and months follow from the sums, so nothing else of the days is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregate import month_partials
from tidemark.operators.chunks import first_fetch_wins
from tidemark.session import materialise

#: months the days of one call may lie in: their names come to the driver
MAX_MONTHS = 100_000


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None  # nothing yet


def _replace(df: DataFrame, path: str) -> None:
    """Write the months of ``df`` in place of what the store has of them."""
    placed = df.hint("rebalance", "_month")
    placed.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("_month").parquet(path)


def append_days(days: DataFrame, store: str, keys: Sequence[str], how: Mapping[str, str] | None = None) -> list[str]:
    """Add canonical daily rows to a store; the months that were touched, as ``yyyy-mm``.

    Of a date that is there already the stored row stays, of one that comes twice the least. Calls on one store
    follow each other; a call that fails before it ends is repeated with the same days.
    """
    spark = days.sparkSession
    new = materialise(days.withColumn("_month", F.date_format("date", "yyyy-MM")), "new-days")
    touched = sorted(r["_month"] for r in new.select("_month").distinct().limit(MAX_MONTHS + 1).collect())
    if len(touched) > MAX_MONTHS:
        raise ValueError(f"days of more than {MAX_MONTHS} months at once")
    if not touched:
        return []
    rows = new.withColumn("_fetch", F.lit(1))
    old = _stored(spark, f"{store}/days")
    if old is not None:
        # a filter on the folder's name: files of other months are not read
        before = old.where(F.col("_month").cast("string").isin(touched)).withColumn("_month", F.col("_month").cast("string"))
        rows = rows.unionByName(before.withColumn("_fetch", F.lit(0)))
    values = [c for c in days.columns if c not in {*keys, "date"}]
    ranked = rows.withColumn("_same", F.struct(*values))
    merged = materialise(first_fetch_wins(ranked, [*keys, "_month"], ["_fetch", "_same"]).drop("_fetch", "_same"), "merged-days")
    _replace(merged, f"{store}/days")
    sums = month_partials(merged.drop("_month"), keys, how)
    _replace(sums.withColumn("_month", F.date_format("month", "yyyy-MM")), f"{store}/months")
    return touched


def stored_months(spark: SparkSession, store: str) -> DataFrame:
    """The monthly sums and counts of a store, as ``month_partials`` gives them."""
    return spark.read.parquet(f"{store}/months").drop("_month")


def stored_days(spark: SparkSession, store: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The days of a store, of a half-open range of dates if one is given; months outside are not read."""
    df = spark.read.parquet(f"{store}/days")
    name = F.col("_month").cast("string")
    if start is not None:
        df = df.where((name >= start[:7]) & (F.col("date") >= F.lit(start).cast("date")))
    if end is not None:
        df = df.where((name <= end[:7]) & (F.col("date") < F.lit(end).cast("date")))
    return df.drop("_month")
