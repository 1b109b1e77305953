"""Dimension tables. All are fixed and have at most a few hundred rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.spec import DEFAULT_SPEC, ERA5_ONLY, SeriesSpec


def small_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A local relation: its size is known to the optimiser, which broadcasts it unasked."""
    return spark.createDataFrame(pa.table(columns))


def registry(spark: SparkSession) -> DataFrame:
    """``key, unit_name, state, multipart, lat, lon, area_km2`` of all keys."""
    rows = fixed.rows(fixed.REGISTRY)
    several = {r[0] for r in fixed.rows(fixed.MULTIPART)}
    return small_table(
        spark,
        {
            "key": [r[0] for r in rows],
            "unit_name": [r[1] for r in rows],
            "state": [r[2] for r in rows],
            "multipart": [r[0] in several for r in rows],
            "lat": [float(r[3]) for r in rows],
            "lon": [float(r[4]) for r in rows],
            "area_km2": [float(r[5]) for r in rows],
        },
    )


def units(spark: SparkSession) -> DataFrame:
    """``key, labels`` of keys with disjoint units."""
    rows = fixed.rows(fixed.MULTIPART)
    return small_table(
        spark, {"key": [r[0] for r in rows], "labels": [[u.strip() for u in r[1].split(";")] for r in rows]}
    )


def aliases(spark: SparkSession) -> DataFrame:
    """``key, alias``: every name under which a boundary layer may list a key."""
    other = {n: [a.strip() for a in names.split(";")] for n, names in fixed.rows(fixed.ALIASES)}
    pairs = [(r[0], a) for r in fixed.rows(fixed.REGISTRY) for a in other.get(r[1], [r[1]])]
    return small_table(spark, {"key": [p[0] for p in pairs], "alias": [p[1] for p in pairs]})


def datasets(spark: SparkSession) -> DataFrame:
    """``dataset, asset_id, scale, coverage, start, bands``."""
    rows = fixed.rows(fixed.DATASETS)
    return small_table(
        spark,
        {
            "dataset": [r[0] for r in rows],
            "asset_id": [r[1] for r in rows],
            "scale": [int(r[2]) for r in rows],
            "coverage": [r[3] for r in rows],
            "start": [r[4] for r in rows],
            "bands": [r[5].split() for r in rows],
        },
    ).withColumn("start", F.to_date("start"))


def declared_columns(spark: SparkSession) -> DataFrame:
    """``dataset, source``: the raw column of every declared band."""
    return datasets(spark).select("dataset", F.explode("bands").alias("band")).select(
        "dataset", F.concat_ws("_", "dataset", "band").alias("source")
    )


def used_columns(spark: SparkSession, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """``source``: the raw columns a spec reads."""
    return small_table(spark, {"source": list(spec.source_columns)})


def warming_bounds(spark: SparkSession) -> DataFrame:
    """``key, lo, hi, source``: published warming over the record."""
    rows = fixed.rows(fixed.WARMING_BOUNDS)
    return small_table(
        spark,
        {
            "key": [r[0] for r in rows],
            "lo": [float(r[1]) for r in rows],
            "hi": [float(r[2]) for r in rows],
            "source": [r[3] for r in rows],
        },
    )


def choose_datasets(
    keys: DataFrame, key: str = "key", single: Sequence[str] = ERA5_ONLY
) -> DataFrame:
    """Every key with the data sources it uses: all, or ERA5 alone for ``single`` keys.

    The sources are a handful, exploded per key from one literal array, not a product
    of two tables.
    """
    spark = keys.sparkSession
    names = [r[0] for r in fixed.rows(fixed.DATASETS)]
    exploded = keys.withColumn("dataset", F.explode(F.array(*[F.lit(n) for n in names])))
    barred = small_table(spark, {key: list(single), "dataset": ["DAYMET"] * len(single)})
    return exploded.join(barred, [key, "dataset"], "left_anti").join(
        datasets(spark).select("dataset", "scale"), "dataset"
    )


def finest_scale(choice: DataFrame, key: str = "key") -> DataFrame:
    return choice.groupBy(key).agg(F.min("scale").alias("scale"))


def only_keys(df: DataFrame, wanted: Sequence[str] | None, key: str = "key") -> DataFrame:
    """Subset by a list of keys; an empty or missing list means all."""
    return df.where(F.col(key).isin(list(wanted))) if wanted else df


def uniqueness(df: DataFrame, column: Column | str) -> DataFrame:
    """Rows and distinct values of a column that should be unique."""
    return df.agg(F.count(column).alias("n"), F.count_distinct(column).alias("n_distinct"))
