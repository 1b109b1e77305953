"""Boundary layers: matching names, fallbacks and map properties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geometry import circle_polygon
from tidemark.functions.values import acres_to_km2


def federal_features(
    layer: DataFrame, manager: str = "Mang_Name", manager_type: str = "Mang_Type"
) -> DataFrame:
    """Features run by the park service, or by any federal body."""
    return layer.where((F.col(manager) == "NPS") | (F.col(manager_type) == "FED"))


def match_aliases(layer: DataFrame, names: DataFrame, layer_name: str = "Unit_Nm") -> DataFrame:
    """Features joined to keys through all names a key goes by.

    ``names`` has ``(key, alias)``, one row per name, and is small enough for Spark to
    broadcast by its size.
    """
    return layer.join(names, F.col(layer_name) == F.col("alias")).drop("alias")


def unmatched(keys: DataFrame, matched: DataFrame, key: str = "key") -> DataFrame:
    """Keys without any feature."""
    return keys.join(matched.select(key), key, "left_anti")


def merge_units(
    matched: DataFrame, key: str = "key", acres: str = "GIS_Acres", order: Sequence[str] = ()
) -> DataFrame:
    """All polygons of a key in one row, with the summed area.

    They stand in the order of the columns ``order``, and of their vertices where these are equal,
    so that parts numbered from them are the same in every run, however rows arrive.

    A collection of the polygons, without dissolving common borders, for documents that
    hold one geometry per key. Zonal means do not need it: ``assign_cells`` takes any
    number of rows with the same zone id.
    """
    return matched.groupBy(key).agg(
        F.flatten(F.sort_array(F.collect_list(F.struct(*order, "polygons")))["polygons"]).alias("polygons"),
        acres_to_km2(F.sum(acres)).alias("area_km2"),
    )


def is_real(features: Column) -> Column:
    """A boundary is real if it has features and none is flagged ``approximate``."""
    flagged = F.exists(features, lambda f: F.coalesce(f.properties.approximate, F.lit(False)))
    return F.coalesce((F.size(features) > 0) & ~flagged, F.lit(False))


def count_sources(boundaries: DataFrame) -> DataFrame:
    """How many keys have a real outline and how many a circle."""
    real = F.col("real")
    return boundaries.agg(
        F.count_if(real).alias("real_polygons"), F.count_if(~real).alias("circle_approximations")
    )


def with_fallback(
    registry: DataFrame, primary: DataFrame, secondary: DataFrame | None = None, key: str = "key"
) -> DataFrame:
    """The outline of each key: primary, else secondary, else a circle, else none.

    ``registry`` has ``lat, lon, area_km2``; the others ``(key, polygons)``. Keys with
    neither an outline nor a position are left out.
    """
    out = registry.join(primary.select(key, F.col("polygons").alias("_first")), key, "left")
    second: Column = F.lit(None)
    if secondary is not None:
        out = out.join(secondary.select(key, F.col("polygons").alias("_second")), key, "left")
        second = F.col("_second")
    circle = F.array(circle_polygon(F.col("lat"), F.col("lon"), F.col("area_km2")))
    source = (
        F.when(F.col("_first").isNotNull(), "primary")
        .when(second.isNotNull(), "secondary")
        .when(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("area_km2").isNotNull(), "circle")
    )
    placed = out.withColumn("boundary_source", source).where(F.col("boundary_source").isNotNull())
    outlines = [F.col("_first"), second, circle] if secondary is not None else [F.col("_first"), circle]
    return placed.withColumn("polygons", F.coalesce(*outlines)).drop("_first", "_second")


def headline_slopes(trend_rows: DataFrame, key: str = "key") -> DataFrame:
    """Temperature and precipitation slopes with their significance, one row per key."""

    def of(variable: str, column: str) -> Column:
        return F.max(F.when(F.col("variable") == variable, F.col(column)))

    return trend_rows.groupBy(key).agg(
        of("tmean_c", "slope_per_year").alias("tmean_slope"),
        of("tmean_c", "significant_95").alias("tmean_sig"),
        of("prcp_mm", "slope_per_year").alias("prcp_slope"),
        of("prcp_mm", "significant_95").alias("prcp_sig"),
    )


def with_slopes(boundaries: DataFrame, slopes: DataFrame, key: str = "key") -> DataFrame:
    """Slopes merged into boundary properties; keys without a trend keep NULLs."""
    return boundaries.join(slopes, key, "left")


def schema_gaps(needed: DataFrame, declared: DataFrame, on: Sequence[str]) -> DataFrame:
    """What is needed but not declared: empty when the contract holds."""
    return needed.join(declared, list(on), "left_anti")
