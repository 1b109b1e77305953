"""Scaling values by the extent of their group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sparkline(
    series: DataFrame,
    keys: Sequence[str],
    order: str = "year",
    value: str = "value",
    width: float = 120.0,
    base: float = 32.0,
    height: float = 28.0,
) -> DataFrame:
    """Plot coordinates of each value of a short series.

    A missing value takes a place on the x axis but has no point. Series with fewer
    than two values have no points at all.
    """
    whole = Window.partitionBy(*keys)
    v = F.col(value)
    placed = series.select(
        *keys,
        order,
        value,
        (F.row_number().over(whole.orderBy(order)) - 1).alias("_i"),
        F.count(F.lit(1)).over(whole).alias("_n"),
        F.count(v).over(whole).alias("_known"),
        F.min(v).over(whole).alias("_low"),
        F.max(v).over(whole).alias("_high"),
    )
    extent = F.col("_high") - F.col("_low")
    span = F.when(extent == 0, F.lit(1.0)).otherwise(extent)
    return placed.where((F.col("_known") >= 2) & v.isNotNull()).select(
        *keys,
        order,
        value,
        (F.col("_i") / (F.col("_n") - 1) * width).alias("x"),
        (F.lit(base) - (v - F.col("_low")) / span * height).alias("y"),
    )


def shares(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Add each row's share of the group total and of the group maximum, in percent.

    Totals are aggregated with map-side combining and joined back, so that a group
    of any size, or the whole table, never meets in one task.
    """
    totals = df.groupBy(*by).agg(F.sum(value).alias("_sum"), F.max(value).alias("_max"))
    return with_group(df, totals, by).withColumns(
        {
            "pct_of_total": F.try_divide(F.col(value) * 100.0, F.col("_sum")),
            "pct_of_max": F.try_divide(F.col(value) * 100.0, F.col("_max")),
        }
    ).drop("_sum", "_max")


def fit_box(
    vertices: DataFrame,
    keys: Sequence[str],
    x: str = "lon",
    y: str = "lat",
    box: tuple[float, float] = (100.0, 46.0),
    drawn: tuple[float, float] = (88.0, 34.0),
) -> DataFrame:
    """Place the vertices of each outline in a box: centred, aspect kept, north up."""
    extent = vertices.groupBy(*keys).agg(
        F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1")
    )
    tiny = F.lit(1e-6)
    wide = F.greatest(F.col("_x1") - F.col("_x0"), tiny)
    tall = F.greatest(F.col("_y1") - F.col("_y0"), tiny)
    scale = F.least(F.lit(drawn[0]) / wide, F.lit(drawn[1]) / tall)
    extent = extent.withColumns(
        {
            "_scale": scale,
            "_left": (F.lit(box[0]) - wide * scale) / 2,
            "_top": (F.lit(box[1]) - tall * scale) / 2,
        }
    )
    placed = with_group(vertices, extent, keys)
    return placed.withColumns(
        {
            "px": F.col("_left") + (F.col(x) - F.col("_x0")) * F.col("_scale"),
            "py": F.col("_top") + (F.col("_y1") - F.col(y)) * F.col("_scale"),
        }
    ).drop("_x0", "_x1", "_y0", "_y1", "_scale", "_left", "_top")


def with_group(df: DataFrame, per_group: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach one-row-per-group columns to the rows of each group, NULL keys included.

    The group side is an aggregate; Spark broadcasts it when its measured size allows,
    and splits a skewed group otherwise.
    """
    if not by:  # a single row, read as scalar subqueries
        return df.withColumns({c: per_group.select(c).scalar() for c in per_group.columns})
    renamed = per_group.withColumnsRenamed({k: f"_g_{k}" for k in by})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in by])
    return df.join(renamed, same).drop(*[f"_g_{k}" for k in by])
