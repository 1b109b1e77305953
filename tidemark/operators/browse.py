"""Queries behind an overview of all series: search, sort, lanes, display units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.labels import humanize, region_of, state_search_key
from tidemark.functions.values import celsius_change_to_fahrenheit, celsius_to_fahrenheit
from tidemark.operators.scaling import with_group
from tidemark.spec import HEADLINE, TEMPERATURES

METADATA = ("label", "unit", "slope_unit", "kind", "decimals", "description")


def variable_metadata(df: DataFrame, variable: str = "variable") -> DataFrame:
    """Add label, unit, slope unit, kind, decimals and description of a variable.

    The table is fixed and small, so it sits in the plan as one literal map.
    """
    entries = []
    for name, label, unit, slope_unit, kind, decimals, text in fixed.rows(fixed.VARIABLE_LABELS):
        cells = (label, unit, slope_unit, kind, int(decimals), text)
        entries += [F.lit(name), F.struct(*[F.lit(v).alias(n) for n, v in zip(METADATA, cells)])]
    known = F.try_element_at(F.create_map(*entries), F.col(variable))
    default: dict[str, Column] = {
        "label": humanize(F.col(variable)),
        "unit": F.lit(""),
        "slope_unit": F.lit("/ yr"),
        "kind": F.lit("other"),
        "decimals": F.lit(3),
        "description": F.lit(""),
    }
    return df.withColumns({n: F.coalesce(known.getField(n), default[n]) for n in METADATA})


def overview(registry: DataFrame, trend_rows: DataFrame, key: str = "key") -> DataFrame:
    """One row per key with what the browse queries filter and sort on.

    ``registry`` has ``key, unit_name, state``. Totals and slopes are in degrees
    Fahrenheit and stay NULL where there is no trend.
    """

    def of(variable: str, column: str) -> Column:
        return F.max(F.when(F.col("variable") == variable, F.col(column)))

    wanted = trend_rows.where(F.col("variable").isin("tmean_c", "prcp_mm"))
    slopes = wanted.groupBy(key).agg(
        celsius_change_to_fahrenheit(of("tmean_c", "total_change")).alias("total_f"),
        celsius_change_to_fahrenheit(of("tmean_c", "slope_per_year")).alias("slope_f"),
        of("prcp_mm", "slope_per_year").alias("prcp_slope"),
        of("tmean_c", "significant_95").alias("significant"),
    )
    state = F.coalesce(F.col("state"), F.lit(""))
    return (
        registry.join(slopes, key, "left")
        .withColumns(
            {
                "significant": F.coalesce("significant", F.lit(False)),
                "no_data": F.col("slope_f").isNull(),
                "state_key": state_search_key(state),
                "region": region_of(state),
            }
        )
    )


def browse(
    rows: DataFrame,
    text: str = "",
    region: str = "all",
    significant_only: bool = False,
    sort: str = "name",
) -> DataFrame:
    """Search, filter and sort an overview.

    ``sort`` is name, warming, cooling, wetter or drier; a missing number sorts as zero,
    and equal numbers sort by name.
    """
    needle = text.strip().lower()
    out = rows
    if needle:
        hit = F.contains(F.lower("unit_name"), F.lit(needle)) | F.contains("state_key", F.lit(needle))
        out = out.where(hit)
    if region != "all":
        out = out.where(F.col("region") == region)
    if significant_only:
        out = out.where("significant")
    total, rain = F.coalesce("total_f", F.lit(0.0)), F.coalesce("prcp_slope", F.lit(0.0))
    orders = {
        "name": [],
        "warming": [total.desc()],
        "cooling": [total.asc()],
        "wetter": [rain.desc()],
        "drier": [rain.asc()],
    }
    return out.orderBy(*orders[sort], F.lower("unit_name"))


def region_strip(rows: DataFrame) -> DataFrame:
    """Keys with a temperature total by region and total, with common axis bounds.

    The axis always includes 0 and 1 and ends at whole degrees. It is an aggregate of the
    same rows, so pass a stored overview rather than one still to be computed.
    """
    known = rows.where(F.col("total_f").isNotNull())
    axis = known.agg(
        F.greatest(F.lit(1), F.ceil(F.max("total_f"))).alias("axis_max"),
        F.least(F.lit(0), F.floor(F.min("total_f"))).alias("axis_min"),
    )
    return with_group(known, axis, []).orderBy("region", "total_f")


def headline_first(trend_rows: DataFrame, keys: Sequence[str], order: Sequence[str] = HEADLINE) -> DataFrame:
    """Trend rows of each key: headline variables in fixed order, then the rest by name."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("variable"))
    rank = F.when(place > 0, place).otherwise(F.lit(99)).cast("int")
    return trend_rows.withColumn("rank", rank).orderBy(*keys, "rank", "variable")


def headline_cards(trend_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The headline variables only, with their display metadata."""
    kept = trend_rows.where(F.col("variable").isin(*HEADLINE))
    return variable_metadata(headline_first(kept, keys))


def display_values(long: DataFrame, columns: Sequence[str] = ("value",)) -> DataFrame:
    """Temperature levels of a long table in degrees Fahrenheit."""
    hot = F.col("variable").isin(*TEMPERATURES)
    return long.withColumns(
        {c: F.when(hot, celsius_to_fahrenheit(F.col(c))).otherwise(F.col(c)) for c in columns}
    )


def display_trends(trend_rows: DataFrame) -> DataFrame:
    """Temperature trends in Fahrenheit: the slope as a difference, the intercept as a level."""
    hot = F.col("variable").isin(*TEMPERATURES)
    slope, level = F.col("slope_per_year"), F.col("intercept")
    return trend_rows.withColumns(
        {
            "slope_per_year": F.when(hot, celsius_change_to_fahrenheit(slope)).otherwise(slope),
            "intercept": F.when(hot, celsius_to_fahrenheit(level)).otherwise(level),
        }
    )


def display_decomposition(docs: DataFrame) -> DataFrame:
    """Temperature decompositions in Fahrenheit, inside their arrays."""
    hot = F.col("variable").isin(*TEMPERATURES)

    def levels(name: str) -> Column:
        return F.when(hot, F.transform(name, celsius_to_fahrenheit)).otherwise(F.col(name))

    def cell(c: Column) -> Column:
        shown = [celsius_to_fahrenheit(c.getField(f)).alias(f) for f in ("mean", "p10", "p90")]
        return F.struct(c.getField("month").alias("month"), *shown)

    climatology = F.transform(
        "climatology",
        lambda p: F.struct(p.period.alias("period"), F.transform(p.getField("values"), cell).alias("values")),
    )
    return docs.withColumns(
        {
            "observed": levels("observed"),
            "trend": levels("trend"),
            "climatology": F.when(hot, climatology).otherwise(F.col("climatology")),
        }
    )


def by_value(df: DataFrame, value: str = "value") -> DataFrame:
    """Line items, largest first."""
    return df.orderBy(F.col(value).desc_nulls_last())
