"""Calendar aggregation of wide daily series.

Frames stay wide (one column per variable) until they have shrunk to years or
months; only then do they turn long. Unpivoting the days would multiply the
rows of the largest table by the number of variables.

``annual``, ``seasonal`` and ``monthly`` each read the daily rows. A job that
needs several of them calls :func:`month_partials` once and derives all three
from it: sums and counts per month are at most twelve rows per series and year.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import month_start, season, season_year, water_year
from tidemark.spec import (
    AVAIL,
    DEFAULT_SPEC,
    MIN_DAYS_PER_SUMMED_MONTH,
    MIN_DAYS_PER_YEAR,
    SeriesSpec,
)

How = Mapping[str, str]


def reductions(df: DataFrame, how: How | None = None, spec: SeriesSpec = DEFAULT_SPEC) -> dict[str, str]:
    """Variables of this frame and how each is reduced; other columns are left out."""
    how = spec.how if how is None else how
    return {name: kind for name, kind in how.items() if name in df.columns}


def _reduce(name: str, kind: str) -> Column:
    # An empty sum is zero, an empty mean is missing.
    return (F.coalesce(F.sum(name), F.lit(0.0)) if kind == "sum" else F.avg(name)).alias(name)


def _mask(df: DataFrame) -> list[Column]:
    return [F.bit_or(AVAIL).alias(AVAIL)] if AVAIL in df.columns else []


def _group(df: DataFrame, by: list, how: How, min_rows: int, completeness: str) -> DataFrame:
    aggs = [_reduce(v, kind) for v, kind in how.items()] + _mask(df)
    if completeness == "rows":
        grouped = df.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n_days"))
        return grouped.where(F.col("n_days") >= min_rows) if min_rows else grouped
    if completeness != "non_null":
        raise ValueError(f"completeness must be 'rows' or 'non_null', not {completeness!r}")
    counts = [F.count(v).alias(f"{v}__n") for v in how]
    grouped = df.groupBy(*by).agg(*aggs, *counts, F.count(F.lit(1)).alias("n_days"))
    enough = {v: F.when(F.col(f"{v}__n") >= min_rows, F.col(v)) for v in how}
    return grouped.withColumns(enough).drop(*[f"{v}__n" for v in how])


def annual(
    daily: DataFrame,
    keys: Sequence[str],
    how: How | None = None,
    min_rows: int = MIN_DAYS_PER_YEAR,
    completeness: str = "rows",
    date: str = "date",
) -> DataFrame:
    """Sum or mean per calendar year.

    ``completeness="rows"`` drops years with fewer than ``min_rows`` dates, whatever
    they hold; ``"non_null"`` blanks each variable with fewer observations.
    """
    how = reductions(daily, how)
    return _group(daily, [*keys, F.year(date).alias("year")], how, min_rows, completeness)


def seasonal(
    daily: DataFrame, keys: Sequence[str], how: How | None = None, min_rows: int = 0, date: str = "date"
) -> DataFrame:
    """Sum or mean per season; December belongs to the next year's winter."""
    d = F.col(date)
    by = [*keys, season_year(d).alias("year"), season(d).alias("season")]
    return _group(daily, by, reductions(daily, how), min_rows, "rows")


def water_years(
    daily: DataFrame, keys: Sequence[str], how: How | None = None, min_rows: int = 0, date: str = "date"
) -> DataFrame:
    by = [*keys, water_year(F.col(date)).alias("water_year")]
    return _group(daily, by, reductions(daily, how), min_rows, "rows")


def month_partials(
    daily: DataFrame, keys: Sequence[str], how: How | None = None, date: str = "date"
) -> DataFrame:
    """Sum and count of each variable per series and month: the one pass over the days."""
    how = reductions(daily, how)
    aggs = [F.sum(v).alias(f"{v}__sum") for v in how] + [F.count(v).alias(f"{v}__n") for v in how]
    return daily.groupBy(*keys, month_start(F.col(date)).alias("month")).agg(
        *aggs, *_mask(daily), F.count(F.lit(1)).alias("n_days")
    )


def _partial_names(partials: DataFrame, how: How | None) -> dict[str, str]:
    how = DEFAULT_SPEC.how if how is None else how
    return {v: kind for v, kind in how.items() if f"{v}__sum" in partials.columns}


def _roll_up(partials: DataFrame, by: list, how: How | None) -> DataFrame:
    def merged(v: str, kind: str) -> Column:
        total = F.sum(f"{v}__sum")
        if kind == "sum":
            return F.coalesce(total, F.lit(0.0)).alias(v)
        return F.try_divide(total, F.sum(f"{v}__n")).alias(v)

    aggs = [merged(v, kind) for v, kind in _partial_names(partials, how).items()]
    return partials.groupBy(*by).agg(*aggs, *_mask(partials), F.sum("n_days").alias("n_days"))


def annual_from_partials(
    partials: DataFrame, keys: Sequence[str], how: How | None = None, min_rows: int = MIN_DAYS_PER_YEAR
) -> DataFrame:
    out = _roll_up(partials, [*keys, F.year("month").alias("year")], how)
    return out.where(F.col("n_days") >= min_rows)


def seasonal_from_partials(
    partials: DataFrame, keys: Sequence[str], how: How | None = None, min_rows: int = 0
) -> DataFrame:
    m = F.col("month")
    out = _roll_up(partials, [*keys, season_year(m).alias("year"), season(m).alias("season")], how)
    return out.where(F.col("n_days") >= min_rows) if min_rows else out


def monthly_from_partials(
    partials: DataFrame,
    keys: Sequence[str],
    how: How | None = None,
    min_days: int = MIN_DAYS_PER_SUMMED_MONTH,
) -> DataFrame:
    """Long monthly series ``(*keys, variable, month, value, n_obs)``.

    A monthly sum needs ``min_days`` observed days; a monthly mean needs one.
    """
    how = _partial_names(partials, how)
    entries = []
    for v, kind in how.items():
        total, n = F.col(f"{v}__sum"), F.col(f"{v}__n")
        value = F.when(n >= min_days, total) if kind == "sum" else F.try_divide(total, n)
        entry = F.struct(F.lit(v).alias("variable"), value.alias("value"), n.alias("n_obs"))
        if AVAIL in partials.columns:
            entry = F.when(_available(v), entry)
        entries.append(entry)
    exploded = partials.select(*keys, "month", F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return exploded.select(*keys, "e.variable", "month", "e.value", "e.n_obs")


def monthly(
    daily: DataFrame,
    keys: Sequence[str],
    how: How | None = None,
    min_days: int = MIN_DAYS_PER_SUMMED_MONTH,
    date: str = "date",
) -> DataFrame:
    how = reductions(daily, how)
    return monthly_from_partials(month_partials(daily, keys, how, date), keys, how, min_days)


def _available(name: str, spec: SeriesSpec = DEFAULT_SPEC) -> Column:
    return F.col(AVAIL).bitwiseAND(F.lit(spec.variable_bit(name)).cast("long")) != 0


def spread_availability(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give every row of a series the variables any of its rows has.

    Parts of one key can differ in their variables, and not all parts cover all
    dates. Meant for aggregated frames: a window over the years or months of a key.
    """
    if AVAIL not in df.columns:
        return df
    return df.withColumn(AVAIL, F.bit_or(AVAIL).over(Window.partitionBy(*keys)))


def only_available(wide: DataFrame, variables: Sequence[str]) -> DataFrame:
    """The wide rows with NULL for variables a series lacks, whose empty sums would read as zero."""
    if AVAIL not in wide.columns:
        return wide
    return wide.withColumns({v: F.when(_available(v), F.col(v)) for v in variables})


def to_long(
    wide: DataFrame, ids: Sequence[str], variables: Sequence[str] | None = None
) -> DataFrame:
    """``(*ids, variable, value)`` with a row per *available* variable, missing or not."""
    names = list(variables) if variables is not None else [v for v in DEFAULT_SPEC.names if v in wide.columns]
    if AVAIL not in wide.columns:
        return wide.unpivot(list(ids), names, "variable", "value")
    entries = [
        F.when(_available(v), F.struct(F.lit(v).alias("variable"), F.col(v).alias("value"))) for v in names
    ]
    return wide.select(*ids, F.inline(F.array_compact(F.array(*entries))))


def period_of_record(annual_rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First and last year per key, or over all keys."""
    return annual_rows.groupBy(*keys).agg(F.min("year").alias("start_year"), F.max("year").alias("end_year"))
