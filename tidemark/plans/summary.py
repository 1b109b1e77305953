"""Summaries of all keys in one job: annual, anomalies, seasons, trends, decomposition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregate import (
    annual_from_partials,
    month_partials,
    monthly_from_partials,
    only_available,
    period_of_record,
    seasonal_from_partials,
    spread_availability,
    to_long,
)
from tidemark.operators.anomaly import anomalies, stripes
from tidemark.operators.canonical import COMBINED, with_combined
from tidemark.operators.decompose import decompose
from tidemark.operators.trend import trends
from tidemark.session import materialise
from tidemark.spec import (
    AVAIL,
    DEFAULT_SPEC,
    HEADLINE,
    MIN_DAYS_PER_YEAR,
    MIN_TREND_POINTS,
    PERIODS,
    REFERENCE_PERIOD,
)

KEY = "key"
TREND_FIELDS = (
    "variable", "n", "start_year", "end_year", "slope_per_year", "intercept", "total_change",
    "mk_statistic", "mk_z", "p_value", "significant_95",
)
INDEX_FIELDS = ("unit_name", "state", "multipart", "period", "headline_trends", "stripes")


@dataclass(frozen=True)
class Thresholds:
    min_days_per_year: int = MIN_DAYS_PER_YEAR
    min_trend_points: int = MIN_TREND_POINTS
    reference: tuple[int, int] = REFERENCE_PERIOD
    periods: tuple[tuple[int, int], ...] = PERIODS


@dataclass(frozen=True)
class SummaryTables:
    """The tables behind the documents, each with all keys."""

    annual: DataFrame  # wide
    seasonal: DataFrame  # wide
    anomalies: DataFrame  # long
    trends: DataFrame
    stripes: DataFrame
    decomposition: DataFrame
    part_annual: DataFrame  # wide
    part_trends: DataFrame
    parts: DataFrame  # every key and part with data


def summary_tables(
    canonical: DataFrame,
    how: Mapping[str, str] | None = None,
    limits: Thresholds = Thresholds(),
    keep: bool = True,
) -> SummaryTables:
    """All tables from canonical daily rows ``key, part, date, <variables>``.

    The days are read once and reduced to months of the parts and of their mean. The
    monthly sums are written out, because eight results with different columns build
    on them; ``keep=False`` leaves everything lazy instead.
    """
    hold = materialise if keep else (lambda df, _: df)
    levels = with_combined(canonical, [KEY])
    series = [KEY, "part", COMBINED]
    both = hold(spread_availability(month_partials(levels, series, how), series), "months")
    months = both.where(COMBINED).drop("part", COMBINED)
    by_part = both.where(~F.col(COMBINED)).drop(COMBINED)

    names = [v for v in (how or DEFAULT_SPEC.how) if f"{v}__sum" in months.columns]
    year = only_available(annual_from_partials(months, [KEY], how, limits.min_days_per_year), names)
    long = to_long(year, [KEY, "year"], names)
    anomaly = anomalies(long, [KEY], limits.reference)
    trend = hold(trends(long, [KEY], min_points=limits.min_trend_points), "trends")
    monthly = monthly_from_partials(months, [KEY], how)
    with_trend = monthly.join(trend.select(KEY, "variable"), [KEY, "variable"], "left_semi")

    part_year = only_available(annual_from_partials(by_part, [KEY, "part"], how, limits.min_days_per_year), names)
    part_long = to_long(part_year, [KEY, "part", "year"], names)
    return SummaryTables(
        annual=year,
        seasonal=only_available(seasonal_from_partials(months, [KEY], how), names),
        anomalies=anomaly,
        trends=trend,
        stripes=stripes(anomaly, [KEY]),
        decomposition=decompose(with_trend, [KEY], limits.periods),
        part_annual=part_year,
        part_trends=trends(part_long, [KEY, "part"], min_points=limits.min_trend_points),
        parts=by_part.select(KEY, "part").distinct(),
    )


def _list(df: DataFrame, by: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """Rows of a group as a sorted array of structs. Groups are years or variables of a key."""
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))


def _map(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    pairs = F.sort_array(F.collect_list(F.struct(F.col(key), value)))
    return df.groupBy(KEY).agg(F.map_from_entries(pairs).alias(name))


def _fields(df: DataFrame, *first: str) -> list[str]:
    """Variables behind the leading columns, without keys and bookkeeping."""
    skip = {KEY, "part", "n_days", AVAIL, *first}
    return [*first, *[c for c in df.columns if c not in skip]]


def summary_documents(tables: SummaryTables, registry: DataFrame) -> DataFrame:
    """One nested row per key of the registry that has data.

    Each piece is a row per key, so the joins neither multiply rows nor move more than
    the finished arrays.
    """
    annual = _list(tables.annual, [KEY], _fields(tables.annual, "year"), "annual")
    seasonal = _list(tables.seasonal, [KEY], _fields(tables.seasonal, "year", "season"), "seasonal")
    anomaly = _list(tables.anomalies, [KEY], ["variable", "year", "anom", "z"], "anomalies")
    trend = _list(tables.trends, [KEY], TREND_FIELDS, "trends")
    stripe = _list(tables.stripes, [KEY], ["year", "value", "z"], "stripes")
    record = F.struct(*TREND_FIELDS)
    headline = _map(
        tables.trends.where(F.col("variable").isin(*HEADLINE)), "variable", record, "headline_trends"
    )
    parts_of = F.struct("variable", "months", "observed", "trend", "climatology")
    decomposition = _map(tables.decomposition, "variable", parts_of, "decomposition")

    by = [KEY, "part"]
    part_annual = _list(tables.part_annual, by, _fields(tables.part_annual, "year"), "annual")
    part_trend = _list(tables.part_trends, by, TREND_FIELDS, "trends")
    parts = tables.parts.join(part_annual, by, "left").join(part_trend, by, "left")
    part_map = _map(parts, "part", F.struct("annual", "trends"), "part_summaries")
    span = period_of_record(tables.annual, [KEY])
    period = span.select(KEY, F.struct("start_year", "end_year").alias("period"))

    docs = registry.select(KEY, "unit_name", "state", "multipart").join(seasonal, KEY)
    for piece in (annual, anomaly, trend, stripe, headline, decomposition, part_map, period):
        docs = docs.join(piece, KEY, "left")
    lists = {c: F.coalesce(c, F.array()) for c in ("annual", "anomalies", "trends", "stripes")}
    return docs.withColumns(
        {
            **lists,
            "parts": F.coalesce(F.map_keys("part_summaries"), F.array().cast("array<string>")),
            "period": F.coalesce(
                "period",
                F.struct(F.lit(None).cast("int").alias("start_year"), F.lit(None).cast("int").alias("end_year")),
            ),
        }
    )


def index_documents(docs: DataFrame) -> DataFrame:
    """The part of each document an overview needs."""
    return docs.select(KEY, *INDEX_FIELDS)
