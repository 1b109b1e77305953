"""From raw source columns to one row per series and date in canonical units.

A raw frame has key columns, a date and source columns named ``<DATASET>_<band>``.
Whether a series *has* a source column at all is different from the column being
empty: an absent variable yields no result, an empty one yields sums of zero. A
table shared by all series cannot tell the two apart by its schema, so raw rows
may carry a bit mask ``_present`` over ``spec.source_columns``; canonical rows then
carry ``_avail`` over ``spec.names``. A mask costs eight bytes per row and merges
with ``bit_or``, which stays inside code-generated partial aggregation. Without
the mask, the columns of the frame decide, for all series alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import nan_to_null, to_canonical_unit
from tidemark.spec import AVAIL, DATASET_COLUMNS, DEFAULT_SPEC, ERA5_ONLY, PRESENT, SeriesSpec


def select_bands(df: DataFrame, keep: Sequence[str], dataset: str, bands: Sequence[str]) -> DataFrame:
    """Keep key columns and some bands, renamed to ``<DATASET>_<band>``."""
    return df.select(*keep, *[F.col(b).alias(f"{dataset}_{b}") for b in bands])


def merge_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union of sources with different bands; missing bands are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def present_columns(columns: Iterable[str], spec: SeriesSpec = DEFAULT_SPEC) -> Column:
    """The ``_present`` mask of series that have exactly these raw columns."""
    return F.lit(spec.source_mask(columns)).cast("long").alias(PRESENT)


def present_by_dataset_choice(
    key: Column, era5_only: Sequence[str] = ERA5_ONLY, spec: SeriesSpec = DEFAULT_SPEC
) -> Column:
    """The ``_present`` mask by key: ERA5 alone for some keys, both sources for the rest."""
    everything = [c for cols in DATASET_COLUMNS.values() for c in cols]
    return (
        F.when(key.isin(list(era5_only)), present_columns(DATASET_COLUMNS["ERA5"], spec))
        .otherwise(present_columns(everything, spec))
        .alias(PRESENT)
    )


def coalesce_dates(raw: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """One row per series and date: the largest non-missing value of each column.

    Sources arrive as separate half-filled rows. The maximum is also taken where
    several rows hold a value. Partial aggregation merges rows of one file before
    the shuffle, and the shuffle spreads each key over its dates.
    """
    skip = {*keys, date, PRESENT}
    values = [f.name for f in raw.schema if f.name not in skip and isinstance(f.dataType, T.NumericType)]
    aggs = [F.max(nan_to_null(F.col(c).cast("double"))).alias(c) for c in values]
    if PRESENT in raw.columns:
        aggs.append(F.bit_or(PRESENT).alias(PRESENT))
    return raw.groupBy(*keys, F.to_date(date).alias(date)).agg(*aggs)


def canonicalise(
    raw: DataFrame, keys: Sequence[str], spec: SeriesSpec = DEFAULT_SPEC, date: str = "date"
) -> DataFrame:
    """Cast, convert units, fill by source priority and derive; one projection.

    The midpoint stands in for a variable only where the series has no column for
    it, never row by row.
    """
    columns = set(raw.columns)
    has_mask = PRESENT in columns

    def has(*names: str) -> Column:
        mask = spec.source_mask(names)
        return F.col(PRESENT).bitwiseAND(F.lit(mask).cast("long")) == mask

    def has_any(*names: str) -> Column:
        return F.col(PRESENT).bitwiseAND(F.lit(spec.source_mask(names)).cast("long")) != 0

    def source(name: str) -> Column:
        return nan_to_null(F.col(name).cast("double"))

    value: dict[str, Column] = {}
    available: dict[str, Column] = {}
    for variable in spec.variables:
        sources = [(c, unit) for c, unit in variable.sources if c in columns]
        if sources:
            value[variable.name] = F.coalesce(*[to_canonical_unit(source(c), unit) for c, unit in sources])
            available[variable.name] = has_any(*[c for c, _ in sources]) if has_mask else F.lit(True)

    if spec.midpoint:
        target, high, low = spec.midpoint
        if high in value and low in value:
            middle = (value[high] + value[low]) / 2.0
            ends = available[high] & available[low]
            if target not in value:
                value[target], available[target] = middle, ends
            elif has_mask:
                own = available[target]
                value[target] = F.when(own, value[target]).otherwise(middle)
                available[target] = own | ends

    if spec.magnitude:
        target, u, v = spec.magnitude
        if u in columns and v in columns:
            value[target] = F.sqrt(source(u) * source(u) + source(v) * source(v))
            available[target] = has(u, v) if has_mask else F.lit(True)

    out = [*keys, F.to_date(date).alias(date)]
    out += [value[n].alias(n) for n in spec.names if n in value]
    if has_mask:
        bits = [
            F.when(available[n], F.lit(spec.variable_bit(n)).cast("long")).otherwise(F.lit(0).cast("long"))
            for n in spec.names
            if n in value
        ]
        out.append(reduce(lambda a, b: a + b, bits, F.lit(0).cast("long")).alias(AVAIL))
    return raw.select(*out)


COMBINED = "_combined"


def with_combined(
    daily: DataFrame, keys: Sequence[str], part: str = "part", date: str = "date"
) -> DataFrame:
    """Daily rows of every part, and next to them the mean over parts.

    ``_combined`` marks the latter, whose part is NULL. Both levels come from one read
    of the days and one shuffle, instead of one each.
    """
    skip = {*keys, part, date, AVAIL}
    values = [f.name for f in daily.schema if f.name not in skip and isinstance(f.dataType, T.DoubleType)]
    aggs = [F.avg(c).alias(c) for c in values]
    if AVAIL in daily.columns:
        aggs.append(F.bit_or(AVAIL).alias(AVAIL))
    levels = [[*keys, date], [*keys, date, part]]
    combined = (F.grouping(part) == 1).alias(COMBINED)
    return daily.groupingSets(levels, *keys, date, part).agg(combined, *aggs)


def combine_parts(
    daily: DataFrame, keys: Sequence[str], date: str = "date", weight: str | None = None
) -> DataFrame:
    """Mean over the parts of a key per date, unweighted unless a weight column is named."""
    skip = {*keys, date, AVAIL, weight}
    values = [f.name for f in daily.schema if f.name not in skip and isinstance(f.dataType, T.DoubleType)]

    def mean(c: str) -> Column:
        if weight is None:
            return F.avg(c)
        share = F.when(F.col(c).isNotNull(), F.col(weight))
        return F.try_divide(F.sum(F.col(c) * F.col(weight)), F.sum(share))

    aggs = [mean(c).alias(c) for c in values]
    if AVAIL in daily.columns:
        aggs.append(F.bit_or(AVAIL).alias(AVAIL))
    return daily.groupBy(*keys, date).agg(*aggs)
