"""Missing values, unit conversion and scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import CONVERSIONS


def nan_to_null(c: Column) -> Column:
    """Missing is NULL inside the library: Spark's max and avg would pass NaN on."""
    return F.when(~F.isnan(c), c)


def finite_or_null(c: Column) -> Column:
    """NaN and both infinities become NULL, as JSON has no word for them."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def numbers_finite(df: DataFrame) -> DataFrame:
    """Apply :func:`finite_or_null` to every float, also inside arrays, structs and maps."""
    return df.select(*[_clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def _clean(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite_or_null(c)
    if not _has_float(kind):
        return c
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda e: _clean(e, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: _clean(v, kind.valueType))
    fields = [_clean(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(c.isNotNull(), F.struct(*fields))


def _has_float(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_float(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_float(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_has_float(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def to_canonical_unit(c: Column, unit: str) -> Column:
    """Convert by unit token; tokens without a rule are already canonical."""
    convert = CONVERSIONS.get(unit)
    return convert(c) if convert else c


def celsius_to_fahrenheit(c: Column) -> Column:
    return c * 9 / 5 + 32


def celsius_change_to_fahrenheit(c: Column) -> Column:
    """Differences and slopes scale without the offset."""
    return c * 9 / 5


def round_or_null(c: Column, digits: int = 4) -> Column:
    return F.round(nan_to_null(c), digits)


ACRE_KM2 = 0.00404686


def acres_to_km2(acres: Column, digits: int = 3) -> Column:
    return F.round(acres * F.lit(ACRE_KM2), digits)
