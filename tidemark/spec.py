"""What a series library has to know about its variables, as one value object.

Operators take a :class:`SeriesSpec` (or plain arguments derived from it), so a
user with other sources, units or variables passes their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed

#: unit token -> conversion of a source column into the canonical unit
CONVERSIONS: dict[str, Callable[[Column], Column]] = {
    "K": lambda c: c - F.lit(273.15),
    "m": lambda c: c * F.lit(1000.0),
    "m_we": lambda c: c * F.lit(1000.0),
    "m_neg": lambda c: c * F.lit(-1000.0),
}

PRESENT = "_present"  # raw rows: which source columns the series has
AVAIL = "_avail"  # canonical rows: which variables the series has


@dataclass(frozen=True)
class Variable:
    name: str
    how: str  # yearly reduction, "mean" or "sum"
    sources: tuple[tuple[str, str], ...]  # (raw column, unit token), first wins


@dataclass(frozen=True)
class SeriesSpec:
    """Variables, their sources and the two derived ones.

    ``midpoint`` is (target, high, low): the target is the mean of the other two
    where the series has no source column for it. ``magnitude`` is (target, u, v):
    the length of a vector given by two raw columns.
    """

    variables: tuple[Variable, ...]
    midpoint: tuple[str, str, str] | None = None
    magnitude: tuple[str, str, str] | None = None

    @cached_property
    def how(self) -> dict[str, str]:
        kinds = {v.name: v.how for v in self.variables}
        if self.midpoint:
            kinds.setdefault(self.midpoint[0], "mean")
        if self.magnitude:
            kinds.setdefault(self.magnitude[0], "mean")
        return kinds

    @cached_property
    def names(self) -> tuple[str, ...]:
        return tuple(self.how)

    @cached_property
    def source_columns(self) -> tuple[str, ...]:
        wanted = [col for v in self.variables for col, _ in v.sources]
        wanted += list(self.magnitude[1:]) if self.magnitude else []
        return tuple(dict.fromkeys(wanted))

    def source_mask(self, columns: Iterable[str]) -> int:
        """Bit mask of raw source columns (see :data:`PRESENT`)."""
        return sum(1 << i for i, c in enumerate(self.source_columns) if c in set(columns))

    def variable_bit(self, name: str) -> int:
        return 1 << self.names.index(name)


DEFAULT_SPEC = SeriesSpec(
    variables=tuple(
        Variable(name, how, tuple(tuple(s.split(":")) for s in sources.split()))
        for name, how, sources in fixed.rows(fixed.VARIABLES)
    ),
    midpoint=("tmean_c", "tmax_c", "tmin_c"),
    magnitude=("wind_speed_ms", "ERA5_u_component_of_wind_10m", "ERA5_v_component_of_wind_10m"),
)

DATASET_COLUMNS: dict[str, tuple[str, ...]] = {
    name: tuple(f"{name}_{band}" for band in bands.split())
    for name, _, _, _, _, bands in fixed.rows(fixed.DATASETS)
}
RAW_COLUMNS: tuple[str, ...] = tuple(c for cols in DATASET_COLUMNS.values() for c in cols)
ERA5_ONLY: tuple[str, ...] = tuple(r[0] for r in fixed.rows(fixed.ERA5_ONLY))

HEADLINE: tuple[str, ...] = tuple(fixed.HEADLINE.split())
TEMPERATURES: tuple[str, ...] = tuple(fixed.TEMPERATURES.split())
REFERENCE_PERIOD = (1981, 2010)
PERIODS: tuple[tuple[int, int], ...] = tuple((int(a), int(b)) for a, b in fixed.rows(fixed.PERIODS))
RANGE_BANDS: dict[str, tuple[float, float]] = {
    v: (float(lo), float(hi)) for v, lo, hi in fixed.rows(fixed.RANGE_BANDS)
}

MIN_DAYS_PER_YEAR = 330
MIN_DAYS_PER_SUMMED_MONTH = 20
MIN_TREND_POINTS = 10
MIN_MK_POINTS = 4
MIN_DECOMPOSE_DAYS = 24 * 28
MIN_DECOMPOSE_MONTHS = 24
ROLLING_MONTHS = 12
ALPHA = 0.05
