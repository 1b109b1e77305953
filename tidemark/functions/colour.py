"""Numbers to colours on a piecewise linear ramp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed

Stops = list[tuple[float, tuple[int, int, int]]]


def parse_stops(block: str) -> Stops:
    return [(float(at), (int(r), int(g), int(b))) for at, r, g, b in fixed.rows(block)]


STRIPE_STOPS = parse_stops(fixed.STRIPE_STOPS)
LABEL_STOPS = parse_stops(fixed.LABEL_STOPS)


def ramp(value: Column, stops: Stops, missing: str) -> Column:
    """``rgb(r,g,b)`` of a value, clamped to the ends of the ramp."""
    at = F.greatest(F.lit(stops[0][0]), F.least(F.lit(stops[-1][0]), value))
    text = F.concat(
        F.lit("rgb("), F.concat_ws(",", *[_channel(at, stops, i).cast("string") for i in range(3)]), F.lit(")")
    )
    return F.when(value.isNull() | F.isnan(value), missing).otherwise(text)


def _channel(at: Column, stops: Stops, i: int) -> Column:
    out = None
    for (x0, left), (x1, right) in zip(stops, stops[1:]):
        mix = left[i] + (right[i] - left[i]) * ((at - x0) / (x1 - x0))
        out = F.when(at <= x1, mix) if out is None else out.when(at <= x1, mix)
    return F.floor(out + 0.5).cast("int")


def stripe_colour(z: Column) -> Column:
    return ramp(z, STRIPE_STOPS, fixed.STRIPE_MISSING)


def label_colour(value: Column, low: Column, high: Column) -> Column:
    """Colour of a value by its place between ``low`` and ``high``."""
    place = (value - low) / F.greatest(F.lit(1e-6), high - low)
    return ramp(place, LABEL_STOPS, fixed.LABEL_MISSING)
