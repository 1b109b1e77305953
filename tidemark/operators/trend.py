"""Theil-Sen slopes and Mann-Kendall tests for all series in one job.

The input has one value per series and calendar period, so a series is as long as
the calendar, however many raw rows its key has. Each series becomes one row of two
arrays. The pairs of a series are formed inside a task from those arrays and are
never rows of a DataFrame: they reach neither a join nor a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import ALPHA, MIN_MK_POINTS, MIN_TREND_POINTS

#: matrix elements worked on at once: 16 MB of doubles
BLOCK = 1 << 21

_FIELDS = ("slope", "intercept", "s", "tie_term", "var_s", "z", "p")
_STATS_TYPE = "struct<" + ",".join(f"{f}:double" for f in _FIELDS) + ">"


def trend_statistics(
    series: DataFrame,
    keys: Sequence[str],
    x: str = "year",
    value: str = "value",
    min_points: int = MIN_TREND_POINTS,
) -> DataFrame:
    """One row per ``(*keys, variable)`` with slope, intercept, S, its variance, Z and p.

    Missing and infinite values are dropped, and series with fewer than ``min_points`` left with
    them. A series has one value per period; aggregate raw values first.
    """
    point = F.struct(F.col(x).cast("double").alias("x"), F.col(value).alias("y"))
    rows = (
        series.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))
        .groupBy(*keys, "variable")
        .agg(F.sort_array(F.collect_list(point)).alias("pts"), F.count(F.lit(1)).cast("int").alias("n"))
        .where(F.col("n") >= max(min_points, 2))
    )
    stats = F.pandas_udf(_statistics, _STATS_TYPE)
    fit = rows.select(
        *keys,
        "variable",
        "n",
        F.element_at("pts", 1).x.alias("first_x"),
        F.element_at("pts", -1).x.alias("last_x"),
        stats(F.col("pts.x"), F.col("pts.y")).alias("t"),
    )
    return fit.select(*keys, "variable", "n", "first_x", "last_x", "t.*")


def trends(
    annual_long: DataFrame,
    keys: Sequence[str],
    x: str = "year",
    min_points: int = MIN_TREND_POINTS,
    alpha: float = ALPHA,
) -> DataFrame:
    """Trend records.

    ``total_change`` spans the calendar from first to last year; ``total_change_n``
    spans the number of values. They differ where a series has gaps.
    """
    t = trend_statistics(annual_long, keys, x, min_points=min_points)
    return t.select(
        *keys,
        "variable",
        "n",
        F.col("first_x").cast("int").alias("start_year"),
        F.col("last_x").cast("int").alias("end_year"),
        F.col("slope").alias("slope_per_year"),
        "intercept",
        (F.col("slope") * (F.col("last_x") - F.col("first_x"))).alias("total_change"),
        (F.col("slope") * (F.col("n") - 1)).alias("total_change_n"),
        F.col("s").alias("mk_statistic"),
        F.col("z").alias("mk_z"),
        F.col("p").alias("p_value"),
        F.coalesce(F.col("p") < alpha, F.lit(False)).alias("significant_95"),
    )


def trend_line(
    trend_rows: DataFrame, series: DataFrame, keys: Sequence[str], x: str = "year"
) -> DataFrame:
    """Fitted value at every period of the series that have a trend."""
    fit = trend_rows.select(*keys, "variable", "slope_per_year", "intercept")
    line: Column = F.col("slope_per_year") * F.col(x) + F.col("intercept")
    return series.join(fit, [*keys, "variable"]).select(
        *keys, "variable", x, "value", line.alias("fitted")
    )


# ---- inside a task: whole batches of series ----------------------------------


def _statistics(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for xs, ys in batches:
        lengths = xs.map(len).to_numpy()
        out = np.full((len(xs), len(_FIELDS)), np.nan)
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            if n * n > BLOCK:
                for r in rows:
                    out[r] = _one_long(np.asarray(xs.iloc[r], float), np.asarray(ys.iloc[r], float))
                continue
            per_block = max(1, BLOCK // int(n * n))
            for at in range(0, len(rows), per_block):
                some = rows[at : at + per_block]
                out[some] = _many_short(np.stack(xs.iloc[some]), np.stack(ys.iloc[some]))
        yield pd.DataFrame(out, columns=list(_FIELDS)).astype("float64")


def _many_short(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Statistics of series of equal length, one per matrix row."""
    i, j = np.triu_indices(x.shape[1], k=1)
    dy, dx = y[:, j] - y[:, i], x[:, j] - x[:, i]
    s = np.sign(dy).sum(axis=1)
    same = (y[:, :, None] == y[:, None, :]).sum(axis=2)
    if (dx != 0).all():
        slope = np.median(dy / dx, axis=1)
    else:
        slope = np.array([_median(b[a != 0] / a[a != 0]) for a, b in zip(dx, dy)])
    return _finish(x, y, slope, s, _tie_term(same))


def _one_long(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same for a series whose pairs should not be held at once, in about n log n steps."""
    rank = np.unique(y, return_inverse=True)[1]
    s = float(_falls(rank[::-1]) - _falls(rank))  # rises less falls, in the order of the series
    values, inverse, counts = np.unique(y, return_inverse=True, return_counts=True)
    slope = np.array([_median_slope(x, y)])
    return _finish(x[None], y[None], slope, np.array([s]), _tie_term(counts[inverse][None]))[0]


def _tie_term(same: np.ndarray) -> np.ndarray:
    # A group of t equal values adds t(t-1)(2t+5); each of its members adds a t-th of that.
    same = same.astype(float)
    return ((same - 1) * (2 * same + 5)).sum(axis=1)


def _finish(x, y, slope, s, ties) -> np.ndarray:
    n = x.shape[1]
    intercept = np.median(y - slope[:, None] * x, axis=1)
    var = (n * (n - 1) * (2 * n + 5) - ties) / 18.0
    spread = var > 0
    z = np.where(spread, np.sign(s) * (np.abs(s) - 1).clip(0) / np.sqrt(np.where(spread, var, 1)), 0.0)
    p = np.array([math.erfc(abs(v) / math.sqrt(2)) for v in z])
    out = np.column_stack([slope, intercept, s, ties, var, z, p])
    if n < MIN_MK_POINTS:
        out[:, 2:] = np.nan
    return out


def _median(v: np.ndarray) -> float:
    return float(np.median(v)) if len(v) else math.nan


def _levels(rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs of places whose ranks fall, as many steps as ranks have bits.

    Ranks are parted bit by bit from the highest on, as in a radix sort. A pair falls at the bit
    where its first has a one and its second a zero, among those that agree on all higher bits. Each
    step gives the places in their present order, which of them have a zero, how many ones of its
    group stand before each, and the number of the group's first one among all ones.
    """
    place = np.arange(len(rank))
    for bit in range(int(rank.max()).bit_length() - 1, -1, -1):
        high = rank[place] >> (bit + 1)
        one = (rank[place] >> bit & 1).astype(bool)
        starts = np.flatnonzero(np.r_[True, high[1:] != high[:-1]])
        before = np.cumsum(one) - one
        base = np.repeat(before[starts], np.diff(np.r_[starts, len(place)]))
        yield place, ~one, before - base, base
        place = place[np.lexsort((one, np.cumsum(np.r_[False, high[1:] != high[:-1]])))]


def _falls(rank: np.ndarray) -> int:
    """How many pairs of places have a higher rank first."""
    return sum([int(before[zero].sum()) for _, zero, before, _ in _levels(rank)])


def _falling_pairs(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """These pairs themselves."""
    firsts, seconds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for place, zero, before, base in _levels(rank):
        ones = place[~zero]
        n, first = before[zero], base[zero]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        firsts.append(ones[at])
        seconds.append(np.repeat(place[zero], n))
    return np.concatenate(firsts), np.concatenate(seconds)


def _below(x: np.ndarray, y: np.ndarray, slope: float) -> int:
    """How many pairs have a slope less than this, as far as rounding can tell."""
    z = y - slope * x
    order = np.lexsort((z, x))
    return _falls(np.unique(z[order], return_inverse=True)[1])


def _slopes_between(x: np.ndarray, y: np.ndarray, low: float, high: float) -> np.ndarray:
    """The slopes of the pairs that are below ``high`` and not below ``low``."""
    z_low, z_high = y - low * x, y - high * x
    # along low they don't fall, along high they do: their order is turned
    order = np.lexsort((z_high, x, z_low))
    turned = np.unique(z_high[order], return_inverse=True)[1]
    i, j = (order[k] for k in _falling_pairs(turned))
    dx, dy = x[j] - x[i], y[j] - y[i]
    return dy[dx > 0] / dx[dx > 0]


def _median_slope(x: np.ndarray, y: np.ndarray, room: int = BLOCK) -> float:
    """Exact median of all pairwise slopes, in bounded memory and about n log n steps."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    same = np.unique(x, return_counts=True)[1].astype(np.int64)
    total = len(x) * (len(x) - 1) // 2 - int((same * (same - 1) // 2).sum())
    if total == 0:
        return math.nan
    return float(np.mean([_nth_slope(x, y, r, total, room) for r in {(total - 1) // 2, total // 2}]))


def _nth_slope(x: np.ndarray, y: np.ndarray, rank: int, total: int, room: int) -> float:
    """Slope of a given rank: a bracket is narrowed by counting until its slopes fit in ``room``.

    Slopes of pairs drawn at random begin it, so only counts decide. Counting is exact but for slopes
    that differ from an end of the bracket by rounding, which are inside either way. Slopes that are too many and
    equal up to rounding are one value.
    """
    rng = np.random.default_rng(7)
    i, j = rng.integers(0, len(x), (2, 8 * len(x)))
    drawn = np.sort(((y[j] - y[i])[x[i] != x[j]] / (x[j] - x[i])[x[i] != x[j]]))
    reach = max(abs(drawn[0]), abs(drawn[-1]), 1e-300) * 1e-13
    step = 3 * math.sqrt(len(drawn))
    low, high = -math.inf, math.inf
    n_low, n_high = 0, total
    trials = [drawn[int(np.clip(rank / total * len(drawn) + d, 0, len(drawn) - 1))] for d in (-step, step)]
    while n_high - n_low > room:
        if trials:
            t = float(trials.pop()) + (reach if len(trials) else -reach)
        else:
            if high - low <= 4 * reach:
                return (low + high) / 2 if low + reach > 0 or high - reach < 0 else 0.0
            t = (low + high) / 2
        if not low < t < high:
            continue
        n = _below(x, y, t)
        if n <= rank:
            low, n_low = t, n
        else:
            high, n_high = t, n
        if not trials and (math.isinf(low) or math.isinf(high)):
            top = float(np.max(np.abs(np.diff(y))) / np.min(np.diff(x)[np.diff(x) > 0])) * 2 + 1  # steeper than any neighbours
            low, high = max(low, -top), min(high, top)
    if math.isinf(low) or math.isinf(high):
        top = float(np.ptp(y) / np.min(np.diff(x)[np.diff(x) > 0])) * 2 + 1
        low, high = max(low, -top), min(high, top)
    found = _slopes_between(x, y, low, high)
    return float(np.partition(found, rank - n_low)[rank - n_low])
