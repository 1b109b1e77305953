from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.operators import trend

SCHEMA = "key string, variable string, year int, value double"


def brute(x, y):
    """The textbook definitions, pair by pair."""
    slopes, s = [], 0
    for a in range(len(x)):
        for b in range(a + 1, len(x)):
            s += int(y[b] > y[a]) - int(y[b] < y[a])
            if x[a] != x[b]:
                slopes.append((y[b] - y[a]) / (x[b] - x[a]))
    slope = float(np.median(slopes))
    n = len(x)
    ties = sum(t * (t - 1) * (2 * t + 5) for t in np.unique(y, return_counts=True)[1])
    var = (n * (n - 1) * (2 * n + 5) - ties) / 18
    z = 0.0 if var <= 0 or s == 0 else (s - math.copysign(1, s)) / math.sqrt(var)
    return slope, float(np.median(np.asarray(y) - slope * np.asarray(x))), s, ties, var, z, math.erfc(abs(z) / 2**0.5)


def series(frame, values, key="k", variable="v"):
    return frame([(key, variable, y, v) for y, v in values], SCHEMA)


def test_exact_line(frame):
    t = trend.trends(series(frame, [(y, 2.0 * y + 1) for y in range(2000, 2021)]), ["key"]).first()
    assert t.slope_per_year == pytest.approx(2.0)
    assert t.intercept == pytest.approx(1.0)
    assert t.significant_95 and t.mk_statistic == 210
    assert (t.n, t.start_year, t.end_year) == (21, 2000, 2020)


def test_flat_series_is_not_significant(frame):
    t = trend.trends(series(frame, [(y, 10.0) for y in range(1980, 2021)]), ["key"]).first()
    assert (t.slope_per_year, t.mk_z, t.p_value, t.significant_95) == (0.0, 0.0, 1.0, False)


def test_ties_by_hand(frame):
    df = series(frame, list(enumerate([1.0, 2.0, 2.0, 3.0])))
    t = trend.trend_statistics(df, ["key"], min_points=4).first()
    assert (t.s, t.tie_term) == (5.0, 18.0)
    assert t.var_s == pytest.approx(7.6667, abs=1e-4)
    assert t.z == pytest.approx(1.4446, abs=1e-4)


def test_too_few_values(frame):
    assert trend.trends(series(frame, [(y, float(y)) for y in range(9)]), ["key"]).count() == 0
    three = trend.trend_statistics(series(frame, [(y, float(y)) for y in range(3)]), ["key"], min_points=2).first()
    assert three.slope == 1.0 and three.p is None


def test_missing_values_are_dropped_and_gaps_matter(frame):
    values = [(y, float(y)) for y in range(2000, 2012)] + [(2030, 2030.0), (2031, None), (2032, float("nan"))]
    t = trend.trends(series(frame, values), ["key"]).first()
    assert (t.n, t.end_year) == (13, 2030)
    assert t.total_change == pytest.approx(30.0)
    assert t.total_change_n == pytest.approx(12.0)


def test_many_series_of_different_lengths_against_brute_force(frame):
    rng = np.random.default_rng(7)
    rows, want = [], {}
    for k in range(40):
        n = int(rng.integers(10, 60))
        x = np.sort(rng.choice(np.arange(1950, 2030), n, replace=False))
        y = np.round(rng.normal(size=n), 1)  # rounded: many ties
        want[f"s{k}"] = brute(x, y)
        rows += [(f"s{k}", "v", int(a), float(b)) for a, b in zip(x, y)]
    rng.shuffle(rows)
    rows = [(k, v, int(a), float(b)) for k, v, a, b in rows]
    got = trend.trend_statistics(frame(rows, SCHEMA), ["key"]).collect()
    assert len(got) == 40
    for r in got:
        assert (r.slope, r.intercept, r.s, r.tie_term, r.var_s, r.z, r.p) == pytest.approx(want[r.key], abs=1e-9)


@pytest.mark.parametrize("room", [1, 5, 64, 10**6])
@pytest.mark.parametrize("n", [2, 3, 50, 51])
def test_median_slope_in_little_room(n, room):
    rng = np.random.default_rng(n)
    x = np.sort(rng.integers(0, 40, n)).astype(float)
    x[-1] += 50  # at least one real pair
    y = np.round(rng.normal(size=n), 1)
    want = [(y[b] - y[a]) / (x[b] - x[a]) for a in range(n) for b in range(a + 1, n) if x[a] != x[b]]
    assert trend._median_slope(x, y, room) == pytest.approx(float(np.median(want)), abs=1e-15)


def test_long_series_path_equals_the_short_one():
    rng = np.random.default_rng(3)
    x, y = np.arange(80.0), np.round(rng.normal(size=80), 1)
    assert trend._one_long(x, y) == pytest.approx(trend._many_short(x[None], y[None])[0], abs=1e-12)


@pytest.mark.parametrize("n", [40, 300])
@pytest.mark.parametrize("kind", ["noise", "ties", "line", "flat", "gaps"])
def test_counting_equals_all_pairs(n, kind):
    rng = np.random.default_rng(n)
    x = np.arange(float(n))
    y = {"noise": rng.normal(size=n), "ties": rng.integers(0, 3, n) * 1.0, "line": 2 * x + rng.integers(0, 2, n), "flat": np.zeros(n), "gaps": rng.normal(size=n)}[kind]
    x = np.sort(rng.integers(0, n, n)) * 1.0 if kind == "gaps" else x
    i, j = np.triu_indices(n, 1)
    dx, dy = x[j] - x[i], y[j] - y[i]
    for room in (20, 10**6):
        assert trend._median_slope(x, y, room) == pytest.approx(np.median(dy[dx != 0] / dx[dx != 0]), abs=1e-12)
    rank = np.unique(y, return_inverse=True)[1]
    assert trend._falls(rank) == (dy < 0).sum()
    a, b = trend._falling_pairs(rank)
    assert set(zip(a.tolist(), b.tolist())) == {(p, q) for p, q in zip(i.tolist(), j.tolist()) if y[p] > y[q]}


def test_a_hundred_thousand_points():
    rng = np.random.default_rng(2)
    x = np.arange(100_000.0)
    slope, _, s, *_ = trend._one_long(x, 0.25 * x + rng.normal(size=len(x)))
    assert slope == pytest.approx(0.25, abs=1e-6) and s > 4e9


def test_all_at_one_place_has_no_slope():
    x, y = np.zeros(5), np.arange(5.0)
    assert math.isnan(trend._many_short(x[None], y[None])[0][0])
    assert math.isnan(trend._median_slope(x, y))


def test_trend_line(frame):
    s = series(frame, [(y, 2.0 * y + 1) for y in range(2000, 2012)])
    line = trend.trend_line(trend.trends(s, ["key"]), s, ["key"]).collect()
    assert all(r.fitted == pytest.approx(r.value) for r in line) and len(line) == 12


def test_seeded_warming_is_found(frame):
    rng = np.random.default_rng(0)
    rows = [(y, 10 + 0.03 * (y - 1980) + rng.normal(scale=0.1)) for y in range(1980, 2024)]
    t = trend.trends(series(frame, [(y, float(v)) for y, v in rows]), ["key"]).first()
    assert t.slope_per_year > 0.01 and t.p_value < 0.01
