from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregate
from tidemark.operators.anomaly import anomalies, stripes
from tidemark.operators.decompose import decompose, period_climatology, rolling_centred, usable_months

START = dt.date(2001, 1, 1)
HOW = {"tmean_c": "mean", "prcp_mm": "sum"}
SCHEMA = "key string, date date, tmean_c double, prcp_mm double"


def days(first: dt.date, n: int, temp=lambda i: 1.0, rain=lambda i: 2.0):
    return [("k", first + dt.timedelta(days=i), temp(i), rain(i)) for i in range(n)]


def test_annual_sum_and_mean(frame):
    out = aggregate.annual(frame(days(START, 365, lambda i: float(i)), SCHEMA), ["key"]).first()
    assert (out.year, out.n_days) == (2001, 365)
    assert out.tmean_c == pytest.approx(182.0)
    assert out.prcp_mm == pytest.approx(730.0)


def test_short_year_is_dropped(frame):
    assert aggregate.annual(frame(days(START, 3), SCHEMA), ["key"]).count() == 0
    assert aggregate.annual(frame(days(START, 329), SCHEMA), ["key"]).count() == 0
    assert aggregate.annual(frame(days(START, 330), SCHEMA), ["key"]).count() == 1


def test_rows_count_even_without_values(frame):
    half = days(START, 340, lambda i: 1.0 if i < 10 else None)
    df = frame(half, SCHEMA)
    assert aggregate.annual(df, ["key"]).first().tmean_c == 1.0
    strict = aggregate.annual(df, ["key"], completeness="non_null").first()
    assert (strict.tmean_c, strict.prcp_mm) == (None, 680.0)


def test_unknown_completeness(frame):
    with pytest.raises(ValueError):
        aggregate.annual(frame(days(START, 3), SCHEMA), ["key"], completeness="some")


def test_winter_spans_the_year(frame):
    out = aggregate.seasonal(frame(days(dt.date(2020, 12, 1), 90, lambda i: float(i % 2)), SCHEMA), ["key"])
    assert [(r.year, r.season, r.tmean_c) for r in out.collect()] == [(2021, "DJF", 0.5)]


def test_trailing_december_is_a_winter_of_its_own(frame):
    out = aggregate.seasonal(frame(days(START, 365), SCHEMA), ["key"]).orderBy("year", "season").collect()
    assert [(r.year, r.season, r.n_days) for r in out] == [
        (2001, "DJF", 59), (2001, "JJA", 92), (2001, "MAM", 92), (2001, "SON", 91), (2002, "DJF", 31),
    ]


def test_water_year(frame):
    out = aggregate.water_years(frame(days(START, 365), SCHEMA), ["key"]).orderBy("water_year").collect()
    assert [(r.water_year, r.n_days) for r in out] == [(2001, 273), (2002, 92)]


def test_monthly_sum_needs_twenty_days_and_mean_one(frame):
    rows = days(START, 31, lambda i: 3.0 if i == 0 else None, lambda i: 1.0 if i < 19 else None)
    rows += days(dt.date(2001, 2, 1), 20, lambda i: None)
    got = {
        (r.variable, r.month.month): (r.value, r.n_obs)
        for r in aggregate.monthly(frame(rows, SCHEMA), ["key"]).collect()
    }
    assert got == {
        ("tmean_c", 1): (3.0, 1),
        ("tmean_c", 2): (None, 0),
        ("prcp_mm", 1): (None, 19),
        ("prcp_mm", 2): (40.0, 20),
    }


def test_partials_agree_with_direct_aggregation(frame):
    rows = days(START, 800, lambda i: (i * 37 % 101) / 7 if i % 13 else None, lambda i: float(i % 11))
    df = frame(rows, SCHEMA)
    part = aggregate.month_partials(df, ["key"])
    for direct, derived in [
        (aggregate.annual(df, ["key"]), aggregate.annual_from_partials(part, ["key"])),
        (aggregate.seasonal(df, ["key"]), aggregate.seasonal_from_partials(part, ["key"])),
    ]:
        by = [c for c in ("year", "season") if c in direct.columns]
        a, b = (x.select(*by, "tmean_c", "prcp_mm", "n_days").orderBy(*by).collect() for x in (direct, derived))
        assert len(a) == len(b) > 0
        for r, s in zip(a, b):
            assert tuple(r) == pytest.approx(tuple(s)) if not by[1:] else r.tmean_c == pytest.approx(s.tmean_c)


def test_anomalies_subtract_the_reference_mean(frame):
    rows = [("k", "v", y, float(y - 2000)) for y in range(1980, 2021)]
    out = anomalies(frame(rows, "key string, variable string, year int, value double"), ["key"])
    at_2000 = out.where("year = 2000").first()
    assert at_2000.anom == pytest.approx(4.5)
    assert at_2000.z == pytest.approx(4.5 / (((30**2 - 1) / 12) ** 0.5))


def test_no_spread_leaves_z_missing_and_no_reference_leaves_both(frame):
    schema = "key string, variable string, year int, value double"
    flat = anomalies(frame([("k", "v", y, 1.0) for y in range(1981, 1985)], schema), ["key"])
    assert {(r.anom, r.z) for r in flat.collect()} == {(0.0, None)}
    late = anomalies(frame([("k", "v", y, 1.0) for y in range(2015, 2018)], schema), ["key"])
    assert {(r.anom, r.z) for r in late.collect()} == {(None, None)}


def test_stripes_have_a_colour_each(frame):
    rows = [("k", v, y, float(y % 5)) for v in ("tmean_c", "other") for y in range(1981, 1991)]
    df = anomalies(frame(rows, "key string, variable string, year int, value double"), ["key"])
    out = stripes(df, ["key"]).collect()
    assert len(out) == 10
    assert all(r.colour.startswith("rgb(") for r in out)


# ---- monthly decomposition -----------------------------------------------------------

MONTHLY = "key string, variable string, month date, value double, n_obs long"


def months(first_year: int, n: int, skip=(), value=lambda i: float(i), n_obs=30):
    out = []
    for i in range(n):
        m = dt.date(first_year + i // 12, i % 12 + 1, 1)
        out.append(("k", "v", m, None if i in skip else value(i), n_obs))
    return out


def test_rolling_window_reaches_six_back_and_five_ahead(frame):
    out = rolling_centred(frame(months(2000, 24), MONTHLY), ["key"]).orderBy("month").collect()
    trend = [r.trend for r in out]
    assert trend[:6] == [None] * 6 and trend[-5:] == [None] * 5
    assert trend[6] == pytest.approx(sum(range(12)) / 12)


def test_rolling_window_runs_over_rows_where_a_month_is_missing(frame):
    usable = usable_months(frame(months(2000, 30, skip={3}), MONTHLY), ["key"])
    out = rolling_centred(usable, ["key"]).orderBy("month").collect()
    kept = [i for i in range(30) if i != 3]
    assert out[6].trend == pytest.approx(sum(kept[:12]) / 12)
    assert len(out) == 29


def test_length_guards(frame):
    assert usable_months(frame(months(2000, 23), MONTHLY), ["key"]).count() == 0
    assert usable_months(frame(months(2000, 24, n_obs=28), MONTHLY), ["key"]).count() == 24
    assert usable_months(frame(months(2000, 24, n_obs=27), MONTHLY), ["key"]).count() == 0


def test_climatology_needs_all_twelve_months(frame):
    df = frame(months(2000, 36, value=lambda i: float(i // 12)), MONTHLY)
    whole = period_climatology(df, ["key"], [(2000, 2002), (2002, 2009)]).orderBy("period_start", "month").collect()
    assert len(whole) == 24
    assert (whole[0].mean, whole[0].p10, whole[0].p90) == (1.0, pytest.approx(0.2), pytest.approx(1.8))
    eleven = df.where(F.month("month") != 7)
    assert period_climatology(eleven, ["key"], [(2000, 2002)]).count() == 0
    assert decompose(eleven, ["key"], [(2000, 2002)]).count() == 0


def test_decomposition_document(frame):
    doc = decompose(frame(months(2000, 36), MONTHLY), ["key"], [(2000, 2002), (1990, 1995)]).first()
    assert doc.months[0] == "2000-01" and len(doc.months) == 36
    assert doc.observed[:2] == [0.0, 1.0] and doc.trend[0] is None and doc.trend[6] == 5.5
    assert [c.period for c in doc.climatology] == [[2000, 2002]]
    assert [v.month for v in doc.climatology[0]["values"]] == list(range(1, 13))
