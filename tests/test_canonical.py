from __future__ import annotations

import datetime as dt
import math

import pytest

from tidemark.operators.aggregate import annual, to_long
from tidemark.operators.canonical import (
    canonicalise,
    coalesce_dates,
    combine_parts,
    merge_sources,
    present_by_dataset_choice,
    present_columns,
)
from tidemark.sources.sinks import export_columns
from tidemark.spec import AVAIL, DEFAULT_SPEC, PRESENT

NAN = float("nan")


def day(i: int) -> dt.date:
    return dt.date(2000, 1, 1) + dt.timedelta(days=i)


def values(df, column, order="date"):
    return [r[column] for r in df.orderBy(order).collect()]


def one_key(frame, columns: dict[str, list]):
    n = len(next(iter(columns.values())))
    rows = [("k", day(i), *[columns[c][i] for c in columns]) for i in range(n)]
    return frame(rows, "key string, date date, " + ", ".join(f"{c} double" for c in columns))


def test_kelvin(frame):
    raw = one_key(
        frame,
        {
            "ERA5_temperature_2m_max": [250.0, 301.4, 273.15],
            "ERA5_temperature_2m_min": [231.5, 290.65, 260.15],
        },
    )
    out = canonicalise(raw, ["key"])
    assert values(out, "tmax_c") == pytest.approx([-23.15, 28.25, 0])
    assert values(out, "tmin_c") == pytest.approx([-41.65, 17.5, -13])
    assert values(out, "tmean_c") == pytest.approx([-32.4, 22.875, -6.5])


def test_first_source_wins_and_second_fills(frame):
    raw = one_key(frame, {"DAYMET_tmax": [NAN, 31.75, None], "ERA5_temperature_2m_max": [240.65, 200.0, 274.4]})
    assert values(canonicalise(raw, ["key"]), "tmax_c") == pytest.approx([-32.5, 31.75, 1.25])


def test_metres_and_sign_flip(frame):
    raw = one_key(
        frame,
        {
            "ERA5_total_precipitation_sum": [0.0423, 0.0, 0.00017],
            "ERA5_total_evaporation_sum": [0.0004, -0.0031, -0.00009],
            "ERA5_potential_evaporation_sum": [-0.0077, 0.0, 0.0012],
            "ERA5_snow_depth": [2.375, 0.0, 0.0625],
        },
    )
    out = canonicalise(raw, ["key"])
    assert values(out, "prcp_mm") == pytest.approx([42.3, 0, 0.17])
    assert values(out, "aet_mm") == pytest.approx([-0.4, 3.1, 0.09])
    assert values(out, "pet_mm") == pytest.approx([7.7, 0, -1.2])
    assert values(out, "snow_depth_we_mm") == pytest.approx([2375, 0, 62.5])


def test_wind_and_passthrough(frame):
    raw = one_key(
        frame,
        {
            "ERA5_u_component_of_wind_10m": [-8.0, NAN],
            "ERA5_v_component_of_wind_10m": [15.0, 2.5],
            "DAYMET_vp": [800.0, 900.0],
        },
    )
    out = canonicalise(raw, ["key"])
    assert values(out, "wind_speed_ms") == [17.0, None]
    assert values(out, "vp_pa") == [800.0, 900.0]
    assert "tmax_c" not in out.columns


def test_midpoint_is_decided_by_column_not_by_row(frame):
    temps = {"DAYMET_tmax": [10.0, 20.0], "DAYMET_tmin": [0.0, 10.0]}
    own = one_key(frame, {**temps, "ERA5_temperature_2m": [280.15, None]})
    assert values(canonicalise(own, ["key"]), "tmean_c") == [pytest.approx(7.0), None]
    assert values(canonicalise(one_key(frame, temps), ["key"]), "tmean_c") == [5.0, 15.0]


def test_midpoint_by_mask_in_a_shared_table(frame):
    rows = [("a", day(0), 10.0, 0.0, None), ("b", day(0), 10.0, 0.0, None)]
    raw = frame(rows, "key string, date date, DAYMET_tmax double, DAYMET_tmin double, ERA5_temperature_2m double")
    from pyspark.sql import functions as F

    two = present_columns(["DAYMET_tmax", "DAYMET_tmin"])
    three = present_columns(["DAYMET_tmax", "DAYMET_tmin", "ERA5_temperature_2m"])
    raw = raw.withColumn(PRESENT, F.when(F.col("key") == "a", two).otherwise(three))
    out = canonicalise(raw, ["key"])
    assert values(out, "tmean_c", "key") == [5.0, None]
    mask = values(out, AVAIL, "key")
    assert mask[0] == mask[1]  # both have the variable, one of them empty


def test_dates_are_merged_by_maximum(frame):
    rows = [
        ("k", "2000-01-01", 1.0, NAN),
        ("k", "2000-01-01", NAN, 7.0),
        ("k", "2000-01-02", 1.0, None),
        ("k", "2000-01-02", 3.0, None),
    ]
    out = coalesce_dates(frame(rows, "key string, date string, a double, b double"), ["key"])
    assert [tuple(r) for r in out.orderBy("date").collect()] == [
        ("k", dt.date(2000, 1, 1), 1.0, 7.0),
        ("k", dt.date(2000, 1, 2), 3.0, None),
    ]


def test_parts_average_without_missing(frame):
    rows = [("k", day(0), 1.0, None), ("k", day(0), 3.0, 5.0), ("k", day(1), None, None)]
    out = combine_parts(frame(rows, "key string, date date, a double, b double"), ["key"]).orderBy("date")
    assert [tuple(r)[2:] for r in out.collect()] == [(2.0, 5.0), (None, None)]


def test_weighted_parts(frame):
    rows = [("k", day(0), 1.0, 3.0), ("k", day(0), 5.0, 1.0), ("k", day(0), None, 9.0)]
    out = combine_parts(frame(rows, "key string, date date, a double, w double"), ["key"], weight="w")
    assert out.first()["a"] == 2.0


def test_ragged_union_keeps_all_columns(frame):
    a = frame([("k", day(0), 1.0)], "key string, date date, DAYMET_tmax double")
    b = frame([("k", day(0), 280.0)], "key string, date date, ERA5_temperature_2m double")
    out = export_columns(merge_sources([a, b]), ["DAYMET", "ERA5"], ["key", "date"])
    assert len(out.columns) == 2 + 18
    assert out.columns[2] == "DAYMET_prcp"
    assert out.count() == 2


def test_dataset_choice_mask(frame):
    df = frame([("denali",), ("zion",)], "key string")
    from pyspark.sql import functions as F

    got = {r.key: r[PRESENT] for r in df.withColumn(PRESENT, present_by_dataset_choice(F.col("key"))).collect()}
    assert got["denali"] & DEFAULT_SPEC.source_mask(["DAYMET_tmax"]) == 0
    assert got["zion"] == DEFAULT_SPEC.source_mask(DEFAULT_SPEC.source_columns)


def test_all_missing_sum_is_zero_and_absent_has_no_rows(frame):
    raw = frame(
        [("k", day(i), None, None) for i in range(366)],
        "key string, date date, DAYMET_tmax double, DAYMET_prcp double",
    ).withColumn(PRESENT, present_columns(["DAYMET_tmax", "DAYMET_prcp"]))
    long = to_long(annual(canonicalise(raw, ["key"]), ["key"]), ["key", "year"])
    assert {(r.variable, r.value) for r in long.collect()} == {("tmax_c", None), ("prcp_mm", 0.0)}
    assert not any(math.isnan(r.value) for r in long.collect() if r.value is not None)
