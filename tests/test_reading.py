"""Labels, colours, browsing, audit and documents."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import colour, labels, values
from tidemark.operators import browse, qc
from tidemark.operators.canonical import canonicalise, coalesce_dates, present_by_dataset_choice
from tidemark.plans.audit import audit
from tidemark.plans.summary import INDEX_FIELDS, Thresholds, index_documents, summary_documents, summary_tables
from tidemark.sources import registry, sinks
from tidemark.spec import PRESENT

NAN, INF = float("nan"), float("inf")


def column(frame, data, kind, f):
    rows = frame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r.o for r in rows.orderBy("i").select(f(F.col("v")).alias("o")).collect()]


def test_number_labels(frame):
    assert column(frame, [0.1234, -0.5, 0.0, None, NAN], "double", labels.slope_label) == [
        "+0.123", "-0.500", "0.000", "—", "—",
    ]
    assert column(frame, [0.0001, 0.05, None], "double", labels.p_label) == ["p < 0.001", "p = 0.050", "—"]
    assert column(frame, [0.1, None], "double", lambda c: labels.total_label(c, F.lit(46))) == ["+4.50", "—"]


def test_name_labels(frame):
    assert column(frame, ["wrangell-st-elias"], "string", labels.kebab_to_title) == ["Wrangell St Elias"]
    assert column(frame, ["soil_temp_c", "mm", "tmax_c"], "string", labels.humanize) == ["Soil temp", "mm", "Tmax"]
    assert column(
        frame, ["Zion National Park", "Denali National Park and Preserve", "National Park of X"], "string", labels.short_name
    ) == ["Zion", "Denali", "National Park of X"]


def test_state_labels(frame):
    assert column(frame, ["CA,NV", "UT", "XX", "TN/NC", ""], "string", labels.state_search_key) == [
        "ca california nv nevada", "ut utah", "xx", "tn tennessee nc north carolina", "",
    ]
    assert column(frame, ["CA,NV", "WY, MT", "XX", ""], "string", labels.region_of) == [
        "California", "Rockies", "Other", "Other",
    ]


def test_colours(frame):
    assert column(frame, [-9.0, -3.0, -1.5, 0.0, 0.75, 3.0, None, NAN], "double", colour.stripe_colour) == [
        "rgb(5,48,97)", "rgb(5,48,97)", "rgb(67,147,195)", "rgb(247,247,247)", "rgb(231,172,162)", "rgb(103,0,31)",
        "#f7f7f7", "#f7f7f7",
    ]
    assert column(frame, [0.0, 10.0, None], "double", lambda c: colour.label_colour(c, F.lit(0.0), F.lit(10.0))) == [
        "rgb(200,155,15)", "rgb(60,10,25)", "#8a8480",
    ]


def test_numbers_finite_everywhere(frame):
    df = frame([(1, [NAN, 1.0], {"a": INF}, (NAN, [(-INF,)]))], "i int, a array<double>, m map<string,double>, s struct<x:double,y:array<struct<z:double>>>")
    r = values.numbers_finite(df).first()
    assert (r.a, r.m, r.s.x, r.s.y[0].z) == ([None, 1.0], {"a": None}, None, None)


def test_fahrenheit(frame):
    assert column(frame, [0.0, 100.0], "double", values.celsius_to_fahrenheit) == [32.0, 212.0]
    assert column(frame, [1.0], "double", values.celsius_change_to_fahrenheit) == [1.8]


TRENDS = "key string, variable string, n int, slope_per_year double, intercept double, total_change double, p_value double, significant_95 boolean"


@pytest.fixture
def rows(frame, spark):
    t = [
        ("zion", "tmean_c", 46, 0.04, 1.0, 1.8, 0.01, True),
        ("zion", "prcp_mm", 46, -1.0, 1.0, -45.0, 0.5, False),
        ("acadia", "tmean_c", 46, 0.02, 1.0, 0.9, 0.2, False),
        ("denali", "prcp_mm", 46, 0.0, 0.0, 0.0, 1.0, False),
    ]
    reg = registry.only_keys(registry.registry(spark), ["zion", "acadia", "denali"]).select("key", "unit_name", "state")
    return browse.overview(reg, frame(t, TRENDS))


def test_browse(rows):
    def keys(**kw):
        return [r.key for r in browse.browse(rows, **kw).collect()]

    assert keys() == ["acadia", "denali", "zion"]
    assert keys(text="  UTAH ") == ["zion"] and keys(text="nali") == ["denali"]
    assert keys(region="East") == ["acadia"] and keys(significant_only=True) == ["zion"]
    assert keys(sort="warming") == ["zion", "acadia", "denali"]
    assert keys(sort="cooling") == ["denali", "acadia", "zion"]
    assert keys(sort="drier") == ["zion", "acadia", "denali"]
    assert {r.key: r.no_data for r in rows.collect()} == {"zion": False, "acadia": False, "denali": True}


def test_region_strip(rows):
    out = browse.region_strip(rows).collect()
    assert [(r.region, r.key) for r in out] == [("East", "acadia"), ("Southwest", "zion")]
    assert {(r.axis_min, r.axis_max) for r in out} == {(0, 4)}


def test_display_decomposition(frame):
    df = frame(
        [("tmax_c", [0.0, None], [None, 100.0], [([2000, 2001], [(1, 0.0, 0.0, 100.0)])]), ("prcp_mm", [5.0], [5.0], [])],
        "variable string, observed array<double>, trend array<double>, climatology array<struct<period:array<int>,values:array<struct<month:int,mean:double,p10:double,p90:double>>>>",
    )
    hot, wet = browse.display_decomposition(df).collect()
    assert hot.observed == [32.0, None] and hot.trend == [None, 212.0]
    assert tuple(hot.climatology[0]["values"][0]) == (1, 32.0, 32.0, 212.0)
    assert wet.observed == [5.0]


def test_range_check_quotes_the_first_violator(frame):
    rows = [("k", y, "tmean_c", v) for y, v in [(2001, 50.0), (2000, 40.0), (1999, 10.0), (1998, None)]]
    rows.append(("k", 2000, "unknown", 1e9))
    out = qc.check_ranges(frame(rows, "key string, year int, variable string, value double")).collect()
    assert [(r.variable, r.status, r.note) for r in out] == [
        ("tmean_c", "FAIL", "in 2000 the value 40.000 leaves the band from -25.0 to 35.0")
    ]


def test_consistency(frame):
    rows = [
        ("a", "v", 46, 0.1, 0.0, 1.0, 0.2, True),
        ("b", "v", 46, 0.0, 0.0, 0.0, 0.01, True),
        ("c", "v", 46, 0.1, 0.0, 1.0, 0.01, True),
        ("d", "v", 46, 0.1, 0.0, 1.0, None, False),
    ]
    out = {r.key: (r.check, r.status, r.note) for r in qc.check_consistency(frame(rows, TRENDS)).collect()}
    assert out == {
        "a": ("significance flag", "FAIL", "flag is true at a p-value of 0.2000"),
        "b": ("flat but significant", "WARN", "significant although the slope is zero, as where most values are"),
    }


def test_external_bounds(spark, frame):
    rows = [("zion", "tmean_c", 11, 0.1, 0.0, 1.0, 0.2, True), ("acadia", "tmean_c", 11, 0.9, 0.0, 1.0, 0.2, True)]
    bounds = frame([("zion", 0.5, 2.0, "s"), ("acadia", 0.5, 2.0, "s"), ("denali", 0.5, 2.0, "s"), ("other", 0.0, 1.0, "s")],
                   "key string, lo double, hi double, source string")
    keys = frame([("zion",), ("acadia",), ("denali",)], "key string")
    out = {r.key: (r.status, r.note) for r in qc.check_external(frame(rows, TRENDS), bounds, keys).collect()}
    assert out["zion"] == ("PASS", "+1.00 °C in 11 years, within +0.5 to +2.0 (s)")
    assert out["acadia"][0] == "WARN" and out["denali"] == ("FAIL", "the key has no trend of tmean_c")
    assert len(out) == 3


def test_summaries_of_several_keys(spark, frame, tmp_path):
    """Two parts, an ERA5-only key, and an island whose values are all missing."""
    first = dt.date(1990, 1, 1)
    rows = []
    for i in range(365 * 13 + 3):
        d = first + dt.timedelta(days=i)
        t = 10 + 0.1 * i / 365 + (i % 30) / 10
        rows += [("saguaro", "saguaro_part-0", d, t, t - 5, 2.0, None), ("saguaro", "saguaro_part-1", d, t + 2, t - 3, 4.0, None)]
        rows += [("denali", "denali", d, None, None, None, t + 273.15), ("virgin-islands", "virgin-islands", d, None, None, None, None)]
    raw = frame(rows, "key string, part string, date date, DAYMET_tmax double, DAYMET_tmin double, DAYMET_prcp double, ERA5_temperature_2m double")
    raw = raw.withColumn(PRESENT, present_by_dataset_choice(F.col("key")))
    canonical = canonicalise(coalesce_dates(raw, ["key", "part"]), ["key", "part"])
    tables = summary_tables(canonical, limits=Thresholds(reference=(1990, 2000), periods=((1990, 1995), (1996, 2002))))
    docs = summary_documents(tables, registry.registry(spark))
    by = {r.key: r for r in docs.collect()}
    assert set(by) == {"saguaro", "denali", "virgin-islands"}

    s = by["saguaro"]
    assert s.parts == ["saguaro_part-0", "saguaro_part-1"] and s.period.start_year == 1990
    assert s.annual[1].prcp_mm == pytest.approx(3.0 * 365)
    # The series has ERA5 mean temperature as a column of its own, empty here.
    assert set(s.headline_trends) == {"tmax_c", "tmin_c", "prcp_mm"}
    assert s.headline_trends["tmax_c"].slope_per_year == pytest.approx(0.1, rel=0.05)
    assert len(s.part_summaries["saguaro_part-0"].annual) == 13
    assert set(s.decomposition) == {"tmax_c", "tmin_c", "prcp_mm"}

    d = by["denali"]
    # A key with ERA5 alone has its variables; what no source of it has is null, not an empty sum.
    assert d.annual[1].tmean_c is not None and d.annual[1].tmax_c is None
    assert set(d.headline_trends) == {"tmean_c"} and len(d.stripes) == 13
    assert {t.variable for t in d.trends} == {"tmean_c"}

    # Missing temperatures have no trend; missing precipitation sums to a flat zero,
    # where the series has such a column.
    v = by["virgin-islands"]
    assert v.headline_trends is None and [t.variable for t in v.trends] == []

    path = str(tmp_path / "docs")
    sinks.write_summaries(docs, path)
    text = json.loads(spark.read.text(f"{path}/key=virgin-islands").first().value)
    assert text["headline_trends"] is None and text["unit_name"] == "Virgin Islands National Park"
    sinks.write_index(index_documents(docs), str(tmp_path / "index"), INDEX_FIELDS)
    index = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "index")).collect()]
    assert sorted(p["key"] for p in index) == sorted(by)

    bounds = registry.warming_bounds(spark)
    findings = audit(canonical.drop("part"), tables.annual, tables.trends, bounds)
    assert {(r.key, r.check, r.status) for r in findings.collect()} >= {("denali", "published warming range", "PASS")}
