"""Files, their columns, and what is wrong with them."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregate
from tidemark.operators.canonical import canonicalise, coalesce_dates
from tidemark.sources import catalogue, daily, sinks
from tidemark.spec import DEFAULT_SPEC, PRESENT

COLUMNS = ["DAYMET_tmax", "DAYMET_tmin", "ERA5_snow_depth"]
MASK = DEFAULT_SPEC.source_mask


def save(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def save_parquet(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), str(path))


def days(n, start="2001-03-01"):
    return pd.date_range(start, periods=n)


def ragged(root, kind):
    """Three keys with different columns: two bands, one band and an empty one, and everything."""
    n = 400
    tables = {
        "reef": {"date": days(n), "DAYMET_tmax": [9.0 + i % 7 for i in range(n)], "DAYMET_tmin": [1.0 + i % 5 for i in range(n)]},
        "dune": {"DAYMET_prcp": [0.5 * (i % 3) for i in range(n)], "date": days(n), "DAYMET_swe": [None] * n},
        "moor": {"date": days(n), "DAYMET_tmax": [float(i % 9) for i in range(n)], "DAYMET_tmin": [float(-(i % 4)) for i in range(n)],
                 "ERA5_temperature_2m": [280.0 + i % 11 for i in range(n)]},
    }
    for key, columns in tables.items():
        df = pd.DataFrame(columns)
        (root / key).mkdir(parents=True)
        if kind == "csv":
            df.to_csv(root / key / f"{key}.csv", index=False)
        else:
            if "DAYMET_swe" in df:
                df["DAYMET_swe"] = df["DAYMET_swe"].astype("float64")
            df.to_parquet(root / key / f"{key}.parquet", index=False)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_series_have_the_columns_of_their_files(spark, tmp_path, kind):
    ragged(tmp_path, kind)
    raw = daily.read_raw(spark, str(tmp_path))
    masks = {r.key: r[PRESENT] for r in raw.select("key", PRESENT).distinct().collect()}
    assert masks == {
        "reef": MASK(["DAYMET_tmax", "DAYMET_tmin"]),
        "dune": MASK(["DAYMET_prcp", "DAYMET_swe"]),
        "moor": MASK(["DAYMET_tmax", "DAYMET_tmin", "ERA5_temperature_2m"]),
    }
    c = canonicalise(coalesce_dates(raw, ["key"]), ["key"])
    long = aggregate.to_long(aggregate.annual(c, ["key"], min_rows=300), ["key", "year"])
    year = {(r.key, r.variable): r.value for r in long.where("value IS NOT NULL").collect()}
    # the mean of two bands where a series has no mean of its own, nothing for bands it lacks
    assert year["reef", "tmean_c"] == pytest.approx((year["reef", "tmax_c"] + year["reef", "tmin_c"]) / 2)
    assert year["moor", "tmean_c"] == pytest.approx(280.0 + sum(i % 11 for i in range(306)) / 306 - 273.15)
    assert {v for k, v in year if k == "reef"} == {"tmean_c", "tmax_c", "tmin_c"}
    assert {v for k, v in year if k == "dune"} - {"swe_mm"} == {"prcp_mm"}


def test_both_formats_give_equal_years(spark, tmp_path):
    found = []
    for kind in ("csv", "parquet"):
        ragged(tmp_path / kind, kind)
        raw = daily.read_raw(spark, str(tmp_path / kind))
        years = aggregate.annual(canonicalise(coalesce_dates(raw, ["key"]), ["key"]), ["key"], min_rows=300)
        found.append(sorted(map(str, years.collect())))
    assert found[0] == found[1] and len(found[0]) == 3


@pytest.mark.parametrize("formats", [["csv"], ["parquet"]])
def test_a_mask_that_was_written_is_read(spark, frame, tmp_path, formats):
    day = dt.date(2001, 2, 3)
    rows = [("reef", "all", day, 1.0, None, MASK(["DAYMET_tmax"])), ("moor", "all", day, 1.0, 2.0, MASK(["DAYMET_tmin"]))]
    df = frame(rows, f"key string, part string, date date, DAYMET_tmax double, DAYMET_tmin double, {PRESENT} long")
    sinks.write_daily(df, str(tmp_path / "out"), formats=formats)
    back = daily.read_raw(spark, str(tmp_path / "out" / formats[0]), columns=COLUMNS[:2])
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(rows)


@pytest.mark.parametrize(
    "kind", [pa.date32(), pa.timestamp("ns"), pa.timestamp("us"), pa.timestamp("ms"), pa.timestamp("us", "UTC"), pa.string()], ids=str
)
def test_dates_of_any_type(spark, tmp_path, kind):
    want = [dt.date(1969, 12, 31), dt.date(2024, 2, 29)]
    given = [str(d) for d in want] if kind == pa.string() else want
    dates = pa.array(given).cast(kind) if kind == pa.string() or kind == pa.date32() else pa.array([dt.datetime(d.year, d.month, d.day) for d in want]).cast(kind)
    save_parquet(tmp_path / "reef" / "a.parquet", date=dates, DAYMET_tmax=pa.array([1, 2], pa.int64()), DAYMET_tmin=pa.array([0.5, None], pa.float32()))
    save_parquet(tmp_path / "reef" / "b.parquet", date=pa.array([dt.date(2000, 1, 1)]), ERA5_snow_depth=[7.0])
    rows = daily.read_raw(spark, str(tmp_path), columns=COLUMNS).orderBy("part", "date").collect()
    assert [(r.part, r.date, r.DAYMET_tmax, r.DAYMET_tmin, r.ERA5_snow_depth) for r in rows] == [
        ("a", want[0], 1.0, 0.5, None), ("a", want[1], 2.0, None, None), ("b", dt.date(2000, 1, 1), None, None, 7.0),
    ]


def damaged(root):
    save(root / "good" / "good.csv", "date,DAYMET_tmax,DAYMET_tmin\n2001-01-01,1,\n2001-01-02,x,2\n\n2001-13-01,3,4\n2001-01-04,5\n2001-01-05,NaN,6\n")
    save(root / "upper" / "upper.csv", "Date,DAYMET_tmax\n2001-01-01,1\n")
    save(root / "void" / "void.csv", "\n")
    save(root / "cut" / "cut.parquet", "PAR1 and no more")
    save_parquet(root / "none" / "none.parquet", day=[dt.date(2001, 1, 1)], DAYMET_tmax=[1.0])
    save_parquet(root / "text" / "text.parquet", date=[dt.date(2001, 1, 1)], DAYMET_tmax=["warm"], DAYMET_tmin=[3.0])
    save_parquet(root / "odd" / "odd.parquet", date=[True], DAYMET_tmax=[1.0])


REJECTS = {
    ("good.csv", "2001-01-02,x,2", "not a number: DAYMET_tmax x"),
    ("good.csv", "2001-13-01,3,4", "not a date: 2001-13-01"),
    ("good.csv", "2001-01-04,5", "2 values under 3 columns"),
    ("upper.csv", None, "no column date"),
    ("void.csv", None, catalogue.EMPTY),
    ("cut.parquet", None, catalogue.NOT_PARQUET),
    ("none.parquet", None, "no column date"),
    ("odd.parquet", None, "the column date has no dates"),
    ("text.parquet", None, "not a column of numbers: DAYMET_tmax"),
}


def test_rejects_and_good_rows(spark, tmp_path):
    damaged(tmp_path)
    rows, rejects = daily.read_raw_checked(spark, str(tmp_path), columns=COLUMNS)
    assert {(r.path.split("/")[-1], r.line, r.reason) for r in rejects.collect()} == REJECTS
    got = sorted(((r.key, r.date.day, r.DAYMET_tmax, r.DAYMET_tmin) for r in rows.collect()), key=str)
    assert [x for x in got if x[2] is None or x[2] == x[2]] == sorted([("good", 1, 1.0, None), ("good", 2, None, 2.0), ("good", 4, 5.0, None), ("text", 1, None, 3.0)], key=str)
    assert len(got) == 5  # and the NaN, which is a number
    plain = daily.read_raw(spark, str(tmp_path), columns=COLUMNS)
    assert sorted(map(str, plain.collect())) == sorted(map(str, rows.collect()))


def test_nothing_but_rejects(spark, tmp_path):
    save(tmp_path / "cut" / "cut.parquet", "no")
    rows, rejects = daily.read_raw_checked(spark, str(tmp_path), columns=COLUMNS)
    assert rows.count() == 0 and rows.columns == ["key", "part", "date", *COLUMNS, PRESENT] and rejects.count() == 1


def test_only_files_of_the_keys_are_opened(spark, tmp_path):
    ragged(tmp_path, "csv")
    ragged(tmp_path / "more", "parquet")
    save(tmp_path / "a{b}*" / "x.csv", "date,DAYMET_tmax\n2001-01-01,1\n")

    def opened(df):  # without the tables in the shared folder
        return {f.split("/")[-1] for f in df.inputFiles() if not f.split("/")[-1].startswith("part-")}

    df = daily.read_raw(spark, str(tmp_path), keys=["reef", "a{b}*"])
    assert {r.key for r in df.select("key").distinct().collect()} == {"reef", "a{b}*"}
    assert opened(df) == {"reef.csv", "x.csv"}  # not those below "more", nor other keys
    deeper = daily.read_raw(spark, str(tmp_path / "more" / ".."), keys=["dune"])
    assert opened(deeper) == {"dune.csv"}
    with pytest.raises(FileNotFoundError):
        daily.read_raw(spark, str(tmp_path), keys=["nobody"])


def test_columns_without_access_by_path(spark, tmp_path):
    """Where Python cannot open a path, Spark reads the files."""
    ragged(tmp_path / "x", "parquet")
    damaged(tmp_path / "x")
    root = "viewfs://store/in"
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}/x")
    by_path = catalogue.catalogue(spark, str(tmp_path / "x"))
    by_content = catalogue.catalogue(spark, root)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    shown = [sorted(map(str, f.select(name, "key", "part", "kind", "length", "columns", "header", "problem").collect())) for f in (by_path, by_content)]
    assert shown[0] == shown[1] and len(shown[0]) == 10
    rows, rejects = daily.read_raw_checked(spark, root, columns=COLUMNS)
    assert {(r.path.split("/")[-1], r.line, r.reason) for r in rejects.collect()} == REJECTS
    assert rows.where("key = 'moor'").count() == 400
