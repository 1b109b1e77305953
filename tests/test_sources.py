from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.labels import candidate_stems, file_key, file_stem, part_label
from tidemark import session
from tidemark.operators import chunks
from tidemark.operators.boundary import is_real, schema_gaps
from tidemark.plans import extract
from tidemark.plans.boundaries import PROPERTIES, boundaries_with_slopes
from tidemark.sources import daily, documents, registry, sinks
from tidemark.spec import DEFAULT_SPEC, PRESENT


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_registry(spark):
    df = registry.registry(spark)
    rows = {r.key: r for r in df.collect()}
    assert df.count() == len(rows) == 63
    assert rows["saguaro"].multipart and not rows["yellowstone"].multipart
    assert all(-15 <= r.lat <= 72 and -171 <= r.lon <= -64 and r.area_km2 > 0 for r in rows.values())
    assert df.where("key = 'atlantis'").count() == 0


def test_dimensions(spark):
    assert registry.declared_columns(spark).count() == 18
    assert schema_gaps(registry.used_columns(spark), registry.declared_columns(spark), ["source"]).count() == 0
    assert registry.units(spark).where("key = 'channel-islands'").first().labels[3] == "Anacapa Island"
    alias = {r.alias for r in registry.aliases(spark).where("key = 'white-sands'").collect()}
    assert alias == {"White Sands National Park", "White Sands National Monument"}
    assert registry.warming_bounds(spark).count() == 20
    assert registry.uniqueness(registry.registry(spark), "key").first() == (63, 63)


def test_dataset_choice(spark):
    chosen = registry.choose_datasets(registry.registry(spark))
    by = {r.key: r.n for r in chosen.groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert by["denali"] == 1 and by["zion"] == 2 and sum(by.values()) == 63 * 2 - 10
    scale = {r.key: r.scale for r in registry.finest_scale(chosen).collect()}
    assert (scale["denali"], scale["zion"]) == (11132, 1000)


def test_key_subset(spark):
    df = registry.registry(spark)
    assert registry.only_keys(df, ["zion", "acadia"]).count() == 2
    assert registry.only_keys(df, None).count() == registry.only_keys(df, []).count() == 63


def test_csv_by_name_and_parquet_first(spark, tmp_path):
    write(tmp_path / "a" / "a_part-0.csv", "date,DAYMET_tmax,DAYMET_tmin\n2000-01-01,1.5,-1\n2000-01-02,,NaN\n")
    write(tmp_path / "b" / "b.csv", '"ERA5_snow_depth","date","DAYMET_tmax"\r\n0.5,2000-01-01,7\r\n')
    write(tmp_path / "c" / "c.csv", "date,DAYMET_tmax\n2000-01-01,999\n")
    good = spark.createDataFrame([(dt.date(2000, 1, 1), 3.0)], "date date, DAYMET_tmax double")
    good.coalesce(1).write.parquet(str(tmp_path / "c" / "p"))
    layout = r"/([abc])/(?:p/)?([^/]+)\.(?:csv|parquet)$"
    cols = ["DAYMET_tmax", "DAYMET_tmin", "ERA5_snow_depth"]
    rows = {(r.key, r.date.day): r for r in daily.read_raw(spark, str(tmp_path), layout, cols).collect()}
    assert len(rows) == 4
    assert rows[("a", 1)].part == "a_part-0" and rows[("a", 1)].DAYMET_tmax == 1.5
    assert rows[("a", 2)].DAYMET_tmax is None
    assert rows[("b", 1)].ERA5_snow_depth == 0.5 and rows[("b", 1)].DAYMET_tmax == 7.0
    assert rows[("c", 1)].DAYMET_tmax == 3.0  # not the CSV beside it
    mask = DEFAULT_SPEC.source_mask
    assert rows[("a", 1)][PRESENT] == mask(["DAYMET_tmax", "DAYMET_tmin"])
    assert rows[("b", 1)][PRESENT] == mask(["DAYMET_tmax", "ERA5_snow_depth"])


def test_default_layout_and_missing_folder(spark, tmp_path):
    write(tmp_path / "zion" / "zion.csv", "date,DAYMET_tmax\n2000-01-01,1\n")
    row = daily.read_raw(spark, str(tmp_path)).first()
    assert (row.key, row.part, row.DAYMET_tmax, row.ERA5_snow_depth) == ("zion", "zion", 1.0, None)
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        daily.read_raw(spark, str(empty))


def test_blanks_and_times_in_csv(spark, tmp_path):
    write(tmp_path / "zion" / "zion.csv", " date , DAYMET_tmax\n 2000-01-01 00:00:00 , 1.5 \n2000-01-02,2\n")
    rows = daily.read_raw(spark, str(tmp_path)).orderBy("date").collect()
    assert [(r.date, r.DAYMET_tmax) for r in rows] == [(dt.date(2000, 1, 1), 1.5), (dt.date(2000, 1, 2), 2.0)]


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_what_is_written_is_read_by_the_default_layout(spark, frame, tmp_path, kind):
    rows = [("zion", "all", dt.date(2000, 1, 1), 1.0), ("007", "part-1", dt.date(2000, 1, 2), 2.0)]
    df = frame(rows, "key string, part string, date date, DAYMET_tmax double")
    sinks.write_daily(df, str(tmp_path / "out"))
    back = daily.read_raw(spark, str(tmp_path / "out" / kind), columns=["DAYMET_tmax"])
    assert sorted(tuple(r) for r in back.select(*df.columns).collect()) == sorted(rows)


def test_summaries_by_line_and_by_file(spark, frame, tmp_path):
    docs = frame([(f"k{i}", i) for i in range(20)], "key string, n int").repartition(2)
    sinks.write_summaries(docs, str(tmp_path / "lines"), folders=False)
    assert documents.read_summaries(spark, str(tmp_path / "lines"), docs.schema).count() == 20
    write(tmp_path / "whole" / "a.json", '{"key": "a",\n "n": 1}')
    whole = documents.read_summaries(spark, str(tmp_path / "whole"), docs.schema, whole_files=True)
    assert [tuple(r) for r in whole.collect()] == [("a", 1)]


def test_gzip_part_only_where_there_are_several(spark, tmp_path):
    for key, part in [("a", "a_part-0"), ("a", "a_part-1"), ("b", "b")]:
        (tmp_path / key).mkdir(exist_ok=True)
        with gzip.open(tmp_path / key / f"{part}.csv.gz", "wt") as f:
            f.write("date,DAYMET_tmax\n2000-01-01,1\n")
    got = {(r.key, r.part) for r in daily.read_gzipped(spark, str(tmp_path)).collect()}
    assert got == {("a", "a_part-0"), ("a", "a_part-1"), ("b", None)}


def test_boundary_forms(spark, tmp_path):
    square = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    feature = {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": square}, "properties": {"slug": "x"}}
    many = {**feature, "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}}
    flagged = {**feature, "properties": {"approximate": True}}
    docs = {
        "bare": feature,
        "real": {"type": "FeatureCollection", "features": [many, feature]},
        "circle": {"type": "FeatureCollection", "features": [flagged]},
        "empty": {"type": "FeatureCollection", "features": []},
    }
    for name, doc in docs.items():
        write(tmp_path / f"{name}.geojson", json.dumps(doc, indent=1))
    files = documents.read_boundaries(spark, str(tmp_path))
    real = {r.key: r.r for r in files.select("key", is_real(F.col("features")).alias("r")).collect()}
    assert real == {"bare": True, "real": True, "circle": False, "empty": False}
    sizes = {(r.key, r.feature): len(r.polygons) for r in documents.feature_polygons(files).collect()}
    assert sizes == {("bare", 0): 1, ("real", 0): 2, ("real", 1): 1, ("circle", 0): 1}


def test_boundaries_written_with_slopes_and_nulls(spark, frame, tmp_path):
    reg = registry.registry(spark).where("key in ('zion', 'acadia')")
    none = documents.parse_boundaries(frame([("zion", "not json")], "key string, value string"))
    trends = frame(
        [("zion", "tmean_c", 0.1, True)], "key string, variable string, slope_per_year double, significant_95 boolean"
    )
    done = boundaries_with_slopes(reg, none, trends)
    sinks.write_boundaries(done, str(tmp_path / "out"), PROPERTIES)
    lines = spark.read.text(str(tmp_path / "out" / "all_keys")).collect()
    props = {p["key"]: p for p in (json.loads(r.value)["properties"] for r in lines)}
    assert props["zion"]["tmean_slope"] == 0.1 and props["zion"]["approximate"] is True
    assert props["acadia"]["tmean_slope"] is None and "prcp_sig" in props["acadia"]
    one = json.loads(spark.read.text(str(tmp_path / "out" / "by_key" / "key=zion")).first().value)
    assert one["type"] == "FeatureCollection" and len(one["features"][0]["geometry"]["coordinates"][0]) == 33


def test_files_of_keys_are_written_by_many_tasks(spark, frame, tmp_path):
    square = [[[[0.0, 0.0], [1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]]]
    keys = [*(f"k {i}" for i in range(60)), "k 7", None]
    rows = frame([(k, f"n{i}", square) for i, k in enumerate(keys)], "key string, unit_name string, polygons array<array<array<array<double>>>>")
    sinks.write_boundaries(rows.coalesce(1), str(tmp_path / "out"), ["unit_name"], files_per_task=10)
    files = [*(tmp_path / "out" / "by_key").glob("key=*/part-*")]
    assert len(files) == 61 and len({f.name.split("-")[1] for f in files}) > 3

    group = "files-of-keys"
    spark.sparkContext.setJobGroup(group, group)
    with session.listing_in(spark, 8):
        assert spark.read.text(str(tmp_path / "out" / "by_key")).count() == 62
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    assert spark.conf.get(listing, None) is None
    tracker = spark.sparkContext.statusTracker()
    first = tracker.getJobInfo(min(tracker.getJobIdsForGroup(group)))
    assert tracker.getStageInfo(first.stageIds[0]).numTasks == 8  # not one for each of 61 folders

    back = documents.feature_polygons(documents.read_boundaries_by_key(spark, str(tmp_path / "out" / "by_key")))
    got = sorted((r.key, r.properties.unit_name, r.polygons) for r in back.collect())
    escaped = [(k or "__HIVE_DEFAULT_PARTITION__").replace(" ", "%20") for k in keys]
    assert got == sorted((k, f"n{i}", square) for i, k in enumerate(escaped))


def test_layer_reads_only_what_it_needs(frame, spark, tmp_path):
    path = str(tmp_path / "layer")
    frame([("a", "NPS", 1.0), ("b", "BLM", 2.0)], "Unit_Nm string, Mang_Name string, GIS_Acres double").write.parquet(path)
    df = documents.read_layer(spark, path, ["Unit_Nm"])
    assert [tuple(r) for r in df.collect()] == [("a",)]
    plan = df._jdf.queryExecution().toString()
    assert "EqualTo(Mang_Name,NPS)" in plan and "GIS_Acres" not in plan.split("ReadSchema")[1]


def test_stems_and_parts(frame):
    df = frame([("zion", False, 0), ("saguaro", True, 1)], "key string, m boolean, i int")
    stem = file_stem(F.col("key"), part_label(F.col("m"), F.col("i")))
    got = [r.s for r in df.select(stem.alias("s")).collect()]
    assert got == ["zion", "saguaro_part-1"]
    keys = df.select(file_key(stem).alias("k"), candidate_stems(F.col("key"), F.when(F.col("m"), 14).otherwise(0)).alias("c"), stem.alias("s")).collect()
    assert [len(r.c) for r in keys] == [1, 15] and all(r.s in r.c for r in keys) and keys[1].k == "saguaro"


@pytest.mark.parametrize(
    "start, end, want",
    [
        ("2003-05-07", "2003-05-07", [("2003-01-01", "2004-01-01")]),
        ("1996-02-29", "2002-01-01", [("1996-01-01", "2001-01-01"), ("2001-01-01", "2003-01-01")]),
        ("1990-12-31", "1999-12-31", [("1990-01-01", "1995-01-01"), ("1995-01-01", "2000-01-01")]),
        ("2011-01-02", "2011-01-01", [("2011-01-01", "2012-01-01")]),
        ("2012-01-01", "2011-12-31", []),
    ],
)
def test_chunks(frame, start, end, want):
    df = frame([(start, end)], "start string, end string").select(
        F.to_date("start").alias("start"), F.to_date("end").alias("end")
    )
    out = chunks.explode_chunks(df, []).orderBy("chunk_start").collect()
    assert [(r.chunk_start.isoformat(), r.chunk_end.isoformat()) for r in out] == want


def test_chunks_of_another_width(frame):
    df = frame([(dt.date(2000, 7, 1), dt.date(2006, 2, 1))], "start date, end date")
    out = chunks.explode_chunks(df, [], years=3).orderBy("chunk_start").collect()
    assert [(r.chunk_start.year, r.chunk_end.year) for r in out] == [(2000, 2003), (2003, 2006), (2006, 2007)]


def test_features_equal_the_small_reader(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    feature = [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[x + i, y] for x, y in ring]]}, "properties": {"slug": f's {{"{i}'}} for i in range(50)]
    for name, indent in (("tight", None), ("wide", 2)):
        write(tmp_path / f"{name}.geojson", json.dumps({"type": "FeatureCollection", "features": feature}, indent=indent))
    whole = documents.feature_polygons(documents.read_boundaries(spark, str(tmp_path))).select("key", "properties", "polygons")
    split = documents.read_features(spark, str(tmp_path))
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect())) and split.count() == 100


def test_cells_in_buckets_are_not_moved(spark, frame, tmp_path):
    cells = frame([(i % 40, dt.date(2000, 1, 1 + i // 40), float(i)) for i in range(400)], "cell_id int, date date, tmax double")
    stored = extract.store_by_cell(cells, "cells_in_buckets", str(tmp_path / "cells"), 4)
    members = frame([("DAYMET", i, "k", f"p{i % 2}") for i in range(0, 40, 3)], "dataset string, cell_id int, key string, part string")
    run = lambda c: extract.daily_series({"DAYMET": c}, members, {"DAYMET": ["tmax"]}, "2000-01-01", "2000-02-01", max_broadcast=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got, want = run(stored), run(cells)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 20
        def moved(df):
            plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
            return plan.count("Exchange hashpartitioning(cell_id")

        assert (moved(got), moved(want)) == (1, 2)  # the membership alone, and both
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE cells_in_buckets")


def test_a_shared_folder_is_required_off_local():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError):
        session.shared_folder(Session)


def test_first_fetch_wins(frame):
    rows = [("k", 1, 2, "late"), ("k", 1, 1, "early"), ("k", 2, 2, "only"), ("k", 3, 1, None), ("k", 3, 2, "x")]
    out = chunks.first_fetch_wins(frame(rows, "key string, date int, chunk int, v string"), ["key"], ["chunk"])
    assert [r.v for r in out.orderBy("date").collect()] == ["early", "only", None]
