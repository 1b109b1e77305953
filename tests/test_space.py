from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.geometry import circle_polygon
from tidemark.operators import boundary, scaling, zonal
from tidemark.plans.extract import UnknownArea, area_series, cell_membership, daily_series, zones_by_key
from tidemark.sources.registry import small_table

SQUARE = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]
HOLE = [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]
FAR = [[20.0, 0.0], [22.0, 0.0], [22.0, 2.0], [20.0, 2.0], [20.0, 0.0]]


def grid(spark, n=24):
    return spark.range(n * n).select(
        F.col("id").alias("cell_id"),
        F.floor(F.col("id") / n).cast("int").alias("row"),
        (F.col("id") % n).cast("int").alias("col"),
        (F.col("id") % n + 0.5).alias("lon"),
        (F.floor(F.col("id") / n) + 0.5).alias("lat"),
    )


def test_square_with_hole(spark):
    zones = small_table(spark, {"zone": ["z"], "polygons": [[[SQUARE, HOLE]]]})
    for tile in (1.0, 3.0, 100.0):
        assert zonal.assign_cells(grid(spark), zones, ["zone"], tile=tile).count() == 96


def test_random_polygons_against_brute_force(spark):
    rng = random.Random(5)
    shapes, points = {}, [(i, rng.uniform(-5, 15), rng.uniform(-5, 15)) for i in range(400)]
    for k in range(12):
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 30)))
        ring = [[5 + rng.uniform(1, 9) * math.cos(a), 5 + rng.uniform(1, 9) * math.sin(a)] for a in angles]
        shapes[f"z{k}"] = ring + ring[:1] if k % 2 else ring  # open rings count as closed

    def within(x, y, ring):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    want = {(z, i) for z, ring in shapes.items() for i, x, y in points if within(x, y, ring)}
    zones = small_table(spark, {"zone": list(shapes), "polygons": [[[r]] for r in shapes.values()]})
    cells = spark.createDataFrame(points, "cell_id long, lon double, lat double")
    got = zonal.assign_cells(cells, zones, ["zone"], tile=2.0).select("zone", "cell_id").collect()
    assert len(got) == len(want) > 500
    assert {(r.zone, r.cell_id) for r in got} == want


def test_coarsening_keeps_an_even_grid(spark):
    zones = small_table(spark, {"zone": ["z", "far"], "polygons": [[[SQUARE]], [[FAR]]]})
    members = zonal.assign_cells(grid(spark), zones, ["zone"])
    out = {r["zone"]: r["count"] for r in zonal.coarsen(members, 2).groupBy("zone").count().collect()}
    assert out == {"z": 25, "far": 1}
    assert zonal.coarsen(members, 1).count() == members.count()
    with pytest.raises(ValueError):
        zonal.coarsen(members, 0)


def test_parts_and_zonal_mean(spark):
    zones = small_table(spark, {"key": ["k"], "multipart": [True], "polygons": [[[SQUARE], [FAR]]]})
    parts = zones_by_key(zones)
    assert {r.part for r in parts.collect()} == {"part-0", "part-1"}
    cells = grid(spark)
    daily = cells.select("cell_id", F.lit("2000-01-01").cast("date").alias("date"), F.col("lon").alias("b"))
    members = zonal.assign_cells(cells, parts, ["key", "part"])
    means = {r.part: r.b for r in zonal.zonal_mean(daily, members, ["key", "part"], ["b"]).collect()}
    assert means == {"part-0": 5.0, "part-1": 21.0}


def test_part_limit(spark):
    zones = small_table(spark, {"key": ["k"], "polygons": [[[SQUARE]] * 12]})
    assert zonal.split_parts(zones, ["key"]).count() == 12
    assert zonal.split_parts(zones, ["key"], 8).count() == 8


def test_parts_have_the_same_numbers_however_features_arrive(spark):
    rings = [[[[float(i % 5), float(i)], [float(i), 1.0], [2.0, 2.0]]] for i in range(30)]
    layer = spark.createDataFrame(
        [("k", i, 1.0, [r]) for i, r in enumerate(rings)],
        "key string, feature int, GIS_Acres double, polygons array<array<array<array<double>>>>",
    )
    found = []
    for n in (1, 3, 11):
        for order in ([], ["feature"]):
            parts = zonal.split_parts(boundary.merge_units(layer.repartition(n, "feature"), order=order), ["key"])
            found.append([r.polygons for r in parts.orderBy("part_index").collect()])
    assert found[0] == found[2] == found[4] and found[1] == found[3] == found[5]
    assert found[1] == [[r] for r in rings]


def test_area_series(spark):
    zones = small_table(spark, {"key": ["k", "denali"], "multipart": [False, False], "polygons": [[[SQUARE]], [[FAR]]]})
    cells = grid(spark)
    dates = F.explode(F.sequence(F.lit("1999-12-30").cast("date"), F.lit("2000-01-03").cast("date"))).alias("date")
    daily = cells.select("cell_id", "lon", "lat", dates).withColumnsRenamed({"lon": "tmax", "lat": "tmin"})
    members = cell_membership({"DAYMET": cells, "ERA5": cells}, zones_by_key(zones))
    grids, bands = {"DAYMET": daily, "ERA5": daily}, {"DAYMET": ["tmax"], "ERA5": ["tmin"]}
    barred = small_table(spark, {"dataset": ["DAYMET"], "key": ["denali"]})
    out = area_series(grids, members, bands, zones_by_key(zones), "k", "2000-01-01", "2000-01-03", barred).collect()
    assert [r.date.isoformat() for r in out] == ["2000-01-01", "2000-01-02"]  # the end is exclusive
    assert (out[0].part, out[0].DAYMET_tmax, out[0].ERA5_tmin) == ("all", 5.0, 5.0)
    both = daily_series(grids, members, bands, "2000-01-01", "2000-01-02", barred=barred).orderBy("key").collect()
    assert [(r.key, r.DAYMET_tmax, r.ERA5_tmin) for r in both] == [("denali", None, 1.0), ("k", 5.0, 5.0)]
    with pytest.raises(UnknownArea):
        area_series(grids, members, bands, zones_by_key(zones), "nowhere", "2000-01-01", "2000-01-03")


def test_circle_is_closed_and_has_its_area(frame):
    df = frame([(44.6, -110.5, 8983.0), (89.9, 0.0, 0.0)], "lat double, lon double, a double")
    rings = [r.p[0] for r in df.select(circle_polygon(F.col("lat"), F.col("lon"), F.col("a")).alias("p")).collect()]
    assert all(len(r) == 33 and r[0] == r[-1] for r in rings)
    ring = rings[0]
    flat = [((x + 110.5) * 111.32 * math.cos(math.radians(44.6)), (y - 44.6) * 111.32) for x, y in ring]
    area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(flat, flat[1:]))) / 2
    assert area == pytest.approx(8983, rel=0.01)


def test_box_keeps_aspect_and_flips_north(frame):
    df = frame([("k", 0.0, 0.0), ("k", 10.0, 20.0)], "key string, lon double, lat double")
    low, high = scaling.fit_box(df, ["key"]).orderBy("lat").collect()
    assert (high.px - low.px, low.py - high.py) == pytest.approx((17.0, 34.0))
    assert (low.px + high.px) / 2 == pytest.approx(50.0)


def test_sparkline_places_missing_values(frame):
    rows = [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("b", 1, 1.0), ("b", 2, None), ("c", 1, 5.0), ("c", 2, 5.0)]
    out = scaling.sparkline(frame(rows, "key string, year int, value double"), ["key"]).orderBy("key", "year")
    assert [(r.key, r.x, r.y) for r in out.collect()] == [
        ("a", 0.0, 32.0), ("a", 120.0, 4.0), ("c", 0.0, 32.0), ("c", 120.0, 32.0),
    ]


def test_shares_keep_null_groups_and_the_whole_table(frame):
    df = frame([("a", 1.0), ("a", 3.0), (None, 2.0)], "g string, v double")
    by = {(r.g, r.v): (r.pct_of_total, r.pct_of_max) for r in scaling.shares(df, "v", ["g"]).collect()}
    assert by[("a", 1.0)] == pytest.approx((25.0, 100 / 3)) and by[(None, 2.0)] == (100.0, 100.0)
    assert sum(r.pct_of_total for r in scaling.shares(df, "v").collect()) == pytest.approx(100)


def test_fallback_order(spark):
    registry = small_table(
        spark, {"key": ["a", "b", "c", "d"], "lat": [1.0, 1.0, 1.0, None], "lon": [1.0] * 4, "area_km2": [5.0] * 4}
    )
    first = small_table(spark, {"key": ["a"], "polygons": [[[SQUARE]]]})
    second = small_table(spark, {"key": ["a", "b"], "polygons": [[[FAR]], [[FAR]]]})
    got = {r.key: (r.boundary_source, len(r.polygons[0][0])) for r in boundary.with_fallback(registry, first, second).collect()}
    assert got == {"a": ("primary", 5), "b": ("secondary", 5), "c": ("circle", 33)}
    assert boundary.with_fallback(registry, first).count() == 3


def test_several_rows_of_one_zone_count_as_one(spark):
    rows = small_table(spark, {"zone": ["z", "z"], "polygons": [[[SQUARE]], [[FAR]]]})
    merged = small_table(spark, {"zone": ["z"], "polygons": [[[SQUARE], [FAR]]]})
    a, b = (zonal.assign_cells(grid(spark), z, ["zone"]).select("cell_id") for z in (rows, merged))
    assert a.count() == b.count() == 104 and a.exceptAll(b).count() == 0


def test_membership_beyond_the_broadcast_limit_gives_the_same(spark):
    zones = small_table(spark, {"key": ["k"], "multipart": [False], "polygons": [[[SQUARE]]]})
    cells = grid(spark)
    daily = cells.select("cell_id", F.lit("2000-01-01").cast("date").alias("date"), F.col("lon").alias("tmax"))
    members = cell_membership({"DAYMET": cells}, zones_by_key(zones))
    runs = [
        daily_series({"DAYMET": daily}, members, {"DAYMET": ["tmax"]}, "2000-01-01", "2001-01-01", max_broadcast=m)
        for m in (0, 1000)
    ]
    assert runs[0].collect() == runs[1].collect()
    assert "broadcast" in runs[1]._jdf.queryExecution().logical().toString()
    assert "broadcast" not in runs[0]._jdf.queryExecution().logical().toString()
