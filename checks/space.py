"""Zones, outlines and boundary layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import SQL_REGISTRY, query, rounded, supplier_registry, table
from checks.trend import SUPPLIER_TRENDS, supplier_trends
from tidemark import fixed_values as fixed
from tidemark.functions import labels
from tidemark.functions.geometry import circle_polygon
from tidemark.operators import boundary, scaling, zonal
from tidemark.plans import boundaries, extract
from tidemark.plans.extract import cell_membership, daily_series
from tidemark.session import new_folder
from tidemark.sources import documents, sinks
from tidemark.sources.registry import choose_datasets, datasets, finest_scale, small_table, uniqueness
from tidemark.spec import DEFAULT_SPEC

# Outlines over the plane of account balance / 100 (x) and nation (y): a square with a
# square hole, a triangle, and two separate strips of one zone.
ZONES: dict[str, list[list[list[list[float]]]]] = {
    "frame": [
        [
            [[5.5, 2.5], [60.25, 2.5], [60.25, 20.5], [5.5, 20.5], [5.5, 2.5]],
            [[20.75, 6.5], [40.25, 6.5], [40.25, 14.5], [20.75, 14.5], [20.75, 6.5]],
        ]
    ],
    "wedge": [[[[30.125, -0.5], [95.375, 12.25], [30.125, 24.75], [30.125, -0.5]]]],
    "strips": [
        [[[-9.5, 0.5], [-2.25, 0.5], [-2.25, 23.5], [-9.5, 23.5], [-9.5, 0.5]]],
        [[[70.5, 1.5], [90.25, 1.5], [90.25, 5.5], [70.5, 5.5], [70.5, 1.5]]],
    ],
}


def zones(spark: SparkSession) -> DataFrame:
    return small_table(spark, {"zone": list(ZONES), "polygons": list(ZONES.values())})


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Customers as cells of a plane."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("cell_id"),
        (F.col("c_acctbal") / 100).alias("lon"),
        F.col("c_nationkey").cast("double").alias("lat"),
        (F.col("c_custkey") / 40).cast("int").alias("row"),
        (F.col("c_custkey") % 40).cast("int").alias("col"),
    )


def _edges_sql(by_part: bool) -> str:
    rows = []
    for name, polygons in ZONES.items():
        for part, rings in enumerate(polygons):
            for ring in rings:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                    rows.append(f"('{name}', {part}, {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)")
    ids = "zone, part_index" if by_part else "zone"
    return f"""edges(zone, part_index, x1, y1, x2, y2) AS (VALUES {', '.join(rows)}),
cells AS (SELECT c_custkey AS cell_id, c_acctbal / 100 AS lon, c_nationkey::DOUBLE AS lat,
  CAST(floor(c_custkey / 40) AS INTEGER) AS row, CAST(c_custkey % 40 AS INTEGER) AS col FROM customer),
cell_zone AS (SELECT {ids}, cell_id, row, col FROM edges JOIN cells
  ON (y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1)
  GROUP BY ALL HAVING count(*) % 2 = 1)"""


@query(f"WITH {_edges_sql(False)} SELECT zone, cell_id FROM cell_zone")
def point_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    return zonal.assign_cells(cells(spark, d), zones(spark), ["zone"], tile=5.0).select("zone", "cell_id")


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("cell_id"), F.to_date("o_orderdate").alias("date"),
        F.round("o_totalprice").alias("price"), F.ascii("o_orderstatus").cast("double").alias("status"),
    )


_ORDERS = """daily AS (SELECT o_custkey AS cell_id, CAST(o_orderdate AS DATE) AS date, round(o_totalprice) AS price,
  CAST(ascii(o_orderstatus) AS DOUBLE) AS status FROM orders)"""


@query(
    f"""WITH {_edges_sql(False)}, {_ORDERS} SELECT zone, date, round(avg(price), 6) AS price, round(avg(status), 6) AS status
FROM daily JOIN cell_zone USING (cell_id) GROUP BY ALL"""
)
def zonal_join_mean(spark: SparkSession, d: str) -> DataFrame:
    members = zonal.assign_cells(cells(spark, d), zones(spark), ["zone"], tile=5.0)
    return rounded(zonal.zonal_mean(_orders(spark, d), members, ["zone"], ["price", "status"]), "price", "status")


@query(
    f"""WITH {_edges_sql(True)}, {_ORDERS} SELECT zone, part_index, date, round(avg(price), 6) AS price
FROM daily JOIN cell_zone USING (cell_id) GROUP BY ALL"""
)
def zonal_mean_by_part(spark: SparkSession, d: str) -> DataFrame:
    ids = ["zone", "part_index"]
    parts = zonal.split_parts(zones(spark), ["zone"])
    members = zonal.assign_cells(cells(spark, d), parts, ids, tile=5.0)
    return rounded(zonal.zonal_mean(_orders(spark, d), members, ids, ["price"]), "price")


@query(
    f"""WITH {_edges_sql(False)}
SELECT zone, cell_id, row, col FROM cell_zone WHERE row % 3 = 0 AND col % 3 = 0"""
)
def zonal_coarsened(spark: SparkSession, d: str) -> DataFrame:
    members = zonal.assign_cells(cells(spark, d), zones(spark), ["zone"], tile=5.0)
    return zonal.coarsen(members, 3).select("zone", "cell_id", "row", "col")


@query(
    f"""WITH {_edges_sql(True)}, {_ORDERS} SELECT zone AS key, CASE zone WHEN 'strips' THEN 'part-' || part_index ELSE 'all' END AS part,
  date, round(avg(price), 6) AS "ERA5_price" FROM daily JOIN cell_zone USING (cell_id)
WHERE date >= '1996-01-01' AND date < '1998-01-01' AND zone <> 'wedge' GROUP BY ALL"""
)
def exported_areas(spark: SparkSession, d: str) -> DataFrame:
    """Two of three zones exported to files, one of them by part, and read again."""
    path = new_folder(spark, "export")
    boundaries = zones(spark).select(F.col("zone").alias("key"), (F.col("zone") == "strips").alias("multipart"), "polygons")
    extract.export_areas(
        {"ERA5": _orders(spark, d)}, {"ERA5": cells(spark, d)}, {"ERA5": ["price"]}, boundaries,
        "1996-01-01", "1998-01-01", path, keys=["frame", "strips"], tile=5.0,
    )
    return rounded(spark.read.parquet(f"{path}/parquet").drop("_present"), "ERA5_price")


_HAS_TMAX, _HAS_SNOW = (DEFAULT_SPEC.source_mask([c]) for c in ("DAYMET_tmax", "ERA5_snow_cover"))


@query(
    f"""WITH {_edges_sql(True)}, {_ORDERS}, served AS (SELECT *, zone = 'strips' AS only_era5 FROM cell_zone),
a AS (SELECT zone AS key, part_index AS part, date, avg(price) AS p FROM daily JOIN served USING (cell_id)
  WHERE NOT only_era5 AND date >= '1996-01-01' AND date < '1998-01-01' GROUP BY ALL),
b AS (SELECT zone AS key, part_index AS part, date, avg(status) AS s FROM daily JOIN served USING (cell_id)
  WHERE date >= '1996-01-01' AND date < '1998-01-01' GROUP BY ALL)
SELECT coalesce(a.key, b.key) AS key, coalesce(a.part, b.part) AS part, coalesce(a.date, b.date) AS date,
  round(p, 6) AS "DAYMET_tmax", round(s, 6) AS "ERA5_snow_cover",
  CAST(CASE WHEN coalesce(a.key, b.key) = 'strips' THEN 0 ELSE {_HAS_TMAX} END + {_HAS_SNOW} AS BIGINT) AS present
FROM a FULL JOIN b ON a.key = b.key AND a.part = b.part AND a.date = b.date"""
)
def daily_series_of_areas(spark: SparkSession, d: str) -> DataFrame:
    """Two sources with their own grids and bands, one of which does not serve one zone: it has no such column there."""
    parts = zonal.split_parts(zones(spark), ["zone"]).withColumnsRenamed({"zone": "key", "part_index": "part"})
    grid = cells(spark, d)
    members = cell_membership({"DAYMET": grid, "ERA5": grid}, parts, tile=5.0)
    barred = small_table(spark, {"dataset": ["DAYMET"], "key": ["strips"]})
    daily = _orders(spark, d)
    daily = daily.withColumnsRenamed({"price": "tmax", "status": "snow_cover"})
    bands = {"DAYMET": ["tmax"], "ERA5": ["snow_cover"]}
    out = daily_series({"DAYMET": daily, "ERA5": daily}, members, bands, "1996-01-01", "1998-01-01", barred=barred)
    return rounded(out.withColumnRenamed("_present", "present"), "DAYMET_tmax", "ERA5_snow_cover")


# ---- outlines -----------------------------------------------------------------------


@query(
    f"""WITH {SQL_REGISTRY}, reach AS (SELECT key, lat, lon, sqrt(greatest(area_km2, 0.05) / pi()) / 111.32 AS up FROM registry),
wide AS (SELECT *, up / greatest(cos(radians(lat)), 0.05) AS side FROM reach),
corners AS (SELECT *, unnest(range(0, 33)) AS corner FROM wide)
SELECT key, CAST(corner AS INTEGER) AS corner, round(lon + side * cos(2 * pi() * (corner % 32) / 32), 6) AS x,
  round(lat + up * sin(2 * pi() * (corner % 32) / 32), 6) AS y FROM corners"""
)
def circle_polygons(spark: SparkSession, d: str) -> DataFrame:
    r = supplier_registry(spark, d)
    ring = circle_polygon(F.col("lat"), F.col("lon"), F.col("area_km2"))[0]
    points = r.select("key", F.posexplode(ring).alias("corner", "p"))
    return rounded(points.select("key", "corner", F.col("p")[0].alias("x"), F.col("p")[1].alias("y")), "x", "y")


@query(
    """WITH points AS (SELECT c_nationkey AS key, c_custkey, c_acctbal / 100 AS lon, c_custkey / 50 AS lat FROM customer),
ext AS (SELECT *, min(lon) OVER k AS x0, greatest(max(lon) OVER k - min(lon) OVER k, 1e-6) AS w, max(lat) OVER k AS y1,
    greatest(max(lat) OVER k - min(lat) OVER k, 1e-6) AS h FROM points WINDOW k AS (PARTITION BY key)),
sc AS (SELECT *, least(88.0 / w, 34.0 / h) AS f FROM ext)
SELECT key, c_custkey, round((100.0 - w * f) / 2 + (lon - x0) * f, 6) AS px, round((46.0 - h * f) / 2 + (y1 - lat) * f, 6) AS py
FROM sc"""
)
def outline_in_box(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "customer").select(
        F.col("c_nationkey").alias("key"), "c_custkey", (F.col("c_acctbal") / 100).alias("lon"),
        (F.col("c_custkey") / 50).alias("lat"),
    )
    return rounded(scaling.fit_box(points, ["key"]).drop("lon", "lat"), "px", "py")


@query(
    """WITH yearly AS (SELECT l_suppkey AS key, CAST(year(l_shipdate) AS INTEGER) AS year,
    CASE WHEN min(l_linenumber) < 3 AND sum(l_quantity) % 7 <> 0 THEN sum(l_quantity) END AS value FROM lineitem GROUP BY ALL),
ext AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY year) - 1 AS i, count(*) OVER k AS n, count(value) OVER k AS known,
    min(value) OVER k AS low, max(value) OVER k AS high FROM yearly WINDOW k AS (PARTITION BY key))
SELECT key, year, value, round(i / (n - 1) * 120.0, 6) AS x,
  round(32.0 - (value - low) / CASE WHEN high = low THEN 1.0 ELSE high - low END * 28.0, 6) AS y
FROM ext WHERE known >= 2 AND value IS NOT NULL"""
)
def sparkline_points(spark: SparkSession, d: str) -> DataFrame:
    """Yearly sums; multiples of seven play missing values."""
    total = F.sum("l_quantity")
    yearly = table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").alias("key"), F.year("l_shipdate").alias("year")
    ).agg(F.when((F.min("l_linenumber") < 3) & (total % 7 != 0), total).alias("value"))
    return rounded(scaling.sparkline(yearly, ["key"]), "x", "y")


@query(
    """SELECT l_returnflag, l_orderkey, l_linenumber, round(l_quantity * 100.0 / sum(l_quantity) OVER f, 9) AS pct_of_total,
  round(l_quantity * 100.0 / max(l_quantity) OVER f, 6) AS pct_of_max FROM lineitem WINDOW f AS (PARTITION BY l_returnflag)"""
)
def share_of_total(spark: SparkSession, d: str) -> DataFrame:
    """Three groups, each a third of the table: totals are joined back, not windowed."""
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    out = scaling.shares(rows, "l_quantity", ["l_returnflag"]).drop("l_quantity")
    return rounded(rounded(out, "pct_of_total", digits=9), "pct_of_max")


# ---- boundary layers ------------------------------------------------------------------


def layer(spark: SparkSession, d: str) -> DataFrame:
    """Customers as features of a polygon layer, each a triangle."""
    x, y = F.col("c_acctbal") / 100, F.col("c_nationkey").cast("double")
    ring = F.array(F.array(x, y), F.array(x + 1, y), F.array(x, y + 1), F.array(x, y))
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("feature_id"),
        F.concat(F.lit("Unit "), (F.col("c_custkey") % 97).cast("string")).alias("Unit_Nm"),
        F.when(F.col("c_mktsegment") == "BUILDING", "NPS").otherwise("BLM").alias("Mang_Name"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "FED").otherwise("STAT").alias("Mang_Type"),
        F.floor("c_acctbal").cast("double").alias("GIS_Acres"),
        F.array(F.array(ring)).alias("polygons"),
    )


def supplier_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Two layer names per supplier."""
    names = F.array(
        F.concat(F.lit("Unit "), F.col("s_suppkey").cast("string")),
        F.concat(F.lit("Old unit "), F.col("s_suppkey").cast("string")),
    )
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.explode(names).alias("alias"))


_LAYER = """layer AS (SELECT c_custkey AS feature_id, 'Unit ' || c_custkey % 97 AS unit_nm, floor(c_acctbal) AS acres,
  c_acctbal / 100 AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
names AS (SELECT s_suppkey AS key, 'Unit ' || s_suppkey AS alias FROM supplier
  UNION ALL SELECT s_suppkey, 'Old unit ' || s_suppkey FROM supplier),
matched AS (SELECT key, feature_id, acres, x, y FROM layer JOIN names ON unit_nm = alias)"""


def _matched(spark: SparkSession, d: str) -> DataFrame:
    return boundary.match_aliases(boundary.federal_features(layer(spark, d)), supplier_aliases(spark, d))


@query(f"WITH {_LAYER} SELECT key, feature_id FROM matched")
def alias_join(spark: SparkSession, d: str) -> DataFrame:
    return _matched(spark, d).select("key", "feature_id")


@query(f"WITH {_LAYER} SELECT s_suppkey AS key FROM supplier ANTI JOIN matched ON s_suppkey = key")
def unmatched_keys(spark: SparkSession, d: str) -> DataFrame:
    return boundary.unmatched(table(spark, d, "supplier").select(F.col("s_suppkey").alias("key")), _matched(spark, d))


def _merged(spark: SparkSession, d: str) -> DataFrame:
    """Features in the order of their ids, from rows that arrive in another order."""
    rows = _matched(spark, d).repartition(7, F.xxhash64("feature_id"))
    return boundary.merge_units(rows, order=["feature_id"])


@query(
    f"""WITH {_LAYER} SELECT key, CAST(count(*) AS INTEGER) AS n_polygons, round(sum(acres) * 0.00404686, 3) AS area_km2,
  array_to_string(list(CAST(round(x * 100) AS BIGINT) ORDER BY feature_id), ' ') AS first_vertices FROM matched GROUP BY key"""
)
def merge_units(spark: SparkSession, d: str) -> DataFrame:
    firsts = F.transform("polygons", lambda p: F.round(p[0][0][0] * 100).cast("long").cast("string"))
    return _merged(spark, d).select(
        "key", F.size("polygons").alias("n_polygons"), "area_km2", F.array_join(firsts, " ").alias("first_vertices")
    )


@query(
    f"""WITH {_LAYER} SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY feature_id) - 1 AS INTEGER) AS part_index,
  round(x, 6) AS x, round(y, 6) AS y FROM matched"""
)
def split_parts(spark: SparkSession, d: str) -> DataFrame:
    """All parts of a key with the vertex they begin at."""
    first = F.col("polygons")[0][0][0]
    parts = zonal.split_parts(_merged(spark, d), ["key"])
    return parts.select("key", "part_index", F.round(first[0], 6).alias("x"), F.round(first[1], 6).alias("y"))


_DATASETS = [r for r in fixed.rows(fixed.DATASETS)]


@query(
    f"""WITH datasets(dataset, scale, start, bands) AS (VALUES {', '.join(f"('{r[0]}', {r[2]}, DATE '{r[4]}', {len(r[5].split())})" for r in _DATASETS)})
SELECT dataset, scale, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, count(*) AS n_days, CAST(any_value(bands) AS INTEGER) AS n_bands
FROM orders JOIN datasets ON dataset = CASE WHEN o_custkey % 2 = 0 THEN 'DAYMET' ELSE 'ERA5' END AND o_orderdate >= start GROUP BY dataset, scale"""
)
def days_of_datasets(spark: SparkSession, d: str) -> DataFrame:
    """A dimension joined to a table of days: each with the data source it comes from, since that began."""
    name = F.when(F.col("o_custkey") % 2 == 0, "DAYMET").otherwise("ERA5")
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), name.alias("dataset"))
    joined = days.join(datasets(spark), "dataset").where(F.col("date") >= F.col("start"))
    return joined.groupBy("dataset", F.col("scale").cast("int").alias("scale")).agg(
        F.min(F.year("date")).alias("first_year"), F.count("*").alias("n_days"), F.size(F.first("bands")).alias("n_bands")
    )


@query(
    f"""WITH {_LAYER} SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY feature_id) - 1 AS INTEGER) AS part_index,
  feature_id, round(x, 6) AS x FROM matched"""
)
def numbered_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts numbered without bringing the features of a key together."""
    rows = _matched(spark, d).repartition(7, F.xxhash64("feature_id")).select("key", "feature_id", "polygons")
    out = boundaries.numbered_parts(rows, ["feature_id"])
    return out.select("key", "part_index", "feature_id", F.round(F.col("polygons")[0][0][0][0], 6).alias("x"))


@query(
    """SELECT CAST(c_custkey % 3 AS VARCHAR) AS key, c_mktsegment AS unit_name, round(c_acctbal, 6) AS x,
  CAST(c_nationkey AS DOUBLE) AS y FROM customer"""
)
def collection_features(spark: SparkSession, d: str) -> DataFrame:
    """Collections of many features, read feature by feature."""
    x, y = F.round("c_acctbal", 6), F.col("c_nationkey").cast("double")
    ring = F.array(*[F.array(x + a, y + b) for a, b in [(0, 0), (1, 0), (0, 1), (0, 0)]])
    n = F.col("c_custkey")
    rows = table(spark, d, "customer").select((n % 3).cast("string").alias("key"), n.alias("n"), F.col("c_mktsegment").alias("unit_name"), F.array(F.array(ring)).alias("polygons"))
    features = sinks.feature_text(rows, ["unit_name"], ["key", "n"])
    ends = features.groupBy("key").agg(F.min("n").alias("first"), F.max("n").alias("last"))
    lines = features.join(ends, "key").withColumn("value", F.concat(F.when(F.col("n") == F.col("first"), "").otherwise(","), F.col("value"))).drop("first", "last")
    opening = ends.select("key", (F.col("first") - 1).alias("n"), F.lit('{"type":"FeatureCollection","features":[').alias("value"))
    closing = ends.select("key", (F.col("last") + 1).alias("n"), F.lit("]}").alias("value"))
    whole = lines.unionByName(opening).unionByName(closing).repartition("key").sortWithinPartitions("key", "n")
    path = new_folder(spark, "collections")
    whole.drop("n").write.partitionBy("key").text(path)
    back = documents.read_features(spark, path, "*.txt", r"key=([^/]+)/")
    first = F.col("polygons")[0][0][0]
    return back.select("key", "properties.unit_name", first[0].alias("x"), first[1].alias("y"))


@query(
    f"""WITH {_LAYER}, ranked AS (SELECT key, key % 2 = 0 AS multipart, x, y, count(*) OVER (PARTITION BY key) AS n,
    row_number() OVER (PARTITION BY key ORDER BY feature_id) - 1 AS i FROM matched),
kept AS (SELECT * FROM ranked WHERE multipart OR i = 0)
SELECT key, round(x, 6) AS x, round(y, 6) AS y, CASE WHEN multipart THEN 'part-' || i ELSE 'all' END AS part,
  CAST(CASE WHEN multipart THEN 1 ELSE n END AS INTEGER) AS n_polygons,
  CASE WHEN multipart THEN key || '_part-' || i ELSE CAST(key AS VARCHAR) END AS stem FROM kept"""
)
def zones_by_key(spark: SparkSession, d: str) -> DataFrame:
    """Parts of multipart keys, whole outlines of the others, with their file names."""
    merged = _merged(spark, d).withColumn("multipart", F.col("key") % 2 == 0)
    out = extract.zones_by_key(merged)
    stem = labels.file_stem(F.col("key").cast("string"), F.col("part"))
    first = F.col("polygons")[0][0][0]
    return out.select(
        "key", "part", F.size("polygons").alias("n_polygons"), stem.alias("stem"),
        F.round(first[0], 6).alias("x"), F.round(first[1], 6).alias("y"),
    )


_FALLBACK = f"""WITH {SQL_REGISTRY}, {_LAYER}, first AS (SELECT key, count(*) AS n FROM matched GROUP BY key),
second AS (SELECT DISTINCT c_nationkey AS key FROM customer),
placed AS (SELECT key, CASE WHEN first.key IS NOT NULL THEN 'primary' WHEN second.key IS NOT NULL THEN 'secondary'
    WHEN key % 11 <> 0 THEN 'circle' END AS boundary_source, n
  FROM registry LEFT JOIN first USING (key) LEFT JOIN second USING (key))
"""


def _placed(spark: SparkSession, d: str) -> DataFrame:
    """Some suppliers have neither an outline nor a position."""
    r = supplier_registry(spark, d).withColumn("lat", F.when(F.col("key") % 11 != 0, F.col("lat")))
    first = boundary.merge_units(_matched(spark, d)).select("key", "polygons")
    squares = F.array(F.array(F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]])))
    second = table(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("key")).distinct()
    return boundary.with_fallback(r, first, second.select("key", squares.alias("polygons")))


@query(
    _FALLBACK
    + """SELECT placed.key, boundary_source, CAST(CASE boundary_source WHEN 'primary' THEN n ELSE 1 END AS INTEGER) AS n_polygons
FROM placed WHERE boundary_source IS NOT NULL"""
)
def boundary_fallback(spark: SparkSession, d: str) -> DataFrame:
    return _placed(spark, d).select("key", "boundary_source", F.size("polygons").alias("n_polygons"))


@query(
    _FALLBACK
    + """SELECT count(*) FILTER (boundary_source <> 'circle') AS real_polygons,
  count(*) FILTER (boundary_source = 'circle') AS circle_approximations FROM placed WHERE boundary_source IS NOT NULL"""
)
def boundary_source_counts(spark: SparkSession, d: str) -> DataFrame:
    return boundary.count_sources(_placed(spark, d).withColumn("real", F.col("boundary_source") != "circle"))


@query(
    f"""{SUPPLIER_TRENDS}, {SQL_REGISTRY} SELECT r.key, unit_name, round(c.slope_per_year, 6) AS tmean_slope, c.significant_95 AS tmean_sig,
  round(w.slope_per_year, 6) AS prcp_slope, w.significant_95 AS prcp_sig FROM registry r
LEFT JOIN trends c ON r.key = c.key AND c.variable = 'tmean_c' AND c.key % 4 <> 0
LEFT JOIN trends w ON r.key = w.key AND w.variable = 'prcp_mm' AND w.key % 4 <> 0"""
)
def boundary_slopes(spark: SparkSession, d: str) -> DataFrame:
    """Every fourth supplier has no trend and keeps NULLs."""
    slopes = boundary.headline_slopes(supplier_trends(spark, d).where(F.col("key") % 4 != 0))
    out = boundary.with_slopes(supplier_registry(spark, d).select("key", "unit_name"), slopes)
    return rounded(out, "tmean_slope", "prcp_slope")


@query(
    """WITH pairs AS (SELECT s_suppkey AS key, unnest(['DAYMET', 'ERA5']) AS dataset FROM supplier),
chosen AS (SELECT * FROM pairs WHERE NOT (dataset = 'DAYMET' AND key IN (3, 14, 15, 92)))
SELECT key, CAST(min(CASE dataset WHEN 'DAYMET' THEN 1000 ELSE 11132 END) AS BIGINT) AS scale, count(*) AS n_datasets
FROM chosen GROUP BY key"""
)
def dataset_choice(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"))
    chosen = choose_datasets(keys, single=[3, 14, 15, 92])
    counts = chosen.groupBy("key").agg(F.count("dataset").alias("n_datasets"))
    return finest_scale(chosen).join(counts, "key")


@query(
    """SELECT c_custkey AS key FROM customer
ANTI JOIN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ON c_custkey = o_custkey"""
)
def coverage_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Customers without an urgent order: what one table needs and another lacks."""
    need = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    have = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("key"))
    return boundary.schema_gaps(need, have, ["key"])


@query("SELECT count(o_custkey) AS n, count(DISTINCT o_custkey) AS n_distinct FROM orders")
def key_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    return uniqueness(table(spark, d, "orders"), "o_custkey")


