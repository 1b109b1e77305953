"""Labels, display units, file round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import (
    MIN_ROWS,
    SQL_ANNUAL,
    SQL_CANONICAL,
    SQL_REGISTRY,
    canonical,
    combined,
    query,
    rounded,
    sql_trends,
    supplier_registry,
    table,
)
from checks.space import layer
from checks.trend import (
    SUPPLIER_TRENDS,
    flag_registry,
    flag_tables,
    supplier_trends,
)
from tidemark.functions import labels
from tidemark.functions.values import acres_to_km2, finite_or_null, numbers_finite
from tidemark.operators import aggregate, browse
from tidemark.operators.boundary import is_real
from tidemark.operators.canonical import canonicalise, coalesce_dates, combine_parts
from tidemark.plans.boundaries import PROPERTIES, boundaries_with_slopes
from tidemark.plans.summary import INDEX_FIELDS, summary_documents
from tidemark.session import new_folder
from tidemark.sources import daily, documents, sinks
from tidemark.sources.catalogue import key_part
from tidemark.spec import DEFAULT_SPEC, PRESENT


@query(
    f"""{SUPPLIER_TRENDS}, shown AS (SELECT *, CASE WHEN key % 9 = 0 THEN NULL ELSE slope_per_year END AS sl,
    CASE WHEN key % 13 = 0 THEN NULL ELSE p_value END AS pv FROM trends)
SELECT key, variable,
  CASE WHEN sl IS NULL THEN '—' ELSE CASE WHEN sl > 0 THEN '+' ELSE '' END || printf('%.3f', round(sl, 3)) END AS slope_text,
  CASE WHEN pv IS NULL THEN '—' WHEN pv < 0.001 THEN 'p < 0.001' ELSE 'p = ' || printf('%.3f', pv) END AS p_text,
  CASE WHEN sl IS NULL THEN '—' ELSE CASE WHEN sl * (n - 1) > 0 THEN '+' ELSE '' END || printf('%.2f', round(sl * (n - 1), 2)) END AS total_text
FROM shown"""
)
def format_labels(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("key")
    slope = F.when(key % 9 != 0, F.col("slope_per_year"))
    p = F.when(key % 13 != 0, F.col("p_value"))
    return supplier_trends(spark, d).select(
        "key",
        "variable",
        labels.slope_label(slope).alias("slope_text"),
        labels.p_label(p).alias("p_text"),
        labels.total_label(slope, F.col("n")).alias("total_text"),
    )


@query(
    f"""WITH {SQL_REGISTRY} SELECT key, array_to_string(list_transform(string_split(replace(lower(unit_name), ' ', '-'), '-'),
    lambda w: upper(w[1]) || w[2:]), ' ') AS title, regexp_replace(unit_name, ' National Park$', '') AS short
FROM registry"""
)
def names(spark: SparkSession, d: str) -> DataFrame:
    kebab = F.translate(F.lower("unit_name"), " ", "-")
    return supplier_registry(spark, d).select(
        "key", labels.kebab_to_title(kebab).alias("title"), labels.short_name(F.col("unit_name")).alias("short")
    )


@query(
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Precipitation' WHEN 1 THEN 'Soil temp' WHEN 2 THEN 'mm' ELSE 'Wind speed' END AS label,
  CASE p_size % 4 WHEN 0 THEN 'mm / yr' WHEN 3 THEN 'm/s' ELSE '' END AS unit,
  CASE p_size % 4 WHEN 0 THEN 'precip' ELSE 'other' END AS kind, CASE p_size % 4 WHEN 0 THEN 2 ELSE 3 END AS decimals FROM part"""
)
def variable_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Known variables, an unknown one, and one that is nothing but a unit."""
    kind = F.col("p_size") % 4
    variable = (
        F.when(kind == 0, "prcp_mm").when(kind == 1, "soil_temp_c").when(kind == 2, "mm").otherwise("wind_speed_ms")
    )
    rows = table(spark, d, "part").select("p_partkey", variable.alias("variable"))
    return browse.variable_metadata(rows).select("p_partkey", "label", "unit", "kind", "decimals")


@query(
    f"""WITH {SQL_ANNUAL} SELECT key, year, variable,
  round(CASE WHEN variable IN ('tmean_c', 'tmax_c', 'tmin_c') THEN value * 9 / 5 + 32 ELSE value END, 6) AS value FROM annual_long"""
)
def temperature_display(spark: SparkSession, d: str) -> DataFrame:
    wide = aggregate.annual(combined(spark, d), ["key"], min_rows=MIN_ROWS)
    return rounded(browse.display_values(aggregate.to_long(wide, ["key", "year"])), "value")


@query(
    """WITH stems AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN replace(p_name, ' ', '-') || '_part-' || p_size % 10
    ELSE replace(p_name, ' ', '-') END AS stem FROM part), keyed AS (SELECT *, string_split(stem, '_part-')[1] AS key FROM stems)
SELECT p_partkey, stem, key, stem = key OR CAST(string_split(stem, '_part-')[2] AS INTEGER) BETWEEN 0 AND 9 AS expected FROM keyed"""
)
def file_stems(spark: SparkSession, d: str) -> DataFrame:
    name, size = F.translate("p_name", " ", "-"), F.col("p_size")
    stem = F.when(size % 2 == 0, F.concat(name, F.lit("_part-"), (size % 10).cast("string"))).otherwise(name)
    rows = table(spark, d, "part").select("p_partkey", stem.alias("stem"))
    keyed = rows.withColumn("key", labels.file_key(F.col("stem")))
    return keyed.withColumn("expected", F.array_contains(labels.candidate_stems(F.col("key"), 10), F.col("stem")))


@query(
    """SELECT c_custkey, round(c_acctbal * 0.00404686, 3) AS area_km2,
  CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS safe FROM customer"""
)
def numbers_for_json(spark: SparkSession, d: str) -> DataFrame:
    """NaN and infinities become NULL."""
    key, v = F.col("c_custkey"), F.col("c_acctbal")
    odd = F.when(key % 3 == 0, F.lit(float("nan"))).when(key % 5 == 0, F.lit(float("-inf"))).otherwise(v)
    return table(spark, d, "customer").select(
        "c_custkey", acres_to_km2(v).alias("area_km2"), finite_or_null(odd).alias("safe")
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS in_array,
  CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS in_struct FROM orders"""
)
def nested_numbers_for_json(spark: SparkSession, d: str) -> DataFrame:
    v = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).otherwise(F.lit(float("nan")))
    nested = table(spark, d, "orders").select(
        "o_orderkey", F.array(v).alias("a"), F.struct(F.create_map(F.lit("v"), v).alias("m")).alias("s")
    )
    clean = numbers_finite(nested)
    return clean.select("o_orderkey", F.col("a")[0].alias("in_array"), F.col("s.m")["v"].alias("in_struct"))


@query("SELECT o_orderpriority AS item, round(sum(round(o_totalprice)), 2) AS value FROM orders GROUP BY ALL")
def items_by_value(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("item")).agg(
        F.sum(F.round("o_totalprice")).alias("value")
    )
    return browse.by_value(items)


# ---- what is written is what is read -----------------------------------------------------


def _as_raw(spark: SparkSession, d: str) -> DataFrame:
    """Canonical days under raw names, as a source would deliver them."""
    c = canonical(spark, d)
    return c.select(
        "key", "part", "date", F.col("tmax_c").alias("DAYMET_tmax"), F.col("tmin_c").alias("DAYMET_tmin"),
        F.col("prcp_mm").alias("DAYMET_prcp"), F.col("wind_speed_ms").alias("ERA5_snow_cover"),
    )


_RAW_COLUMNS = ["DAYMET_tmax", "DAYMET_tmin", "DAYMET_prcp", "ERA5_snow_cover", "ERA5_snow_depth"]
_ROUND_TRIP = f"""WITH {SQL_CANONICAL} SELECT key, part, date, tmax_c AS "DAYMET_tmax", tmin_c AS "DAYMET_tmin",
  prcp_mm AS "DAYMET_prcp", wind_speed_ms AS "ERA5_snow_cover", CAST(NULL AS DOUBLE) AS "ERA5_snow_depth",
  CAST({DEFAULT_SPEC.source_mask(_RAW_COLUMNS[:4])} AS BIGINT) AS _present FROM canonical"""


@query(_ROUND_TRIP)
def daily_files_parquet(spark: SparkSession, d: str) -> DataFrame:
    """Both formats are written; Parquet is preferred when read."""
    path = new_folder(spark, "daily")
    sinks.write_daily(_as_raw(spark, d), path)
    return daily.read_raw(spark, path, columns=_RAW_COLUMNS)


@query(_ROUND_TRIP)
def daily_files_csv(spark: SparkSession, d: str) -> DataFrame:
    """CSV files with different columns and column orders, matched by name."""
    path = new_folder(spark, "daily")
    rows = _as_raw(spark, d)
    sinks.write_daily(rows.where(F.col("key") != "A"), f"{path}/one", formats=["csv"])
    other = rows.select("key", "part", "DAYMET_prcp", "ERA5_snow_cover", "date", "DAYMET_tmin", "DAYMET_tmax")
    sinks.write_daily(other.where(F.col("key") == "A"), f"{path}/two", formats=["csv"])
    return daily.read_raw(spark, path, columns=_RAW_COLUMNS)


@query(_ROUND_TRIP + " WHERE key = 'A'")
def daily_files_of_keys(spark: SparkSession, d: str) -> DataFrame:
    """The files of one key; those of other keys are not opened."""
    path = new_folder(spark, "daily")
    sinks.write_daily(_as_raw(spark, d), path)
    return daily.read_raw(spark, f"{path}/parquet", columns=_RAW_COLUMNS, keys=["A"])


_RAGGED = f"""WITH {SQL_ANNUAL} SELECT key, year, variable, round(value, 6) AS value FROM annual_long
WHERE value IS NOT NULL AND CASE key WHEN 'A' THEN variable IN ('tmax_c', 'tmin_c', 'tmean_c') WHEN 'N' THEN variable = 'prcp_mm'
  ELSE variable IN ('tmax_c', 'prcp_mm') END"""


def _ragged_years(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """Annual values of keys whose files have different columns."""
    path, rows = new_folder(spark, "ragged"), _as_raw(spark, d)
    for key, bands in (("A", ["DAYMET_tmin", "DAYMET_tmax"]), ("N", ["DAYMET_prcp"]), ("R", ["DAYMET_tmax", "DAYMET_prcp"])):
        sinks.write_daily(rows.where(F.col("key") == key).select("key", "part", "date", *bands), f"{path}/{key}", formats=[kind])
    days = canonicalise(coalesce_dates(daily.read_raw(spark, path), ["key", "part"]), ["key", "part"])
    years = aggregate.annual(combine_parts(days.drop("part"), ["key"]), ["key"], min_rows=MIN_ROWS)
    return rounded(aggregate.to_long(years, ["key", "year"]).where("value IS NOT NULL"), "value")


@query(_RAGGED)
def ragged_parquet_years(spark: SparkSession, d: str) -> DataFrame:
    return _ragged_years(spark, d, "parquet")


@query(_RAGGED)
def ragged_csv_years(spark: SparkSession, d: str) -> DataFrame:
    return _ragged_years(spark, d, "csv")


def _damaged_files(spark: SparkSession, d: str) -> daily.Reading:
    """Balances as series, with bad dates, numbers and widths, and a header without a date."""
    n, path = F.col("c_custkey"), new_folder(spark, "damaged")
    date = F.when(n % 11 == 0, "2001-13-01").otherwise(F.date_add(F.lit("2001-01-01"), n.cast("int")).cast("string"))
    value = F.when(n % 7 == 0, "x").when(n % 5 == 0, "NA").otherwise(F.col("c_acctbal").cast("string"))
    line = F.when(n % 13 == 0, date).otherwise(F.concat_ws(",", date, value))
    rows = table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("key"), F.concat(F.lit("p"), n % 2).alias("part"), n.alias("n"), line.alias("line")
    )
    heads = rows.select("key", "part").distinct().withColumn("n", F.lit(-1).cast("long"))
    heads = heads.withColumn("line", F.when(F.col("key") == "FURNITURE", "Date,DAYMET_tmax").otherwise("date,DAYMET_tmax"))
    one_file = rows.unionByName(heads).repartition("key", "part").sortWithinPartitions("key", "part", "n").drop("n")
    one_file.write.partitionBy("key", "part").option("sep", "\u0001").option("quote", "").csv(path)
    return daily.read_raw_checked(spark, path, columns=["DAYMET_tmax"])


SQL_DAMAGED = """
lines AS (SELECT c_mktsegment AS key, 'p' || c_custkey % 2 AS part, c_custkey AS n, c_acctbal,
  CASE WHEN c_custkey % 11 = 0 THEN '2001-13-01' ELSE CAST(CAST(DATE '2001-01-01' + CAST(c_custkey AS INTEGER) AS DATE) AS VARCHAR) END AS date
  FROM customer)"""


@query(
    f"""WITH {SQL_DAMAGED} SELECT key, part, CAST(date AS DATE) AS date,
  CASE WHEN n % 13 <> 0 AND n % 7 <> 0 AND n % 5 <> 0 THEN c_acctbal END AS "DAYMET_tmax",
  CAST({DEFAULT_SPEC.source_mask(["DAYMET_tmax"])} AS BIGINT) AS _present
FROM lines WHERE key <> 'FURNITURE' AND n % 11 <> 0"""
)
def rows_of_damaged_files(spark: SparkSession, d: str) -> DataFrame:
    return _damaged_files(spark, d).rows


@query(
    f"""WITH {SQL_DAMAGED}, told AS (
  SELECT key, part, n, date || CASE WHEN n % 13 = 0 THEN '' WHEN n % 7 = 0 THEN ',x' ELSE '' END AS line,
    [CASE WHEN n % 13 = 0 THEN '1 values under 2 columns' END, CASE WHEN n % 11 = 0 THEN 'not a date: 2001-13-01' END,
     CASE WHEN n % 13 <> 0 AND n % 7 = 0 THEN 'not a number: DAYMET_tmax x' END] AS reasons
  FROM lines WHERE key <> 'FURNITURE')
SELECT key, part, n % 13 = 0 AS cut, reason FROM (SELECT key, part, n, unnest(reasons) AS reason FROM told) WHERE reason IS NOT NULL
UNION ALL SELECT DISTINCT key, part, NULL, 'no column date' FROM lines WHERE key = 'FURNITURE'"""
)
def rejects_of_damaged_files(spark: SparkSession, d: str) -> DataFrame:
    """What was wrong with files and lines; ``cut`` tells lines without a second value."""
    rejects = _damaged_files(spark, d).rejects
    return rejects.select(*key_part(F.col("path")), (F.instr("line", ",") == 0).alias("cut"), "reason")


@query(
    """SELECT o_orderkey AS key, CASE WHEN o_orderkey % 3 = 0 THEN 'not JSON' ELSE 'without a type' END AS reason
FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 4 = 0"""
)
def rejected_outlines(spark: SparkSession, d: str) -> DataFrame:
    """Boundary files cut short, and such that are no feature."""
    n = F.col("o_orderkey")
    whole = '{"type":"FeatureCollection","features":[]}'
    text = F.when(n % 3 == 0, whole[:30]).when(n % 4 == 0, '{"kind":"Feature"}').otherwise(whole)
    files = table(spark, d, "orders").select(n.alias("key"), text.alias("value"))
    return documents.rejected_boundaries(files).drop("line")


@query(
    f"""WITH {SQL_CANONICAL} SELECT key, part, date, tmax_c AS "DAYMET_tmax", tmin_c AS "DAYMET_tmin", prcp_mm AS "DAYMET_prcp",
  CAST({DEFAULT_SPEC.source_mask(_RAW_COLUMNS[:3])} AS BIGINT) AS present FROM (
    SELECT * REPLACE (CASE WHEN key <> 'N' THEN part END AS part) FROM canonical WHERE key <> 'N'
    UNION ALL BY NAME SELECT * REPLACE (NULL AS part) FROM canonical WHERE key = 'N')"""
)
def daily_files_gzip(spark: SparkSession, d: str) -> DataFrame:
    """Gzipped CSV; the part is dropped for the key whose parts are in one file."""
    path = new_folder(spark, "gzip")
    rows = _as_raw(spark, d).drop("ERA5_snow_cover")
    one_file = rows.withColumn("part", F.when(F.col("key") == "N", "all").otherwise(F.col("part"))).repartition("key", "part")
    one_file.write.partitionBy("key", "part").option("header", True).option("compression", "gzip").csv(path)
    read = daily.read_gzipped(spark, path, r"key=([^/]+)/(part=[^/]+)/", _RAW_COLUMNS)
    part = F.regexp_replace("part", "part=", "")
    return read.select("key", part.alias("part"), "date", *_RAW_COLUMNS[:3], F.col(PRESENT).alias("present"))


@query(
    f"""WITH {SQL_ANNUAL} SELECT key, CAST(year AS INTEGER) AS year, round(tmean_c, 6) AS tmean_c, round(prcp_mm, 6) AS prcp_mm
FROM annual"""
)
def summary_files(spark: SparkSession, d: str) -> DataFrame:
    """Summary documents written as JSON and read back with their schema."""
    docs = summary_documents(flag_tables(spark, d), flag_registry(spark, d))
    path = new_folder(spark, "summaries")
    sinks.write_summaries(docs, path)
    back = documents.read_summaries(spark, path, docs.schema)
    years = back.select("key", F.inline("annual"))
    return rounded(years.select("key", "year", "tmean_c", "prcp_mm"), "tmean_c", "prcp_mm")


@query(
    f"""WITH {SQL_ANNUAL}, {sql_trends('annual_long', 'year', 5)}
SELECT k.key, 'Flag ' || k.key AS unit_name, CAST(min(year) AS INTEGER) AS start_year,
  CASE WHEN count(year) > 0 THEN CAST(count(year) AS INTEGER) END AS n_stripes,
  any_value((SELECT round(slope_per_year, 6) FROM trends t WHERE t.key = k.key AND t.variable = 'tmean_c')) AS tmean_slope,
  true AS no_snow FROM (SELECT DISTINCT l_returnflag AS key FROM lineitem) k LEFT JOIN annual a ON a.key = k.key GROUP BY k.key"""
)
def index_file(spark: SparkSession, d: str) -> DataFrame:
    """The index written as lines, and facts read from its text; a key without years has no stripes."""
    docs = summary_documents(flag_tables(spark, d), flag_registry(spark, d))
    path = new_folder(spark, "index")
    sinks.write_index(docs, path, INDEX_FIELDS)
    shape = (
        "key string, unit_name string, period struct<start_year:int>, stripes array<struct<year:int>>, "
        "headline_trends map<string,struct<slope_per_year:double>>"
    )
    lines = spark.read.text(path).select(F.from_json("value", shape).alias("j"))
    return lines.select(
        "j.key",
        "j.unit_name",
        "j.period.start_year",
        F.when(F.size("j.stripes") > 0, F.size("j.stripes")).alias("n_stripes"),
        F.round(F.col("j.headline_trends")["tmean_c"].slope_per_year, 6).alias("tmean_slope"),
        F.col("j.headline_trends")["snowfall_mm"].isNull().alias("no_snow"),
    )


@query(
    f"""{SUPPLIER_TRENDS}, {SQL_REGISTRY} SELECT CAST(r.key AS VARCHAR) AS key, unit_name, r.key % 2 = 1 AS approximate,
  CAST(CASE WHEN r.key % 2 = 1 THEN 33 ELSE 4 END AS INTEGER) AS n_vertices, round(c.slope_per_year, 6) AS tmean_slope
FROM registry r LEFT JOIN trends c ON r.key = c.key AND c.variable = 'tmean_c'"""
)
def boundary_files(spark: SparkSession, d: str) -> DataFrame:
    """Boundary files read, completed by circles and slopes, written and read again.

    Even keys have an outline of their own, one key in three as a bare Feature.
    """
    r = supplier_registry(spark, d).withColumn("key", F.col("key").cast("string"))
    number = F.col("key").cast("int")
    ring = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]])
    own = r.where(number % 2 == 0).withColumn("polygons", F.array(F.array(ring)))
    features = sinks.feature_text(own, ["unit_name", "state"])
    wrapped = F.concat(F.lit('{"type":"FeatureCollection","features":['), "value", F.lit("]}"))
    files = features.select("key", F.when(number % 3 == 0, F.col("value")).otherwise(wrapped).alias("value"))
    trend_rows = supplier_trends(spark, d).withColumn("key", F.col("key").cast("string"))
    done = boundaries_with_slopes(r, documents.parse_boundaries(files), trend_rows)

    path = new_folder(spark, "boundaries")
    sinks.write_boundaries(done, path, PROPERTIES)
    back = documents.feature_polygons(documents.read_boundaries_by_key(spark, f"{path}/by_key"))
    return back.select(
        "key",
        "properties.unit_name",
        "properties.approximate",
        F.size(F.col("polygons")[0][0]).alias("n_vertices"),
        F.round("properties.tmean_slope", 6).alias("tmean_slope"),
    )


@query(
    """SELECT c_custkey AS key, c_custkey % 4 <> 0 AND c_custkey % 3 <> 0 AS is_real FROM customer"""
)
def real_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """Files without features, and files with a circle, are no real boundaries."""
    key = F.col("c_custkey")
    feature = '{{"type":"Feature","geometry":null,"properties":{{"approximate":{}}}}}'
    text = (
        F.when(key % 4 == 0, '{"type":"FeatureCollection","features":[]}')
        .when(key % 3 == 0, f'{{"type":"FeatureCollection","features":[{feature.format("true")}]}}')
        .otherwise(f'{{"type":"FeatureCollection","features":[{feature.format("null")}]}}')
    )
    files = table(spark, d, "customer").select(key.alias("key"), text.alias("value"))
    return documents.parse_boundaries(files).select("key", is_real(F.col("features")).alias("is_real"))


@query(
    """SELECT c_custkey AS feature_id, 'Unit ' || c_custkey % 97 AS "Unit_Nm", CAST(floor(c_acctbal) AS DOUBLE) AS "GIS_Acres"
FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def layer_files(spark: SparkSession, d: str) -> DataFrame:
    """A polygon layer read with its attribute filter and three columns."""
    path = new_folder(spark, "layer")
    layer(spark, d).write.parquet(path)
    return documents.read_layer(spark, path, ["feature_id", "Unit_Nm", "GIS_Acres"])


