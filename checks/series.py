"""Daily rows, calendar aggregation, anomalies, monthly decomposition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import (
    MIN_ROWS,
    PERIODS,
    REFERENCE,
    SQL_ANNUAL,
    SQL_CANONICAL,
    SQL_COMBINED,
    SQL_MONTHLY,
    SQL_RAW,
    SUMS,
    VARS,
    canonical,
    combined,
    query,
    raw,
    rounded,
    sql_reduce,
    table,
)
from tidemark.functions.calendar import in_dates, month_label, season, season_year, water_year
from tidemark.functions.colour import label_colour
from tidemark.operators import aggregate, anomaly, browse, chunks, decompose
from tidemark.operators.canonical import canonicalise, coalesce_dates, combine_parts, present_columns, select_bands
from tidemark.operators.zonal import zonal_mean
from tidemark.plans import backfill
from tidemark.session import materialise, new_folder
from tidemark.sources.registry import only_keys
from tidemark.sources.sinks import export_columns
from tidemark.spec import DATASET_COLUMNS, PRESENT

R_VARS = ", ".join(f"round({v}, 6) AS {v}" for v in VARS)


@query(
    """SELECT p_brand AS zone, CAST(l_shipdate AS DATE) AS date, round(avg(l_quantity), 6) AS l_quantity,
  round(avg(l_linenumber), 6) AS l_linenumber
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_shipdate >= '1996-01-01' AND l_shipdate < '1999-01-01' GROUP BY ALL"""
)
def daily_zonal_mean(spark: SparkSession, d: str) -> DataFrame:
    """Parts are cells, brands are zones."""
    items = table(spark, d, "lineitem").where(in_dates(F.col("l_shipdate"), "1996-01-01", "1999-01-01"))
    cells = items.select(
        F.col("l_partkey").alias("cell_id"), F.to_date("l_shipdate").alias("date"), "l_quantity", "l_linenumber"
    )
    zones = table(spark, d, "part").select(F.col("p_partkey").alias("cell_id"), F.col("p_brand").alias("zone"))
    return rounded(zonal_mean(cells, zones, ["zone"], ["l_quantity", "l_linenumber"]), "l_quantity", "l_linenumber")


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity AS shop_l_quantity, l_discount AS shop_l_discount FROM lineitem"""
)
def select_and_prefix_bands(spark: SparkSession, d: str) -> DataFrame:
    return select_bands(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "shop", ["l_quantity", "l_discount"]
    )


_DECLARED = [c for cols in DATASET_COLUMNS.values() for c in cols]
_IN_RAW = {
    "DAYMET_tmax", "DAYMET_tmin", "DAYMET_prcp", "ERA5_temperature_2m_max", "ERA5_temperature_2m_min",
    "ERA5_total_precipitation_sum", "ERA5_u_component_of_wind_10m", "ERA5_v_component_of_wind_10m",
    "ERA5_potential_evaporation_sum",
}


@query(
    f"WITH {SQL_RAW} SELECT key, part, date, "
    + ", ".join((c.lower() if c in _IN_RAW else "CAST(NULL AS DOUBLE)") + f' AS "{c}"' for c in _DECLARED)
    + " FROM (SELECT * FROM gappy UNION ALL BY NAME SELECT * FROM complete)"
)
def merge_with_all_columns(spark: SparkSession, d: str) -> DataFrame:
    """Two rows per date, one per source, with every declared column."""
    return export_columns(raw(spark, d), ["DAYMET", "ERA5"], ["key", "part", "date"])


@query(
    f"WITH {SQL_RAW} SELECT key, part, date, "
    + ", ".join(f'{c.lower()} AS "{c}"' for c in sorted(_IN_RAW))
    + " FROM merged"
)
def coalesce_sources_max(spark: SparkSession, d: str) -> DataFrame:
    return coalesce_dates(raw(spark, d), ["key", "part"])


@query(f"WITH {SQL_CANONICAL} SELECT key, part, date, {R_VARS} FROM canonical")
def canonicalise_units(spark: SparkSession, d: str) -> DataFrame:
    return rounded(canonical(spark, d), *VARS)


@query(f"WITH {SQL_COMBINED} SELECT key, date, {R_VARS} FROM combined")
def combine_parts_mean(spark: SparkSession, d: str) -> DataFrame:
    return rounded(combined(spark, d), *VARS)


@query(
    f"""WITH {SQL_CANONICAL}, weighted AS (SELECT *, CASE part WHEN 'F' THEN 3.0 ELSE 1.0 END AS w FROM canonical)
SELECT key, date, """
    + ", ".join(
        f"round(sum({v} * w) / sum(CASE WHEN {v} IS NOT NULL THEN w END), 6) AS {v}" for v in VARS
    )
    + " FROM weighted GROUP BY key, date"
)
def combine_parts_weighted(spark: SparkSession, d: str) -> DataFrame:
    weighted = canonical(spark, d).withColumn("w", F.when(F.col("part") == "F", 3.0).otherwise(1.0))
    return rounded(combine_parts(weighted.drop("part"), ["key"], weight="w"), *VARS)


@query(f"WITH {SQL_ANNUAL} SELECT key, year, n_days, {R_VARS} FROM annual")
def annual_agg(spark: SparkSession, d: str) -> DataFrame:
    return rounded(aggregate.annual(combined(spark, d), ["key"], min_rows=MIN_ROWS), *VARS)


@query(
    f"WITH {SQL_CANONICAL} SELECT key, part, CAST(year(date) AS INTEGER) AS year, count(*) AS n_days, "
    + ", ".join(
        f"round(CASE WHEN count({v}) >= 340 THEN {'coalesce(sum(' + v + '), 0.0)' if v in SUMS else 'avg(' + v + ')'} "
        f"END, 6) AS {v}"
        for v in VARS
    )
    + " FROM canonical GROUP BY ALL"
)
def annual_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Per part, each variable blanked in years with fewer than 340 observed days."""
    out = aggregate.annual(canonical(spark, d), ["key", "part"], min_rows=340, completeness="non_null")
    return rounded(out, *VARS)


@query(
    f"""WITH {SQL_CANONICAL}, reduced AS (
  SELECT key, part, CAST(year(date) AS INTEGER) AS year, count(*) AS n_days, {sql_reduce()}
  FROM canonical GROUP BY ALL HAVING count(*) >= {MIN_ROWS})
SELECT key, part, year, n_days, {R_VARS} FROM reduced"""
)
def annual_by_part_from_months(spark: SparkSession, d: str) -> DataFrame:
    """Per part, by way of monthly sums and counts."""
    months = aggregate.month_partials(canonical(spark, d), ["key", "part"])
    return rounded(aggregate.annual_from_partials(months, ["key", "part"], min_rows=MIN_ROWS), *VARS)


@query(
    f"""WITH {SQL_CANONICAL}, reduced AS (
  SELECT key, part, CAST(year(date) AS INTEGER) AS year, count(*) AS n_days, {sql_reduce()}
  FROM canonical GROUP BY ALL HAVING count(*) >= {MIN_ROWS})
SELECT key, part, year, n_days, {R_VARS} FROM reduced"""
)
def annual_of_appended_days(spark: SparkSession, d: str) -> DataFrame:
    """Days that arrive in two chunks with a common month; the second also has wrong values for known days."""
    days, store = materialise(canonical(spark, d), "days"), new_folder(spark, "store")
    backfill.append_days(days.where("date < '1995-06-17'"), store, ["key", "part"])
    late = days.where("date >= '1995-03-01'")
    wrong = F.when(F.col("date") < "1995-06-17", F.col("prcp_mm") + 1).otherwise(F.col("prcp_mm"))
    backfill.append_days(late.withColumn("prcp_mm", wrong), store, ["key", "part"])
    months = backfill.stored_months(spark, store)
    return rounded(aggregate.annual_from_partials(months, ["key", "part"], min_rows=MIN_ROWS), *VARS)


@query(
    f"WITH {SQL_ANNUAL} SELECT key, year, variable, round(value, 6) AS value FROM annual_long"
)
def annual_long(spark: SparkSession, d: str) -> DataFrame:
    wide = aggregate.annual(combined(spark, d), ["key"], min_rows=MIN_ROWS)
    return rounded(aggregate.to_long(wide, ["key", "year"]), "value")


@query(
    f"""WITH {SQL_ANNUAL} SELECT key, min(year) AS start_year, max(year) AS end_year FROM annual GROUP BY ALL
UNION ALL SELECT 'all', min(year), max(year) FROM annual"""
)
def period_of_record(spark: SparkSession, d: str) -> DataFrame:
    wide = aggregate.annual(combined(spark, d), ["key"], min_rows=MIN_ROWS)
    overall = aggregate.period_of_record(wide).select(F.lit("all").alias("key"), "*")
    return aggregate.period_of_record(wide, ["key"]).unionByName(overall)


# Key A has only the source without gaps, key N only the other, key R both; the latter
# also has a mean temperature of its own, which is empty.
_ABSENT = f"""WITH {SQL_RAW},
cut AS (SELECT key, part, date, CASE WHEN key <> 'A' THEN daymet_tmax END AS dx,
    CASE WHEN key <> 'A' THEN daymet_tmin END AS dn, CASE WHEN key <> 'A' THEN daymet_prcp END AS dp,
    CASE WHEN key <> 'N' THEN era5_temperature_2m_max END AS ex,
    CASE WHEN key <> 'N' THEN era5_temperature_2m_min END AS en,
    CASE WHEN key <> 'N' THEN era5_total_precipitation_sum END AS ep,
    CASE WHEN key <> 'N' THEN era5_potential_evaporation_sum END AS ee FROM merged),
filled AS (SELECT key, part, date, coalesce(dx, ex - 273.15) AS tmax_c, coalesce(dn, en - 273.15) AS tmin_c,
    coalesce(dp, ep * 1000) AS prcp_mm, ee * -1000 AS pet_mm FROM cut),
yearly AS (SELECT key, CAST(year(date) AS INTEGER) AS year, avg(tmax_c) AS tmax_c, avg(tmin_c) AS tmin_c,
    coalesce(sum(prcp_mm), 0.0) AS prcp_mm, coalesce(sum(pet_mm), 0.0) AS pet_mm,
    avg(CASE WHEN key <> 'R' THEN (tmax_c + tmin_c) / 2 END) AS tmean_c FROM filled GROUP BY ALL)
SELECT key, year, 'tmax_c' AS variable, round(tmax_c, 6) AS value FROM yearly
UNION ALL SELECT key, year, 'tmin_c', round(tmin_c, 6) FROM yearly
UNION ALL SELECT key, year, 'prcp_mm', round(prcp_mm, 6) FROM yearly
UNION ALL SELECT key, year, 'tmean_c', round(tmean_c, 6) FROM yearly
UNION ALL SELECT key, year, 'pet_mm', round(pet_mm, 6) FROM yearly WHERE key <> 'N'
UNION ALL SELECT key, year, 'snowfall_mm', 0.0 FROM yearly WHERE key = 'R'"""


@query(_ABSENT)
def absent_versus_missing(spark: SparkSession, d: str) -> DataFrame:
    """Absent variables have no rows; empty ones sum to zero; the midpoint goes by column."""
    key = F.col("key")
    daymet = ["DAYMET_tmax", "DAYMET_tmin", "DAYMET_prcp"]
    era5 = [
        "ERA5_temperature_2m_max", "ERA5_temperature_2m_min", "ERA5_total_precipitation_sum",
        "ERA5_potential_evaporation_sum",
    ]
    merged = coalesce_dates(raw(spark, d), ["key", "part"])
    cut = merged.select(
        "key",
        "part",
        "date",
        *[F.when(key != "A", F.col(c)).alias(c) for c in daymet],
        *[F.when(key != "N", F.col(c)).alias(c) for c in era5],
        F.lit(None).cast("double").alias("ERA5_temperature_2m"),
        F.lit(None).cast("double").alias("ERA5_snowfall_sum"),
        F.when(key == "A", present_columns(era5))
        .when(key == "N", present_columns(daymet))
        .otherwise(present_columns([*daymet, *era5, "ERA5_temperature_2m", "ERA5_snowfall_sum"]))
        .alias(PRESENT),
    )
    wide = aggregate.annual(canonicalise(cut, ["key", "part"]), ["key"], min_rows=0)
    spread = aggregate.spread_availability(wide, ["key"])
    return rounded(aggregate.to_long(spread, ["key", "year"]), "value")


@query(
    f"""WITH {SQL_COMBINED}, shifted AS (SELECT *, date + INTERVAL 1 MONTH AS later FROM combined)
SELECT key, CAST(year(later) AS INTEGER) AS year,
  CASE CAST(quarter(later) AS INTEGER) WHEN 1 THEN 'DJF' WHEN 2 THEN 'MAM' WHEN 3 THEN 'JJA' ELSE 'SON' END AS season,
  count(*) AS n_days, {', '.join(f"round({'coalesce(sum(' + v + '), 0.0)' if v in SUMS else 'avg(' + v + ')'}, 6) AS {v}" for v in VARS)}
FROM shifted GROUP BY ALL"""
)
def seasonal_agg(spark: SparkSession, d: str) -> DataFrame:
    return rounded(aggregate.seasonal(combined(spark, d), ["key"]), *VARS)


@query(
    f"""WITH {SQL_COMBINED} SELECT key, CAST(year(date) + CASE WHEN month(date) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year,
  count(*) AS n_days, {', '.join(f"round({'coalesce(sum(' + v + '), 0.0)' if v in SUMS else 'avg(' + v + ')'}, 6) AS {v}" for v in VARS)}
FROM combined GROUP BY ALL"""
)
def water_year_agg(spark: SparkSession, d: str) -> DataFrame:
    return rounded(aggregate.water_years(combined(spark, d), ["key"]), *VARS)


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) = 12 THEN 1 ELSE 0 END AS INTEGER) AS season_year,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'DJF' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'MAM'
    WHEN month(o_orderdate) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season,
  CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year,
  strftime(o_orderdate, '%Y-%m') AS month_label FROM orders"""
)
def calendar_columns(spark: SparkSession, d: str) -> DataFrame:
    date = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey",
        season_year(date).alias("season_year"),
        season(date).alias("season"),
        water_year(date).alias("water_year"),
        month_label(date).alias("month_label"),
    )


@query(
    f"WITH {SQL_MONTHLY} SELECT key, variable, month, round(value, 6) AS value, n_obs FROM monthly"
)
def monthly_resample(spark: SparkSession, d: str) -> DataFrame:
    return rounded(aggregate.monthly(combined(spark, d), ["key"]), "value")


def _usable(spark: SparkSession, d: str) -> DataFrame:
    return decompose.usable_months(aggregate.monthly(combined(spark, d), ["key"]), ["key"])


@query(
    f"""WITH {SQL_MONTHLY} SELECT key, variable, month, round(value, 6) AS value, n_obs, round(trend, 6) AS trend
FROM rolled"""
)
def rolling_centred_12(spark: SparkSession, d: str) -> DataFrame:
    return rounded(decompose.rolling_centred(_usable(spark, d), ["key"]), "value", "trend")


@query(
    f"""WITH {SQL_MONTHLY} SELECT key, variable, period_start, period_end, moy AS month, round(mean, 6) AS mean,
  round(p10, 6) AS p10, round(p90, 6) AS p90 FROM full_climatology"""
)
def period_climatology(spark: SparkSession, d: str) -> DataFrame:
    out = decompose.period_climatology(_usable(spark, d), ["key"], PERIODS)
    return rounded(out, "mean", "p10", "p90")


@query(
    f"""WITH {SQL_MONTHLY} SELECT key, variable, strftime(month, '%Y-%m') AS month, round(value, 4) AS observed,
  round(trend, 4) AS trend FROM rolled SEMI JOIN full_climatology USING (key, variable)"""
)
def decomposition_document_months(spark: SparkSession, d: str) -> DataFrame:
    """The series inside the nested decomposition documents."""
    docs = decompose.decompose(aggregate.monthly(combined(spark, d), ["key"]), ["key"], PERIODS)
    zipped = docs.select("key", "variable", F.explode(F.arrays_zip("months", "observed", "trend")).alias("e"))
    return zipped.select("key", "variable", F.col("e.months").alias("month"), "e.observed", "e.trend")


@query(
    f"""WITH {SQL_MONTHLY} SELECT key, variable, period_start, period_end, moy AS month,
  round(CASE WHEN variable[1:4] IN ('tmax', 'tmin', 'tmea') THEN round(mean, 4) * 9 / 5 + 32 ELSE round(mean, 4) END, 6) AS mean,
  round(CASE WHEN variable[1:4] IN ('tmax', 'tmin', 'tmea') THEN round(p10, 4) * 9 / 5 + 32 ELSE round(p10, 4) END, 6) AS p10,
  round(CASE WHEN variable[1:4] IN ('tmax', 'tmin', 'tmea') THEN round(p90, 4) * 9 / 5 + 32 ELSE round(p90, 4) END, 6) AS p90
FROM full_climatology"""
)
def decomposition_in_fahrenheit(spark: SparkSession, d: str) -> DataFrame:
    """The climatology inside decomposition documents, in display units."""
    docs = decompose.decompose(aggregate.monthly(combined(spark, d), ["key"]), ["key"], PERIODS)
    shown = browse.display_decomposition(docs)
    periods = shown.select("key", "variable", F.explode("climatology").alias("c"))
    cells = periods.select(
        "key", "variable", F.col("c.period")[0].alias("period_start"), F.col("c.period")[1].alias("period_end"),
        F.inline("c.values"),
    )
    return rounded(cells, "mean", "p10", "p90")


@query()
def decomposition_document(spark: SparkSession, d: str) -> DataFrame:
    return decompose.decompose(aggregate.monthly(combined(spark, d), ["key"]), ["key"], PERIODS)


_ANOMALY = f"""WITH {SQL_ANNUAL}, moments AS (SELECT *,
  avg(CASE WHEN year BETWEEN {REFERENCE[0]} AND {REFERENCE[1]} THEN value END) OVER s AS mu,
  stddev_pop(CASE WHEN year BETWEEN {REFERENCE[0]} AND {REFERENCE[1]} THEN value END) OVER s AS sd
  FROM annual_long WINDOW s AS (PARTITION BY key, variable)),
scored AS (SELECT *, value - mu AS anom, CASE WHEN sd <> 0 THEN (value - mu) / sd END AS z FROM moments)
"""


def _anomalies(spark: SparkSession, d: str) -> DataFrame:
    wide = aggregate.annual(combined(spark, d), ["key"], min_rows=MIN_ROWS)
    return anomaly.anomalies(aggregate.to_long(wide, ["key", "year"]), ["key"], REFERENCE)


@query(
    _ANOMALY
    + """SELECT key, year, variable, round(value, 6) AS value, round(anom, 6) AS anom, round(z, 6) AS z FROM scored"""
)
def anomaly_z(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_anomalies(spark, d), "value", "anom", "z")


def sql_ramp(at: str, stops: list[tuple[float, tuple[int, int, int]]], missing: str, value: str) -> str:
    """The colour ramp as SQL."""

    def channel(i: int) -> str:
        steps = " ".join(
            f"WHEN {at} <= {b} THEN {lo[i]} + ({hi[i]} - {lo[i]}) * (({at} - {a}) / ({b} - {a}))"
            for (a, lo), (b, hi) in zip(stops, stops[1:])
        )
        return f"CAST(floor((CASE {steps} END) + 0.5) AS INTEGER)"

    body = " || ',' || ".join(channel(i) for i in range(3))
    return f"CASE WHEN {value} IS NULL THEN '{missing}' ELSE 'rgb(' || {body} || ')' END"


RAMP_Z = [
    (-3.0, (5, 48, 97)), (-1.5, (67, 147, 195)), (0.0, (247, 247, 247)), (1.5, (214, 96, 77)), (3.0, (103, 0, 31)),
]
RAMP_LABEL = [
    (0.0, (200, 155, 15)), (0.25, (220, 110, 20)), (0.5, (200, 55, 40)), (0.75, (130, 25, 40)), (1.0, (60, 10, 25)),
]


@query(
    _ANOMALY
    + f""", clamped AS (SELECT *, greatest(-3.0, least(3.0, z)) AS pos FROM scored WHERE variable = 'tmean_c')
SELECT key, year, round(value, 6) AS value, round(z, 6) AS z, {sql_ramp('pos', RAMP_Z, '#f7f7f7', 'z')} AS colour
FROM clamped"""
)
def climate_stripes(spark: SparkSession, d: str) -> DataFrame:
    return rounded(anomaly.stripes(_anomalies(spark, d), ["key"]), "value", "z")


@query(
    f"""WITH placed AS (SELECT c_custkey, c_acctbal, greatest(0.0, least(1.0, c_acctbal / 8000.0)) AS pos FROM customer)
SELECT c_custkey, {sql_ramp('pos', RAMP_LABEL, '#8a8480', 'c_acctbal')} AS colour FROM placed"""
)
def label_colours(spark: SparkSession, d: str) -> DataFrame:
    low, high = F.lit(0.0), F.lit(8000.0)
    return table(spark, d, "customer").select(
        "c_custkey", label_colour(F.col("c_acctbal"), low, high).alias("colour")
    )


# ---- ranges of dates --------------------------------------------------------------


@query(
    """WITH spans AS (SELECT l_partkey, min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b FROM lineitem GROUP BY ALL),
starts AS (SELECT l_partkey, b, unnest(range(a, b + 1, 2)) AS y FROM spans)
SELECT l_partkey, make_date(y, 1, 1) AS chunk_start, make_date(least(y + 1, b) + 1, 1, 1) AS chunk_end FROM starts"""
)
def date_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Two-year chunks of the record of every part."""
    spans = table(spark, d, "lineitem").groupBy("l_partkey").agg(
        F.to_date(F.min("l_shipdate")).alias("start"), F.to_date(F.max("l_shipdate")).alias("end")
    )
    return chunks.explode_chunks(spans, ["l_partkey"], years=2)


@query(
    """SELECT event_type AS key, user_id, CAST(ts AS DATE) AS date, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY event_id) = 1"""
)
def dedupe_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The first event of each user, type and day."""
    fetched = table(spark, d, "events").select(
        F.col("event_type").alias("key"), "user_id", F.to_date("ts").alias("date"), "event_id", "value"
    )
    return chunks.first_fetch_wins(fetched, ["key", "user_id"], ["event_id"])


@query(
    f"WITH {SQL_COMBINED} SELECT key, date, {R_VARS} FROM combined WHERE key IN ('A', 'R') AND date >= '1998-01-01' AND date < '2000-07-01'"
)
def daily_range_of_keys(spark: SparkSession, d: str) -> DataFrame:
    """A key list and a half-open date range, both pushed to the scan."""
    out = combined(spark, d).where(in_dates(F.col("date"), "1998-01-01", "2000-07-01"))
    return rounded(only_keys(out, ["A", "R"]), *VARS)
