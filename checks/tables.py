"""The shared tables seen as daily series, and the same views as SQL.

A key is a return flag, a part a line status, a date a ship date. The first line item
of an order plays a source with gaps, all line items one without; daily values are
maxima, minima and sums of whole numbers, so both engines get identical doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.canonical import canonicalise, coalesce_dates, combine_parts, merge_sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MIN_ROWS = 330
#: prices become "temperatures" in a unit whose values are never decimal ties when rounded
PRICE_UNIT = 977
REFERENCE = (1995, 1997)
PERIODS = ((1995, 1997), (1998, 2000))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL of its result."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared table. Kept per session, so that its file footers are read once."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- two daily sources from lineitem ------------------------------------------


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("key"),
        F.col("l_linestatus").alias("part"),
        F.to_date("l_shipdate").alias("date"),
    )


def gappy_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    def first_lines(c: str) -> Column:
        return F.when(F.col("l_linenumber") == 1, F.col(c))

    return _days(spark, sf_dir).agg(
        (F.max(first_lines("l_extendedprice")) / PRICE_UNIT).alias("DAYMET_tmax"),
        (F.min(first_lines("l_extendedprice")) / PRICE_UNIT).alias("DAYMET_tmin"),
        F.sum(first_lines("l_quantity")).alias("DAYMET_prcp"),
    )


def full_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return _days(spark, sf_dir).agg(
        (F.max(price) / PRICE_UNIT + 273.15).alias("ERA5_temperature_2m_max"),
        (F.min(price) / PRICE_UNIT + 273.15).alias("ERA5_temperature_2m_min"),
        (F.sum("l_quantity") / 1000).alias("ERA5_total_precipitation_sum"),
        F.max("l_discount").alias("ERA5_u_component_of_wind_10m"),
        F.max("l_tax").alias("ERA5_v_component_of_wind_10m"),
        (-F.sum("l_linenumber") / 1000).alias("ERA5_potential_evaporation_sum"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_sources([gappy_source(spark, sf_dir), full_source(spark, sf_dir)])


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonicalise(coalesce_dates(raw(spark, sf_dir), ["key", "part"]), ["key", "part"])


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_parts(canonical(spark, sf_dir).drop("part"), ["key"])


VARS = ("tmax_c", "tmin_c", "prcp_mm", "pet_mm", "tmean_c", "wind_speed_ms")
SUMS = {"prcp_mm", "pet_mm"}
HOW = {v: "sum" if v in SUMS else "mean" for v in VARS}

SQL_RAW = """
gappy AS (
  SELECT l_returnflag AS key, l_linestatus AS part, CAST(l_shipdate AS DATE) AS date,
    max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) / 977 AS daymet_tmax,
    min(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) / 977 AS daymet_tmin,
    sum(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS daymet_prcp
  FROM lineitem GROUP BY ALL),
complete AS (
  SELECT l_returnflag AS key, l_linestatus AS part, CAST(l_shipdate AS DATE) AS date,
    max(l_extendedprice) / 977 + 273.15 AS era5_temperature_2m_max,
    min(l_extendedprice) / 977 + 273.15 AS era5_temperature_2m_min,
    sum(l_quantity) / 1000 AS era5_total_precipitation_sum,
    max(l_discount) AS era5_u_component_of_wind_10m,
    max(l_tax) AS era5_v_component_of_wind_10m,
    -sum(l_linenumber) / 1000 AS era5_potential_evaporation_sum
  FROM lineitem GROUP BY ALL),
merged AS (
  SELECT key, part, date, max(daymet_tmax) AS daymet_tmax, max(daymet_tmin) AS daymet_tmin,
    max(daymet_prcp) AS daymet_prcp, max(era5_temperature_2m_max) AS era5_temperature_2m_max,
    max(era5_temperature_2m_min) AS era5_temperature_2m_min,
    max(era5_total_precipitation_sum) AS era5_total_precipitation_sum,
    max(era5_u_component_of_wind_10m) AS era5_u_component_of_wind_10m,
    max(era5_v_component_of_wind_10m) AS era5_v_component_of_wind_10m,
    max(era5_potential_evaporation_sum) AS era5_potential_evaporation_sum
  FROM (SELECT * FROM gappy UNION ALL BY NAME SELECT * FROM complete) GROUP BY key, part, date)"""

SQL_CANONICAL = (
    SQL_RAW
    + """,
filled AS (
  SELECT key, part, date,
    coalesce(daymet_tmax, era5_temperature_2m_max - 273.15) AS tmax_c,
    coalesce(daymet_tmin, era5_temperature_2m_min - 273.15) AS tmin_c,
    coalesce(daymet_prcp, era5_total_precipitation_sum * 1000) AS prcp_mm,
    era5_potential_evaporation_sum * -1000 AS pet_mm,
    sqrt(era5_u_component_of_wind_10m * era5_u_component_of_wind_10m
       + era5_v_component_of_wind_10m * era5_v_component_of_wind_10m) AS wind_speed_ms
  FROM merged),
canonical AS (SELECT *, (tmax_c + tmin_c) / 2 AS tmean_c FROM filled)"""
)


def sql_reduce(prefix: str = "") -> str:
    """Select items that reduce every variable over days."""
    return ", ".join(
        f"coalesce(sum({v}), 0.0) AS {prefix}{v}" if v in SUMS else f"avg({v}) AS {prefix}{v}" for v in VARS
    )


SQL_COMBINED = (
    SQL_CANONICAL
    + f""",
combined AS (SELECT key, date, {', '.join(f'avg({v}) AS {v}' for v in VARS)}
  FROM canonical GROUP BY key, date)"""
)

SQL_ANNUAL = (
    SQL_COMBINED
    + f""",
annual AS (SELECT key, CAST(year(date) AS INTEGER) AS year, {sql_reduce()}, count(*) AS n_days
  FROM combined GROUP BY ALL HAVING count(*) >= {MIN_ROWS}),
annual_long AS ({' UNION ALL '.join(f"SELECT key, year, '{v}' AS variable, {v} AS value FROM annual" for v in VARS)})"""
)

SQL_MONTHLY = (
    SQL_COMBINED
    + """,
monthly AS ("""
    + " UNION ALL ".join(
        f"SELECT key, '{v}' AS variable, CAST(date_trunc('month', date) AS DATE) AS month, "
        + (f"CASE WHEN count({v}) >= 20 THEN sum({v}) END" if v in SUMS else f"avg({v})")
        + f" AS value, count({v}) AS n_obs FROM combined GROUP BY ALL"
        for v in VARS
    )
    + """),
usable AS (SELECT key, variable, month, value, n_obs FROM monthly
  WINDOW s AS (PARTITION BY key, variable)
  QUALIFY sum(n_obs) OVER s >= 672 AND count(value) OVER s >= 24),
months AS (SELECT * FROM usable WHERE value IS NOT NULL),
rolled AS (SELECT *, CASE WHEN count(value) OVER r = 12 THEN avg(value) OVER r END AS trend FROM months
  WINDOW r AS (PARTITION BY key, variable ORDER BY month ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)),
periods(period_start, period_end) AS (VALUES """
    + ", ".join(f"({a}, {b})" for a, b in PERIODS)
    + """),
climatology AS (
  SELECT key, variable, period_start, period_end, CAST(month(month) AS INTEGER) AS moy, avg(value) AS mean,
    quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.9) AS p90
  FROM months JOIN periods ON year(month) BETWEEN period_start AND period_end GROUP BY ALL),
full_climatology AS (SELECT * FROM climatology
  QUALIFY count(*) OVER (PARTITION BY key, variable, period_start, period_end) = 12)"""
)


# ---- monthly series of every supplier -----------------------------------------


def supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exact monthly variables per supplier on a month axis: ``key, variable, x, value``."""
    m = F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1
    wide = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("key"), m.alias("x"))
        .agg(
            (F.max("l_extendedprice") / PRICE_UNIT).alias("tmean_c"),
            F.sum("l_quantity").alias("prcp_mm"),
        )
    )
    return wide.unpivot(["key", "x"], ["tmean_c", "prcp_mm"], "variable", "value")


SQL_SUPPLIER_MONTHS = """
supplier_wide AS (
  SELECT l_suppkey AS key, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER) AS x,
    max(l_extendedprice) / 977 AS tmean_c, sum(l_quantity) AS prcp_mm FROM lineitem GROUP BY ALL),
series AS (SELECT key, x, 'tmean_c' AS variable, tmean_c AS value FROM supplier_wide
  UNION ALL SELECT key, x, 'prcp_mm', prcp_mm FROM supplier_wide)"""


def sql_trends(series: str = "series", x: str = "x", min_points: int = 10) -> str:
    """Common table expressions from a long series to trend records, by plain pairs."""
    return f"""
sized AS (SELECT key, variable, {x} AS x, value AS y, count(*) OVER (PARTITION BY key, variable) AS n
  FROM {series} WHERE value IS NOT NULL QUALIFY n >= {min_points}),
pairs AS (SELECT a.key, a.variable, (b.y - a.y) / (b.x - a.x) AS slope, sign(b.y - a.y) AS rise
  FROM sized a JOIN sized b ON a.key = b.key AND a.variable = b.variable AND a.x < b.x),
slopes AS (SELECT key, variable, quantile_cont(slope, 0.5) AS slope, CAST(sum(rise) AS DOUBLE) AS s
  FROM pairs GROUP BY ALL),
levels AS (SELECT z.key, z.variable, any_value(n) AS n, min(x) AS first_x, max(x) AS last_x,
    quantile_cont(y - slope * x, 0.5) AS intercept
  FROM sized z JOIN slopes USING (key, variable) GROUP BY ALL),
tie_groups AS (SELECT key, variable, y, count(*) AS t FROM sized GROUP BY ALL),
ties AS (SELECT key, variable, CAST(sum(t * (t - 1) * (2 * t + 5)) AS DOUBLE) AS tie_term
  FROM tie_groups GROUP BY ALL),
tested AS (SELECT *, (n * (n - 1) * (2 * n + 5) - tie_term) / 18.0 AS var_s
  FROM slopes JOIN levels USING (key, variable) JOIN ties USING (key, variable)),
scored AS (SELECT *, CASE WHEN var_s <= 0 OR s = 0 THEN 0.0 ELSE (s - sign(s)) / sqrt(var_s) END AS z FROM tested),
arg AS (SELECT *, abs(z) / sqrt(2.0) AS q FROM scored),
fitted AS (SELECT *, CASE WHEN q = 0 THEN 1.0 ELSE greatest(0.0, 1 - 2 / sqrt(pi()) * exp(-q * q) * list_sum(
    list_transform(range(0, 200), lambda k: exp(2 * k * ln(2.0) + (2 * k + 1) * ln(q) + lgamma(k + 1)
      - lgamma(2 * k + 2))))) END AS p FROM arg),
trends AS (SELECT key, variable, CAST(n AS INTEGER) AS n, CAST(first_x AS INTEGER) AS start_year,
    CAST(last_x AS INTEGER) AS end_year, slope AS slope_per_year, intercept,
    slope * (last_x - first_x) AS total_change, slope * (n - 1) AS total_change_n, s AS mk_statistic,
    z AS mk_z, p AS p_value, abs(z) > 1.959963984540054 AS significant_95 FROM fitted)"""


# ---- suppliers as a registry ----------------------------------------------------

STATES = (
    "AK", "WA", "OR", "CA", "CA,NV", "WY,MT,ID", "UT", "AZ", "NM", "TX", "CO", "SD", "ND", "MN", "MI", "OH",
    "TN,NC", "FL", "HI", "AS", "VI", "ME", "VA/WV", "MO", "XX",
)


def supplier_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as keys: a name and the states of their nation; balances as positions."""
    states = F.array(*[F.lit(s) for s in STATES])
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.concat(F.translate("s_name", "#", " "), F.lit(" National Park")).alias("unit_name"),
        F.element_at(states, F.col("s_nationkey") + 1).alias("state"),
        (F.col("s_suppkey") % 2 == 0).alias("multipart"),
        (F.col("s_acctbal") / 200).alias("lat"),
        (F.col("s_acctbal") / -100).alias("lon"),
        (F.col("s_acctbal") + 1000).alias("area_km2"),
    )


SQL_REGISTRY = f"""
registry AS (SELECT s_suppkey AS key, translate(s_name, '#', ' ') || ' National Park' AS unit_name,
    {list(STATES)}[s_nationkey + 1] AS state, s_suppkey % 2 = 0 AS multipart, s_acctbal / 200 AS lat,
    s_acctbal / -100 AS lon, s_acctbal + 1000 AS area_km2 FROM supplier)"""
