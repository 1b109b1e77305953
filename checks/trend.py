"""Trends, audit, summary documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import (
    HOW,
    MIN_ROWS,
    PERIODS,
    REFERENCE,
    SQL_ANNUAL,
    SQL_REGISTRY,
    SQL_SUPPLIER_MONTHS,
    VARS,
    canonical,
    combined,
    query,
    rounded,
    sql_reduce,
    sql_trends,
    supplier_months,
    supplier_registry,
    table,
)
from tidemark.operators import aggregate, browse, qc, trend
from tidemark.plans.audit import audit
from tidemark.plans.summary import (
    SummaryTables,
    Thresholds,
    index_documents,
    summary_documents,
    summary_tables,
)
from tidemark.session import materialise

SUPPLIER_TRENDS = f"WITH {SQL_SUPPLIER_MONTHS}, {sql_trends()}"
RECORD = (
    "round(slope_per_year, 6) AS slope_per_year, round(intercept, 4) AS intercept, "
    "round(total_change, 6) AS total_change, round(total_change_n, 6) AS total_change_n, mk_statistic, "
    "round(mk_z, 6) AS mk_z, round(p_value, 6) AS p_value, significant_95"
)


def supplier_trends(spark: SparkSession, d: str) -> DataFrame:
    return trend.trends(supplier_months(spark, d), ["key"], "x")


def _round_record(df: DataFrame) -> DataFrame:
    six = ["slope_per_year", "total_change", "total_change_n", "mk_z", "p_value"]
    return rounded(rounded(df, *six), "intercept", digits=4)


@query(
    f"{SUPPLIER_TRENDS} SELECT key, variable, CAST(n AS INTEGER) AS n, round(slope, 6) AS slope, "
    "round(intercept, 4) AS intercept FROM fitted"
)
def theil_sen(spark: SparkSession, d: str) -> DataFrame:
    stats = trend.trend_statistics(supplier_months(spark, d), ["key"], "x")
    return rounded(rounded(stats.select("key", "variable", "n", "slope", "intercept"), "slope"), "intercept", digits=4)


@query(
    f"{SUPPLIER_TRENDS} SELECT key, variable, CAST(n AS INTEGER) AS n, s, tie_term, round(var_s, 6) AS var_s, "
    "round(z, 6) AS z, abs(z) > 1.959963984540054 AS significant FROM fitted"
)
def mann_kendall(spark: SparkSession, d: str) -> DataFrame:
    stats = trend.trend_statistics(supplier_months(spark, d), ["key"], "x")
    columns = ["key", "variable", "n", "s", "tie_term", "var_s", "z", (F.col("p") < 0.05).alias("significant")]
    return rounded(stats.select(*columns), "var_s", "z")


@query(f"{SUPPLIER_TRENDS} SELECT key, variable, round(p, 6) AS p FROM fitted")
def mann_kendall_pvalue(spark: SparkSession, d: str) -> DataFrame:
    stats = trend.trend_statistics(supplier_months(spark, d), ["key"], "x")
    return rounded(stats.select("key", "variable", "p"), "p")


@query(f"{SUPPLIER_TRENDS} SELECT key, variable, n, start_year, end_year, {RECORD} FROM trends")
def trend_records(spark: SparkSession, d: str) -> DataFrame:
    return _round_record(supplier_trends(spark, d))


@query(
    f"""WITH {SQL_ANNUAL}, {sql_trends('annual_long', 'year', 5)}
SELECT key, variable, n, start_year, end_year, {RECORD} FROM trends"""
)
def annual_trends(spark: SparkSession, d: str) -> DataFrame:
    wide = aggregate.annual(combined(spark, d), ["key"], min_rows=MIN_ROWS)
    long = aggregate.to_long(wide, ["key", "year"])
    return _round_record(trend.trends(long, ["key"], min_points=5))


@query(
    f"""{SUPPLIER_TRENDS} SELECT key, variable, x, value, round(slope_per_year * x + intercept, 4) AS fitted
FROM series JOIN trends USING (key, variable)"""
)
def trend_line(spark: SparkSession, d: str) -> DataFrame:
    series = materialise(supplier_months(spark, d), "series")  # read for the fit and for the line
    return rounded(trend.trend_line(trend.trends(series, ["key"], "x"), series, ["key"], "x"), "fitted", digits=4)


@query(
    f"""WITH {SQL_ANNUAL}, {sql_trends('annual_long', 'year', 5)}
SELECT key, variable, round(slope_per_year, 6) AS slope_per_year,
  CASE variable WHEN 'tmean_c' THEN 1 WHEN 'tmax_c' THEN 2 WHEN 'tmin_c' THEN 3 WHEN 'prcp_mm' THEN 4 ELSE 99 END AS rank
FROM trends"""
)
def headline_trends_ranked(spark: SparkSession, d: str) -> DataFrame:
    wide = aggregate.annual(combined(spark, d), ["key"], min_rows=MIN_ROWS)
    rows = trend.trends(aggregate.to_long(wide, ["key", "year"]), ["key"], min_points=5)
    return rounded(
        browse.headline_first(rows, ["key"]).select("key", "variable", "slope_per_year", "rank"), "slope_per_year"
    )


@query(
    f"""{SUPPLIER_TRENDS} SELECT key, variable, round(slope_per_year, 6) AS slope_per_year,
  CASE variable WHEN 'tmean_c' THEN 'Mean temperature' ELSE 'Precipitation' END AS label,
  CASE variable WHEN 'tmean_c' THEN '°F / yr' ELSE 'mm / yr²' END AS slope_unit,
  CASE variable WHEN 'tmean_c' THEN 'temperature' ELSE 'precip' END AS kind,
  CASE variable WHEN 'tmean_c' THEN 3 ELSE 2 END AS decimals FROM trends"""
)
def headline_cards(spark: SparkSession, d: str) -> DataFrame:
    cards = browse.headline_cards(supplier_trends(spark, d), ["key"])
    picked = cards.select("key", "variable", "slope_per_year", "label", "slope_unit", "kind", "decimals")
    return rounded(picked, "slope_per_year")


@query(
    f"""{SUPPLIER_TRENDS} SELECT key, variable,
  round(slope_per_year * CASE variable WHEN 'tmean_c' THEN 1.8 ELSE 1.0 END, 6) AS slope_per_year,
  round(CASE variable WHEN 'tmean_c' THEN intercept * 9 / 5 + 32 ELSE intercept END, 4) AS intercept FROM trends"""
)
def display_trends(spark: SparkSession, d: str) -> DataFrame:
    shown = browse.display_trends(supplier_trends(spark, d)).select("key", "variable", "slope_per_year", "intercept")
    return rounded(rounded(shown, "slope_per_year"), "intercept", digits=4)


# ---- audit --------------------------------------------------------------------------

BANDS = {"tmean_c": (20.0, 52.7), "tmax_c": (0.0, 93.5), "prcp_mm": (0.0, 1e9)}


def _annual(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.annual(combined(spark, d), ["key"], min_rows=MIN_ROWS)


_BANDS_SQL = "bands(variable, lo, hi) AS (VALUES " + ", ".join(
    f"('{v}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for v, (lo, hi) in BANDS.items()
) + ")"
_RANGE_SQL = f"""bad AS (SELECT key, variable, min(year) AS year, arg_min(value, year) AS value, any_value(lo) AS lo,
    any_value(hi) AS hi FROM annual_long JOIN bands USING (variable) WHERE value < lo OR value > hi GROUP BY ALL)"""
_RANGE_ROWS = """SELECT key, variable, 'range' AS "check", 'FAIL' AS status,
  'in ' || year || ' the value ' || printf('%.3f', value) || ' leaves the band from ' || lo || ' to ' || hi AS note FROM bad"""


@query(f"WITH {SQL_ANNUAL}, {_BANDS_SQL}, {_RANGE_SQL} {_RANGE_ROWS}")
def qc_range(spark: SparkSession, d: str) -> DataFrame:
    return qc.check_ranges(aggregate.to_long(_annual(spark, d), ["key", "year"]), bands=BANDS)


_RECOMPUTE_ROWS = """
published AS (SELECT key, year, tmean_c, prcp_mm + CASE WHEN key = 'N' AND year >= 1997 THEN 1.0 ELSE 0.0 END AS prcp_mm
  FROM annual),
compared AS (SELECT p.key, p.year, 'tmean_c' AS variable, 'annual mean recompute' AS "check",
    abs(p.tmean_c - a.tmean_c) > 1e-6 AS bad, a.tmean_c AS e, p.tmean_c AS g
  FROM published p JOIN annual a ON p.key = a.key AND p.year = a.year
  UNION ALL SELECT p.key, p.year, 'prcp_mm', 'annual sum recompute', abs(p.prcp_mm - a.prcp_mm) > 1e-3, a.prcp_mm, p.prcp_mm
  FROM published p JOIN annual a ON p.key = a.key AND p.year = a.year),
recomputed AS (SELECT key, variable, "check", CASE WHEN bool_or(bad) THEN 'FAIL' ELSE 'PASS' END AS status,
  CASE WHEN bool_or(bad) THEN min(CASE WHEN bad THEN year END) || ': expected '
    || printf('%.4f', arg_min(e, year) FILTER (bad)) || ', pipeline ' || printf('%.4f', arg_min(g, year) FILTER (bad))
    ELSE count(*) || ' years agree' END AS note FROM compared GROUP BY ALL)"""


def _published(spark: SparkSession, d: str) -> DataFrame:
    """Annual rows with a planted error in one key."""
    planted = F.when((F.col("key") == "N") & (F.col("year") >= 1997), 1.0).otherwise(0.0)
    return _annual(spark, d).withColumn("prcp_mm", F.col("prcp_mm") + planted)


@query(f"WITH {SQL_ANNUAL}, {_RECOMPUTE_ROWS} SELECT * FROM recomputed")
def qc_recompute(spark: SparkSession, d: str) -> DataFrame:
    return qc.check_recompute(combined(spark, d), _published(spark, d), min_rows=MIN_ROWS)


# Every third supplier has its flag turned around, every fifth its slope set to zero.
_PLANTED = """planted AS (SELECT key, variable, n, CASE WHEN key % 5 = 0 THEN 0.0 ELSE slope_per_year END AS slope_per_year,
    p_value, CASE WHEN key % 3 = 0 THEN NOT significant_95 ELSE significant_95 END AS significant_95 FROM trends),
consistency AS (
  SELECT key, variable, 'significance flag' AS "check", 'FAIL' AS status,
    'flag is ' || CASE WHEN significant_95 THEN 'true' ELSE 'false' END || ' at a p-value of ' || printf('%.4f', p_value) AS note
  FROM planted WHERE (p_value < 0.05) <> significant_95
  UNION ALL SELECT key, variable, 'flat but significant', 'WARN',
    'significant although the slope is zero, as where most values are'
  FROM planted WHERE (p_value < 0.05) = significant_95 AND slope_per_year = 0 AND significant_95)"""


def _planted(rows: DataFrame) -> DataFrame:
    key, flag = F.col("key"), F.col("significant_95")
    return rows.withColumns(
        {
            "slope_per_year": F.when(key % 5 == 0, 0.0).otherwise(F.col("slope_per_year")),
            "significant_95": F.when(key % 3 == 0, ~flag).otherwise(flag),
        }
    )


@query(f"{SUPPLIER_TRENDS}, {_PLANTED} SELECT * FROM consistency")
def qc_consistency(spark: SparkSession, d: str) -> DataFrame:
    return qc.check_consistency(_planted(supplier_trends(spark, d)))


_BOUNDS = """bounds AS (SELECT s_suppkey AS key, -1.0 - s_nationkey % 3 AS lo, 1.5 AS hi, s_name AS source FROM supplier),
external AS (SELECT b.key, 'tmean_c' AS variable, 'published warming range' AS "check",
  CASE WHEN t.key IS NULL THEN 'FAIL' WHEN total_change_n BETWEEN lo AND hi THEN 'PASS' ELSE 'WARN' END AS status,
  CASE WHEN t.key IS NULL THEN 'the key has no trend of tmean_c' ELSE printf('%+.2f °C in %d years, %s %+.1f to %+.1f (%s)',
    total_change_n, t.n, CASE WHEN total_change_n BETWEEN lo AND hi THEN 'within' ELSE 'not within' END, lo, hi, source) END AS note
  FROM bounds b LEFT JOIN trends t ON b.key = t.key AND t.variable = 'tmean_c' AND t.key % 7 <> 0)"""


def _bounds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"),
        (F.lit(-1.0) - F.col("s_nationkey") % 3).alias("lo"),
        F.lit(1.5).alias("hi"),
        F.col("s_name").alias("source"),
    )


@query(f"{SUPPLIER_TRENDS}, {_BOUNDS} SELECT * FROM external")
def qc_external(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh supplier has lost its temperature trend."""
    rows = supplier_trends(spark, d)
    lost = rows.where((F.col("variable") != "tmean_c") | (F.col("key") % 7 != 0))
    return qc.check_external(lost, _bounds(spark, d), supplier_registry(spark, d))


@query(
    f"""{SUPPLIER_TRENDS}, {_PLANTED}, {_BOUNDS}, findings AS (SELECT * FROM consistency UNION ALL SELECT * FROM external)
SELECT "check", count(*) FILTER (status = 'PASS') AS pass, count(*) FILTER (status = 'WARN') AS warn,
  count(*) FILTER (status = 'FAIL') AS fail FROM findings GROUP BY ALL"""
)
def qc_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = materialise(supplier_trends(spark, d), "trends")  # read by both checks
    lost = rows.where((F.col("variable") != "tmean_c") | (F.col("key") % 7 != 0))
    findings = qc.check_consistency(_planted(rows)).unionByName(
        qc.check_external(lost, _bounds(spark, d), supplier_registry(spark, d))
    )
    return qc.count_findings(findings)


@query(
    f"""WITH {SQL_ANNUAL}, {sql_trends('annual_long', 'year', 5)}, {_BANDS_SQL}, {_RANGE_SQL}
SELECT key, variable, 'range' AS "check", 'FAIL' AS status, 'in ' || year || ' the value ' || printf('%.3f', value)
  || ' leaves the band from ' || lo || ' to ' || hi AS note FROM bad
UNION ALL SELECT key, 'tmean_c', 'annual mean recompute', 'PASS', count(*) || ' years agree' FROM annual GROUP BY key
UNION ALL SELECT key, 'prcp_mm', 'annual sum recompute', 'PASS', count(*) || ' years agree' FROM annual GROUP BY key
UNION ALL SELECT key, variable, 'flat but significant', 'WARN',
  'significant although the slope is zero, as where most values are' FROM trends WHERE significant_95 AND slope_per_year = 0
UNION ALL SELECT key, variable, 'published warming range',
  CASE WHEN total_change_n BETWEEN -1 AND 1 THEN 'PASS' ELSE 'WARN' END,
  printf('%+.2f °C in %d years, %s -1.0 to +1.0 (own estimate)', total_change_n, n,
    CASE WHEN total_change_n BETWEEN -1 AND 1 THEN 'within' ELSE 'not within' END) FROM trends WHERE variable = 'tmean_c'"""
)
def audit_findings(spark: SparkSession, d: str) -> DataFrame:
    """All four checks over the flags, on published tables."""
    wide = materialise(_annual(spark, d), "annual")
    rows = materialise(trend.trends(aggregate.to_long(wide, ["key", "year"]), ["key"], min_points=5), "trends")
    bounds = wide.select("key").distinct().select(
        "key", F.lit(-1.0).alias("lo"), F.lit(1.0).alias("hi"), F.lit("own estimate").alias("source")
    )
    return audit(combined(spark, d), wide, rows, bounds, BANDS, MIN_ROWS)


_PART_YEARS = f"""part_annual AS (SELECT key, part, CAST(year(date) AS INTEGER) AS year, {sql_reduce()}
  FROM canonical GROUP BY ALL HAVING count(*) >= {MIN_ROWS}),
part_long AS ({' UNION ALL '.join(f"SELECT key || '/' || part AS key, year, '{v}' AS variable, {v} AS value FROM part_annual" for v in VARS)}),
all_years AS (SELECT * FROM annual_long UNION ALL SELECT * FROM part_long)"""


@query(
    f"""WITH {SQL_ANNUAL}, {_PART_YEARS}
SELECT key, variable, 'annual ' || CASE variable WHEN 'tmean_c' THEN 'mean' ELSE 'sum' END || ' recompute' AS "check", 'PASS' AS status,
  count(*) || ' years agree' AS note FROM all_years WHERE variable IN ('tmean_c', 'prcp_mm') GROUP BY key, variable"""
)
def audit_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """What the audit says of the recomputed years of keys and of all their parts."""
    wide = materialise(_annual(spark, d), "annual")
    rows = trend.trends(aggregate.to_long(wide, ["key", "year"]), ["key"], min_points=5)
    bounds = wide.select("key").distinct().select("key", F.lit(-1.0).alias("lo"), F.lit(1.0).alias("hi"), F.lit("own").alias("source"))
    parts = canonical(spark, d)
    part_annual = aggregate.annual(parts, ["key", "part"], min_rows=MIN_ROWS)
    found = audit(combined(spark, d), wide, rows, bounds, BANDS, MIN_ROWS, part_daily=parts, part_annual=part_annual)
    return found.where(F.col("check").endswith("recompute"))


# ---- documents ------------------------------------------------------------------------

LIMITS = Thresholds(MIN_ROWS, 5, REFERENCE, PERIODS)


def flag_registry(spark: SparkSession, d: str) -> DataFrame:
    flags = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("key")).distinct()
    return flags.select(
        "key", F.concat(F.lit("Flag "), "key").alias("unit_name"), F.lit("CA,NV").alias("state"),
        F.lit(True).alias("multipart"),
    )


def flag_tables(spark: SparkSession, d: str) -> SummaryTables:
    return summary_tables(canonical(spark, d), HOW, LIMITS)


@query()
def summary_document(spark: SparkSession, d: str) -> DataFrame:
    return summary_documents(flag_tables(spark, d), flag_registry(spark, d))


@query(
    f"""WITH {SQL_ANNUAL}, {sql_trends('annual_long', 'year', 5)},
part_years AS (SELECT key, part, year(date) AS year FROM canonical GROUP BY ALL HAVING count(*) >= {MIN_ROWS}),
part_counts AS (SELECT key, count(*) AS n_part_years FROM part_years GROUP BY ALL),
seasons AS (SELECT key, count(DISTINCT (year(date + INTERVAL 1 MONTH), quarter(date + INTERVAL 1 MONTH))) AS n_seasons
  FROM combined GROUP BY ALL),
years AS (SELECT key, min(year) AS start_year, max(year) AS end_year, count(*) AS n_annual FROM annual GROUP BY ALL),
tests AS (SELECT key, count(*) AS n_trends, max(CASE variable WHEN 'tmean_c' THEN slope_per_year END) AS slope
  FROM trends GROUP BY ALL)
SELECT key, start_year, end_year, CAST(coalesce(n_annual, 0) AS INTEGER) AS n_annual,
  CAST(n_seasons AS INTEGER) AS n_seasonal, round(slope, 6) AS tmean_slope,
  CAST(coalesce(n_trends, 0) AS INTEGER) AS n_trends, CAST(coalesce(n_part_years, 0) AS INTEGER) AS n_part_years
FROM seasons LEFT JOIN years USING (key) LEFT JOIN tests USING (key) LEFT JOIN part_counts USING (key)"""
)
def summary_document_facts(spark: SparkSession, d: str) -> DataFrame:
    """Facts read from inside the nested documents."""
    docs = summary_documents(flag_tables(spark, d), flag_registry(spark, d))
    part_years = F.aggregate(
        F.map_values("part_summaries"), F.lit(0), lambda acc, p: acc + F.coalesce(F.size(p.annual), F.lit(0))
    )
    return docs.select(
        "key",
        "period.start_year",
        "period.end_year",
        F.size("annual").alias("n_annual"),
        F.size("seasonal").alias("n_seasonal"),
        F.round(F.col("headline_trends")["tmean_c"].slope_per_year, 6).alias("tmean_slope"),
        F.size("trends").alias("n_trends"),
        part_years.alias("n_part_years"),
    )


def _with_parts(docs: DataFrame, field: str) -> DataFrame:
    """The rows of a list in the documents, of keys and of their parts, named ``key/part``."""
    own = docs.select("key", F.inline(field))
    parts = docs.select("key", F.explode("part_summaries").alias("part", "s")).select(F.concat_ws("/", "key", "part").alias("key"), F.inline(f"s.{field}"))
    return own.unionByName(parts)


@query(f"WITH {SQL_ANNUAL}, {_PART_YEARS} SELECT key, year, variable, round(value, 6) AS value FROM all_years WHERE value IS NOT NULL")
def summary_document_years(spark: SparkSession, d: str) -> DataFrame:
    """All annual values inside the documents, those of parts included."""
    docs = materialise(summary_documents(flag_tables(spark, d), flag_registry(spark, d)), "documents")
    wide = _with_parts(docs, "annual")
    long = wide.unpivot(["key", "year"], [c for c in wide.columns if c not in ("key", "year")], "variable", "value")
    return rounded(long.where("value IS NOT NULL"), "value")


@query(
    f"""WITH {SQL_ANNUAL}, {_PART_YEARS}, {sql_trends('all_years', 'year', 5)}
SELECT key, variable, n, start_year, end_year, round(slope_per_year, 6) AS slope_per_year, round(total_change, 6) AS total_change,
  round(p_value, 6) AS p_value, significant_95 FROM trends"""
)
def summary_document_trends(spark: SparkSession, d: str) -> DataFrame:
    """All trends inside the documents, those of parts included."""
    docs = materialise(summary_documents(flag_tables(spark, d), flag_registry(spark, d)), "documents")
    fields = "key variable n start_year end_year slope_per_year total_change p_value significant_95".split()
    return rounded(_with_parts(docs, "trends").select(*fields), "slope_per_year", "total_change", "p_value")


@query(
    f"""WITH {SQL_ANNUAL}, moments AS (SELECT *,
  avg(CASE WHEN year BETWEEN {REFERENCE[0]} AND {REFERENCE[1]} THEN value END) OVER s AS mu,
  stddev_pop(CASE WHEN year BETWEEN {REFERENCE[0]} AND {REFERENCE[1]} THEN value END) OVER s AS sd
  FROM annual_long WINDOW s AS (PARTITION BY key, variable)),
scored AS (SELECT key, year, variable, value - mu AS anom, CASE WHEN sd <> 0 THEN (value - mu) / sd END AS z FROM moments)
SELECT key, year, variable, round(anom, 6) AS anom, round(z, 6) AS z FROM scored"""
)
def summary_document_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """All anomalies inside the documents."""
    docs = summary_documents(flag_tables(spark, d), flag_registry(spark, d))
    return rounded(docs.select("key", F.inline("anomalies")).select("key", "year", "variable", "anom", "z"), "anom", "z")


@query(
    f"""WITH {SQL_ANNUAL}, {sql_trends('annual_long', 'year', 5)}
SELECT k.key, 'Flag ' || k.key AS unit_name, CAST(min(year) AS INTEGER) AS start_year, CAST(max(year) AS INTEGER) AS end_year,
  t.variable, round(any_value(t.slope_per_year), 6) AS slope_per_year, any_value(t.significant_95) AS significant_95
FROM (SELECT DISTINCT l_returnflag AS key FROM lineitem) k JOIN trends t ON t.key = k.key LEFT JOIN annual a ON a.key = k.key
WHERE t.variable IN ('tmean_c', 'tmax_c', 'tmin_c', 'prcp_mm') GROUP BY k.key, t.variable"""
)
def index_document_trends(spark: SparkSession, d: str) -> DataFrame:
    """The headline trends of all index entries."""
    entries = index_documents(summary_documents(flag_tables(spark, d), flag_registry(spark, d)))
    each = entries.select("key", "unit_name", "period.start_year", "period.end_year", F.explode("headline_trends").alias("variable", "t"))
    return each.select("key", "unit_name", "start_year", "end_year", "variable", F.round("t.slope_per_year", 6).alias("slope_per_year"), "t.significant_95")


@query()
def index_document(spark: SparkSession, d: str) -> DataFrame:
    return index_documents(summary_documents(flag_tables(spark, d), flag_registry(spark, d)))


_OVERVIEW = f"""{SUPPLIER_TRENDS}, {SQL_REGISTRY},
overview AS (SELECT r.key, unit_name, state, c.total_change * 9 / 5 AS total_f, w.slope_per_year AS prcp_slope,
    coalesce(c.significant_95, false) AS significant, c.key IS NULL AS no_data
  FROM registry r LEFT JOIN trends c ON c.key = r.key AND c.variable = 'tmean_c'
  LEFT JOIN trends w ON w.key = r.key AND w.variable = 'prcp_mm'),
codes AS (SELECT *, list_transform(string_split_regex(state, '[,/]'), lambda s: trim(s)) AS cs FROM overview)"""

_STATE_CASE = {
    "AK": "alaska", "WA": "washington", "OR": "oregon", "CA": "california", "NV": "nevada", "WY": "wyoming",
    "MT": "montana", "ID": "idaho", "UT": "utah", "AZ": "arizona", "NM": "new mexico", "TX": "texas",
    "CO": "colorado", "SD": "south dakota", "ND": "north dakota", "MN": "minnesota", "MI": "michigan", "OH": "ohio",
    "TN": "tennessee", "NC": "north carolina", "FL": "florida", "HI": "hawaii", "AS": "american samoa",
    "VI": "virgin islands", "ME": "maine", "VA": "virginia", "WV": "west virginia", "MO": "missouri",
}
_REGION_CASE = {
    "Alaska": "AK", "Pacific NW": "WA OR", "California": "CA", "Rockies": "MT WY ID CO SD ND",
    "Southwest": "AZ UT NV NM TX", "Midwest": "MN MI OH MO", "East": "ME VA WV TN NC FL", "Tropical": "HI AS VI",
}
_STATE_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in _STATE_CASE.items()) + "}"
_REGION_MAP = "MAP {" + ", ".join(f"'{c}': '{r}'" for r, cs in _REGION_CASE.items() for c in cs.split()) + "}"
_SEARCHED = f"""{_OVERVIEW},
searchable AS (SELECT *, array_to_string(list_transform(cs, lambda s:
    lower(s) || coalesce(' ' || {_STATE_MAP}[s], '')), ' ') AS state_key,
  coalesce({_REGION_MAP}[cs[1]], 'Other') AS region FROM codes)"""


def supplier_overview(spark: SparkSession, d: str) -> DataFrame:
    registry = supplier_registry(spark, d).select("key", "unit_name", "state")
    return browse.overview(registry, supplier_trends(spark, d))


@query(
    f"""{_SEARCHED} SELECT key, unit_name, state, state_key, region, round(total_f, 6) AS total_f,
  round(prcp_slope, 6) AS prcp_slope, significant, no_data FROM searchable"""
)
def browse_overview(spark: SparkSession, d: str) -> DataFrame:
    return rounded(supplier_overview(spark, d).drop("slope_f"), "total_f", "prcp_slope")


@query(
    f"""{_SEARCHED} SELECT key, region, round(total_f, 6) AS total_f FROM searchable
WHERE (contains(lower(unit_name), 'ia') OR contains(state_key, 'ia')) ORDER BY coalesce(total_f, 0) DESC"""
)
def browse_search_sort(spark: SparkSession, d: str) -> DataFrame:
    found = browse.browse(supplier_overview(spark, d), text=" IA ", sort="warming")
    return rounded(found.select("key", "region", "total_f"), "total_f")


@query(
    f"""{_SEARCHED} SELECT key, region, significant, round(prcp_slope, 6) AS prcp_slope FROM searchable
WHERE region = 'Rockies' AND significant"""
)
def browse_region_significant(spark: SparkSession, d: str) -> DataFrame:
    found = browse.browse(supplier_overview(spark, d), region="Rockies", significant_only=True, sort="drier")
    return rounded(found.select("key", "region", "significant", "prcp_slope"), "prcp_slope")


@query(
    f"""{_SEARCHED} SELECT key, region, significant, round(prcp_slope, 6) AS prcp_slope FROM searchable
WHERE region = 'Southwest' AND NOT significant"""
)
def browse_region(spark: SparkSession, d: str) -> DataFrame:
    """A region with hits, of which those without a significant trend are shown."""
    found = browse.browse(supplier_overview(spark, d), region="Southwest", sort="wetter")
    return rounded(found.where(~F.col("significant")).select("key", "region", "significant", "prcp_slope"), "prcp_slope")


@query(
    f"""{_SEARCHED} SELECT key, region, round(total_f, 6) AS total_f, significant,
  CAST(greatest(1, ceil(max(total_f) OVER ())) AS BIGINT) AS axis_max,
  CAST(least(0, floor(min(total_f) OVER ())) AS BIGINT) AS axis_min FROM searchable WHERE total_f IS NOT NULL"""
)
def region_strip(spark: SparkSession, d: str) -> DataFrame:
    rows = materialise(supplier_overview(spark, d), "overview")  # read twice: rows and axis
    strip = browse.region_strip(rows)
    return rounded(strip.select("key", "region", "total_f", "significant", "axis_max", "axis_min"), "total_f")


