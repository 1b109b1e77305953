"""Readers of raw daily series: one file per key and part.

Key and part come from the path. Files of different keys may have different columns,
so a reader returns all known columns plus the ``_present`` mask: that of a file which has it as a
column, else the columns the file has. What cannot be read is not lost in silence: the
checked reader gives it as rows of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import broadcast_within, materialise
from tidemark.sources.catalogue import DATES, LAYOUT, NUMBERS, SPARK_TYPES, catalogue, decoded, escaped, key_part
from tidemark.spec import DEFAULT_SPEC, PRESENT, RAW_COLUMNS, SeriesSpec

#: per-file tables up to this many rows are sent to every task: some 300 bytes each
MAX_BROADCAST_FILES = 500_000
#: texts that stand for a missing number
MISSING = ("", "na", "nan", "null", "none", "n/a", "<na>", "#n/a")
_NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


class Reading(NamedTuple):
    """``rows`` as ``read_raw`` gives them, and ``rejects``: ``path, line, reason``."""

    rows: DataFrame
    rejects: DataFrame


def _mask(spec: SeriesSpec, names: Column) -> Column:
    """The ``_present`` mask of a file with these columns."""
    bits = [F.when(F.array_contains(names, c), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(spec.source_columns)]
    return reduce(lambda a, b: a + b, bits)


def _day(kind: str) -> Column:
    date = F.col("date")
    if kind == "nanos":
        return F.to_date(F.timestamp_seconds(F.floor(date / F.lit(10**9))))
    return date.try_cast("date")


# ---- Parquet -----------------------------------------------------------------------


def _read_parquet(spark: SparkSession, files: DataFrame, layout: str, columns: Sequence[str], spec: SeriesSpec) -> list[DataFrame]:
    """A frame for each schema among the files; columns a file lacks are NULL.

    The paths of a schema come to the driver, which holds them as Spark's file index in any case.
    """
    wanted = [*columns, *spec.source_columns, "date", PRESENT]
    relevant = F.array_sort(F.filter("columns", lambda c: c["name"].isin(wanted)))
    groups = files.groupBy(relevant.alias("columns")).agg(F.collect_list("path").alias("paths"))
    frames = []
    for group in groups.collect():
        kinds = {c["name"]: c["kind"] for c in group["columns"]}
        if kinds["date"] == "nanos":
            spark.conf.set(_NANOS_AS_LONG, "true")  # Spark has no other way to read them
        readable = [n for n in kinds if kinds[n] in SPARK_TYPES and (n in ("date", PRESENT) or kinds[n] in NUMBERS)]
        schema = ", ".join(f"`{n}` {SPARK_TYPES[kinds[n]]}" for n in readable)
        df = spark.read.schema(schema).parquet(*sorted(map(escaped, group["paths"])))
        mask = F.lit(spec.source_mask(kinds)).cast("long")
        if kinds.get(PRESENT) in ("long", "int"):
            mask = F.coalesce(F.col(PRESENT).cast("long"), mask)
        values = [(F.col(f"`{c}`").cast("double") if c in readable else F.lit(None).cast("double")).alias(c) for c in columns]
        path = decoded(F.col("_metadata.file_path"))
        frames.append(df.select(*key_part(path, layout), _day(kinds["date"]).alias("date"), *values, mask.alias(PRESENT)))
    return frames


# ---- CSV ---------------------------------------------------------------------------


def _fields(line: Column | str) -> Column:
    # blanks around a value go, those inside (a date with a time) stay
    return F.split(F.trim(F.regexp_replace(line, r'["\r\x{FEFF}]', "")), " *, *")


def _read_csv(
    spark: SparkSession, files: DataFrame, layout: str, columns: Sequence[str], spec: SeriesSpec, checked: bool
) -> DataFrame:
    """CSV files by column name, whatever the order and choice of columns in each.

    Spark's CSV reader matches columns by position over all files, so lines are read as
    text, once, and each column is looked up in the header of its own file, which the
    catalogue has. The values are dates and numbers, without commas of their own.
    """
    paths = sorted(escaped(r["path"]) for r in files.select("path").toLocalIterator())
    lines = spark.read.text(paths).select(decoded(F.col("_metadata.file_path")).alias("_uri"), "value")
    # the two readers may write the root of a local path in different ways
    place = F.regexp_replace(F.col("_uri"), "^file:/+", "file:/")
    names = F.transform("columns", lambda c: c["name"])
    heads = files.select(
        F.regexp_replace("path", "^file:/+", "file:/").alias("_place"),
        F.col("path").alias("_path"), F.col("header").alias("_header"), names.alias("_names"), _mask(spec, names).alias("_mask"),
    )
    rows = lines.join(broadcast_within(heads, MAX_BROADCAST_FILES), place == F.col("_place"))
    rows = rows.where((F.trim(F.regexp_replace("value", r"[\r\x{FEFF}]", "")) != F.trim(F.regexp_replace("_header", r"[\r\x{FEFF}]", ""))) & (F.trim("value") != ""))
    rows = rows.withColumn("_cells", _fields("value"))

    def cell(name: str) -> Column:
        at = F.array_position("_names", F.lit(name)).cast("int")
        return F.when(at > 0, F.try_element_at("_cells", at))

    date = cell("date").try_cast("date")
    out = rows.select(
        *key_part(F.col("_path"), layout),
        date.alias("date"),
        *[cell(c).try_cast("double").alias(c) for c in columns],
        F.coalesce(cell(PRESENT).try_cast("long"), F.col("_mask")).alias(PRESENT),
        *(_problems(cell, columns, date) if checked else []),
    )
    return out


def _problems(cell, columns: Sequence[str], date: Column) -> list[Column]:
    """Path, line, and what is wrong with each; a missing number is nothing wrong."""
    width = F.when(F.size("_cells") != F.size("_names"), F.concat(F.size("_cells"), F.lit(" values under "), F.size("_names"), F.lit(" columns")))
    no_date = F.when(date.isNull(), F.concat(F.lit("not a date: "), F.coalesce(cell("date"), F.lit(""))))
    numbers = [
        F.when(cell(c).try_cast("double").isNull() & ~F.lower(cell(c)).isin(list(MISSING)), F.concat(F.lit(f"not a number: {c} "), cell(c)))
        for c in columns
    ]
    return [F.col("_path"), F.col("value").alias("_line"), F.array_compact(F.array(width, no_date, *numbers)).alias("_problems")]


# ---- all -----------------------------------------------------------------------


def _read(spark, root, layout, columns, spec, keys, suffixes, checked) -> Reading | DataFrame:
    files = catalogue(spark, root, keys, suffixes, layout)
    is_parquet = F.col("kind") == "parquet"
    first = files.groupBy("key").agg(F.max(is_parquet).alias("_parquet"))
    files = files.join(broadcast_within(first, MAX_BROADCAST_FILES), "key").where(is_parquet == F.col("_parquet"))
    if files.isEmpty():
        raise FileNotFoundError(f"no .{' or .'.join(suffixes)} below {root}" + (f" for {list(keys)}" if keys else ""))
    date_kind = F.get(F.filter("columns", lambda c: c["name"] == "date"), F.lit(0))["kind"]
    reason = F.coalesce("problem", F.when(date_kind.isNull(), "no column date").when(~date_kind.isin(*DATES, "text"), "the column date has no dates"))
    files = materialise(files.withColumn("reason", reason), "files")
    good = files.where("reason IS NULL")
    if "csv.gz" in suffixes and len(suffixes) == 1:
        several = good.groupBy("key").agg((F.count_distinct("part") > 1).alias("_several"))

    frames = _read_parquet(spark, good.where(is_parquet), layout, columns, spec)
    csv = good.where(~is_parquet)
    told = None
    if not csv.isEmpty():
        rows = _read_csv(spark, csv, layout, columns, spec, checked)
        if checked:
            rows = materialise(rows, "lines")  # good rows and rejects come from one pass over the text
            told = rows.where(F.size("_problems") > 0).select(F.col("_path").alias("path"), F.col("_line").alias("line"), F.explode("_problems").alias("reason"))
            rows = rows.drop("_path", "_line", "_problems")
        frames.append(rows)
    if frames:
        out = reduce(DataFrame.unionByName, frames).where("date IS NOT NULL")
    else:
        names = ", ".join(f"`{c}` double" for c in columns)
        out = spark.createDataFrame([], f"key string, part string, date date, {names}, {PRESENT} long")
    if "csv.gz" in suffixes and len(suffixes) == 1:
        out = out.join(broadcast_within(several, MAX_BROADCAST_FILES), "key")
        out = out.withColumn("part", F.when(F.col("_several"), F.col("part"))).drop("_several")
    if not checked:
        return out
    whole = files.where("reason IS NOT NULL").select("path", F.lit(None).cast("string").alias("line"), "reason")
    odd = good.where(is_parquet).select("path", F.explode("columns").alias("c")).where(F.col("c.name").isin(list(columns)) & ~F.col("c.kind").isin(*NUMBERS))
    odd = odd.select("path", F.lit(None).cast("string").alias("line"), F.concat(F.lit("not a column of numbers: "), F.col("c.name")).alias("reason"))
    rejects = whole.unionByName(odd)
    return Reading(out, rejects.unionByName(told) if told is not None else rejects)


def read_raw(
    spark: SparkSession,
    root: str,
    layout: str = LAYOUT,
    columns: Sequence[str] = RAW_COLUMNS,
    spec: SeriesSpec = DEFAULT_SPEC,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Raw daily rows of all keys, or of some: ``key, part, date, <columns>, _present``.

    Parquet is preferred per key; of a key that has it no CSV file is opened, and none at all of keys
    that are not asked for. Dates may be dates, timestamps of any unit or texts. Files without
    dates, lines without one and values that are no numbers are left out (the latter as NULL).
    """
    return _read(spark, root, layout, columns, spec, keys, ("parquet", "csv"), False)


def read_raw_checked(
    spark: SparkSession,
    root: str,
    layout: str = LAYOUT,
    columns: Sequence[str] = RAW_COLUMNS,
    spec: SeriesSpec = DEFAULT_SPEC,
    keys: Sequence[str] | None = None,
) -> Reading:
    """The rows of ``read_raw``, and a row for whatever was wrong with a file (no ``line``) or a line.

    One damaged file or line costs nobody else anything. The text is read once: rows with their
    problems are stored, and both results are taken from there.
    """
    return _read(spark, root, layout, columns, spec, keys, ("parquet", "csv"), True)


def read_gzipped(
    spark: SparkSession,
    root: str,
    layout: str = LAYOUT,
    columns: Sequence[str] = RAW_COLUMNS,
    spec: SeriesSpec = DEFAULT_SPEC,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Gzipped CSV files; ``part`` is NULL for keys with a single file."""
    return _read(spark, root, layout, columns, spec, keys, ("csv.gz",), False)
