"""Time the summary of many full-length series, one key of which holds a third of all rows.

    python -m checks.scale [keys] [years] [folder]

Writes raw rows as two sources would deliver them (two half-filled rows per date), then
runs the whole summary over them. No query uses these rows.
"""

from __future__ import annotations

import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.canonical import canonicalise, coalesce_dates, present_columns
from tidemark.plans.summary import summary_documents, summary_tables
from tidemark.session import SETTINGS
from tidemark.spec import DATASET_COLUMNS, RAW_COLUMNS, PRESENT


def raw_rows(spark: SparkSession, keys: int, years: int) -> DataFrame:
    """``keys`` series of ``years`` years; series 0 has as many parts as half of the others."""
    n = years * 365
    parts = spark.range(keys).select(
        F.format_string("k%05d", "id").alias("key"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("id") == 0, F.lit(keys // 2)).otherwise(F.lit(0)))).alias("part"),
    )
    days = parts.repartition("key", "part").select(
        "key",
        F.concat_ws("_", "key", F.col("part").cast("string")).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"),
    )
    days = days.select("key", "part", F.date_add(F.lit("1980-01-01").cast("date"), F.col("i")).alias("date"), "i")
    wave = F.cos(F.col("i") * (6.283185 / 365.25))

    def noise(c: str):
        return (F.xxhash64("key", "part", "i", F.lit(c)) % 1000) / 500.0

    def band(c: str, mine: bool):
        if not mine:
            return F.lit(None).cast("double").alias(c)
        level = 275.0 if "temperature" in c else 10.0
        return (F.lit(level) - 8 * wave + noise(c) + F.col("i") * 1e-4).alias(c)

    sources = [
        days.select("key", "part", "date", *[band(c, c in mine) for c in RAW_COLUMNS])
        for mine in DATASET_COLUMNS.values()
    ]
    return sources[0].unionByName(sources[1])


def main(keys: int, years: int, folder: str) -> None:
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
    builder = builder.config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    raw_rows(spark, keys, years).write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw").withColumn(PRESENT, present_columns(RAW_COLUMNS))
    print(f"{raw.count()} raw rows, {raw.where(F.col('key') == 'k00000').count()} of one key", flush=True)

    start = time.perf_counter()
    daily = canonicalise(coalesce_dates(raw, ["key", "part"]), ["key", "part"])
    tables = summary_tables(daily)
    registry = raw.select("key").distinct().select(
        "key", F.col("key").alias("unit_name"), F.lit("UT").alias("state"), F.lit(False).alias("multipart")
    )
    summary_documents(tables, registry).write.parquet(f"{folder}/documents")
    seconds = time.perf_counter() - start
    docs = spark.read.parquet(f"{folder}/documents")
    tests = docs.agg(F.count("*").alias("n"), F.sum(F.size("trends")).alias("t")).first()
    print(f"{tests.n} summaries with {tests.t} trends in {seconds:.1f} s")


if __name__ == "__main__":
    args = sys.argv[1:]
    main(
        int(args[0]) if args else 63,
        int(args[1]) if len(args) > 1 else 45,
        args[2] if len(args) > 2 else tempfile.mkdtemp(prefix="run-"),
    )
