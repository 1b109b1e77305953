"""Writers. Every writer keeps all rows distributed; nothing is gathered into one file."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geometry import geojson_geometry
from tidemark.functions.values import numbers_finite
from tidemark.session import materialise
from tidemark.spec import DATASET_COLUMNS

#: files of single keys that a task writes: a small file costs milliseconds, however few bytes it has
FILES_PER_TASK = 500


def export_columns(df: DataFrame, datasets: Sequence[str], keep: Sequence[str] = ("date",)) -> DataFrame:
    """Every declared column of the data sources, in order; those the frame lacks are NULL.

    A table of mixed sources then has the same columns whatever its first rows hold.
    """
    wanted = [c for d in datasets for c in DATASET_COLUMNS[d]]
    have = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in wanted])


def write_daily(
    df: DataFrame, path: str, keys: Sequence[str] = ("key", "part"), formats: Sequence[str] = ("csv", "parquet")
) -> None:
    """Daily rows in one folder per key and part, below a folder per format.

    Rows are rebalanced by key first: few files per folder, and a key with very many
    rows is split over several tasks. Dates are sorted within a file, so that Parquet
    statistics can prune a date range. Parquet is written first and other formats are
    made from it, so that the series are computed once.
    """
    for kind in sorted(formats, key=lambda k: k != "parquet"):
        placed = df.hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*keys, "date")
        writer = placed.write.mode("errorifexists").partitionBy(*keys)
        if kind == "csv":
            writer.option("header", True).csv(f"{path}/{kind}")
        else:
            writer.format(kind).save(f"{path}/{kind}")
        if kind == "parquet":
            df = df.sparkSession.read.schema(df.schema).parquet(f"{path}/parquet")


def write_summaries(docs: DataFrame, path: str, key: str = "key", folders: bool = True) -> None:
    """One JSON document per key, in its own folder or as lines. NULL fields are written.

    With very many keys, lines spare the file system a small file for each.
    """
    writer = numbers_finite(docs).write.option("ignoreNullFields", False)
    (writer.partitionBy(key) if folders else writer).json(path)


def index_lines(docs: DataFrame, fields: Sequence[str], key: str = "key") -> DataFrame:
    """The index entry of every key as JSON text."""
    entry = F.to_json(F.struct(key, *fields), {"ignoreNullFields": "false"})
    return numbers_finite(docs.select(key, *fields)).select(key, entry.alias("value"))


def write_index(docs: DataFrame, path: str, fields: Sequence[str], key: str = "key") -> None:
    """All index entries in key order, one JSON object per line.

    Lines instead of one array: the index grows with the keys and is written by all tasks.
    """
    index_lines(docs, fields, key).repartitionByRange(key).sortWithinPartitions(key).select("value").write.text(path)


def feature_text(
    boundaries: DataFrame, properties: Sequence[str], keep: Sequence[str] = ("key",)
) -> DataFrame:
    """A GeoJSON Feature per row, with the given columns as properties."""
    bag: Column = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    text = F.concat(
        F.lit('{"type":"Feature","geometry":'), geojson_geometry(F.col("polygons")),
        F.lit(',"properties":'), bag, F.lit("}"),
    )
    return boundaries.select(*keep, text.alias("value"))


def write_boundaries(
    boundaries: DataFrame, path: str, properties: Sequence[str], key: str = "key", folders: bool = True,
    files_per_task: int = FILES_PER_TASK,
) -> None:
    """All features as newline-delimited GeoJSON, and a FeatureCollection per key.

    Tasks for the files of keys are made by their number, since all of them together have few bytes. A key of very many
    features is dealt in blocks of them, to a file each. With very many keys, ``folders=False`` leaves out the small
    file for each.
    """
    features = feature_text(boundaries, properties, (key,))
    if not folders:
        features.select("value").write.text(f"{path}/all_keys")
        return
    features = materialise(features, "features")  # written in two forms
    features.select("value").write.text(f"{path}/all_keys")
    collection = F.concat(F.lit('{"type":"FeatureCollection","features":['), "value", F.lit("]}"))
    tasks = max(1, math.ceil(features.count() / files_per_task))
    block = F.shiftright(F.monotonically_increasing_id(), 16)  # 65,536 stored rows
    dealt = features.select(key, collection.alias("value"), block.alias("_block")).repartition(tasks, key, "_block")
    dealt.drop("_block").write.partitionBy(key).text(f"{path}/by_key")
