"""Readers of JSON documents: summaries and boundaries, and of polygon layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.geometry import geojson_polygons
from tidemark.session import listing_in, materialise

_PROPERTIES = (
    "struct<slug:string, unit_name:string, state:string, area_km2:double, source:string, "
    "approximate:boolean, tmean_slope:double, tmean_sig:boolean, prcp_slope:double, prcp_sig:boolean>"
)
_GEOMETRY = "struct<type:string, coordinates:string>"  # coordinates stay text until the type is known
_FEATURE = f"struct<type:string, geometry:{_GEOMETRY}, properties:{_PROPERTIES}>"
BOUNDARY_SCHEMA = (
    f"struct<type:string, features:array<{_FEATURE}>, geometry:{_GEOMETRY}, properties:{_PROPERTIES}>"
)
#: tasks that list the folders of keys
LISTING_TASKS = 200


def parse_boundaries(texts: DataFrame, text: str = "value", keep: Sequence[str] = ("key",)) -> DataFrame:
    """Add ``features``: those of a FeatureCollection, or the bare Feature itself."""
    doc = texts.select(*keep, F.from_json(text, BOUNDARY_SCHEMA).alias("d"))
    itself = F.array(F.struct(F.col("d.type"), F.col("d.geometry"), F.col("d.properties")))
    collection = F.col("d.type") == "FeatureCollection"
    features = F.when(collection, F.coalesce("d.features", F.array())).otherwise(itself)
    return doc.where(F.col("d.type").isNotNull()).select(*keep, features.alias("features"))


def rejected_boundaries(texts: DataFrame, text: str = "value", keep: Sequence[str] = ("key",)) -> DataFrame:
    """``*keep, line, reason`` of the texts that ``parse_boundaries`` leaves out."""
    doc = texts.select(*keep, F.col(text).alias("line"), F.from_json(text, BOUNDARY_SCHEMA).alias("d"))
    kind = F.get_json_object("line", "$")
    reason = F.when(kind.isNull(), "not JSON").when(F.col("d.type").isNull(), "without a type")
    return doc.where(F.col("d.type").isNull()).select(*keep, "line", reason.alias("reason"))


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON files as ``key, features``; the key is the file name. A file is one row."""
    texts = spark.read.text(path, wholetext=True, pathGlobFilter="*.geojson")
    key = F.regexp_extract("_metadata.file_name", r"^(.*)\.geojson$", 1)
    return parse_boundaries(texts.select(key.alias("key"), "value"))


def read_boundaries_by_key(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """The folder per key that ``write_boundaries`` writes, as ``key, features``; a line is a row.

    The key is taken from the path as text, so Spark need not look for partitions in all paths.
    """
    with listing_in(spark, LISTING_TASKS):
        texts = spark.read.option("recursiveFileLookup", True).text(path)
    return parse_boundaries(texts.select(F.regexp_extract("_metadata.file_path", f"{key}=([^/]+)/[^/]+$", 1).alias("key"), "value"))


def feature_polygons(boundaries: DataFrame, keep: Sequence[str] = ("key",)) -> DataFrame:
    """One row per feature with its properties and ``polygons``."""
    each = boundaries.select(*keep, F.posexplode("features").alias("feature", "f"))
    return each.select(
        *keep, "feature", F.col("f.properties").alias("properties"),
        geojson_polygons(F.col("f.geometry")).alias("polygons"),
    )


def read_features(
    spark: SparkSession, path: str | list[str], glob: str = "*.geojson", key: str = r"([^/]+)\.geojson$"
) -> DataFrame:
    """``key, properties, polygons`` of each feature of GeoJSON files, which are split at their features.

    ``key`` is found in a file's path by an expression.

    A collection of any size is read by many tasks, a feature a row. Every feature must begin with its
    type, as writers put it; ``read_boundaries`` takes any order, but a file at a time.
    """
    reader = spark.read.option("lineSep", '"Feature"').option("pathGlobFilter", glob)
    texts = reader.text(path).select("_metadata.file_path", "value")
    # what stands behind the type of one feature, up to that of the next; the reader stops where the feature ends
    body = texts.where(F.col("value").rlike(r"^\s*,")).select(
        F.regexp_extract("file_path", key, 1).alias("key"), F.from_json(F.concat(F.lit('{"type":"Feature"'), "value"), _FEATURE).alias("f")
    )
    return body.select("key", F.col("f.properties").alias("properties"), geojson_polygons(F.col("f.geometry")).alias("polygons"))


def read_layer(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = ("Unit_Nm", "Mang_Name", "Des_Tp", "State_Nm", "GIS_Acres", "polygons"),
    manager: str = "NPS",
) -> DataFrame:
    """A Parquet polygon layer; the attribute filter and the columns reach the scan."""
    return spark.read.parquet(path).where(F.col("Mang_Name") == manager).select(*columns)


def read_summaries_checked(spark: SparkSession, path: str, schema, whole_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """The documents that could be read, and ``path, line, reason`` of the others; one pass over the files.

    What has been read is stored, since both results are taken from it.
    """
    line = "_line"
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(line, T.StringType())]))
    read = reader.option("columnNameOfCorruptRecord", line).json(path, multiLine=whole_files)
    read = materialise(read.select("*", F.col("_metadata.file_path").alias("_path")), "documents")
    rejects = read.where(F.col(line).isNotNull()).select(F.col("_path").alias("path"), F.col(line).alias("line"), F.lit("not a document of this schema").alias("reason"))
    return read.where(F.col(line).isNull()).drop(line, "_path"), rejects


def read_summaries(spark: SparkSession, path: str, schema, whole_files: bool = False) -> DataFrame:
    """Summary documents as nested rows: one per line, as the writers write them.

    With ``whole_files`` each file is one document, which may span lines.
    """
    return spark.read.schema(schema).json(path, multiLine=whole_files)
