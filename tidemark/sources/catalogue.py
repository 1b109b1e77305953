"""Which files there are below a folder, and which columns each has, as tables.

One listing serves all readers of a folder. The keys asked for prune it before any file is opened.
Columns are found by tasks that open the files of a slice of the listing and read no more than a
Parquet footer or the first line of a CSV file; where Python has no access to a store, Spark reads the
files instead.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise

#: ``<key>/<part>.<suffix>``; folders ``key=<key>/part=<part>`` of files are understood as well
LAYOUT = r"([^/]+)/([^/]+?)(?:\.csv\.gz|\.csv|\.parquet)$"
FOLDERS = r"(?:^|/)key=([^/]+)/part=([^/]+)/[^/]+$"
SUFFIXES = ("parquet", "csv", "csv.gz")
#: files whose columns a task looks up
SLICE = 500
#: the first line of a CSV file is expected within so many bytes
HEAD = 1 << 20

#: what a Parquet column can be read as; anything else is no series
SPARK_TYPES = {
    "double": "double", "float": "float", "int": "int", "long": "bigint", "date": "date", "string": "string",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp_ntz", "nanos": "bigint",
}
NUMBERS = ("double", "float", "int", "long", "nothing")
DATES = ("date", "timestamp", "timestamp_ntz", "nanos", "string")

NOT_PARQUET, EMPTY, UNREACHABLE = "not a Parquet file", "an empty file", "out of reach"


def decoded(uri: Column) -> Column:
    """The path behind ``_metadata.file_path``, whose odd characters are escaped."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def key_part(path: Column, layout: str = LAYOUT) -> tuple[Column, Column]:
    """Key and part of a path."""

    def group(i: int) -> Column:
        plain = F.regexp_extract(path, layout, i)
        return F.when(path.rlike(FOLDERS), F.regexp_extract(path, FOLDERS, i)).otherwise(plain) if layout == LAYOUT else plain

    return group(1).alias("key"), group(2).alias("part")


def _kind(path: Column) -> Column:
    return F.when(path.endswith(".csv.gz"), "csv.gz").when(path.endswith(".csv"), "csv").otherwise("parquet")


def escaped(name: str) -> str:
    """A path for readers that take patterns."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", name)


def _binary(spark: SparkSession, root: str, keys: Sequence[str] | None, suffixes: Sequence[str], layout: str) -> DataFrame:
    glob = "*.{" + ",".join(suffixes) + "}" if len(suffixes) > 1 else f"*.{suffixes[0]}"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if keys and layout == LAYOUT:
        names = ",".join(escaped(n) for k in keys for n in (k, f"key={k}"))
        try:  # only the folders of these keys are listed
            return reader.load(f"{root.rstrip('/')}/{{{names}}}")
        except AnalysisException:
            pass  # they lie deeper: all is listed, and names decide
    return reader.load(root)


def listing(
    spark: SparkSession, root: str, keys: Sequence[str] | None = None, suffixes: Sequence[str] = SUFFIXES, layout: str = LAYOUT
) -> DataFrame:
    """``path, key, part, kind, length`` of the files below a folder, of some keys or all. Only names are read."""
    path = F.col("path")
    files = _binary(spark, root, keys, suffixes, layout).select(path, *key_part(path, layout), _kind(path).alias("kind"), "length")
    return files.where(F.col("key").isin(list(keys))) if keys else files


# ---- columns of files --------------------------------------------------------------


def _open(path: str) -> pa.NativeFile:
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return pyarrow.fs.LocalFileSystem().open_input_file("/" + (rest or scheme).lstrip("/"))
    if scheme not in ("hdfs", "s3", "s3a", "gs", "abfs"):
        raise OSError(scheme)
    files, inner = pyarrow.fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", path))
    return files.open_input_file(inner)


def _parquet_kind(c) -> str:
    logical, physical = c.logical_type.type, c.physical_type
    if "." in c.path:
        return "other"
    if physical == "INT96":
        return "timestamp"
    if physical == "INT64" and logical == "TIMESTAMP":
        told = c.logical_type.to_json()
        return "nanos" if "nanoseconds" in told else "timestamp" if '"isAdjustedToUTC": true' in told else "timestamp_ntz"
    if logical == "NULL":
        return "nothing"
    plain = {("INT32", "DATE"): "date", ("INT32", "NONE"): "int", ("INT64", "NONE"): "long", ("FLOAT", "NONE"): "float", ("DOUBLE", "NONE"): "double", ("BYTE_ARRAY", "STRING"): "string"}
    if logical == "INT" and '"isSigned": true' in c.logical_type.to_json():
        return "long" if physical == "INT64" else "int"
    return plain.get((physical, logical), "other")


def _columns(file: pa.NativeFile, kind: str) -> tuple[list[dict], str | None, str | None]:
    """Columns, the header of a CSV file, and what is wrong with the file."""
    if kind == "parquet":
        try:
            schema = pyarrow.parquet.ParquetFile(file).schema
        except (pa.ArrowInvalid, OSError):
            return [], None, NOT_PARQUET
        columns = [schema.column(i) for i in range(len(schema))]
        found = {c.path.split(".")[0]: _parquet_kind(c) for c in columns}
        return [{"name": n, "kind": k} for n, k in found.items()], None, None
    try:
        head = (gzip.GzipFile(fileobj=file) if kind == "csv.gz" else file).read(HEAD)
    except (OSError, EOFError):
        return [], None, "not a gzipped file"
    lines = [x for x in head.decode("utf-8", "replace").splitlines() if x.strip("﻿\r ")]
    if not lines:
        return [], None, EMPTY
    names = [n.strip(' "') for n in lines[0].strip("﻿").split(",")]
    return [{"name": n, "kind": "text"} for n in names], lines[0], None


_COLUMNS = pa.list_(pa.struct([("name", pa.string()), ("kind", pa.string())]))
_INSPECTED = "path string, columns array<struct<name: string, kind: string>>, header string, problem string"


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [(), (), (), ()]
    kinds = (pa.string(), _COLUMNS, pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["path", "columns", "header", "problem"])


def _by_path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for path, kind in zip(b["path"].to_pylist(), b["kind"].to_pylist()):
            try:
                with _open(path) as file:
                    found.append((path, *_columns(file, kind)))
            except (OSError, ImportError, pa.ArrowException):
                found.append((path, [], None, UNREACHABLE))
        yield _rows(found)


def _by_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, kind, content in zip(b["path"].to_pylist(), b["kind"].to_pylist(), b["content"]):
            yield _rows([(path, *_columns(pa.BufferReader(content.as_buffer()), kind))])


def catalogue(
    spark: SparkSession, root: str, keys: Sequence[str] | None = None, suffixes: Sequence[str] = SUFFIXES, layout: str = LAYOUT
) -> DataFrame:
    """The listing with ``columns`` (name, kind), ``header`` (of CSV files) and ``problem`` of each file; stored."""
    files = materialise(listing(spark, root, keys, suffixes, layout), "listing")
    slices = files.repartition(max(1, -(-files.count() // SLICE)))
    found = materialise(slices.select("path", "kind").mapInArrow(_by_path, _INSPECTED), "columns")
    lost = found.where(F.col("problem") == UNREACHABLE).select("path")
    if not lost.isEmpty():
        content = _binary(spark, root, keys, suffixes, layout).select("path", _kind(F.col("path")).alias("kind"), "content")
        read = content.join(lost, "path", "left_semi").mapInArrow(_by_content, _INSPECTED)
        found = found.where(F.col("problem").isNull() | (F.col("problem") != UNREACHABLE)).unionByName(read)
    return materialise(files.join(found, "path"), "catalogue")
