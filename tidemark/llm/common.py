"""What several operators share: words, shared tables, columns kept clear of each other."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise, new_folder

__all__ = ["SPACE", "materialise", "new_folder", "nullable", "table", "temporary", "words_of"]

#: ASCII white space, as a character class of Java's expressions
SPACE = r"[ \t\n\x0B\f\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The maximal runs of anything but ASCII white space; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def nullable(values: list[int | None]) -> pd.api.extensions.ExtensionArray:
    """Whole numbers as a column of pandas, exact beside nulls.

    The way from Spark to pandas makes floats of numbers beside a null: ids travel it as text.
    """
    return pd.array(values, dtype="Int64")


def temporary(*names: str) -> list[str]:
    """Column names that no caller's column can clash with."""
    tag = uuid.uuid4().hex[:8]
    return [f"__{n}_{tag}" for n in names]
