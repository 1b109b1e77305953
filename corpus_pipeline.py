"""A corpus from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. The
result of each is written to the shared folder and read again, so a lost executor costs no
more than a stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, packing, quality, simhash
from tidemark.llm.common import materialise, table

#: Clean text is asked for in full and a little more, so that it stays whole; low-quality text
#: may fill a small share beside it, and toxic text has no place.
TARGETS = {"clean": 0.97, "low": 0.03, "toxic": 0.0}
HEADROOM = 0.05


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: lines that fail are cut out, documents that lose too much or fail the base rules go."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: of each group the document with the smallest id stays."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents are taken at the rates that meet the target weights, each at most once."""
    labels = mixing.domains_of(table(spark, sf_dir, "labels"))
    return mixing.keep_mixed(docs, labels, TARGETS, anchor="clean", headroom=HEADROOM)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: a row for each piece of a document in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", good_documents),
    ("simhash near-duplicates", one_of_each_group),
    ("mixing to target weights", mixed),
    ("packing", packed),
]

#: the fingerprints, the fitted rates and the tokens have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
