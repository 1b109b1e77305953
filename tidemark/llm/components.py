"""Connected components of links too many for one machine.

Alternating stars: every round hangs the neighbours of a node on the smallest of them, once
for larger neighbours and once for smaller ones, until each component is a star around its
smallest node. Each round is written to the shared folder, so lineage stays short and lost
executors cost one round. A node with very many links is only ever aggregated or joined by
its number, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def _signature(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that can be reached, of linked nodes.

    ``links`` has the long columns ``a`` and ``b``; direction, repeats and loops don't matter.
    Links with a null end are ignored. Nodes without a link are not in the result.
    """
    e = links.where(F.col("a") != F.col("b"))
    e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialise(e, "links")
    before = _signature(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        e = materialise(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "links")
        after = _signature(e)
        if after == before:
            break
        before = after
    leaves = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
