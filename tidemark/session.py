"""Session settings and durable intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: what results depend on, and what a job at scale wants; sizes are left to AQE
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans here are built from many columns; noting the source line of each takes longer than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only on a local master without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("on a cluster spark.checkpoint.dir has to name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    Consumers with different columns would each recompute the work behind it. The
    written table survives the loss of executors, prunes columns per consumer and
    gives the optimiser true sizes.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def listing_in(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Paths read inside are listed by at most so many tasks, or two a core if these are more.

    Spark lists many folders by up to 10,000 tasks; a folder takes far less than starting a task for it.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name, None)
    most = max(tasks, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set(name, str(min(most, int(before or most))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark for broadcast if the frame is counted to have at most ``max_rows`` rows.

    Beyond that the frame is returned unmarked, and the join shuffles. The count runs the
    frame, so pass a stored table where it is costly.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
