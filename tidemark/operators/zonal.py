"""Means of gridded values inside polygons.

Zones are rows with id columns and ``polygons`` (see ``functions.geometry``); cells
are rows with a position. Membership of a cell is that of its centre, under the
even-odd rule. It depends on the grid alone, so it is computed once from the cell
dimension and then joined to daily values by cell id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geometry import inside, ring_edges


def split_parts(
    zones: DataFrame, keep: Sequence[str], max_parts: int | None = None, part: str = "part_index"
) -> DataFrame:
    """One row per disjoint polygon, numbered from 0 in the order they are stored in.

    All parts are kept; only a caller who names ``max_parts`` gets no more than the first of each key.
    """
    out = zones.select(*keep, F.posexplode("polygons").alias(part, "polygon"))
    if max_parts is not None:
        out = out.where(F.col(part) < max_parts)
    return out.select(*keep, part, F.array("polygon").alias("polygons"))


def zone_edges(zones: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Edges of all rings of a zone. Edges along the ray are no crossings and are left out."""
    rings = zones.select(*ids, F.explode(F.flatten("polygons")).alias("ring"))
    return rings.select(*ids, F.inline(ring_edges(F.col("ring")))).where(F.col("y1") != F.col("y2"))


def zone_tiles(zones: DataFrame, ids: Sequence[str], tile: float) -> DataFrame:
    """Zones cut into square tiles; each tile holds the edges of its own latitude band.

    A ray through a band meets only edges that reach into it, so a detailed outline
    costs each cell the few edges of its band and not the whole outline.
    """
    banded = zone_edges(zones, ids).select(
        *ids,
        F.struct("x1", "y1", "x2", "y2").alias("edge"),
        F.explode(
            F.sequence(
                F.floor(F.least("y1", "y2") / tile).cast("int"),
                F.floor(F.greatest("y1", "y2") / tile).cast("int"),
            )
        ).alias("_ty"),
    )
    bands = banded.groupBy(*ids, "_ty").agg(
        F.collect_list("edge").alias("_edges"),
        F.min(F.least("edge.x1", "edge.x2")).alias("_x0"),
        F.max(F.greatest("edge.x1", "edge.x2")).alias("_x1"),
    )
    tiles = F.sequence(F.floor(F.col("_x0") / tile).cast("int"), F.floor(F.col("_x1") / tile).cast("int"))
    return bands.withColumn("_tx", F.explode(tiles))


def assign_cells(
    cells: DataFrame,
    zones: DataFrame,
    ids: Sequence[str],
    x: str = "lon",
    y: str = "lat",
    tile: float = 1.0,
) -> DataFrame:
    """Cells joined to every zone they lie in: all cell columns, then the zone ids.

    An equi-join on tiles; only cells and zones that share a tile ever meet.
    """
    placed = cells.withColumns(
        {"_cx": F.floor(F.col(x) / tile).cast("int"), "_cy": F.floor(F.col(y) / tile).cast("int")}
    )
    tiles = zone_tiles(zones, ids, tile)
    meets = (
        (F.col("_cx") == F.col("_tx"))
        & (F.col("_cy") == F.col("_ty"))
        & F.col(x).between(F.col("_x0"), F.col("_x1"))
    )
    pairs = placed.join(tiles, meets).where(inside(F.col("_edges"), F.col(x), F.col(y)))
    return pairs.select(*cells.columns, *ids)


def coarsen(cell_zone: DataFrame, stride: int, row: str = "row", col: str = "col") -> DataFrame:
    """Every ``stride``-th row and column of the grid: a coarser grid for all zones alike."""
    if stride < 1:
        raise ValueError("the stride is at least one")
    return cell_zone.where((F.col(row) % stride == 0) & (F.col(col) % stride == 0))


def zonal_mean(
    daily_cells: DataFrame,
    cell_zone: DataFrame,
    ids: Sequence[str],
    bands: Sequence[str],
    cell: str = "cell_id",
    date: str = "date",
) -> DataFrame:
    """Mean of each band over the cells of a zone per date.

    Cells outside every zone drop out in the join, and partial aggregation leaves at
    most one row per zone, date and task to shuffle.
    """
    members = cell_zone.select(cell, *ids)
    return (
        daily_cells.select(cell, date, *bands)
        .join(members, cell)
        .groupBy(*ids, date)
        .agg(*[F.avg(b).alias(b) for b in bands])
    )
