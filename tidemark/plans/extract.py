"""Daily series of areas, from gridded cells to canonical rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import in_dates
from tidemark.functions.labels import part_label
from tidemark.operators.canonical import coalesce_dates, merge_sources
from tidemark.operators.zonal import assign_cells, split_parts, zonal_mean
from tidemark.session import broadcast_within, materialise
from tidemark.sources.registry import only_keys
from tidemark.sources.sinks import write_daily
from tidemark.spec import DEFAULT_SPEC, PRESENT, SeriesSpec


#: a cell and its zone take some 60 bytes, so a full broadcast is about 120 MB
MAX_BROADCAST_CELLS = 2_000_000


class UnknownArea(ValueError):
    """A name or key that no boundary matches."""


def zones_by_key(boundaries: DataFrame, max_parts: int | None = None) -> DataFrame:
    """``key, part, polygons``: one zone per part of a multipart key, one zone ``all`` for others.

    ``boundaries`` has ``key, multipart, polygons``.
    """
    several = split_parts(boundaries.where("multipart"), ["key", "multipart"], max_parts)
    whole = boundaries.where(~F.col("multipart")).select("key", "multipart", F.lit(0).alias("part_index"), "polygons")
    label = part_label(F.col("multipart"), F.col("part_index"))
    return several.unionByName(whole).select("key", label.alias("part"), "polygons")


def daily_series(
    grids: Mapping[str, DataFrame],
    members: DataFrame,
    bands: Mapping[str, Sequence[str]],
    start: str,
    end: str,
    ids: Sequence[str] = ("key", "part"),
    barred: DataFrame | None = None,
    max_broadcast: int = MAX_BROADCAST_CELLS,
    spec: SeriesSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Zonal means of several data sources merged to one row per zone and date.

    ``grids`` maps a source name to its daily cells ``(cell_id, date, <bands>)`` and
    ``members`` has ``(dataset, cell_id, *ids)``: each source has its own grid.
    ``barred`` lists ``(dataset, key)`` a source does not serve. The date range is half
    open and is filtered on the scan.

    ``_present`` tells which columns a zone has: those of the bands of each source that has
    cells in it and is not barred, on all its dates.

    The membership of up to ``max_broadcast`` cells goes to every task, and the daily
    cells stay where they are read. Beyond that the join shuffles by cell, unless cells
    are stored by ``store_by_cell``: then only the membership moves.
    """
    # read three times for each source: to be counted, for its columns and for its cells
    members = materialise(members.select("dataset", "cell_id", *ids), "members")
    means, served = [], []
    for name, cells in grids.items():
        zone = members.where(F.col("dataset") == name)
        if barred is not None:
            zone = zone.join(barred, ["dataset", "key"], "left_anti")
        inside = cells.where(in_dates(F.col("date"), start, end))
        zone = broadcast_within(zone.select("cell_id", *ids), max_broadcast)
        mask = F.lit(spec.source_mask([f"{name}_{b}" for b in bands[name]])).cast("long").alias(PRESENT)
        served.append(zone.select(*ids, mask).distinct())
        mean = zonal_mean(inside, zone, ids, bands[name])
        means.append(mean.withColumnsRenamed({b: f"{name}_{b}" for b in bands[name]}))
    masks = merge_sources(served).groupBy(*ids).agg(F.bit_or(PRESENT).alias(PRESENT))
    # a row per zone: Spark sends it to every task where its size allows
    return coalesce_dates(merge_sources(means), ids).join(masks, list(ids))


def store_by_cell(cells: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Store daily cells in buckets of their ``cell_id``, and return them as they are read back.

    A join with them by cell has no exchange of cells, only one of the membership, which has no dates.
    """
    writer = cells.repartition(buckets, "cell_id").write.bucketBy(buckets, "cell_id").sortBy("cell_id")
    writer.option("path", path).saveAsTable(table)
    return cells.sparkSession.table(table)


def cell_membership(
    grid_cells: Mapping[str, DataFrame],
    zones: DataFrame,
    ids: Sequence[str] = ("key", "part"),
    tile: float = 1.0,
) -> DataFrame:
    """``(dataset, cell_id, *ids)`` for all grids.

    It does not change with the dates: store it (``session.materialise``) and use it for
    all of them.
    """
    parts = []
    for name, cells in grid_cells.items():
        inside = assign_cells(cells, zones, ids, tile=tile)
        parts.append(inside.select(F.lit(name).alias("dataset"), "cell_id", *ids))
    return merge_sources(parts)


def area_series(
    grids: Mapping[str, DataFrame],
    members: DataFrame,
    bands: Mapping[str, Sequence[str]],
    zones: DataFrame,
    key: str,
    start: str,
    end: str,
    barred: DataFrame | None = None,
) -> DataFrame:
    """The same for one key, sorted by part and date. An unknown key is an error."""
    if zones.where(F.col("key") == key).isEmpty():
        raise UnknownArea(f"no boundary for {key!r}")
    mine = only_keys(members, [key])
    return daily_series(grids, mine, bands, start, end, barred=barred).orderBy("part", "date")


def export_areas(
    grids: Mapping[str, DataFrame],
    grid_cells: Mapping[str, DataFrame],
    bands: Mapping[str, Sequence[str]],
    boundaries: DataFrame,
    start: str,
    end: str,
    path: str,
    keys: Sequence[str] | None = None,
    barred: DataFrame | None = None,
    tile: float = 1.0,
    max_parts: int | None = None,
    formats: Sequence[str] = ("parquet",),
) -> None:
    """Write the daily series of all keys, or of some, in one folder per key and part.

    ``_present`` is written along, so that a reader knows which columns a series has. ``max_parts``
    limits the parts of a key only if it is named.
    """
    zones = zones_by_key(only_keys(boundaries, keys), max_parts)
    members = materialise(cell_membership(grid_cells, zones, tile=tile), "members")
    write_daily(daily_series(grids, members, bands, start, end, barred=barred), path, formats=formats)
