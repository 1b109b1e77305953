"""Polygons as nested arrays: polygons of rings of ``[x, y]`` vertices."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RING = "array<array<double>>"
POLYGON = f"array<{RING}>"
POLYGONS = f"array<{POLYGON}>"
KM_PER_DEGREE = 111.32


def circle_polygon(lat: Column, lon: Column, area_km2: Column, corners: int = 32) -> Column:
    """A closed one-ring polygon of the given area around a point.

    Longitudes are stretched by the cosine of the latitude, so that the shape looks
    round on a web map. Floors keep tiny areas visible and poles finite.
    """
    lat_reach = F.sqrt(F.greatest(area_km2, F.lit(0.05)) / F.lit(math.pi)) / KM_PER_DEGREE
    lon_reach = lat_reach / F.greatest(F.cos(F.radians(lat)), F.lit(0.05))

    def corner(i: Column) -> Column:
        angle = i * F.lit(2 * math.pi / corners)
        return F.array(lon + lon_reach * F.cos(angle), lat + lat_reach * F.sin(angle))

    # The last corner is the first one again, not the angle 2 pi, which is a rounding off.
    steps = F.transform(F.sequence(F.lit(0), F.lit(corners)), lambda i: i % corners)
    return F.array(F.transform(steps, corner))


def ring_edges(ring: Column) -> Column:
    """Edges ``(x1, y1, x2, y2)`` of a ring, closed if the data left it open."""
    after = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        after,
        lambda a, b: F.struct(
            a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")
        ),
    )


def crosses(edge: Column, x: Column, y: Column) -> Column:
    """Does the ray from the point towards growing x cross this edge?

    An edge owns its lower end and not its upper one, so that a vertex between two
    edges counts once, and edges along the ray never.
    """
    spans = (edge.y1 > y) != (edge.y2 > y)
    at = edge.x1 + F.try_divide((y - edge.y1) * (edge.x2 - edge.x1), edge.y2 - edge.y1)
    return spans & (x < at)


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over the edges of all rings; holes come for free."""
    return F.size(F.filter(edges, lambda e: crosses(e, x, y))) % 2 == 1


def geojson_polygons(geometry: Column) -> Column:
    """Polygons of a GeoJSON geometry ``struct<type, coordinates>`` with raw coordinates.

    A Polygon is a list of one; any other type is NULL.
    """
    one = F.from_json(geometry.coordinates, POLYGON)
    many = F.from_json(geometry.coordinates, POLYGONS)
    return F.when(geometry.type == "Polygon", F.array(one)).when(geometry.type == "MultiPolygon", many)


def geojson_geometry(polygons: Column) -> Column:
    """GeoJSON text: a Polygon if there is one, else a MultiPolygon."""
    single = F.to_json(F.struct(F.lit("Polygon").alias("type"), polygons[0].alias("coordinates")))
    several = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), polygons.alias("coordinates")))
    return F.when(F.size(polygons) == 1, single).otherwise(several)
