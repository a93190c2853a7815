"""Geodesy as Column expressions: no UDF, no geometry type, no extra library.

All of them stay inside whole-stage codegen and yield null when a coordinate
is null. They are written without branches, so that Spark's common
subexpression elimination evaluates every shared term of a projection once.
"""

import math
from dataclasses import dataclass
from functools import reduce
from operator import ne

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid and the mean sphere used for haversine.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
SPHERE_KM = 6371.0

# Ring around the coast of the contiguous United States, (lon, lat).
COAST_RING = [
    (-125.1, 48.8),
    (-124.7, 41.9),
    (-124.5, 40.3),
    (-120.7, 34.4),
    (-117.3, 32.4),
    (-97.0, 25.7),
    (-97.0, 27.6),
    (-93.0, 29.5),
    (-89.0, 28.7),
    (-87.3, 30.1),
    (-85.0, 29.4),
    (-83.0, 27.8),
    (-81.2, 25.0),
    (-80.0, 25.0),
    (-80.0, 27.0),
    (-80.5, 28.6),
    (-75.3, 35.2),
    (-75.7, 36.9),
    (-73.8, 40.3),
    (-69.7, 41.1),
    (-70.0, 43.0),
    (-125.1, 48.8),
]

# Keeps the quotients below finite for equal and for opposite points.
_TINY = 1e-300
_OPPOSITE = 1e-16

Place = tuple[Column, Column, Column]


def point(lon: Column, lat: Column) -> Column:
    """A position as a plain struct, longitude first."""
    return F.struct(lon.alias("lon"), lat.alias("lat"))


@dataclass(frozen=True)
class Globe:
    """An ellipsoid. Points become places on its auxiliary unit sphere, where the
    latitude is the reduced one: all trigonometry is done once per point, and a
    comparison of two places is plain arithmetic."""

    radius_m: float
    flattening: float

    def place(self, lon: Column, lat: Column) -> Place:
        tan = (1 - self.flattening) * F.tan(F.radians(lat))
        cos = 1 / F.sqrt(1 + tan * tan)
        return cos * F.cos(F.radians(lon)), cos * F.sin(F.radians(lon)), tan * cos

    @staticmethod
    def chord(a: Place, b: Place) -> Column:
        """Squared half chord, which grows with the distance: the haversine of the arc."""
        dx, dy, dz = (q - p for p, q in zip(a, b))
        return (dx * dx + dy * dy + dz * dz) / 4

    def chord_bound(self, metres: float) -> float:
        """No two points closer than ``metres`` have a longer squared half chord."""
        smallest_radius = self.radius_m * (1 - self.flattening) ** 2
        return math.sin(min(metres * 1.01 / smallest_radius, math.pi) / 2) ** 2

    def metres(self, a: Place, b: Place) -> Column:
        return self.metres_of(self.chord(a, b), a[2], b[2])

    def metres_of(self, h: Column, z1: Column, z2: Column) -> Column:
        """Andoyer-Lambert distance from the squared half chord and both heights over
        the equator's plane: first order in the flattening, exact on a sphere."""
        rest = F.abs(1 - h)
        arc = 2 * F.atan2(F.sqrt(h), F.sqrt(rest))
        if not self.flattening:
            return self.radius_m * arc
        sine = 2 * F.sqrt(h * rest)
        mean, half_gap = (z1 + z2) / 2, (z2 - z1) / 2
        high = mean * mean / (rest + _OPPOSITE)
        wide = half_gap * half_gap / (h + _TINY)
        half_f = self.flattening / 2
        return self.radius_m * (arc * (1 - half_f * (high + wide)) + half_f * sine * (high - wide))


WGS84 = Globe(WGS84_A, WGS84_F)
SPHERE = Globe(SPHERE_KM * 1000, 0.0)


def geodesic_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres between two points on WGS84. Over many pairs, keep the places in columns instead."""
    return WGS84.metres(WGS84.place(lon1, lat1), WGS84.place(lon2, lat2))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Kilometres between two points on the mean sphere."""
    return SPHERE.metres(SPHERE.place(lon1, lat1), SPHERE.place(lon2, lat2)) / 1000


def in_box(lon: Column, lat: Column, ring=COAST_RING) -> Column:
    """Plain comparisons with the ring's bounds, which reach the Parquet scan."""
    lons = [x for x, _ in ring]
    lats = [y for _, y in ring]
    return lon.between(min(lons), max(lons)) & lat.between(min(lats), max(lats))


def in_polygon(lon: Column, lat: Column, ring=COAST_RING) -> Column:
    """Even-odd rule: true when a ray to the east crosses the closed ring an odd number of times."""
    crossings = []
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if y1 == y2:
            continue
        slope = (x2 - x1) / (y2 - y1)
        spans = (F.lit(y1) > lat) != (F.lit(y2) > lat)
        crossings.append(spans & (lon < lat * slope + (x1 - y1 * slope)))
    return reduce(ne, crossings)
