"""The raster index against the plain rule."""

import random

import pytest
from conftest import plan_of
from makers import positions

from aisflow.functions import geo
from aisflow.operators import audit, polygon


def plain(ring, lon, lat):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if y1 != y2:
            slope = (x2 - x1) / (y2 - y1)
            odd ^= (y1 > lat) != (y2 > lat) and lon < lat * slope + (x1 - y1 * slope)
    return odd


def star(n, seed):
    """A ring around the origin whose radius jumps from vertex to vertex."""
    import math

    draw = random.Random(seed)
    points = [(math.cos(2 * math.pi * k / n) * (r := draw.uniform(3, 10)), math.sin(2 * math.pi * k / n) * r) for k in range(n)]
    return [*points, points[0]]


@pytest.mark.parametrize("ring", [polygon.refined(geo.COAST_RING, 250), star(300, 1), star(7, 2), [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0)]])
def test_same_as_the_plain_rule(spark, ring):
    ring, draw = [(float(x), float(y)) for x, y in ring], random.Random(4)
    west, east = min(x for x, _ in ring), max(x for x, _ in ring)
    south, north = min(y for _, y in ring), max(y for _, y in ring)
    places = [(draw.uniform(south - 1, north + 1), draw.uniform(west - 1, east + 1)) for _ in range(1500)]
    places += [(y, x) for x, y in ring[:200]] + [(y, x + 1e-12) for x, y in ring[:100]] + [(south, west), (north, east), (north, west)]
    rows = [(str(k), 0, lat, lon) for k, (lat, lon) in enumerate(places)] + [("none", 0, None, 1.0), ("none", 0, 1.0, None)]
    found = {r["MMSI"] for r in polygon.inside(positions(spark, rows), ring).collect()}
    assert found == {str(k) for k, (lat, lon) in enumerate(places) if plain(ring, lon, lat)}


def test_a_long_ring_runs_in_a_hash_join_with_short_lists(spark):
    ring = polygon.refined(geo.COAST_RING, 250)
    assert len(ring) > 5000
    pings = positions(spark, [("1", 0, 40.0, -100.0)])
    plan = plan_of(audit.near_coast(pings, ring))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    lists = [len(edges) for *_, edges in polygon.cells(ring, polygon.Raster.over(ring))]
    assert sum(lists) / len(lists) < 40
    assert audit.near_coast(pings, ring).count() == 1 and "Join" not in plan_of(audit.near_coast(pings))
