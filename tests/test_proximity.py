import math
import random

import pytest
from conftest import plan_of
from makers import ports as make_ports
from makers import positions, vincenty_m

from aisflow.functions import geo
from aisflow.operators import proximity


def spread(seed, n, lat_range, lon_range):
    r = random.Random(seed)
    return [(r.uniform(*lat_range), (r.uniform(*lon_range) + 180) % 360 - 180) for _ in range(n)]


def near(seed, points, reach, n):
    """Pings scattered around the points, kept on the globe."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lat, lon = points[i % len(points)]
        lat = max(-90.0, min(90.0, lat + r.uniform(-reach, reach)))
        wide = min(180.0, reach / max(math.cos(math.radians(lat)), 1e-3))
        rows.append((f"{i:09d}", i, lat, (lon + r.uniform(-wide, wide) + 180) % 360 - 180))
    return rows


AREAS = {
    "coast": ((25, 48), (-125, -70)),
    "seam": ((-20, 20), (179.5, 180.5)),
    "north": ((88.5, 90), (-180, 180)),
    "south": ((-90, -89), (-180, 180)),
    "equator": ((-1, 1), (-1, 1)),
}


@pytest.mark.parametrize("area", AREAS)
@pytest.mark.parametrize("radius", [500.0, 3500.0, 35_000.0])
def test_grid_join_finds_what_all_pairs_find(spark, area, radius):
    places = spread(f"{area}{radius}", 25, *AREAS[area])
    port_rows = [(f"P{i}", lat, lon) for i, (lat, lon) in enumerate(places)]
    ping_rows = near(area, places, 2 * radius / 111_000, 400)
    expected = {
        (mmsi, code)
        for mmsi, _, lat, lon in ping_rows
        for code, plat, plon in port_rows
        if vincenty_m(lon, lat, plon, plat) < radius
    }
    found = proximity.port_hits(positions(spark, ping_rows), make_ports(spark, port_rows), radius)
    assert {(row["MMSI"], row["UNLOCODE"]) for row in found.collect()} == expected != set()


@pytest.mark.parametrize("radius", [0.5, 120_000.0, 3_000_000.0, 19_000_000.0])
def test_tiny_and_global_radii(spark, radius):
    places = spread(radius, 6, (-80, 80), (-180, 180))
    port_rows = [(f"P{i}", lat, lon) for i, (lat, lon) in enumerate(places)]
    ping_rows = near(1, places, min(radius / 55_000, 60), 60)
    expected = {
        (mmsi, code)
        for mmsi, _, lat, lon in ping_rows
        for code, plat, plon in port_rows
        if 6_371_000 * _angle(lat, lon, plat, plon) < radius
    }
    found = proximity.port_hits(
        positions(spark, ping_rows), make_ports(spark, port_rows), radius, geo.SPHERE
    )
    assert {(row["MMSI"], row["UNLOCODE"]) for row in found.collect()} == expected


def _angle(lat1, lon1, lat2, lon2):
    a, b, d = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(d / 2) ** 2
    return 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


@pytest.fixture
def scene(spark):
    """Pings around pairs of close ports, with shared keys and exact copies."""
    places = spread(5, 10, *AREAS["coast"])
    port_rows = [(f"P{i}", lat, lon) for i, (lat, lon) in enumerate(places)]
    port_rows += [(f"Q{i}", lat + 0.02, lon) for i, (lat, lon) in enumerate(places)]
    rows = near(6, places, 0.05, 500)
    rows = [(f"{i % 20:09d}", i // 3, lat, lon) for i, (_, _, lat, lon) in enumerate(rows)]
    rows += rows[:40] + [(m, s, lat + 0.01, lon) for m, s, lat, lon in rows[40:120]]
    rows += [("000000099", 5, None, None), ("000000099", 6, 10.0, None)]
    return positions(spark, rows), make_ports(spark, port_rows)


def test_salted_join_equals_broadcast_join(scene, rows_of):
    pings, ports = scene
    salted = proximity.port_hits(pings, ports, broadcast_cells=5, cell_rows=3)
    assert "_part" in plan_of(salted)
    assert rows_of(salted) == rows_of(proximity.port_hits(pings, ports)) != []


def test_nearest_port_is_the_minimum_over_all_ports(scene):
    pings, ports = scene
    hits = proximity.port_hits(pings, ports).collect()
    best = {}
    for row in hits:
        key = (row["MMSI"], row["BaseDateTime"])
        best[key] = min(best.get(key, (math.inf, "")), (row["d"], row["UNLOCODE"]))
    found = proximity.nearest_port(proximity.port_hits(pings, ports)).collect()
    assert len(found) == len(best)
    assert {(r["MMSI"], r["BaseDateTime"]): (r["d"], r["UNLOCODE"]) for r in found} == best


def test_equal_distances_go_to_the_smaller_code(spark):
    ports = make_ports(spark, [("B", 10.01, 0.0), ("A", 9.99, 0.0), ("C", 10.01, 0.0)])
    pings = positions(spark, [("1", 0, 10.01, 0.0)])
    assert proximity.nearest_port(proximity.port_hits(pings, ports)).first()["UNLOCODE"] == "B"
    assert proximity.own_port(pings, ports).first()["port"]["UNLOCODE"] == "B"


def test_the_radius_itself_is_outside_unless_inclusive(spark):
    ports = make_ports(spark, [("A", 0.0, 0.0)])
    pings = positions(spark, [("1", 0, 0.01, 0.0)])
    d = proximity.port_hits(pings, ports, 5000.0).first()["d"]
    assert proximity.port_hits(pings, ports, d).count() == 0
    assert proximity.port_hits(pings, ports, d, inclusive=True).count() == 1


def test_own_port_keeps_every_ping(scene):
    pings, ports = scene
    tagged = proximity.own_port(pings, ports)
    assert tagged.columns == [*pings.columns, "port"]
    assert tagged.count() == pings.count()
    assert tagged.drop("port").exceptAll(pings).isEmpty()
    hits = {(r["MMSI"], r["BaseDateTime"], r["LAT"], r["LON"], r["d"], r["UNLOCODE"]) for r in proximity.port_hits(pings, ports).collect()}
    for row in tagged.collect():
        mine = [(d, c) for m, t, lat, lon, d, c in hits if (m, t, lat, lon) == (row["MMSI"], row["BaseDateTime"], row["LAT"], row["LON"])]
        assert (tuple(row["port"]) if row["port"] else None) == min(mine, default=None)


def test_equal_keys_share_one_port(scene):
    pings, ports = scene
    tagged = proximity.pings_with_port(pings, ports)
    assert tagged.count() == pings.count()
    by_key = {}
    for row in tagged.collect():
        by_key.setdefault((row["MMSI"], row["BaseDateTime"]), set()).add(row["UNLOCODE"])
    assert all(len(codes) == 1 for codes in by_key.values())
    assert None in set().union(*by_key.values()) and len(by_key) < pings.count()


def test_plans(scene):
    pings, ports = scene
    assert "CartesianProduct" not in (plan := plan_of(proximity.port_hits(pings, ports)))
    assert "NestedLoop" not in plan and "BroadcastHashJoin" in plan
    assert plan_of(proximity.nearest_port(proximity.port_hits(pings, ports))).count("WindowGroupLimit") == 2
    lookup = plan_of(proximity.own_port(pings, ports))
    assert lookup.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(_cell" in lookup


def test_the_broadcast_is_bounded_by_cells_not_ports(spark, scene):
    _, ports = scene
    assert proximity.few_enough(ports, 20) and not proximity.few_enough(ports, 19)
    assert proximity.can_broadcast(ports, 3500.0, 20 * 20)
    polar = make_ports(spark, [(f"N{i}", 89.999, float(i)) for i in range(20)])
    assert not proximity.can_broadcast(polar, 3500.0)


def test_a_busy_instant_is_spread_without_adaptive_execution(spark, rows_of):
    """A third of all pings are one ship's at one instant, most of them equal."""
    from pyspark.sql import functions as F

    rows = [("000000001", 7, 30.0 + (k % 3) / 1000, -90.0) for k in range(400)] + [(f"{k:09d}", k, 30.0, -90.0) for k in range(2, 802)]
    rows += [(None, 7, 30.0, -90.0)] * 5 + [("000000001", None, 30.0, -90.0)] * 5
    pings, ports = positions(spark, rows), make_ports(spark, [("A", 30.0, -90.0), ("B", 30.01, -90.0)])
    usual = rows_of(proximity.pings_with_port(pings, ports))
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        found = proximity.pings_with_port_by_join(pings, ports, broadcast_cells=0, key_rows=40)
        assert "_part" in plan_of(found) and rows_of(found) == usual
        sizes = found.where("MMSI = '000000001'").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 250
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "_part" not in plan_of(proximity.pings_with_port_by_join(pings, ports, broadcast_cells=0))


@pytest.mark.parametrize("globe", [geo.WGS84, geo.SPHERE])
def test_crowded_cells_are_divided(spark, rows_of, globe, monkeypatch):
    """Thousands of ports in one harbour, and some at one place: few candidates a ping, and the nearest is the nearest."""
    from pyspark.sql import functions as F

    draw = random.Random(8)
    ports_ = [(f"H{k:05d}", 30 + draw.gauss(0, 0.004), -90 + draw.gauss(0, 0.004)) for k in range(3000)]
    ports_ += [(f"S{k}", 10.0, 180.0) for k in range(100)] + [(f"N{k}", 89.999, float(k)) for k in range(3)]
    places = [(30 + draw.uniform(-0.06, 0.06), -90 + draw.uniform(-0.06, 0.06)) for _ in range(400)]
    places += [(10.001, -179.999), (10.0, 180.0), (89.9999, 50.0), (-90.0, 0.0), (90.0, 180.0)]
    pings = positions(spark, [(f"{k:09d}", k, lat, lon) for k, (lat, lon) in enumerate(places)])
    ports = make_ports(spark, ports_)
    hits = proximity.port_hits(pings, ports, globe=globe)
    best = {(r["MMSI"]): (r["d"], r["UNLOCODE"]) for r in proximity.nearest_port(hits).collect()}
    found = {r["MMSI"]: tuple(r["port"]) for r in proximity.own_port(pings, ports, globe=globe).where("port IS NOT NULL").collect()}
    assert found == best and len(best) > 150
    cells = proximity.nearest_cells(ports, 3500.0, globe)
    counts = cells.ports.groupBy("_cell").count()
    assert cells.divided and counts.agg(F.max("count")).first()[0] <= proximity.CELL_PORTS
    joined = proximity.pings_with_port_by_join(pings, ports, globe=globe, broadcast_cells=0)
    assert rows_of(joined.select("MMSI", "UNLOCODE").where("UNLOCODE IS NOT NULL")) == sorted([(m, c) for m, (_, c) in best.items()], key=repr)
