import math
import random

import pytest
from makers import vincenty_m
from pyspark.sql import functions as F

from aisflow.functions import geo

PAIR = "lon1 double, lat1 double, lon2 double, lat2 double"


def distances(spark, pairs, function=geo.geodesic_m):
    frame = spark.createDataFrame(pairs, PAIR)
    d = function(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    return [row[0] for row in frame.select(d).collect()]


@pytest.mark.parametrize("reach", [0.0005, 0.05, 1.0, 30.0])
def test_geodesic_agrees_with_vincenty(spark, reach):
    r = random.Random(reach)
    pairs = []
    for _ in range(500):
        lon, lat = r.uniform(-130, -60), r.uniform(18, 49)
        pairs.append((lon, lat, lon + r.uniform(-reach, reach), lat + r.uniform(-reach, reach)))
    for pair, d in zip(pairs, distances(spark, pairs)):
        assert d == pytest.approx(vincenty_m(*pair), rel=3e-6, abs=1e-4)


def test_geodesic_is_symmetric_and_not_negative(spark):
    r = random.Random(1)
    pairs = [(r.uniform(-180, 180), r.uniform(-90, 90), r.uniform(-180, 180), r.uniform(-90, 90)) for _ in range(300)]
    there = distances(spark, pairs)
    back = distances(spark, [(c, d, a, b) for a, b, c, d in pairs])
    assert there == pytest.approx(back, rel=1e-9)
    assert min(there) >= 0 and max(there) < 20_100_000


def test_geodesic_special_points(spark):
    same, seam, poles, opposite = distances(
        spark,
        [(10.0, 20.0, 10.0, 20.0), (179.99, 10.0, -179.99, 10.0), (0.0, 90.0, 77.0, 90.0), (0.0, 0.0, 180.0, 0.0)],
    )
    assert same == 0
    assert seam == pytest.approx(vincenty_m(-0.01, 10.0, 0.01, 10.0), rel=1e-6)
    assert poles == pytest.approx(0, abs=1e-3)
    assert math.isfinite(opposite) and opposite == pytest.approx(20_015_000, rel=5e-3)


def test_null_coordinates_give_null(spark):
    for at in range(4):
        pair = [1.0, 2.0, 3.0, 4.0]
        pair[at] = None
        assert distances(spark, [tuple(pair)]) == [None]
        assert distances(spark, [tuple(pair)], geo.haversine_km) == [None]


def test_haversine_uses_half_the_longitude_difference(spark):
    (quarter, step) = distances(spark, [(0.0, 0.0, 90.0, 0.0), (-90.0, 30.0, -60.0, 30.0)], geo.haversine_km)
    assert quarter == pytest.approx(6371 * math.pi / 2)
    h = math.cos(math.radians(30)) ** 2 * math.sin(math.radians(15)) ** 2
    assert step == pytest.approx(2 * 6371 * math.asin(math.sqrt(h)))


def inside(lon, lat, ring):
    """Winding number, another way than counting crossings."""
    total = 0.0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        turn = math.atan2(y2 - lat, x2 - lon) - math.atan2(y1 - lat, x1 - lon)
        total += (turn + math.pi) % (2 * math.pi) - math.pi
    return abs(total) > math.pi


def test_polygon_agrees_with_winding_number(spark):
    r = random.Random(3)
    points = [(r.uniform(-130, -65), r.uniform(22, 52)) for _ in range(3000)]
    frame = spark.createDataFrame(points, "lon double, lat double")
    lon, lat = F.col("lon"), F.col("lat")
    found = frame.select("lon", "lat", geo.in_polygon(lon, lat).alias("p"), geo.in_box(lon, lat).alias("b")).collect()
    assert 500 < sum(row["p"] for row in found) < 2500
    for row in found:
        assert row["p"] == inside(row["lon"], row["lat"], geo.COAST_RING)
        assert row["b"] or not row["p"]


def test_point_has_longitude_first(spark):
    row = spark.range(1).select(geo.point(F.lit(1.0), F.lit(2.0)).alias("p")).first()
    assert row["p"].asDict() == {"lon": 1.0, "lat": 2.0}
