"""The iterated geodesic against a bisection on exact integrals."""

import math
import random

import numpy as np
from makers import positions
from pyspark.sql import functions as F

from aisflow.functions import geo, geodesic
from aisflow.operators import motion

NODES, WEIGHTS = np.polynomial.legendre.leggauss(48)


def plain_m(lon1, lat1, lon2, lat2):
    """The azimuth at the end further from the equator by bisection, all integrals by quadrature."""
    f, a = geo.WGS84_F, geo.WGS84_A
    gap = abs(math.radians((lon2 - lon1 + 180) % 360 - 180))
    reduced = [math.atan2((1 - f) * math.sin(math.radians(t)), math.cos(math.radians(t))) for t in (lat1, lat2)]
    b1, b2 = sorted(reduced, key=lambda b: -abs(b))
    if b1 > 0:
        b1, b2 = -b1, -b2
    b1 = b1 or -1e-200

    def path(azimuth):
        sine, d1 = math.sin(azimuth) * math.cos(b1), math.cos(azimuth) * math.cos(b1)
        d2 = math.sqrt(max(0, d1 * d1 + math.sin(b1) ** 2 - math.sin(b2) ** 2))
        arc1, arc2 = math.atan2(math.sin(b1), d1), math.atan2(math.sin(b2), d2)
        turn = math.atan2(sine * math.sin(b2), d2) - math.atan2(sine * math.sin(b1), d1)
        k2 = f * (2 - f) / (1 - f) ** 2 * (1 - sine * sine)
        half = (arc2 - arc1) / 2
        root = np.sqrt(1 + k2 * np.sin(half * NODES + (arc1 + arc2) / 2) ** 2)
        lag = f * sine * half * float(WEIGHTS @ ((2 - f) / (1 + (1 - f) * root)))
        return a * (1 - f) * half * float(WEIGHTS @ root), turn - lag, sine

    low, high = 0.0, math.pi
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if path(middle)[1] > gap else (middle, high)
    metres, turn, sine = path((low + high) / 2)
    return max(0.0, metres + a * sine * (gap - turn))


def pairs_of_all_kinds(n=60):
    r = random.Random(8)

    def place():
        return r.uniform(-180, 180), math.degrees(math.asin(r.uniform(-1, 1)))

    def tiny():
        return 10 ** r.uniform(-18, -5) * r.choice([0, -1, 1])

    pairs = [(*place(), *place()) for _ in range(n)]
    for reach in (3, 0.6, 0.01):
        for lon, lat in (place() for _ in range(n)):
            other = max(-90.0, min(90.0, -lat + r.uniform(-reach, reach)))
            pairs.append((lon, lat, lon + 180 + r.uniform(-reach, reach), other))
    for lat in (r.uniform(-80, 80) for _ in range(2 * n)):
        # where the shortest paths begin to leave the parallel: the cusp of the astroid
        off = 0.6036 * math.cos(math.radians(lat)) * (1 + r.uniform(-0.01, 0.01))
        pairs.append((0.0, lat, 180 - off, -lat + 10 ** r.uniform(-14, -1) * r.choice([-1, 0, 1])))
    pairs += [(0.0, tiny(), 10 ** r.uniform(0, 2.25), tiny()) for _ in range(n)]
    pairs += [(0.0, tiny(), 179.39642 + r.uniform(-1e-3, 1e-3), tiny()) for _ in range(n)]
    pairs += [(0.0, lat, r.uniform(-180, 180), r.choice([lat, -lat])) for lat in (r.uniform(-89, 89) for _ in range(n))]
    pairs += [(5.0, r.uniform(-90, 90), r.choice([5.0, 185.0, -355.0]), r.uniform(-90, 90)) for _ in range(n)]
    pairs += [(r.uniform(0, 360), r.choice([-90.0, 90.0]), r.uniform(0, 360), r.uniform(-90, 90)) for _ in range(n)]
    return pairs


def metres(spark, pairs, **options):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double, c double, d double")
    found = geodesic.with_metres(frame, "m", F.col("a"), F.col("b"), F.col("c"), F.col("d"), **options)
    return [row["m"] for row in sorted(found.collect(), key=lambda row: row["i"])]


def test_all_kinds_of_pairs_are_right_to_nine_digits(spark):
    pairs = pairs_of_all_kinds()
    for pair, found in zip(pairs, metres(spark, pairs)):
        want = plain_m(*pair)
        assert abs(found - want) <= 1e-9 * want + 1e-7, pair


def test_published_distances(spark):
    # Karney (2013), and the pair on which Vincenty's iteration fails
    pairs = [(0.0, -30.0, 179.8, 29.9), (0.0, 0.0, 179.5, 0.5), (0.0, 0.0, 180.0, 0.0)]
    assert [round(m, 3) for m in metres(spark, pairs)] == [19989832.828, 19936288.579, 20003931.459]


def test_same_place_nulls_and_an_empty_table(spark):
    pair = (3.0, 4.0, 3.0, 4.0)
    nulls = [tuple(None if i == at else v for i, v in enumerate(pair)) for at in range(4)]
    found = metres(spark, [pair, (10.0, 90.0, 50.0, 90.0), *nulls])
    assert max(found[:2]) < 1e-7 and found[2:] == [None] * 4
    empty = spark.createDataFrame([], "x double")
    assert geodesic.with_metres(empty, "m", *[F.col("x")] * 4).collect() == []


def test_clashing_columns_stay_and_the_plan_is_generated_code(spark):
    frame = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0, "kept", "also")], "lon double, lat double, _a double, _s1 double, _off string, `__a` string")
    found = geodesic.with_metres(frame, "m", F.col("lon"), F.col("lat"), F.col("_a"), F.col("_s1"))
    assert found.columns == [*frame.columns, "m"]
    row = found.first()
    assert (row["_off"], row["__a"]) == ("kept", "also") and round(row["m"], 3) == 111319.491
    plan = found._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if "Project" in line]
    assert steps and all("*(" in line for line in steps) and "Exchange" not in plan


def test_exact_gaps_between_opposite_places(spark):
    track = [("1", 0, 0.0, 0.0), ("1", 60, 0.5, 179.5), ("1", 120, 0.5, 179.5), ("2", 0, 1.0, 1.0)]
    gaps = motion.previous_gaps(positions(spark, track), exact=True)
    found = {(r["MMSI"], r["BaseDateTime"].minute): (r["MeterSincePrevPing"], r["MinSincePrevPing"]) for r in gaps.collect()}
    assert found["1", 0] == found["2", 0] == (None, None)
    assert abs(found["1", 1][0] - 19936288.579) < 0.001 and found["1", 1][1] == 1
    assert found["1", 2][0] < 1e-7
    plain = motion.previous_gaps(positions(spark, track))
    assert gaps.columns == plain.columns
    assert abs(plain.agg(F.max("MeterSincePrevPing")).first()[0] - 19936288.579) > 1000
