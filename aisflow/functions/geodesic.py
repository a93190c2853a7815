"""Exact distances on an ellipsoid, for points anywhere, nearly opposite ones included.

``Globe.metres`` is of first order in the flattening and plain arithmetic; this
is for whoever needs more, at some seconds of planning and microseconds a pair.
The azimuth at one end is found by Newton's method within a bracket, as in
Karney, "Algorithms for geodesics" (2013), with Vincenty's series (1975). Each
step is a projection of its own, so that no expression is repeated by the next;
all of them are generated code of one stage. It is longer than the JVM compiles
unless ``spark.sql.codegen.hugeMethodLimit`` is 8000, with which Spark cuts it up.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisflow.functions.geo import WGS84, Globe

#: Newton steps. What the last one leaves enters the distance by its square.
STEPS = 5
_TINY = 1e-200


def with_metres(
    frame: DataFrame, name: str, lon1: Column, lat1: Column, lon2: Column, lat2: Column, globe: Globe = WGS84, steps: int = STEPS
) -> DataFrame:
    """The frame with the metres of the shortest path between two points in degrees as ``name``.

    The relative error is below 1e-9, or the absolute one below 1e-7 m where that is more (measured over
    ordinary, short, polar, equatorial and nearly opposite pairs). Null coordinates give null,
    rows and other columns stay as they are, and longitudes may differ by any number of turns.
    """
    kept = [F.col(f"`{c}`") for c in frame.columns if c.lower() != name.lower()]
    mark = "_"
    while any(c.lower().startswith(mark) for c in frame.columns):
        mark += "_"

    def col(key: str) -> Column:
        return F.col(mark + key)

    def add(to: DataFrame, values: dict[str, Column]) -> DataFrame:
        return to.withColumns({mark + key: value for key, value in values.items()})

    ends = {"lon1": lon1, "lat1": lat1, "lon2": lon2, "lat2": lat2}
    known = lon1.isNotNull() & lat1.isNotNull() & lon2.isNotNull() & lat2.isNotNull()
    # without nulls the generated code is half as long
    found = add(frame, {"known": known} | {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in ends.items()})
    found = add(found, _normal(*[col(k) for k in ends], globe))
    found = add(found, _opposite(col, globe))
    found = add(found, {"m": _root(col)})
    # along the equator any arc will do: what it leaves is made up for by the equator itself
    flat = (col("s1") > -1e-15) & (col("gap") <= (1 - globe.flattening) * math.pi)
    start = {"low": F.lit(0.0), "high": F.lit(math.pi), "a": _start(col, globe)}
    found = add(found, {key: F.when(flat, F.lit(math.pi / 2)).otherwise(value) for key, value in start.items()})
    for _ in range(steps):
        path = _along(col, globe)
        turn = F.coalesce(F.try_divide(path["off"] * path["d2"], _reduced_length(col, path, globe)), F.lit(0.0))
        found = add(found, {"off": path["off"], "next": col("a") - turn})
        low = F.when(col("off") <= 0, col("a")).otherwise(col("low"))
        high = F.when(col("off") >= 0, col("a")).otherwise(col("high"))
        mirrored = math.pi - col("a")
        # past a cusp the slope is that of the other branch, which begins at the mirrored azimuth
        turned = (F.abs(col("a") - math.pi / 2) < 0.1) & (mirrored > low) & (mirrored < high)
        safe = F.when(turned, mirrored).otherwise((low + high) / 2)
        found = add(found, {"low": low, "high": high, "a": F.when(col("next").between(low, high), col("next")).otherwise(safe)})
    return found.select(*kept, F.when(col("known"), _length(_along(col, globe), globe)).alias(name))


def _normal(lon1: Column, lat1: Column, lon2: Column, lat2: Column, globe: Globe) -> dict[str, Column]:
    """The pair turned and mirrored so that the first point is the one further from the equator, and
    south of it: sines and cosines of the reduced latitudes, and the gap in longitude up to half a turn."""
    turned = F.radians(F.abs(F.pmod(lon2 - lon1 + 180, F.lit(360.0)) - 180))
    (x1, _, z1), (x2, _, z2) = globe.place(F.lit(0.0), lat1), globe.place(F.lit(0.0), lat2)
    lower = F.least(F.abs(z1), F.abs(z2))
    return {
        "s1": -F.greatest(F.abs(z1), F.abs(z2), F.lit(_TINY)),
        "c1": F.least(x1, x2),
        "s2": F.when(z1 * z2 > 0, -lower).otherwise(lower),
        "c2": F.greatest(x1, x2),
        "gap": turned,
    }


def _opposite(col, globe: Globe) -> dict[str, Column]:
    """The place of the second point seen from the first one's antipode, in units of the astroid
    that the shortest paths envelop there."""
    unit = globe.flattening * math.pi * col("c1") + _TINY
    return {
        "x": (col("gap") - math.pi) / unit,
        "y": F.least((col("s1") * col("c2") + col("c1") * col("s2")) / (unit * col("c1") + _TINY), F.lit(0.0)),
    }


def _root(col) -> Column:
    """The root m >= 0 of (x / (1 + m))^2 + (y / m)^2 = 1, by the resolvent cubic of this quartic.
    Far from the astroid it is of no use, so the place is held within bounds."""
    p = F.least(col("x") * col("x"), F.lit(1e4))
    q = F.least(col("y") * col("y"), F.lit(1e4))
    r = (p + q - 1) / 6
    s = p * q / 4
    disc = s * (s + 2 * r * r * r)
    cube = s + r * r * r
    t = F.cbrt(cube + F.when(cube < 0, -F.sqrt(F.abs(disc))).otherwise(F.sqrt(F.abs(disc))))
    real = r + t + F.coalesce(F.try_divide(r * r, t), F.lit(0.0))
    bent = r + 2 * r * F.cos(F.atan2(F.sqrt(F.abs(disc)), -cube) / 3)
    u = F.when(disc >= 0, real).otherwise(bent)
    v = F.sqrt(u * u + q)
    both = F.when(u < 0, F.coalesce(F.try_divide(q, v - u), F.lit(0.0))).otherwise(u + v)
    w = F.coalesce(F.try_divide(both - q, 2 * v), F.lit(0.0))
    return F.coalesce(F.try_divide(both, F.sqrt(both + w * w) + w), F.lit(0.0))


def _start(col, globe: Globe) -> Column:
    """Azimuth at the first point: that of the sphere, or by the astroid for nearly opposite points."""
    s1, c1, s2, c2 = (col(k) for k in ("s1", "c1", "s2", "c2"))
    east, north = c2 * F.sin(col("gap")), c1 * s2 - s1 * c2 * F.cos(col("gap"))
    arc_cos, arc_sin = s1 * s2 + c1 * c2 * F.cos(col("gap")), F.sqrt(east * east + north * north)
    reach = 3 * globe.flattening * math.pi * c1 * c1
    x, y, m = col("x"), col("y"), col("m")
    on_axis = F.atan2(-x, -F.sqrt(F.abs(1 - x * x)))
    beside = F.atan2(-x / (1 + m), F.coalesce(F.try_divide(y, m), F.lit(0.0)))
    opposite = F.when((y > -1e-14) & (x > -1), on_axis).otherwise(beside)
    return F.when((arc_cos < 0) & (arc_sin < reach), opposite).otherwise(F.atan2(east, north))


def _along(col, globe: Globe) -> dict[str, Column]:
    """The path that leaves with azimuth ``a``, up to the second point's latitude: its arc on the
    auxiliary sphere, and by how much its longitude goes too far."""
    s1, s2, f = col("s1"), col("s2"), globe.flattening
    sin_a0, d1 = F.sin(col("a")) * col("c1"), F.cos(col("a")) * col("c1")
    d2 = F.sqrt(F.greatest(d1 * d1 + (s1 - s2) * (s1 + s2), F.lit(0.0)))
    cos2_a0 = d1 * d1 + s1 * s1
    arc1, arc2 = F.atan2(s1, d1), F.atan2(s2, d2)
    arc, twice = arc2 - arc1, F.cos(arc1 + arc2)
    turn = F.atan2(sin_a0 * s2, d2) - F.atan2(sin_a0 * s1, d1)
    c = f / 16 * cos2_a0 * (4 + f * (4 - 3 * cos2_a0))
    sum_ = arc + c * F.sin(arc) * (twice + c * F.cos(arc) * (2 * twice * twice - 1))
    off = turn - (1 - c) * f * sin_a0 * sum_ - col("gap")
    return {"sin_a0": sin_a0, "d1": d1, "d2": d2, "cos2_a0": cos2_a0, "arc": arc, "twice": twice, "off": off}


def _k2(path: dict[str, Column], globe: Globe) -> Column:
    f = globe.flattening
    return f * (2 - f) / (1 - f) ** 2 * path["cos2_a0"]


def _reduced_length(col, path: dict[str, Column], globe: Globe) -> Column:
    """How far the end moves sideways for a turn at the start, in equatorial radii; second order in k^2."""
    k2 = _k2(path, globe)
    # not by the angles: both cosines vanish together where the path turns at its ends
    scale = F.sqrt(path["cos2_a0"]) + _TINY
    sin1, cos1, sin2, cos2 = col("s1") / scale, path["d1"] / scale, col("s2") / scale, path["d2"] / scale
    half = (sin2 * cos2 - sin1 * cos1) / 2
    quarter = (sin2 * cos2 * (1 - 2 * sin2 * sin2) - sin1 * cos1 * (1 - 2 * sin1 * sin1)) / 8
    bent = k2 * (path["arc"] / 2 - half) - k2 * k2 / 2 * (3 * path["arc"] / 8 - half + quarter)
    straight = F.sqrt(1 + k2 * sin2 * sin2) * cos1 * sin2 - F.sqrt(1 + k2 * sin1 * sin1) * sin1 * cos2
    return (1 - globe.flattening) * (straight - cos1 * cos2 * bent)


def _length(path: dict[str, Column], globe: Globe) -> Column:
    """Metres of the path, less what its longitude goes too far by: the distance grows with the
    longitude by the sine of the azimuth at the equator."""
    root = F.sqrt(1 + _k2(path, globe))
    e = (root - 1) / (root + 1)
    a, b = (1 + e * e / 4) / (1 - e), e * (1 - 3 * e * e / 8)
    sin, cos, twice = F.sin(path["arc"]), F.cos(path["arc"]), path["twice"]
    third = b / 6 * twice * (4 * sin * sin - 3) * (4 * twice * twice - 3)
    less = b * sin * (twice + b / 4 * (cos * (2 * twice * twice - 1) - third))
    polar = globe.radius_m * (1 - globe.flattening)
    return F.greatest(polar * a * (path["arc"] - less) - globe.radius_m * path["sin_a0"] * path["off"], F.lit(0.0))
