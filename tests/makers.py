"""Hand-made rows."""

import math
from datetime import datetime, timedelta

from aisflow import schemas

START = datetime(2024, 3, 10, 0, 0, 0)

DEFAULTS = {
    "MMSI": "338000001",
    "BaseDateTime": START,
    "LAT": 30.0,
    "LON": -90.0,
    "SOG": 1.0,
    "COG": 2.0,
    "Heading": 3.0,
    "VesselName": "ONE",
    "IMO": "IMO9000001",
    "CallSign": "CS1",
    "VesselType": 30,
    "Status": 0,
    "Length": 10.0,
    "Width": 4.0,
    "Draft": 2.0,
    "Cargo": "30",
    "TransceiverClass": "A",
}


def pings(spark, *changes: dict):
    rows = [tuple({**DEFAULTS, **change}[name] for name in schemas.PING.names) for change in changes]
    return spark.createDataFrame(rows, schemas.PING)


def positions(spark, rows):
    """Rows (mmsi, seconds after START, lat, lon)."""
    data = [(m, None if s is None else START + timedelta(seconds=s), lat, lon) for m, s, lat, lon in rows]
    return spark.createDataFrame(data, schemas.POSITION)


def ports(spark, rows):
    """Rows (code, lat, lon)."""
    return spark.createDataFrame([(c, c, "XX", lat, lon) for c, lat, lon in rows], schemas.PORT)


def vincenty_m(lon1, lat1, lon2, lat2):
    """Inverse geodesic by iteration, accurate to a millimetre unless nearly antipodal."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    if (lon1, lat1) == (lon2, lat2):
        return 0.0
    u1 = math.atan((1 - f) * math.tan(math.radians(lat1)))
    u2 = math.atan((1 - f) * math.tan(math.radians(lat2)))
    span = math.radians(lon2 - lon1)
    lam = span
    for _ in range(200):
        x = math.cos(u2) * math.sin(lam)
        y = math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam)
        sin_s = math.hypot(x, y)
        if sin_s == 0:
            return 0.0
        cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        s = math.atan2(sin_s, cos_s)
        sin_al = math.cos(u1) * math.cos(u2) * math.sin(lam) / sin_s
        cos2_al = 1 - sin_al * sin_al
        cos_2m = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2_al if cos2_al else 0.0
        c = f / 16 * cos2_al * (4 + f * (4 - 3 * cos2_al))
        old, lam = lam, span + (1 - c) * f * sin_al * (
            s + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1))
        )
        if abs(lam - old) < 1e-13:
            break
    u_sq = cos2_al * (a * a - b * b) / (b * b)
    big_a = 1 + u_sq / 16384 * (4096 + u_sq * (-768 + u_sq * (320 - 175 * u_sq)))
    big_b = u_sq / 1024 * (256 + u_sq * (-128 + u_sq * (74 - 47 * u_sq)))
    ds = big_b * sin_s * (
        cos_2m
        + big_b
        / 4
        * (
            cos_s * (2 * cos_2m**2 - 1)
            - big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)
        )
    )
    return b * big_a * (s - ds)
