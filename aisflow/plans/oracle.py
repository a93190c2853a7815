"""ANSI SQL for every registered query, written apart from the operators.

Spatial predicates are plain theta joins here and rankings are windows: the
slow, obvious forms that the operators must agree with.
"""

from aisflow.functions.geo import COAST_RING
from aisflow.plans import queries, standin

_IDENTITY = "MMSI, VesselName, IMO, CallSign, VesselType, Length, Width"
_KINEMATIC = "MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading, Status, Draft, Cargo, TransceiverClass"

_RAD = "pi() / 180"


def _geodesic(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Lambert's formula with P = mean and Q = half difference of the reduced latitudes."""
    beta1 = f"atan((1 - 1e0 / 298.257223563e0) * tan(radians({lat1})))"
    beta2 = f"atan((1 - 1e0 / 298.257223563e0) * tan(radians({lat2})))"
    p = f"(({beta1} + {beta2}) / 2)"
    q = f"(({beta2} - {beta1}) / 2)"
    h = f"(pow(sin({q}), 2) + cos({beta1}) * cos({beta2}) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    s = f"(2 * asin(sqrt({h})))"
    x = f"(({s} - sin({s})) * pow(sin({p}) * cos({q}), 2) / pow(cos({s} / 2), 2))"
    y = f"(({s} + sin({s})) * pow(cos({p}) * sin({q}), 2) / pow(sin({s} / 2), 2))"
    d = f"6378137e0 * ({s} - 1e0 / 298.257223563e0 / 2 * ({x} + {y}))"
    return f"CASE WHEN {lat1} = {lat2} AND {lon1} = {lon2} THEN 0e0 ELSE {d} END"


def _vincenty(table: str, steps: int = 8) -> str:
    """Rows of ``table`` with the metres from (p_lon, p_lat) to (LON, LAT) by Vincenty's iteration on the
    longitude. It does not converge between nearly opposite places, and the stand-in has none."""
    f = "(1e0 / 298.257223563e0)"
    rows = f"""SELECT *, atan((1 - {f}) * tan(radians(p_lat))) AS u1, atan((1 - {f}) * tan(radians(LAT))) AS u2,
        radians(LON - p_lon) AS span, radians(LON - p_lon) AS lam FROM {table}"""
    arcs = """cos(u2) * sin(lam) AS x, cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam) AS y,
        sqrt(x * x + y * y) AS sin_s, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cos_s, atan2(sin_s, cos_s) AS s,
        cos(u1) * cos(u2) * sin(lam) / sin_s AS sin_al, 1 - sin_al * sin_al AS cos2_al,
        cos_s - 2 * sin(u1) * sin(u2) / cos2_al AS cos_2m"""
    names = "x, y, sin_s, cos_s, s, sin_al, cos2_al, cos_2m"
    for _ in range(steps):
        rows = f"""SELECT * EXCLUDE (lam, c, {names}), span + (1 - c) * {f} * sin_al * (s + c * sin_s * (cos_2m
            + c * cos_s * (2 * cos_2m * cos_2m - 1))) AS lam
            FROM (SELECT *, {arcs}, {f} / 16 * cos2_al * (4 + {f} * (4 - 3 * cos2_al)) AS c FROM ({rows}))"""
    series = f"""cos2_al * (1 / pow(1 - {f}, 2) - 1) AS w,
        1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS a, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS b,
        b * sin_s * (cos_2m + b / 4 * (cos_s * (2 * cos_2m * cos_2m - 1)
        - b / 6 * cos_2m * (4 * sin_s * sin_s - 3) * (4 * cos_2m * cos_2m - 3))) AS less"""
    metres = f"CASE WHEN p_lat = LAT AND p_lon = LON THEN 0e0 ELSE 6378137e0 * (1 - {f}) * a * (s - less) END"
    return f"SELECT *, {metres} AS exact_m FROM (SELECT *, {series} FROM (SELECT *, {arcs} FROM ({rows})))"


def _haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    h = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(6371e0 * 2 * asin(sqrt({h})))"


def _inside_coast() -> str:
    """Number of ring edges crossed by a ray to the east, which is odd inside."""
    edges = []
    for (x1, y1), (x2, y2) in zip(COAST_RING, COAST_RING[1:]):
        if y1 != y2:
            at_lat = f"{x1}e0 + (LAT - {y1}e0) * ({x2}e0 - {x1}e0) / ({y2}e0 - {y1}e0)"
            at_lat = at_lat.replace("--", "+ ").replace("- -", "+ ")
            edges.append(f"CASE WHEN ({y1}e0 > LAT) <> ({y2}e0 > LAT) AND LON < {at_lat} THEN 1 ELSE 0 END")
    return f"({' + '.join(edges)}) % 2 = 1"


_CTES = {
    "raw": standin.ping_sql(),
    "ports": standin.port_sql(),
    "valid": "SELECT * FROM raw WHERE length(MMSI) = 9 AND abs(LAT) <= 90 AND abs(LON) <= 180",
    "positions": "SELECT MMSI, BaseDateTime, LAT, LON FROM valid",
    "moved": f"SELECT {_KINEMATIC} FROM valid",
    "named": f"SELECT DISTINCT {_IDENTITY} FROM valid",
    "decoded_names": """SELECT MMSI, VesselName,
        CASE WHEN IMO IN ('NULL', 'IMO0000000') THEN NULL ELSE IMO END AS IMO,
        CASE WHEN CallSign = 'NULL' THEN NULL ELSE CallSign END AS CallSign, VesselType,
        CASE WHEN Length = 0 THEN NULL ELSE Length END AS Length,
        CASE WHEN Width = 0 THEN NULL ELSE Width END AS Width FROM named""",
    "identities": """SELECT MMSI, VesselName, IMO, CallSign,
        cast(coalesce(VesselType, 0) AS smallint) AS VesselType, Length, Width FROM decoded_names""",
    "profiles": """SELECT MMSI, min(VesselName) AS VesselName, max(IMO) AS IMO, max(CallSign) AS CallSign,
        max(VesselType) AS VesselType, max(Length) AS Length, max(Width) AS Width
        FROM identities GROUP BY MMSI""",
    "decoded": """SELECT MMSI, BaseDateTime, LAT, LON,
        CASE WHEN SOG < 0 THEN cast(SOG + cast(102.4 AS double) AS float)
             WHEN SOG = cast(102.3 AS float) THEN NULL ELSE SOG END AS SOG,
        CASE WHEN COG < 0 THEN cast(COG + cast(409.6 AS double) AS float)
             WHEN COG = 360 THEN NULL ELSE COG END AS COG,
        CASE WHEN Heading = 511 THEN NULL ELSE Heading END AS Heading, Status,
        CASE WHEN Draft = 0 THEN NULL ELSE Draft END AS Draft, Cargo, TransceiverClass FROM moved""",
    "motion": """SELECT MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading,
        cast(coalesce(Status, 15) AS smallint) AS Status, Draft, coalesce(Cargo, '0') AS Cargo,
        TransceiverClass FROM decoded""",
    "hits": f"""SELECT * FROM (SELECT a.MMSI, a.BaseDateTime, a.LAT, a.LON, p.UNLOCODE,
        {_geodesic('a.LON', 'a.LAT', 'p.LON', 'p.LAT')} AS d
        FROM positions a JOIN ports p ON abs(a.LAT - p.LAT) < 1) WHERE d < 3500""",
    "nearest": """SELECT MMSI, BaseDateTime, UNLOCODE, d FROM (SELECT *, row_number() OVER
        (PARTITION BY MMSI, BaseDateTime ORDER BY d, UNLOCODE) AS r FROM hits) WHERE r = 1""",
    "tagged": """SELECT a.*, n.UNLOCODE FROM positions a LEFT JOIN nearest n
        ON a.MMSI = n.MMSI AND a.BaseDateTime = n.BaseDateTime""",
    "stepped": """SELECT *, lag(LAT) OVER w AS p_lat, lag(LON) OVER w AS p_lon,
        lag(BaseDateTime) OVER w AS p_time FROM tagged
        WINDOW w AS (PARTITION BY MMSI ORDER BY BaseDateTime NULLS FIRST, LAT NULLS FIRST, LON NULLS FIRST)""",
    "gaps": f"""SELECT MMSI, BaseDateTime, LAT, LON, UNLOCODE AS NearPort,
        round({_geodesic('p_lon', 'p_lat', 'LON', 'LAT')}, 2) AS MeterSincePrevPing,
        (epoch(date_trunc('second', BaseDateTime)) - epoch(date_trunc('second', p_time))) / 60
        AS MinSincePrevPing FROM stepped""",
}

_MONTHS = """strftime(BaseDateTime, '%Y-%m') AS YearMonth,
    cast(year(BaseDateTime) AS integer) AS year, cast(month(BaseDateTime) AS integer) AS month"""

_SECONDS = "date_trunc('second', BaseDateTime)"


def _with(body: str, changed: dict[str, str] | None = None) -> str:
    """Prefixes the common tables, some of them ``changed``; the engine evaluates only those in use."""
    tables = ",\n".join(f"{name} AS ({text})" for name, text in (_CTES | (changed or {})).items())
    return f"WITH {tables}\n{body}"


def _in_seconds() -> str:
    return f"""SELECT MMSI, {_SECONDS} AS BaseDateTime, LAT, LON, SOG, COG, Heading, VesselName, IMO,
        CallSign, VesselType, Status, Length, Width, Draft, Cargo, TransceiverClass"""


_ANALYSIS = f"SELECT MMSI, BaseDateTime, NearPort, MeterSincePrevPing, MinSincePrevPing, {_MONTHS} FROM gaps"

_CONFLICTS = """SELECT * FROM (SELECT MMSI, count(DISTINCT IMO) AS c_IMO,
    count(DISTINCT CallSign) AS c_CallSign, count(DISTINCT Width) AS c_Width,
    count(DISTINCT Length) AS c_Length,
    count(DISTINCT CASE WHEN VesselType <> 0 THEN VesselType END) AS c_VesselType
    FROM identities GROUP BY MMSI)
    WHERE c_IMO > 1 OR c_CallSign > 1 OR c_Width > 1 OR c_Length > 1 OR c_VesselType > 1"""

_LEGS = f"""SELECT MMSI, BaseDateTime, LAT, LON, lead_LAT, lead_LON, lead_time,
    round({_haversine('LON', 'LAT', 'lead_LON', 'lead_LAT')}, 3) AS d FROM (
    SELECT *, lead(LAT) OVER w AS lead_LAT, lead(LON) OVER w AS lead_LON,
    lead(BaseDateTime) OVER w AS lead_time FROM positions
    WINDOW w AS (PARTITION BY MMSI ORDER BY BaseDateTime NULLS FIRST, LAT NULLS FIRST, LON NULLS FIRST))"""

_SPHERE_PORTS = f"""SELECT MMSI, BaseDateTime, UNLOCODE FROM (SELECT *, row_number() OVER
    (PARTITION BY MMSI, BaseDateTime ORDER BY km, UNLOCODE) AS r FROM (
    SELECT a.MMSI, a.BaseDateTime, p.UNLOCODE, {_haversine('p.LON', 'p.LAT', 'a.LON', 'a.LAT')} AS km
    FROM positions a CROSS JOIN ports p) WHERE km <= 35) WHERE r = 1"""

_LEGS_WITH_PORT = f"""SELECT l.*, coalesce(n.UNLOCODE, 'None') AS UNLOCODE FROM ({_LEGS}) l LEFT JOIN ({_SPHERE_PORTS}) n
    ON l.MMSI = n.MMSI AND l.BaseDateTime = n.BaseDateTime"""

#: The common tables from rows with a time only, or of 2024 only: what the stored tables hold.
_OF_TIMED = {"valid": "SELECT * FROM raw WHERE length(MMSI) = 9 AND abs(LAT) <= 90 AND abs(LON) <= 180 AND BaseDateTime IS NOT NULL"}
_OF_2024 = {"valid": f"{_OF_TIMED['valid']} AND year(BaseDateTime) = 2024"}

_BODIES = {
    "valid_pings": "SELECT * FROM valid",
    "split_profile": "SELECT * FROM named",
    "split_profile_keep_invalid": f"SELECT DISTINCT {_IDENTITY} FROM raw",
    "decode_motion": "SELECT * FROM decoded",
    "decode_profile": "SELECT * FROM decoded_names",
    "fill_defaults": """SELECT MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading,
        cast(coalesce(Status, 15) AS smallint) AS Status, Draft, coalesce(Cargo, '0') AS Cargo,
        TransceiverClass FROM moved""",
    "clean_motion": f"SELECT *, {_MONTHS} FROM motion",
    "year_month": f"SELECT {_MONTHS}, count(*) AS n FROM positions GROUP BY ALL",
    "profile_conflicts": _CONFLICTS,
    "profile_merge": "SELECT * FROM profiles",
    "profiles_from_state": "SELECT * FROM profiles",
    "port_hits": "SELECT MMSI, BaseDateTime, LAT, LON, UNLOCODE, round(d, 2) AS d FROM hits",
    "port_hits_cross": f"""SELECT MMSI, BaseDateTime, round(km, 3) AS km_to_port, UNLOCODE FROM (
        SELECT a.MMSI, a.BaseDateTime, p.UNLOCODE, {_haversine('p.LON', 'p.LAT', 'a.LON', 'a.LAT')} AS km
        FROM positions a CROSS JOIN ports p) WHERE km <= 35""",
    "nearest_port": "SELECT MMSI, BaseDateTime, UNLOCODE, round(d, 2) AS d FROM nearest",
    "pings_with_port": "SELECT * FROM tagged",
    "port_ping_counts": "SELECT UNLOCODE, count(*) AS c FROM tagged GROUP BY UNLOCODE ORDER BY c DESC",
    "port_ping_counts_named": """SELECT coalesce(UNLOCODE, 'None') AS UNLOCODE, count(*) AS c FROM tagged
        GROUP BY 1 ORDER BY c DESC""",
    "gap_prev": "SELECT MMSI, BaseDateTime, LAT, LON, MeterSincePrevPing, MinSincePrevPing FROM gaps",
    "gap_prev_hot": "SELECT MMSI, BaseDateTime, LAT, LON, MeterSincePrevPing, MinSincePrevPing FROM gaps",
    "gap_prev_exact": f"""SELECT MMSI, BaseDateTime, LAT, LON, round(exact_m, 2) AS MeterSincePrevPing,
        (epoch(date_trunc('second', BaseDateTime)) - epoch(date_trunc('second', p_time))) / 60 AS MinSincePrevPing
        FROM ({_vincenty('stepped')})""",
    "gap_next": _LEGS,
    "gap_next_hot": _LEGS,
    "legs_with_port": _LEGS_WITH_PORT,
    "legs_per_port": f"SELECT UNLOCODE, count(*) AS c FROM ({_LEGS_WITH_PORT}) GROUP BY UNLOCODE",
    "port_hits_salted": "SELECT MMSI, BaseDateTime, LAT, LON, UNLOCODE, round(d, 2) AS d FROM hits",
    "pings_with_port_by_join": "SELECT * FROM tagged",
    "time_analysis_hot": _ANALYSIS,
    "time_analysis_hot_by_join": _ANALYSIS,
    "time_analysis": _ANALYSIS,
    "time_analysis_by_join": _ANALYSIS,
    "gap_prev_legacy_sign": "SELECT MMSI, BaseDateTime, -MinSincePrevPing AS MinSincePrevPing FROM gaps",
    "last_pings": """SELECT MMSI, BaseDateTime, LAT, LON FROM (SELECT *, row_number() OVER
        (PARTITION BY MMSI ORDER BY BaseDateTime DESC NULLS LAST, LAT DESC, LON DESC) AS r FROM positions) WHERE r = 1""",
    "max_gap_rows": """SELECT MMSI, BaseDateTime, LAT, LON, MinSincePrevPing FROM gaps
        WHERE MinSincePrevPing = (SELECT max(MinSincePrevPing) FROM gaps)""",
    "dup_mmsi": """SELECT MMSI, count(*) AS count FROM named GROUP BY MMSI HAVING count(*) > 1
        ORDER BY count DESC, MMSI""",
    "rows_and_ships": "SELECT count(*) AS n_rows, count(DISTINCT MMSI) AS n_mmsi FROM named",
    "mmsi_lengths": f"""SELECT cast(length(MMSI) AS integer) AS mmsi_length, count(*) AS count
        FROM (SELECT DISTINCT {_IDENTITY} FROM raw) GROUP BY 1""",
    "callsign_conflicts": """SELECT MMSI, count(DISTINCT CallSign) AS c FROM named GROUP BY MMSI
        HAVING count(DISTINCT CallSign) > 1""",
    "range_audit": "SELECT * FROM raw WHERE abs(LAT) > 90 OR abs(LON) > 180",
    "length_audit": f"SELECT {_KINEMATIC} FROM raw WHERE length(MMSI) <> 9",
    "length_audit_count": "SELECT count(*) AS n FROM raw WHERE length(MMSI) <> 9",
    "null_audit": "SELECT * FROM raw WHERE MMSI IS NULL",
    "null_call_signs": "SELECT count(*) AS n FROM named WHERE CallSign IS NULL",
    "name_lookup": "SELECT * FROM named WHERE VesselName = '@'",
    "mmsi_lookup": "SELECT * FROM moved WHERE MMSI = '338000007'",
    "mmsi_number_lookup": "SELECT DISTINCT * FROM decoded_names WHERE cast(MMSI AS bigint) = 338000007",
    "callsign_lookup": "SELECT * FROM named WHERE MMSI = '338000007' AND CallSign = 'NULL'",
    "callsign_null_text_count": "SELECT count(*) AS n FROM named WHERE CallSign = 'NULL'",
    "ping_count": "SELECT count(*) AS n FROM valid",
    "coast_filter": f"SELECT * FROM positions WHERE {_inside_coast()}",
    "coast_count": f"SELECT count(*) AS n FROM raw WHERE {_inside_coast()}",
    "preview": "SELECT * FROM positions ORDER BY BaseDateTime NULLS FIRST, MMSI, LAT, LON LIMIT 20",
    "stg_ais": """SELECT MMSI, BaseDateTime AS PingTime, LAT, LON, SOG, COG, Heading, Status, Draft, Cargo,
        TransceiverClass AS Class FROM motion""",
    "stg_profile": """SELECT MMSI, VesselName AS Name, IMO, CallSign, VesselType AS Type, Length, Width
        FROM profiles""",
    "stg_aggregate": """SELECT MMSI, BaseDateTime AS PingTime, NearPort, MeterSincePrevPing,
        MinSincePrevPing AS MinuteSincePrevPing FROM gaps""",
    "partition_roundtrip": f"SELECT *, {_MONTHS} FROM motion WHERE year(BaseDateTime) = 2024",
    "profile_roundtrip": "SELECT * FROM profiles",
    "csv_roundtrip": f"""SELECT *, cast(year(BaseDateTime) AS integer) AS year,
        cast(month(BaseDateTime) AS integer) AS month FROM ({_in_seconds()} FROM raw)""",
    "zip_roundtrip": f"{_in_seconds()} FROM raw",
    "profile_files": "SELECT * FROM profiles",
    "zip_files": f"{_in_seconds()} FROM raw",
    "ports_csv": """SELECT UNLOCODE, trim(NAME) AS NAME, STATE, LAT, LON, reader
        FROM ports, (SELECT unnest(['declared', 'text']) AS reader)""",
    "ingest_incremental": f"{_in_seconds()} FROM raw WHERE BaseDateTime IS NOT NULL",
    "ingest_ledger": """SELECT cast(8 AS bigint) AS files, count(BaseDateTime) AS n_rows,
        count(*) - count(BaseDateTime) AS n_rejected FROM raw""",
    "incremental_days": """SELECT cast(day AS varchar) AS day, cast(year(day) AS integer) AS year, cast(month(day) AS integer) AS month,
        cast(day(day) AS integer) AS dayofmonth
        FROM (SELECT DISTINCT cast(l_shipdate AS date) AS day FROM lineitem
        EXCEPT SELECT cast(o_orderdate AS date) FROM orders)""",
    "backfill_days": """SELECT cast(day AS varchar) AS day, cast(year(day) AS integer) AS year, cast(month(day) AS integer) AS month,
        cast(day(day) AS integer) AS dayofmonth FROM (SELECT cast(unnest(generate_series(
        cast(min(o_orderdate) AS date), cast(max(o_orderdate) AS date), INTERVAL 1 DAY)) AS date) AS day
        FROM orders EXCEPT SELECT cast(BaseDateTime AS date) FROM raw)""",
}

def _ring_edges(parts: int) -> str:
    """The edges of polygon.refined(COAST_RING, parts), by the same arithmetic."""
    base = ", ".join(f"({i}, {x1}e0, {y1}e0, {x2}e0, {y2}e0)" for i, ((x1, y1), (x2, y2)) in enumerate(zip(COAST_RING, COAST_RING[1:])))
    aside = "CASE WHEN k = 0 THEN 0e0 ELSE cast(k * 37 % 101 - 50 AS double) / 5000e0 END"
    return f"""SELECT x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM (
        SELECT i, k, x1 + (x2 - x1) * cast(k AS double) / {parts}e0 + {aside} AS x, y1 + (y2 - y1) * cast(k AS double) / {parts}e0 - {aside} AS y
        FROM (VALUES {base}) AS b(i, x1, y1, x2, y2), (SELECT unnest(range({parts})) AS k)
        UNION ALL SELECT {len(COAST_RING)}, 0, {COAST_RING[-1][0]}e0, {COAST_RING[-1][1]}e0) WINDOW w AS (ORDER BY i, k)"""


_BODIES["coast_filter_fine"] = f"""SELECT MMSI, BaseDateTime, LAT, LON FROM (
    SELECT p.*, count(*) AS crossed FROM (SELECT *, row_number() OVER () AS r FROM positions) p JOIN ({_ring_edges(queries.RING_PARTS)}) e
    ON (y1 > LAT) <> (y2 > LAT) AND LON < LAT * ((x2 - x1) / (y2 - y1)) + (x1 - y1 * ((x2 - x1) / (y2 - y1))) GROUP BY ALL) WHERE crossed % 2 = 1"""

_STORED = {
    "pings_with_port_crowded": (
        "SELECT * FROM tagged",
        {"ports": standin.harbour_sql(), "hits": _CTES["hits"].replace("abs(a.LAT - p.LAT) < 1", "abs(a.LAT - p.LAT) < 0.1 AND abs(a.LON - p.LON) < 0.1")},
    ),
    "clean_job": (f"SELECT *, {_MONTHS} FROM motion", _OF_TIMED),
    "swapped_months": (f"SELECT *, {_MONTHS} FROM motion", _OF_TIMED),
    "clean_job_profiles": ("SELECT * FROM profiles", _OF_2024),
    "profiles_over_years": ("SELECT * FROM profiles", _OF_TIMED),
    "conflicts_over_years": (_CONFLICTS, _OF_TIMED),
    "aggregate_job": (_ANALYSIS, _OF_TIMED),
    "max_gap_rows_stored": (
        """SELECT MMSI, BaseDateTime, NearPort, MinSincePrevPing FROM gaps
        WHERE MinSincePrevPing = (SELECT max(MinSincePrevPing) FROM gaps)""",
        _OF_TIMED,
    ),
    "profile_gate": (_CONFLICTS, _OF_2024),
    "external_tables": (
        """SELECT Type, count(*) AS ships, cast(sum(pings) AS bigint) AS pings,
        cast(sum(headings) AS bigint) AS headings, cast(sum(near_port) AS bigint) AS near_port
        FROM (SELECT MMSI, max(cast(coalesce(VesselType, 0) AS smallint)) AS Type FROM valid
        WHERE year(BaseDateTime) = 2024 GROUP BY MMSI)
        JOIN (SELECT MMSI, count(*) AS pings, count(Heading) AS headings FROM motion GROUP BY MMSI) USING (MMSI)
        JOIN (SELECT MMSI, count(NearPort) AS near_port FROM gaps GROUP BY MMSI) USING (MMSI)
        GROUP BY Type""",
        _OF_TIMED,
    ),
}

SQL = {name: _with(body) for name, body in _BODIES.items()}
SQL |= {name: _with(body, tables) for name, (body, tables) in _STORED.items()}
