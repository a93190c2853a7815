"""Every registered query: (spark, folder of the test tables) -> DataFrame."""

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisflow import schemas
from aisflow.functions import geo
from aisflow.operators import audit, clean, motion, polygon, profile, profile_state, proximity
from aisflow.plans import aggregate_year, clean_year, ingest_days, standin
from aisflow.sinks import catalog, tables, versions
from aisflow.sources import days
from aisflow.sources import pings as ping_source
from aisflow.sources import ports as port_source
from aisflow.storage import scratch_path, written

Query = Callable[[SparkSession, str], DataFrame]

REGISTERED: dict[str, Query] = {}


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    return clean.valid_pings(standin.pings(spark, folder))


def _positions(spark: SparkSession, folder: str) -> DataFrame:
    return _valid(spark, folder).select(*schemas.POSITION_COLUMNS)


def _identities(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_identity(_valid(spark, folder))


def _rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(name, 2) for name in names})


def _dated(found: DataFrame) -> DataFrame:
    return days.split_day(found).withColumn("day", F.col("day").cast("string"))


# Cleaning


@registered
def valid_pings(spark, folder):
    return _valid(spark, folder)


@registered
def split_profile(spark, folder):
    identities, _ = clean.split(standin.pings(spark, folder))
    return identities


@registered
def split_profile_keep_invalid(spark, folder):
    identities, _ = clean.split(standin.pings(spark, folder), scope="pings")
    return identities


@registered
def decode_motion(spark, folder):
    _, kinematics = clean.split(standin.pings(spark, folder))
    return clean.decode_motion(kinematics)


@registered
def decode_profile(spark, folder):
    return clean.decode_identity(clean.identity_rows(_valid(spark, folder)))


@registered
def fill_defaults(spark, folder):
    return clean.default_motion(clean.kinematic_rows(_valid(spark, folder)))


@registered
def clean_motion(spark, folder):
    return clean.with_months(clean.clean_motion(_valid(spark, folder)))


@registered
def year_month(spark, folder):
    months = clean.with_months(_positions(spark, folder))
    return months.groupBy("YearMonth", "year", "month").agg(F.count("*").alias("n"))


# Profiles


@registered
def profile_conflicts(spark, folder):
    return profile_state.conflicts(profile_state.facts(_identities(spark, folder)))


@registered
def profiles_from_state(spark, folder):
    """Profiles merged from the states of three parts of the pings, two of which overlap."""
    named = clean.clean_identity(_valid(spark, folder))
    part = F.pmod(F.xxhash64(*named.columns), F.lit(3))
    states = [profile_state.facts(named.where(part == k if k else part < 2)) for k in range(3)]
    return profile_state.merge(profile_state.merged(*states))


@registered
def profile_merge(spark, folder):
    return profile.merge(_identities(spark, folder))


# Ports


@registered
def port_hits(spark, folder):
    hits = proximity.port_hits(_positions(spark, folder), standin.ports(spark, folder))
    return _rounded(hits, "d")


@registered
def port_hits_cross(spark, folder):
    hits = proximity.port_hits(
        _positions(spark, folder),
        standin.ports(spark, folder),
        radius_m=35_000.0,
        globe=geo.SPHERE,
        inclusive=True,
    )
    return hits.select("MMSI", "BaseDateTime", F.round(F.col("d") / 1000, 3).alias("km_to_port"), "UNLOCODE")


@registered
def port_hits_salted(spark, folder):
    """The same as port_hits without a broadcast of the ports, with busy cells in parts."""
    hits = proximity.port_hits(
        _positions(spark, folder), standin.ports(spark, folder), broadcast_cells=0, cell_rows=100
    )
    return _rounded(hits, "d")


@registered
def nearest_port(spark, folder):
    hits = proximity.port_hits(_positions(spark, folder), standin.ports(spark, folder))
    return _rounded(proximity.nearest_port(hits), "d")


@registered
def pings_with_port(spark, folder):
    return proximity.pings_with_port(_positions(spark, folder), standin.ports(spark, folder))


@registered
def pings_with_port_by_join(spark, folder):
    return proximity.pings_with_port_by_join(_positions(spark, folder), standin.ports(spark, folder), broadcast_cells=0)


@registered
def pings_with_port_crowded(spark, folder):
    """Nearest of 40 times as many ports: each has 39 others around it, within some 150 m."""
    return proximity.pings_with_port(_positions(spark, folder), standin.harbours(spark, folder))


@registered
def legs_with_port(spark, folder):
    """Next leg and nearest port within 35 km on a sphere, for every ping."""
    legs = aggregate_year.legs_with_port(_positions(spark, folder), standin.ports(spark, folder))
    return legs.withColumn("d", F.round("d", 3))


@registered
def legs_per_port(spark, folder):
    return audit.pings_per_port(aggregate_year.legs_with_port(_positions(spark, folder), standin.ports(spark, folder)))


@registered
def port_ping_counts(spark, folder):
    tagged = proximity.pings_with_port(_positions(spark, folder), standin.ports(spark, folder))
    return audit.pings_per_port(tagged)


@registered
def port_ping_counts_named(spark, folder):
    tagged = proximity.pings_with_port(_positions(spark, folder), standin.ports(spark, folder))
    return audit.pings_per_port(clean.default_port(tagged))


# Motion


@registered
def gap_prev(spark, folder):
    return _rounded(motion.previous_gaps(_positions(spark, folder)), "MeterSincePrevPing")


@registered
def gap_prev_exact(spark, folder):
    """The same as gap_prev by the iterated geodesic."""
    return _rounded(motion.previous_gaps(_positions(spark, folder), exact=True), "MeterSincePrevPing")


@registered
def gap_next(spark, folder):
    return motion.next_leg(_positions(spark, folder)).withColumn("d", F.round("d", 3))


#: Small enough for many of the stand-in's ships to count as hot.
_HOT = {"hot_rows": 20, "slice_rows": 50}


@registered
def gap_prev_hot(spark, folder):
    """The same as gap_prev with most ships cut into slices."""
    return _rounded(motion.previous_gaps(_positions(spark, folder), **_HOT), "MeterSincePrevPing")


@registered
def gap_next_hot(spark, folder):
    return motion.next_leg(_positions(spark, folder), **_HOT).withColumn("d", F.round("d", 3))


@registered
def time_analysis(spark, folder):
    analysed = aggregate_year.time_analysis(_valid(spark, folder), standin.ports(spark, folder))
    return _rounded(clean.with_months(analysed), "MeterSincePrevPing")


@registered
def time_analysis_by_join(spark, folder):
    """The same without a broadcast of the ports."""
    analysed = aggregate_year.time_analysis(
        _valid(spark, folder), standin.ports(spark, folder), broadcast_cells=0
    )
    return _rounded(clean.with_months(analysed), "MeterSincePrevPing")


@registered
def time_analysis_hot(spark, folder):
    """The same with most ships cut into slices."""
    analysed = aggregate_year.time_analysis(_valid(spark, folder), standin.ports(spark, folder), **_HOT)
    return _rounded(clean.with_months(analysed), "MeterSincePrevPing")


@registered
def time_analysis_hot_by_join(spark, folder):
    analysed = aggregate_year.time_analysis(
        _valid(spark, folder), standin.ports(spark, folder), broadcast_cells=0, **_HOT
    )
    return _rounded(clean.with_months(analysed), "MeterSincePrevPing")


@registered
def gap_prev_legacy_sign(spark, folder):
    gaps = motion.previous_gaps(_positions(spark, folder), legacy_sign=True)
    return gaps.select("MMSI", "BaseDateTime", "MinSincePrevPing")


@registered
def last_pings(spark, folder):
    return motion.last_pings(_positions(spark, folder))


@registered
def max_gap_rows(spark, folder):
    gaps = motion.previous_gaps(_positions(spark, folder))
    return audit.rows_at_maximum(gaps.drop("MeterSincePrevPing"), "MinSincePrevPing")


@registered
def max_gap_rows_stored(spark, folder):
    """The same from the table that the yearly job stores: a scan of one column, then of the row groups that can hold its maximum."""
    stored = ping_source.read_parquet(spark, _jobs(spark, folder).analysis, None)
    return audit.rows_at_maximum(stored.select("MMSI", "BaseDateTime", "NearPort", "MinSincePrevPing"), "MinSincePrevPing", stored=True)


# Audits


@registered
def dup_mmsi(spark, folder):
    return audit.repeated_mmsi(clean.identity_rows(_valid(spark, folder)))


@registered
def rows_and_ships(spark, folder):
    return audit.rows_and_ships(clean.identity_rows(_valid(spark, folder)))


@registered
def mmsi_lengths(spark, folder):
    return audit.mmsi_lengths(clean.identity_rows(standin.pings(spark, folder)))


@registered
def callsign_conflicts(spark, folder):
    return audit.several_call_signs(clean.identity_rows(_valid(spark, folder)))


@registered
def range_audit(spark, folder):
    return audit.out_of_range(standin.pings(spark, folder))


@registered
def length_audit(spark, folder):
    return audit.bad_mmsi_length(standin.pings(spark, folder).select(*schemas.KINEMATIC_COLUMNS))


@registered
def length_audit_count(spark, folder):
    return audit.row_count(audit.bad_mmsi_length(standin.pings(spark, folder)))


@registered
def null_audit(spark, folder):
    return audit.missing_in(standin.pings(spark, folder), "MMSI")


@registered
def null_call_signs(spark, folder):
    return audit.row_count(audit.missing_in(clean.identity_rows(_valid(spark, folder)), "CallSign"))


@registered
def name_lookup(spark, folder):
    return audit.name_like(clean.identity_rows(_valid(spark, folder)), "@")


@registered
def mmsi_lookup(spark, folder):
    return audit.of_mmsi(clean.kinematic_rows(_valid(spark, folder)), "338000007")


@registered
def mmsi_number_lookup(spark, folder):
    return audit.of_mmsi(clean.decode_identity(clean.identity_rows(_valid(spark, folder))), 338000007).distinct()


@registered
def callsign_lookup(spark, folder):
    return audit.text_null_call_signs(clean.identity_rows(_valid(spark, folder)), 338000007)


@registered
def callsign_null_text_count(spark, folder):
    return audit.row_count(audit.text_null_call_signs(clean.identity_rows(_valid(spark, folder))))


@registered
def ping_count(spark, folder):
    return audit.row_count(_valid(spark, folder))


@registered
def coast_filter(spark, folder):
    return audit.near_coast(_positions(spark, folder))


#: Parts of every edge of the ring in coast_filter_fine, which has some 5,000 edges then.
RING_PARTS = 250


@registered
def coast_filter_fine(spark, folder):
    """The same with a ring of very many edges, by its raster index."""
    return audit.near_coast(_positions(spark, folder), polygon.refined(geo.COAST_RING, RING_PARTS))


@registered
def coast_count(spark, folder):
    return audit.row_count(audit.near_coast(standin.pings(spark, folder)))


@registered
def preview(spark, folder):
    return ping_source.preview(_positions(spark, folder).orderBy("BaseDateTime", "MMSI", "LAT", "LON"))


# Publishing


@registered
def stg_ais(spark, folder):
    return catalog.staged(clean.clean_motion(_valid(spark, folder)), "stg_ais")


@registered
def stg_profile(spark, folder):
    return catalog.staged(profile.merge(_identities(spark, folder)), "stg_profile")


@registered
def stg_aggregate(spark, folder):
    analysed = aggregate_year.time_analysis(_valid(spark, folder), standin.ports(spark, folder))
    return catalog.staged(_rounded(analysed, "MeterSincePrevPing"), "stg_aggregate")


@registered
def partition_roundtrip(spark, folder):
    """Written by month twice, read back through a pruned scan."""
    path = scratch_path(spark, "pings-by-month")
    rows = clean.with_months(clean.clean_motion(_valid(spark, folder)))
    tables.write_months(rows, path)
    tables.write_months(rows, path, balance=True)
    return ping_source.year_of(ping_source.read_parquet(spark, path, None), 2024)


@registered
def profile_roundtrip(spark, folder):
    path = scratch_path(spark, "profiles")
    tables.write_profile(profile.merge(_identities(spark, folder)), path)
    return ping_source.read_parquet(spark, path, schemas.PROFILE)


@registered
def profile_files(spark, folder):
    path = scratch_path(spark, "profile-files")
    tables.write_profile_files(profile.merge(_identities(spark, folder)), path)
    return ping_source.read_parquet(spark, path, schemas.PROFILE)


@registered
def csv_roundtrip(spark, folder):
    """Raw pings as CSV day files, stored in the raw table's layout, read back with the declared schema."""
    files, root = scratch_path(spark, "day-files"), scratch_path(spark, "raw-day")
    standin.csv_text(standin.pings(spark, folder)).write.options(header=True, quote="").csv(files)
    read = clean.with_months(ping_source.read_csv(spark, files)).drop("YearMonth")
    tables.write_days(read.withColumn(schemas.FILE_DAY, F.lit("2024-01-01").cast("date")), root)
    return ping_source.read_parquet(spark, root).drop(schemas.FILE_DAY)


@registered
def zip_roundtrip(spark, folder):
    """Raw pings as zipped CSV, unpacked and parsed."""
    archives = standin.zip_archives(standin.pings(spark, folder))
    return ping_source.parse_lines(ping_source.first_member_lines(archives))


@registered
def zip_files(spark, folder):
    """The same through archive files. The text writer stores their bytes and a line end, which
    unzipping skips; an archive has a file of its own."""
    path = scratch_path(spark, "archives")
    archives = standin.zip_archives(standin.pings(spark, folder)).select(F.col("content").cast("string").alias("value"))
    archives.write.option("maxRecordsPerFile", 1).text(path)
    # stored, so that archives are unpacked once, whatever reads the result
    return written(ping_source.read_zip(spark, path), "unpacked")


@registered
def ports_csv(spark, folder):
    """Ports as CSV with a byte order mark, read with the declared schema and as text."""
    path = scratch_path(spark, "ports")
    lines = standin.ports(spark, folder).select(*[F.col(n).cast("string") for n in schemas.PORT.names])
    marked = lines.coalesce(1).withColumnRenamed("UNLOCODE", "\ufeffUNLOCODE")
    marked.write.option("header", True).csv(path)
    declared = port_source.read_ports(spark, path).withColumn("reader", F.lit("declared"))
    as_text = port_source.typed(port_source.read_ports_as_text(spark, path)).withColumn("reader", F.lit("text"))
    return declared.unionByName(as_text)


def _ingested(spark: SparkSession, folder: str) -> str:
    """Root of a raw table made by two runs of the ingest job over overlapping day files."""
    files, root = scratch_path(spark, "day-files"), scratch_path(spark, "raw")
    standin.write_day_files(standin.files_by_day(standin.pings(spark, folder)), files)
    ingest_days.run(spark, f"{files}/AIS_2024_01_0[1-5].csv", root)
    ingest_days.run(spark, f"{files}/*.csv", root, "2024-01-01", "2024-01-31")
    return root


@registered
def ingest_incremental(spark, folder):
    """Raw pings through the ingest job; reports lie on other days than their files'."""
    return ping_source.read_parquet(spark, _ingested(spark, folder)).drop("year", "month", schemas.FILE_DAY)


@registered
def ingest_ledger(spark, folder):
    """What the job noted of its files, in all."""
    ledger = days.read_ledger(spark, _ingested(spark, folder))
    return ledger.agg(F.count("*").alias("files"), F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected"))


def _raw_table(spark: SparkSession, folder: str) -> str:
    root = scratch_path(spark, "raw")
    raw = clean.with_months(standin.pings(spark, folder)).drop("YearMonth").where("BaseDateTime IS NOT NULL")
    tables.write_days(raw.withColumn(schemas.FILE_DAY, F.lit("2024-01-01").cast("date")), root)
    return root


@dataclass(frozen=True)
class Jobs:
    """Roots that the yearly jobs wrote."""

    profile: str
    ais: str
    analysis: str


def _jobs(spark: SparkSession, folder: str, aggregate: bool = True) -> Jobs:
    """Both years of the stand-in through the yearly jobs; each year's profile has a root of its own."""
    raw = _raw_table(spark, folder)
    root = scratch_path(spark, "tables")
    for year in (2024, 2025):
        clean_year.run(spark, raw, f"{root}/profile-{year}", f"{root}/ais", year, strict=False)
    for year in (2024, 2025) if aggregate else ():
        aggregate_year.run(spark, f"{root}/ais", standin.ports(spark, folder), f"{root}/agg", year, carry_over=year == 2025)
    return Jobs(f"{root}/profile-2024", f"{root}/ais", f"{root}/agg")


@registered
def clean_job(spark, folder):
    """Clean kinematics of both years, as the job stores them by month."""
    return ping_source.read_parquet(spark, _jobs(spark, folder, aggregate=False).ais, None)


@registered
def clean_job_profiles(spark, folder):
    """The profiles of the first year."""
    return ping_source.read_parquet(spark, _jobs(spark, folder, aggregate=False).profile, schemas.PROFILE)


def _state_of_years(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Roots of the profiles and of their state after runs over both years, the first of them twice."""
    raw, root = _raw_table(spark, folder), scratch_path(spark, "years")
    for year in (2024, 2025, 2024):
        clean_year.run(spark, raw, f"{root}/profile", f"{root}/ais", year, strict=False, state_root=f"{root}/state")
    return f"{root}/profile", f"{root}/state"


@registered
def profiles_over_years(spark, folder):
    """Profiles of both years, each of which was read by its own run."""
    return ping_source.read_parquet(spark, _state_of_years(spark, folder)[0], schemas.PROFILE)


@registered
def conflicts_over_years(spark, folder):
    """Conflicts across both years, from the stored state."""
    stored = profile_state.read(spark, _state_of_years(spark, folder)[1])
    return profile_state.conflicts(profile_state.merged(stored))


@registered
def aggregate_job(spark, folder):
    """Two yearly runs, the second of which carries the last pings of the first over."""
    analysed = ping_source.read_parquet(spark, _jobs(spark, folder).analysis, None)
    return _rounded(analysed, "MeterSincePrevPing")


@registered
def profile_gate(spark, folder):
    """Conflicts that a strict run writes before it stops; it must leave no table behind."""
    raw, root = _raw_table(spark, folder), scratch_path(spark, "gate")
    try:
        clean_year.run(spark, raw, f"{root}/profile", f"{root}/ais", 2024, conflicts_root=f"{root}/conflicts")
    except profile.ProfileConflictError:
        found = spark.read.parquet(f"{root}/conflicts")
    else:
        raise AssertionError("the gate let conflicting profiles pass")
    for table in ("profile", "ais"):
        try:
            spark.read.parquet(f"{root}/{table}")
        except AnalysisException:
            continue
        raise AssertionError(f"the gate left the {table} table behind")
    return found


@registered
def external_tables(spark, folder):
    """All three tables as the jobs write them, registered, and read through the staging views."""
    database = f"aisflow_{uuid.uuid4().hex[:12]}"
    made = _jobs(spark, folder)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    for _ in range(2):
        catalog.publish(spark, made.profile, made.ais, made.analysis, database)
    summary = spark.sql(
        f"""
        WITH moved AS (
          SELECT MMSI, count(*) AS pings, count(Heading) AS headings FROM {database}.stg_ais GROUP BY MMSI
        ), placed AS (
          SELECT MMSI, count(NearPort) AS near_port FROM {database}.stg_aggregate GROUP BY MMSI
        )
        SELECT Type, count(*) AS ships, sum(pings) AS pings, sum(headings) AS headings,
               sum(near_port) AS near_port
        FROM {database}.stg_profile JOIN moved USING (MMSI) JOIN placed USING (MMSI)
        GROUP BY Type
        """
    )
    held = written(summary, "summary")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return held


@registered
def swapped_months(spark, folder):
    """Clean kinematics in a catalog table whose months were all replaced by a version of their own."""
    database = f"aisflow_{uuid.uuid4().hex[:12]}"
    root = f"{scratch_path(spark, 'swapped')}/ais"
    rows = clean.with_months(clean.clean_motion(_valid(spark, folder).where("BaseDateTime IS NOT NULL")))
    tables.write_months(rows.where(F.col("month") < 7).limit(100), root)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    table = catalog.create_external(spark, catalog.PINGS_TABLE, root, database)
    versions.replace_months(rows, table, root, balance=True)
    held = written(spark.table(table), "swapped")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return held


# Days


@registered
def incremental_days(spark, folder):
    """Ship days without any order day: what an ingest of the former would still have to read."""
    shipped = standin.table(spark, folder, "lineitem").select(F.col("l_shipdate").alias("BaseDateTime"))
    ordered = standin.table(spark, folder, "orders").select(F.col("o_orderdate").alias("BaseDateTime"))
    return _dated(days.missing(days.landed_days(shipped), days.landed_days(ordered)))


@registered
def backfill_days(spark, folder):
    """All days spanned by the orders on which no ping landed."""
    ordered = standin.table(spark, folder, "orders").select(F.col("o_orderdate").alias("BaseDateTime"))
    landed = days.landed_days(standin.pings(spark, folder))
    return _dated(days.missing(days.days_spanned(ordered), landed))
