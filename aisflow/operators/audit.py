"""Checks an analyst runs on raw and cleaned tables. All scale with the table and keep every row."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aisflow.functions import decode, geo
from aisflow.operators import polygon
from aisflow.operators.clean import MMSI_LENGTH
from aisflow.storage import written


def missing_in(table: DataFrame, column: str) -> DataFrame:
    return table.where(F.col(column).isNull())


def out_of_range(pings: DataFrame) -> DataFrame:
    return pings.where((F.abs("LAT") > 90) | (F.abs("LON") > 180))


def name_like(identities: DataFrame, pattern: str) -> DataFrame:
    """SQL LIKE on the ship name. A pattern without wildcards matches only itself."""
    return identities.where(F.col("VesselName").like(pattern))


def bad_mmsi_length(table: DataFrame) -> DataFrame:
    return table.where(F.length("MMSI") != MMSI_LENGTH)


def of_mmsi(table: DataFrame, mmsi: str | int) -> DataFrame:
    """Rows of one ship. A number is compared as text, so one odd MMSI cannot fail the query."""
    return table.where(F.col("MMSI") == str(mmsi))


def text_null_call_signs(identities: DataFrame, mmsi: str | int | None = None) -> DataFrame:
    """Rows whose call sign is the word NULL, of one ship or of all."""
    rows = identities if mmsi is None else of_mmsi(identities, mmsi)
    return rows.where(F.col("CallSign") == decode.NULL_TEXT)


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("n"))


#: Rings of more edges are looked up by a raster index instead of one expression.
EXPRESSION_EDGES = 64


def near_coast(pings: DataFrame, ring=geo.COAST_RING) -> DataFrame:
    """Pings inside the coast ring. The ring's bounds come first and prune the scan."""
    lon, lat = F.col("LON"), F.col("LAT")
    likely = pings.where(geo.in_box(lon, lat, ring))
    return likely.where(geo.in_polygon(lon, lat, ring)) if len(ring) <= EXPRESSION_EDGES else polygon.inside(likely, ring)


def repeated_mmsi(identities: DataFrame) -> DataFrame:
    counts = identities.groupBy("MMSI").agg(F.count("*").alias("count"))
    return counts.where("count > 1").orderBy(F.desc("count"), "MMSI")


def rows_and_ships(identities: DataFrame) -> DataFrame:
    return identities.agg(F.count("*").alias("n_rows"), F.count_distinct("MMSI").alias("n_mmsi"))


def mmsi_lengths(identities: DataFrame) -> DataFrame:
    """Distinct lengths of the MMSI text and how often each occurs."""
    return identities.groupBy(F.length("MMSI").alias("mmsi_length")).agg(F.count("*").alias("count"))


def several_call_signs(identities: DataFrame) -> DataFrame:
    counts = identities.groupBy("MMSI").agg(F.count_distinct("CallSign").alias("c"))
    return counts.where("c > 1")


def pings_per_port(pings: DataFrame, port: str = "UNLOCODE") -> DataFrame:
    """Busiest first; pings near no port count under null."""
    counts = pings.groupBy(port).agg(F.count("*").alias("c"))
    return counts.orderBy(F.desc("c"), F.asc_nulls_last(port))


def rows_at_maximum(table: DataFrame, column: str, stored: bool = False) -> DataFrame:
    """All rows that hold the column's largest value.

    The maximum becomes a literal, so the rows are found by a scan that skips
    every row group whose statistics lie below it. A ``stored`` table is read for
    that column first, and nothing is written. Any other frame is computed once:
    it is written to the shared folder, and the maximum is observed on the way.
    """
    largest = F.max(column).cast("string").alias("largest")
    if stored:
        found = table.agg(largest).first()["largest"]
    else:
        seen = Observation()
        table = written(table.observe(seen, largest), "to-scan")
        found = seen.get["largest"]
    return table.where(F.col(column) == F.lit(found).cast(table.schema[column].dataType))
