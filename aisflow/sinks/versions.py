"""Months of a catalog table replaced as a whole.

New months are written to a folder of their own below the table. When all of
them are there, the catalog's partitions are pointed at them, one statement a
month. Readers list a month's files from one place, the old or the new one, and
never see half of it; old files stay until nobody needs them. A table is kept
either this way or by ``tables.write_months``, which replaces files in place.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from aisflow import storage_files as files
from aisflow.schemas import MONTH_PARTITIONS

#: Readers of the table's folder skip names with an underscore.
PREFIX = "_version-"


@dataclass(frozen=True)
class Version:
    """A folder with months that no reader sees yet."""

    path: str
    months: list[tuple[int, int]]


def write(pings: DataFrame, root: str, balance: bool = False) -> Version:
    """Writes the months that occur in ``pings`` beside what the table has."""
    path = f"{root}/{PREFIX}{uuid.uuid4().hex}"
    rows = pings.hint("rebalance", *MONTH_PARTITIONS) if balance else pings
    rows.write.partitionBy(*MONTH_PARTITIONS).parquet(path)
    return Version(path, _months(pings.sparkSession, path))


def _months(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The months that have a folder below a path."""
    folders = files.matching(spark, f"{path}/year=*/month=*")
    values = [[part.partition("=")[2] for part in folder.rsplit("/", 2)[1:]] for folder in folders]
    return sorted((int(year), int(month)) for year, month in values)


def add_months(spark: SparkSession, table: str, root: str) -> None:
    """Adds the months in the table's own folders that the catalog lacks; the others stay where they point."""
    for year, month in sorted(set(_months(spark, root)) - set(locations(spark, table))):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (year={year}, month={month}) LOCATION '{root}/year={year}/month={month}'")


def swap(spark: SparkSession, table: str, version: Version) -> None:
    """Points the table's months at the version; months that it does not have stay."""
    for year, month in version.months:
        place = f"PARTITION (year={year}, month={month})"
        location = f"{version.path}/year={year}/month={month}".replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {place} LOCATION '{location}'")
        spark.sql(f"ALTER TABLE {table} {place} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def replace_months(pings: DataFrame, table: str, root: str, balance: bool = False) -> Version:
    version = write(pings, root, balance)
    swap(pings.sparkSession, table, version)
    return version


def locations(spark: SparkSession, table: str) -> dict[tuple[int, int], str]:
    """Where each month of the table lies."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=") for part in row[0].split("/"))
        year, month = int(values["year"]), int(values["month"])
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (year={year}, month={month})").collect()
        found[year, month] = next(r["data_type"] for r in told if r["col_name"] == "Location")
    return found


def _plain(path: str) -> str:
    """A path without its scheme, which catalogs spell in several ways."""
    return "/" + path.split(":", 1)[-1].strip("/") + "/"


def remove_unused(spark: SparkSession, table: str, root: str) -> list[str]:
    """Removes versions to which no month points, once no reader can still be at them."""
    used = [_plain(place) for place in locations(spark, table).values()]
    found = files.matching(spark, f"{root}/{PREFIX}*")
    gone = [path for path in found if not any(place.startswith(_plain(path)) for place in used)]
    for path in gone:
        files.remove(spark, path)
    return gone
