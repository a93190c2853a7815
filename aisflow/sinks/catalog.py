"""External tables over the Parquet folders, and staging views over them."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aisflow import schemas
from aisflow import storage_files as files
from aisflow.sinks import versions

MONTH_LABEL = T.StructField("YearMonth", T.StringType())

ANALYSIS = T.StructType(
    [
        schemas.PING["MMSI"],
        schemas.PING["BaseDateTime"],
        T.StructField("NearPort", T.StringType()),
        T.StructField("MeterSincePrevPing", T.DoubleType()),
        T.StructField("MinSincePrevPing", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class External:
    name: str
    columns: T.StructType
    by_month: bool


PROFILE_TABLE = External("vessel_profile", schemas.PROFILE, by_month=False)
PINGS_TABLE = External("vessel_ais", T.StructType([*schemas.KINEMATICS, MONTH_LABEL]), by_month=True)
ANALYSIS_TABLE = External("vessel_agg", T.StructType([*ANALYSIS, MONTH_LABEL]), by_month=True)

# Names of the staging views and their columns. View -> (table, column -> name in the view), in the view's order.
STAGING = {
    "stg_ais": (
        PINGS_TABLE,
        {
            "MMSI": "MMSI",
            "BaseDateTime": "PingTime",
            "LAT": "LAT",
            "LON": "LON",
            "SOG": "SOG",
            "COG": "COG",
            "Heading": "Heading",
            "Status": "Status",
            "Draft": "Draft",
            "Cargo": "Cargo",
            "TransceiverClass": "Class",
        },
    ),
    "stg_aggregate": (
        ANALYSIS_TABLE,
        {
            "MMSI": "MMSI",
            "BaseDateTime": "PingTime",
            "NearPort": "NearPort",
            "MeterSincePrevPing": "MeterSincePrevPing",
            "MinSincePrevPing": "MinuteSincePrevPing",
        },
    ),
    "stg_profile": (
        PROFILE_TABLE,
        {
            "MMSI": "MMSI",
            "VesselName": "Name",
            "IMO": "IMO",
            "CallSign": "CallSign",
            "VesselType": "Type",
            "Length": "Length",
            "Width": "Width",
        },
    ),
}


def _qualified(name: str, database: str | None) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def create_external(spark: SparkSession, table: External, path: str, database: str | None = None) -> str:
    """Points the table at ``path``; files are not touched.

    Call after a successful write. A table of the same definition only gets its
    new location, so readers find it at any time; one of another definition is
    replaced. Returns the qualified name.
    """
    name = _qualified(table.name, database)
    location = path.replace("'", "\\'")
    columns = table.columns.toDDL()
    partitions = ""
    if table.by_month:
        columns += ", year INT, month INT"
        partitions = f"PARTITIONED BY ({', '.join(schemas.MONTH_PARTITIONS)})"
    wanted = T.StructType.fromDDL(columns)
    if spark.catalog.tableExists(name) and spark.table(name).schema == wanted:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitions} LOCATION '{location}'")
    if table.by_month:
        if files.matching(spark, f"{path}/{versions.PREFIX}*"):
            # a repair would point months back from their versions to the table's own folders
            versions.add_months(spark, name, path)
        else:
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def staged(table: DataFrame, view: str) -> DataFrame:
    """The staging projection of ``view`` over any frame with the table's columns."""
    _, names = STAGING[view]
    return table.select(*names).withColumnsRenamed(names)


def create_staging_view(spark: SparkSession, view: str, database: str | None = None) -> str:
    table, names = STAGING[view]
    columns = ", ".join(f"`{old}` AS `{new}`" for old, new in names.items())
    name = _qualified(view, database)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {_qualified(table.name, database)}")
    return name


def publish(spark: SparkSession, profile_root: str, pings_root: str, analysis_root: str, database: str | None = None) -> None:
    """All external tables over what the jobs wrote, and the staging views over them."""
    for table, root in ((PROFILE_TABLE, profile_root), (PINGS_TABLE, pings_root), (ANALYSIS_TABLE, analysis_root)):
        create_external(spark, table, root, database)
    for view in STAGING:
        create_staging_view(spark, view, database)
