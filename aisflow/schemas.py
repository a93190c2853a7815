"""Declared schemas of every table.

``BaseDateTime`` carries no zone in the source files, so it is a
``timestamp_ntz`` here: no result depends on the session time zone.
"""

from pyspark.sql import types as T

# Names and types of the published day files.
PING = T.StructType(
    [
        T.StructField("MMSI", T.StringType()),
        T.StructField("BaseDateTime", T.TimestampNTZType()),
        T.StructField("LAT", T.DoubleType()),
        T.StructField("LON", T.DoubleType()),
        T.StructField("SOG", T.FloatType()),
        T.StructField("COG", T.FloatType()),
        T.StructField("Heading", T.FloatType()),
        T.StructField("VesselName", T.StringType()),
        T.StructField("IMO", T.StringType()),
        T.StructField("CallSign", T.StringType()),
        T.StructField("VesselType", T.ShortType()),
        T.StructField("Status", T.ShortType()),
        T.StructField("Length", T.FloatType()),
        T.StructField("Width", T.FloatType()),
        T.StructField("Draft", T.FloatType()),
        T.StructField("Cargo", T.StringType()),
        T.StructField("TransceiverClass", T.StringType()),
    ]
)

# The columns of a port list.
PORT = T.StructType(
    [
        T.StructField("UNLOCODE", T.StringType()),
        T.StructField("NAME", T.StringType()),
        T.StructField("STATE", T.StringType()),
        T.StructField("LAT", T.DoubleType()),
        T.StructField("LON", T.DoubleType()),
    ]
)

# One row per ship.
IDENTITY_COLUMNS = ["MMSI", "VesselName", "IMO", "CallSign", "VesselType", "Length", "Width"]

# One row per report.
KINEMATIC_COLUMNS = [
    "MMSI",
    "BaseDateTime",
    "LAT",
    "LON",
    "SOG",
    "COG",
    "Heading",
    "Status",
    "Draft",
    "Cargo",
    "TransceiverClass",
]

# All that the yearly aggregation reads.
POSITION_COLUMNS = ["MMSI", "BaseDateTime", "LAT", "LON"]

MONTH_PARTITIONS = ["year", "month"]

# The raw table also keeps apart what each day file brought: a file may hold reports of another day.
FILE_DAY = "ingest_day"
RAW_PARTITIONS = [*MONTH_PARTITIONS, FILE_DAY]


def pick(schema: T.StructType, names: list[str]) -> T.StructType:
    """The declared schema narrowed to ``names``, in that order."""
    return T.StructType([schema[name] for name in names])


POSITION = pick(PING, POSITION_COLUMNS)
KINEMATICS = pick(PING, KINEMATIC_COLUMNS)
PROFILE = pick(PING, IDENTITY_COLUMNS)
