"""Port positions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisflow import schemas

# UNLOCODE, name, state, latitude, longitude.
US_PORTS = [
    ("USHOU", "Port of Houston", "TX", 29.611, -95.02156),
    ("USLU8", "Port of South Louisiana", "LA", 30.0559, -90.56685),
    ("USCRP", "Port of Corpus Christi", "TX", 27.81125, -97.39786),
    ("USNYC", "Port of New York and New Jersey", "NY", 40.76648, -74.02531),
    ("USMSY", "Port of New Orleans", "LA", 29.93867, -90.06431),
    ("USLGB", "Port of Long Beach", "CA", 33.75463, -118.21606),
    ("USBTR", "Port of Greater Baton Rouge", "LA", 30.43446, -91.20521),
    ("USBPT", "Port of Beaumont", "TX", 30.07941, -94.09279),
    ("USHR3", "Port of Hampton Roads", "VA", 36.95924, -76.37836),
    ("USTPA", "Port Tampa Bay", "FL", 27.92789, -82.43271),
    ("USSEA", "Port of Seattle", "WA", 47.61379, -122.35427),
    ("USTIW", "Port of Tacoma", "WA", 47.26544, -122.41228),
    ("USRCH", "Port of Richmond", "CA", 37.90757, -122.33733),
    ("USPDX", "Port of Portland", "OR", 45.58806, -122.58952),
    ("USPEF", "Port Everglades", "FL", 26.08143, -80.12065),
]


def us_ports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(US_PORTS, schemas.PORT)


def read_ports(spark: SparkSession, path: str) -> DataFrame:
    """A port CSV with header; columns go by position, so header spelling and BOM do not matter."""
    ports = spark.read.schema(schemas.PORT).option("header", True).csv(path)
    return ports.withColumn("NAME", F.trim("NAME"))


def read_ports_as_text(spark: SparkSession, path: str) -> DataFrame:
    """A port CSV without a schema: every column is text and named by the header."""
    return spark.read.option("header", True).csv(path)


def typed(ports: DataFrame) -> DataFrame:
    """Text columns, in the usual order, cast to the declared types."""
    named = ports.toDF(*schemas.PORT.names)
    columns = [F.trim(f.name).cast(f.dataType).alias(f.name) for f in schemas.PORT]
    return named.select(*columns)
