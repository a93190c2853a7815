"""Which days are asked for, which files hold them, and which were ingested before."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aisflow.sources.manifest import read_ledger as read_ledger

# Fixed value: day files carry their date as YYYY_MM_DD.
DAY_IN_NAME = r"(\d{4}_\d{2}_\d{2})\.\w+$"

def day_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """All days from ``first`` to ``last`` (ISO dates), both included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("day"))


def days_spanned(pings: DataFrame) -> DataFrame:
    """All days from the first to the last report, whether or not any report falls on them."""
    ends = pings.agg(F.min("BaseDateTime").alias("first"), F.max("BaseDateTime").alias("last"))
    return ends.select(F.explode(F.sequence(F.to_date("first"), F.to_date("last"))).alias("day"))


def split_day(days: DataFrame) -> DataFrame:
    """Adds the integer parts, as the table's folders have them."""
    return days.withColumns({"year": F.year("day"), "month": F.month("day"), "dayofmonth": F.dayofmonth("day")})


def day_of(path: Column) -> Column:
    """The date in a file's name, null without one."""
    text = F.regexp_extract(path, DAY_IN_NAME, 1)
    return F.when(text != "", F.to_date(text, "yyyy_MM_dd"))


def listed_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, day) of the files found; contents are not read. Without a date in the name, day is null."""
    files = spark.read.format("binaryFile").load(paths).select("path")
    return files.withColumn("day", day_of(F.col("path")))


def one_per_day(files: DataFrame) -> DataFrame:
    """(path, day, chosen): of several files of a day one is chosen, an archive before plain
    text and then the first by path. Files without a day are never chosen."""
    zipped_first = [F.lower("path").endswith(".zip").desc(), F.col("path").asc()]
    rank = F.row_number().over(Window.partitionBy("day").orderBy(*zipped_first))
    return files.withColumn("chosen", F.col("day").isNotNull() & (rank == 1))


def landed_days(pings: DataFrame) -> DataFrame:
    return pings.select(F.to_date("BaseDateTime").alias("day")).distinct()


def missing(requested: DataFrame, landed: DataFrame) -> DataFrame:
    """Requested rows whose day has not landed."""
    return requested.join(landed, "day", "left_anti")
