"""Parquet tables: ship profiles, pings by year and month, raw pings by the day of their file."""

from pyspark.sql import DataFrame

from aisflow.schemas import MONTH_PARTITIONS, RAW_PARTITIONS


def write_profile(profiles: DataFrame, path: str) -> None:
    """Replaces the table with files of the advisory size, hence one file while it is small."""
    profiles.hint("rebalance").write.mode("overwrite").parquet(path)


def write_profile_files(profiles: DataFrame, path: str) -> None:
    """Replaces the table, with the files as they come."""
    profiles.write.mode("overwrite").parquet(path)


def _replace(pings: DataFrame, path: str, partitions: list[str]) -> None:
    writer = pings.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def write_months(pings: DataFrame, path: str, balance: bool = False) -> None:
    """Replaces the months that occur in ``pings`` and leaves the others alone.

    Rows read from monthly files are already apart, and are written without a
    shuffle. Rows that come out of a shuffle by ship mix all months in each
    task: ``balance`` regroups them by month and lets Spark cut large months
    into files of the advisory size, instead of one file per task and month.
    """
    if balance:
        pings = pings.hint("rebalance", *MONTH_PARTITIONS)
    _replace(pings, path, MONTH_PARTITIONS)


def write_days(pings: DataFrame, path: str) -> None:
    """Replaces what the day files in ``pings`` have in each month, without a shuffle: writing
    a day a second time, after a job that broke off, leaves it there once."""
    _replace(pings, path, RAW_PARTITIONS)
