"""Day files -> typed Parquet by year, month and the day of the file."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisflow import storage_files
from aisflow.operators.clean import with_months
from aisflow.schemas import FILE_DAY, PING, RAW_PARTITIONS
from aisflow.sources import days, manifest
from aisflow.sources import pings as ping_source
from aisflow.storage import job, written

# Rows without a time have no month: they are kept here, within the table, by the day of their file.
REJECTS = "_rejected"

# Where a run writes before it publishes, and the partition column that tells rows with a time from those without.
STAGED = "_staged-"
KIND, TIMED, UNTIMED = "kind", "timed", "untimed"


@dataclass(frozen=True)
class Ingested:
    """Files that were read; days of the range without any file; files left aside as their day
    has another file in this call, or was ingested before; rows kept among the rejects."""

    read: list[str]
    missing_days: list[str]
    second_files: list[str]
    known_files: list[str]
    n_rejected: int


def run(
    spark: SparkSession,
    paths: str | list[str],
    raw_root: str,
    first: str | None = None,
    last: str | None = None,
    claim_hours: float = manifest.CLAIM_HOURS,
) -> Ingested:
    """Ingests all files (zip or CSV) of days that the table does not have, in one job.

    A file belongs to the day in its name, whatever days its reports carry; a
    file without one is an error, before anything is read. ``first`` and
    ``last`` (ISO dates) bound a backfill. Days are claimed in the manifest
    first, so runs may overlap and each day is read by one of them. A day counts
    as ingested once the manifest says so, which is written last; its rows
    replace those that a broken-off attempt may have left, so a run can always
    be repeated, after a run that died once its claims are ``claim_hours`` old.
    """
    with job(spark):
        files = written(days.listed_files(spark, paths), "files")
        undated = [row["path"] for row in files.where("day IS NULL").collect()]
        if undated:
            raise ValueError(f"no date in the name of {sorted(undated)}")
        if first:
            files = files.where(F.col("day") >= F.lit(first).cast("date"))
        if last:
            files = files.where(F.col("day") <= F.lit(last).cast("date"))
        gone = days.missing(days.day_range(spark, first, last), files.select("day")) if first and last else None
        gaps = [] if gone is None else sorted(str(row["day"]) for row in gone.collect())
        marked = [(row["path"], str(row["day"]), row["chosen"]) for row in days.one_per_day(files).collect()]
        wanted = [day for _, day, chosen in marked if chosen]
        run_id, own = manifest.claim(spark, raw_root, wanted, claim_hours) if wanted else ("", [])
        chosen = sorted(path for path, day, first_ in marked if first_ and day in own)
        second = sorted(path for path, day, first_ in marked if not first_ and day in own)
        known = sorted(path for path, day, _ in marked if day not in own)
        rejected = _ingest(spark, chosen, own, raw_root, run_id) if chosen else 0
    return Ingested(chosen, gaps, second, known, rejected)


def _ingest(spark: SparkSession, chosen: list[str], own: list[str], raw_root: str, run_id: str) -> int:
    staged = f"{raw_root}/{STAGED}{run_id}"
    try:
        _stage(spark, chosen, staged)
        _publish(spark, own, staged, raw_root)
        # counted from what was stored, by partition: no file is parsed again
        stored = _count(spark, raw_root, own)
        rejects = _count(spark, f"{raw_root}/{REJECTS}", own)
        by_day = {str(row["day"]): row["path"] for row in _dated(spark, chosen).collect()}
        entries = [{"day": d, "path": by_day[d], "n_rows": stored.get(d, 0), "n_rejected": rejects.get(d, 0)} for d in own]
        manifest.note(spark, raw_root, run_id, manifest.DONE, entries)
    except BaseException:
        manifest.note(spark, raw_root, run_id, manifest.RELEASED, [{"day": d} for d in own])
        raise
    finally:
        storage_files.remove(spark, staged)
    return sum(rejects.values())


def _dated(spark: SparkSession, chosen: list[str]) -> DataFrame:
    return spark.createDataFrame([(path,) for path in chosen], "path string").withColumn("day", days.day_of(F.col("path")))


def _stage(spark: SparkSession, chosen: list[str], staged: str) -> None:
    """One write of all files' rows: a partition column says which have a time, so each file is read and parsed once."""
    dated = with_months(_read(spark, chosen).withColumn(FILE_DAY, days.day_of(F.col(ping_source.PATH)))).drop("YearMonth")
    kind = F.when(F.col("BaseDateTime").isNotNull(), F.lit(TIMED)).otherwise(F.lit(UNTIMED)).alias(KIND)
    dated.select(*PING.names, kind, *RAW_PARTITIONS).write.partitionBy(KIND, *RAW_PARTITIONS).parquet(staged)


def _publish(spark: SparkSession, own: list[str], staged: str, raw_root: str) -> None:
    """Moves the staged folders to their places. Whatever else these days have there is of a broken-off attempt."""
    storage_files.make_folder(spark, f"{raw_root}/{REJECTS}")
    for day in own:
        for old in storage_files.matching(spark, f"{raw_root}/year=*/month=*/{FILE_DAY}={day}"):
            storage_files.remove(spark, old)
        storage_files.remove(spark, f"{raw_root}/{REJECTS}/{FILE_DAY}={day}")
    for folder in storage_files.matching(spark, f"{staged}/{KIND}={TIMED}/year=*/month=*/{FILE_DAY}=*"):
        storage_files.move(spark, folder, "/".join([raw_root, *folder.rsplit("/", 3)[1:]]))
    for folder in storage_files.matching(spark, f"{staged}/{KIND}={UNTIMED}/*/*/{FILE_DAY}=*"):
        storage_files.move(spark, folder, f"{raw_root}/{REJECTS}/{folder.rsplit('/', 1)[1]}")


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    zipped = [path for path in paths if path.lower().endswith(".zip")]
    plain = [path for path in paths if path not in set(zipped)]
    parts = [ping_source.read_zip(spark, zipped, with_path=True)] if zipped else []
    parts += [ping_source.read_csv(spark, plain, with_path=True)] if plain else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _count(spark: SparkSession, root: str, wanted: list[str]) -> dict[str, int]:
    """Rows stored for each day: footers of these partitions are read, no rows."""
    table = spark.read.schema(T.StructType([*PING.fields, T.StructField(FILE_DAY, T.DateType())])).parquet(root)
    dates = [F.lit(day).cast("date") for day in wanted]
    counts = table.where(F.col(FILE_DAY).isin(dates)).groupBy(FILE_DAY).agg(F.count(F.lit(1)).alias("n"))
    return {str(row[FILE_DAY]): row["n"] for row in counts.collect()}
