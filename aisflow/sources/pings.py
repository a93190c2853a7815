"""Position reports: Parquet tables, CSV day files and zipped CSV day files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisflow import schemas
from aisflow.sources import archives

# The day files have a header, no quoting, and must parse in full.
CSV_FORMAT = {"quote": "", "mode": "FAILFAST"}

# Lines that the zip reader hands to Spark at a time.
LINES_PER_BATCH = 50_000


# Name of the column with a row's file, where it is asked for.
PATH = "_path"


def read_csv(spark: SparkSession, paths: str | list[str], with_path: bool = False) -> DataFrame:
    """Day files as typed rows. Columns go by position; a value of the wrong type fails the read."""
    rows = spark.read.schema(schemas.PING).options(header=True, **CSV_FORMAT).csv(paths)
    return rows.select("*", F.col("_metadata.file_path").alias(PATH)) if with_path else rows


def read_archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Zip files as rows (path, content); each must be smaller than 2 GB."""
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def first_member_lines(whole: DataFrame) -> DataFrame:
    """(path, line): text lines, without the header, of the first member of each archive.

    Reads every archive as a stream, out of the memory that Arrow has it in. Archives are spread
    over tasks; only the unpacking happens in Python, parsing stays with Spark.
    """
    lines_per_batch = LINES_PER_BATCH

    def unpack(batches):
        import io
        import itertools
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    with archive.open(archive.namelist()[0]) as member:
                        text = io.TextIOWrapper(member, encoding="ascii")
                        next(text, None)
                        while lines := [line.rstrip("\n") for line in itertools.islice(text, lines_per_batch)]:
                            paths = pa.array([path.as_py()] * len(lines), pa.string())
                            yield pa.RecordBatch.from_arrays([paths, pa.array(lines, pa.string())], ["path", "line"])

    return whole.select("path", "content").mapInArrow(unpack, "path string, line string")


def parse_lines(lines: DataFrame, with_path: bool = False) -> DataFrame:
    parsed = F.from_csv("line", schemas.PING.toDDL(), CSV_FORMAT)
    path = [F.col("path").alias(PATH)] if with_path else []
    return lines.where("line <> ''").select(parsed.alias("ping"), *path).select("ping.*", *[PATH] * with_path)


def read_zip(spark: SparkSession, paths: str | list[str], with_path: bool = False) -> DataFrame:
    """Archives as typed rows. Those on a file system that tasks can open are streamed, whatever
    their size; others, by paths that Spark alone can read, are taken in whole and must be smaller than 2 GB."""
    found = [row["path"] for row in spark.read.format("binaryFile").load(paths).select("path").collect()]
    if found and all(archives.can_stream(path) for path in found):
        return parse_lines(archives.read_lines(spark, sorted(found), LINES_PER_BATCH), with_path)
    return parse_lines(first_member_lines(read_archives(spark, paths)), with_path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = schemas.PING) -> DataFrame:
    """A file or a table root, with a declared schema, or with the files' own when None."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def year_of(table: DataFrame, year: int) -> DataFrame:
    """Prunes the table to the directories of one year and keeps the partition columns."""
    return table.where(F.col("year") == year)


def raw_year(spark: SparkSession, root: str, year: int) -> DataFrame:
    return year_of(read_parquet(spark, root), year).select(*schemas.PING.names)


def positions(spark: SparkSession, root: str, year: int) -> DataFrame:
    """The four columns that the yearly aggregation needs."""
    return year_of(read_parquet(spark, root, schemas.POSITION), year).select(*schemas.POSITION_COLUMNS)


def preview(pings: DataFrame, rows: int = 20) -> DataFrame:
    """Some rows, from as few files as hold them."""
    return pings.limit(rows)
