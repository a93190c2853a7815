"""A data source that streams the first member of zip archives, an archive a task.

The archive is opened on its file system and unpacked as it is read, so neither
its size nor the member's matters to a task's memory.
"""

import io
import itertools
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "first_member_lines"
SCHEMA = "path string, line string"


def can_stream(path: str) -> bool:
    """Whether tasks can open the path by themselves."""
    try:
        fs.FileSystem.from_uri(path)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return False


def member_lines(path: str, lines_per_batch: int) -> Iterator[list[str]]:
    """The lines of an archive's first member but for the header, some at a time."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as stream, zipfile.ZipFile(stream) as archive, archive.open(archive.namelist()[0]) as member:
        text = io.TextIOWrapper(member, encoding="ascii")
        next(text, None)
        while lines := list(itertools.islice(text, lines_per_batch)):
            yield [line.rstrip("\n") for line in lines]


class FirstMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "MemberReader":
        return MemberReader(json.loads(self.options["paths"]), int(self.options["lines"]))


class MemberReader(DataSourceReader):
    def __init__(self, paths: list[str], lines: int) -> None:
        self.paths, self.lines = paths, lines

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(path) for path in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for lines in member_lines(partition.value, self.lines):
            yield pa.RecordBatch.from_arrays([pa.array([partition.value] * len(lines)), pa.array(lines)], ["path", "line"])


def read_lines(spark: SparkSession, paths: list[str], lines_per_batch: int) -> DataFrame:
    """(path, line) of archives that ``can_stream`` accepts."""
    spark.dataSource.register(FirstMembers)
    return spark.read.format(NAME).options(paths=json.dumps(paths), lines=str(lines_per_batch)).load()
