"""Gapless numbers within groups of any size."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisflow.storage import written

#: Rows that one task numbers at a time, about, and where the session's partitions allow fewer.
SLICE_ROWS = 200_000
LEAST_SLICE_ROWS = 5_000
#: Equal rows that one array of numbers stands for.
COPIES_AT_ONCE = 10_000


def gapless(frame: DataFrame, group: list[str], order: list[str | Column], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``slot``: 0, 1, ... within each group.

    A group may hold any share of the rows. Equal rows are counted as one
    before they are shuffled, so a pile of copies does not land in one task;
    they get consecutive numbers. The folded rows are cut into slices by ranges
    of group, ``order`` and the remaining columns, which break ties, numbered
    within group and slice, and shifted by the sizes of the slices before. So
    ``order`` holds throughout a group, and numbers depend neither on the run
    nor on where the slices are cut.

    The frame should be narrow: it is written to the shared folder once, and
    once more by slices where it is more than one. A slice has ``slice_rows``
    rows at most, or so few that the slices use the session's shuffle partitions.
    """
    names = frame.columns
    held = written(frame.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies")), "numbering")
    rows = held.agg(F.sum("_copies")).first()[0] or 0
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, -(-rows // slice_rows), min(partitions, rows // LEAST_SLICE_ROWS))
    if slices > 1:
        # the bounds come from a sample, so what they gave is written before it is read twice
        ranged = held.repartitionByRange(slices, *group, *order, *names)
        held = written(ranged.withColumn("_slice", F.spark_partition_id()), "numbering-slices")
    else:
        held = held.withColumn("_slice", F.lit(0))
    ordered = Window.partitionBy(*group, "_slice").orderBy(*order, *names)
    before = F.sum("_copies").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_copies")
    numbered = held.withColumn("_before", before)
    if slices > 1:
        sizes = held.groupBy(*group, "_slice").agg(F.sum("_copies").alias("_size"))
        running = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        offsets = sizes.select(*group, "_slice", (F.sum("_size").over(running) - F.col("_size")).alias("_offset"))
        same = numbered["_slice"] == offsets["_slice"]
        for name in group:
            same &= numbered[name].eqNullSafe(offsets[name])
        numbered = numbered.join(offsets, same).select(
            *[numbered[n] for n in names], "_copies", (F.col("_before") + F.col("_offset")).alias("_before")
        )
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES_AT_ONCE))
    chunked = numbered.select(*names, "_copies", "_before", F.explode(chunks).alias("_chunk"))
    first = F.col("_chunk") * COPIES_AT_ONCE
    last = F.least(first + COPIES_AT_ONCE, F.col("_copies")) - 1
    numbers = F.sequence(F.col("_before") + first, F.col("_before") + last)
    return chunked.select(*names, F.explode(numbers).alias("slot"))
