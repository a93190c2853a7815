"""Keys too large for one task.

A window over a key sorts the whole key in one task. A real ship sends a
bounded number of reports a year, but an MMSI that many transponders share can
hold a large part of all rows. Such keys are found first, by a count with a
map-side stage, and take a path of their own.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisflow.storage import written

# About ten years of one report a minute: no single ship gets here.
HOT_ROWS = 5_000_000

# Choices of plan, which no result depends on: up to this many hot keys they are listed in the plan (as Arrow, some 20 bytes each);
# beyond it they are written once, and broadcast up to the second number.
LISTED_KEYS = 100_000
BROADCAST_KEYS = 500_000


@dataclass(frozen=True)
class Parts:
    """Rows of ordinary keys, rows of hot keys (None when there are none), number of hot rows."""

    cold: DataFrame
    hot: DataFrame | None
    hot_rows: int


def split_hot(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS, listed_keys: int = LISTED_KEYS) -> Parts:
    sizes = rows.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows"))
    hot_keys = sizes.where(F.col("_rows") > hot_rows)
    listed = hot_keys.limit(listed_keys + 1).toArrow()
    if not listed.num_rows:
        return Parts(rows, None, 0)
    if listed.num_rows <= listed_keys:
        total = sum(listed.column("_rows").to_pylist())
        side = F.broadcast(rows.sparkSession.createDataFrame(listed, hot_keys.schema).select("_hot"))
    else:
        # written, as the count would run again for each of the two parts
        side = written(hot_keys, "hot_keys")
        total, keys = side.agg(F.sum("_rows"), F.count("*")).first()
        side = F.broadcast(side.select("_hot")) if keys <= BROADCAST_KEYS else side.select("_hot")
    same = rows[key].eqNullSafe(side["_hot"])
    return Parts(rows.join(side, same, "left_anti"), rows.join(side, same, "left_semi"), total)
