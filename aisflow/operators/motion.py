"""Each report next to the one before or after it, of the same ship."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisflow.functions import geo, geodesic
from aisflow.operators.hotkeys import HOT_ROWS, split_hot
from aisflow.storage import written

KEY = "MMSI"

# Equal times are ordered by position, so that results do not depend on the input order.
ORDER = ["BaseDateTime", "LAT", "LON"]

# Names of the neighbour's columns.
PREVIOUS = "_prev_"
NEXT = "_next_"

# How many equal rows a folded row stands for.
COPIES = "_copies"

# Rows per slice of a hot key.
SLICE_ROWS = 1_000_000

# A choice of plan, which no result depends on: rows of hot keys that a task sorts and cuts, where slices are smaller.
TASK_ROWS = 250_000

# A choice of plan, which no result depends on: rows that occur at most so often (and no more than a quarter of a chunk) are laid out where they are.
FEW_COPIES = 16

# Spark's numbers of rows are unique: those of a partition start at its multiple of this.
_PARTITION = 1 << 33


def _in_order(columns: list[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in columns]


def _total_order(columns: list[str]) -> list[str]:
    return ORDER + [c for c in columns if c != KEY and c not in ORDER]


def _beside(prefix: str) -> list[str]:
    return [prefix + column for column in ORDER]


def _lagged(window, prefix: str) -> dict[str, Column]:
    """One lag per column: a lag of a struct would put the struct into the shuffle a second time."""
    return {prefix + column: F.lag(column).over(window) for column in ORDER}


def link_cold(pings: DataFrame, prefix: str, reverse: bool = False) -> DataFrame:
    """Adds time and position of the previous (or next) row of the same ship, as
    columns named with ``prefix``. One shuffle by ship and one sort."""
    window = Window.partitionBy(KEY).orderBy(*_in_order(ORDER, reverse))
    return pings.withColumns(_lagged(window, prefix))


def fold(pings: DataFrame) -> DataFrame:
    """Equal rows as one, counted in ``_copies``. Folding starts before the shuffle,
    so that a pile of copies costs one row per task."""
    return pings.groupBy(*pings.columns).agg(F.count("*").alias(COPIES))


def cut_hot(
    folded: DataFrame,
    total_rows: int,
    slice_rows: int = SLICE_ROWS,
    lookup: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows of ``fold`` with ``_slice``: a range partitioning by ship, time and position deals
    each ship out evenly, wherever its rows lie in time, and each task cuts its rows, in that
    order, into slices of ``slice_rows``. Slices ascend, but may skip numbers; the number of tasks
    goes by the rows, however many slices that makes.

    The cut is written out: all that reads it must see the same one, even after
    an executor is lost. ``lookup`` adds columns to each row on the way.
    """
    order = _total_order([c for c in folded.columns if c != COPIES])
    ranged = folded.repartitionByRange(hot_tasks(total_rows, slice_rows), KEY, *order)
    numbered = ranged.sortWithinPartitions(KEY, *order).withColumn("_row", F.monotonically_increasing_id())
    within = F.pmod("_row", F.lit(_PARTITION))
    sliced = numbered.withColumn("_slice", F.col("_row") - within + F.floor(within / slice_rows)).drop("_row")
    return written(lookup(sliced) if lookup else sliced, "slices")


def hot_tasks(total_rows: int, slice_rows: int) -> int:
    """Tasks for rows of hot keys: a slice each, or as many small slices as make up TASK_ROWS."""
    return max(2, -(-total_rows // max(slice_rows, TASK_ROWS)))


def link_cut(cut: DataFrame, columns: list[str], prefix: str, reverse: bool = False, beside: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``cut``, linked as in ``link_cold``, with ``beside``, expressions over
    windows by ship and slice.

    Each slice gets the last row of the slice before it as an extra row, then a
    window per (ship, slice) links rows; the extra rows go again.
    """
    order = _total_order(columns)
    # One row per ship and slice from here on.
    edge = F.min if reverse else F.max
    by_slice = Window.partitionBy(KEY).orderBy("_slice")
    neighbour = F.lag("_slice").over(by_slice) if reverse else F.lead("_slice").over(by_slice)
    carried = (
        cut.groupBy(KEY, "_slice")
        .agg(edge(F.struct(*order)).alias("_edge"))
        .select(KEY, neighbour.alias("_slice"), "_edge.*", F.lit(0).cast("long").alias(COPIES))
        .where("_slice IS NOT NULL")
    )
    window = Window.partitionBy(KEY, "_slice").orderBy(*_in_order(order, reverse))
    linked = cut.unionByName(carried, allowMissingColumns=True).withColumns({**_lagged(window, prefix), **(beside or {})})
    return linked.where(F.col(COPIES) > 0)


def lay_out(firsts: DataFrame, cut: DataFrame, columns: list[str], prefix: str, tasks: int, chunk_rows: int = SLICE_ROWS) -> DataFrame:
    """The linked rows as often as they occur. All but the first copy follow an equal row.

    Few copies are laid out by the task that links the row, so that the links are found once;
    rows with more, if there are any, are linked again for theirs."""
    many = F.col(COPIES) > max(1, min(FEW_COPIES, chunk_rows // 4))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.when(many, F.lit(0)).otherwise(F.col(COPIES) - 1))).alias("_copy")
    neighbour = [F.when(F.col("_copy") > 0, F.col(c)).otherwise(F.col(prefix + c)).alias(prefix + c) for c in ORDER]
    few = firsts.select("*", copy).select(*columns, *neighbour)
    if cut.where(many).isEmpty():
        return few
    return few.unionByName(_further_copies(firsts.where(many), columns, prefix, tasks, chunk_rows))


def link_hot(
    folded: DataFrame,
    prefix: str,
    total_rows: int,
    reverse: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``link_cold`` for ships with more rows than one task should sort: ``fold``, ``cut_hot``, ``link_cut``, ``lay_out``."""
    columns = [c for c in folded.columns if c != COPIES]
    cut = cut_hot(folded, total_rows, slice_rows)
    firsts = link_cut(cut, columns, prefix, reverse)
    return lay_out(firsts, cut, columns, prefix, hot_tasks(total_rows, slice_rows), slice_rows)


def _further_copies(
    firsts: DataFrame, columns: list[str], prefix: str, tasks: int, chunk_rows: int
) -> DataFrame:
    """All copies but the first, laid out in chunks over many tasks."""
    last_chunk = F.floor((F.col(COPIES) - 2) / chunk_rows)
    chunks = (
        firsts.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
        .repartition(tasks, KEY, *ORDER, "_chunk")
    )
    in_chunk = F.least(F.lit(chunk_rows), F.col(COPIES) - 1 - F.col("_chunk") * chunk_rows)
    laid_out = chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), in_chunk)))
    return laid_out.select(*columns, *[F.col(c).alias(prefix + c) for c in ORDER])


def link(
    pings: DataFrame,
    prefix: str,
    reverse: bool = False,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``link_cold`` for ordinary ships, ``link_hot`` for the rest, if any."""
    parts = split_hot(pings, KEY, hot_rows)
    linked = link_cold(parts.cold, prefix, reverse)
    if parts.hot is None:
        return linked
    folded = written(fold(parts.hot), "folded")
    return linked.unionByName(link_hot(folded, prefix, parts.hot_rows, reverse, slice_rows))


def minutes_between(earlier: Column, later: Column, legacy_sign: bool = False) -> Column:
    """Whole seconds of both times, as minutes. ``legacy_sign`` counts backwards."""
    seconds = F.unix_timestamp(later) - F.unix_timestamp(earlier)
    return (-seconds if legacy_sign else seconds) / 60


def _placed(linked: DataFrame, prefix: str, globe: geo.Globe) -> tuple[DataFrame, geo.Place, geo.Place]:
    """Adds the places of both positions, so that their trigonometry is done once."""
    here = dict(zip(("_x", "_y", "_z"), globe.place(F.col("LON"), F.col("LAT"))))
    there = globe.place(F.col(f"{prefix}LON"), F.col(f"{prefix}LAT"))
    there = dict(zip(("_other_x", "_other_y", "_other_z"), there))
    return linked.withColumns({**here, **there}), tuple(map(F.col, there)), tuple(map(F.col, here))


def with_gaps(linked: DataFrame, prefix: str = PREVIOUS, legacy_sign: bool = False, exact: bool = False) -> DataFrame:
    """Metres and minutes since the previous ping; null for the first of a ship. ``exact`` metres are
    right between any two places; the others are off by up to a thousandth between nearly opposite ones."""
    kept = [c for c in linked.columns if c not in _beside(prefix)]
    minutes = minutes_between(F.col(f"{prefix}BaseDateTime"), F.col("BaseDateTime"), legacy_sign)
    if exact:
        there = F.col(f"{prefix}LON"), F.col(f"{prefix}LAT")
        measured = geodesic.with_metres(linked, "MeterSincePrevPing", *there, F.col("LON"), F.col("LAT"))
        return measured.select(*kept, "MeterSincePrevPing", minutes.alias("MinSincePrevPing"))
    placed, there, here = _placed(linked, prefix, geo.WGS84)
    return placed.select(
        *kept,
        geo.WGS84.metres(there, here).alias("MeterSincePrevPing"),
        minutes.alias("MinSincePrevPing"),
    )


def previous_gaps(pings: DataFrame, legacy_sign: bool = False, exact: bool = False, **limits) -> DataFrame:
    """Position rows with the gap to the previous one."""
    return with_gaps(link(pings, PREVIOUS, **limits), legacy_sign=legacy_sign, exact=exact)


def next_leg(pings: DataFrame, **limits) -> DataFrame:
    """Position rows with the next position and the haversine kilometres ``d`` to it."""
    placed, there, here = _placed(link(pings, NEXT, reverse=True, **limits), NEXT, geo.SPHERE)
    return placed.select(
        *pings.columns,
        F.col(f"{NEXT}LAT").alias("lead_LAT"),
        F.col(f"{NEXT}LON").alias("lead_LON"),
        F.col(f"{NEXT}BaseDateTime").alias("lead_time"),
        (geo.SPHERE.metres(here, there) / 1000).alias("d"),
    )


def last_pings(pings: DataFrame) -> DataFrame:
    """The last position row of each ship."""
    last = F.max(F.struct(*ORDER)).alias("_last")
    return pings.groupBy(KEY).agg(last).select(KEY, "_last.*")
