"""Yearly aggregation: nearest port and gap to the previous ping, for every ping."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aisflow.functions import geo
from aisflow.operators import clean, motion, proximity
from aisflow.operators.hotkeys import HOT_ROWS, split_hot
from aisflow.schemas import POSITION_COLUMNS
from aisflow.sinks import tables
from aisflow.sources import pings as ping_source
from aisflow.storage import job, written

OUTPUT_COLUMNS = ["MMSI", "BaseDateTime", "NearPort", "MeterSincePrevPing", "MinSincePrevPing"]


def time_analysis(
    pings: DataFrame,
    ports: DataFrame,
    radius_m: float = proximity.DEFAULT_RADIUS_M,
    legacy_sign: bool = False,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = motion.SLICE_ROWS,
    broadcast_cells: int = proximity.BROADCAST_CELLS,
) -> DataFrame:
    """MMSI, BaseDateTime, NearPort, MeterSincePrevPing, MinSincePrevPing.

    With a broadcastable port list all pings go through a single shuffle, by
    ship: the port lookup happens on the map side, and both windows use the
    same partitioning and sort. Without ship or time a ping has no port,
    whichever way it takes.
    """
    positions = pings.select(*POSITION_COLUMNS)
    parts = split_hot(positions, motion.KEY, hot_rows)
    own = proximity.own_port(parts.cold, ports, radius_m, broadcast_cells=broadcast_cells)
    if own is None:
        # the ships were counted before the join, which then runs once for each part; instants are counted for hot ships alone
        def tagged(some: DataFrame, key_rows: int | None = None) -> DataFrame:
            found = proximity.pings_with_port_by_join(some, ports, radius_m, broadcast_cells=broadcast_cells, key_rows=key_rows)
            return found.withColumnRenamed("UNLOCODE", "NearPort")

        result = _named(motion.link_cold(tagged(parts.cold), motion.PREVIOUS), legacy_sign)
        if parts.hot is None:
            return result
        folded = written(motion.fold(tagged(parts.hot, min(slice_rows, proximity.KEY_ROWS))), "folded")
        hot = motion.link_hot(folded, motion.PREVIOUS, parts.hot_rows, slice_rows=slice_rows)
    else:
        linked = motion.link_cold(own, motion.PREVIOUS)
        result = _named(proximity.shared_port(linked, "NearPort"), legacy_sign)
        if parts.hot is None:
            return result

        def looked_up(rows: DataFrame) -> DataFrame:
            return proximity.own_port(rows, ports, radius_m, broadcast_cells=broadcast_cells)

        hot = _scan_slices(written(motion.fold(parts.hot), "folded"), parts.hot_rows, slice_rows, looked_up)
    return result.unionByName(_named(hot, legacy_sign))


def _scan_slices(folded: DataFrame, total_rows: int, slice_rows: int, looked_up: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hot ships linked and with their ports: a segmented scan over slices.

    Ports are looked up once, while the cut is written. A slice shares them among
    its rows of an instant by itself. What lies in another slice can only concern
    the instants at its two ends, so those are summarised, one row per ship and
    slice, merged by instant, and handed back.
    """
    columns = [*POSITION_COLUMNS, "NearPort"]
    cut = motion.cut_hot(folded, total_rows, slice_rows, looked_up)
    at_instant = Window.partitionBy(motion.KEY, "_slice", "BaseDateTime")
    linked = motion.link_cut(cut, POSITION_COLUMNS, motion.PREVIOUS, beside={"_best": F.min("port").over(at_instant)})
    ends = _best_at_ends(cut)
    joined = linked.join(ends, [motion.KEY, "_slice"], "left")
    best = F.when(F.col("BaseDateTime") == F.col("_first"), F.col("_best_first"))
    best = best.when(F.col("BaseDateTime") == F.col("_last"), F.col("_best_last")).otherwise(F.col("_best"))
    known = F.col("MMSI").isNotNull() & F.col("BaseDateTime").isNotNull()
    named = joined.withColumn("NearPort", F.when(known, best["UNLOCODE"]))
    return motion.lay_out(named, cut, columns, motion.PREVIOUS, motion.hot_tasks(total_rows, slice_rows), slice_rows)


def _best_at_ends(cut: DataFrame) -> DataFrame:
    """MMSI, _slice, the first and last instant of each slice, and the nearest port that the ship has at each, in any slice."""
    since = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2000-01-01 00:00:00', BaseDateTime)")
    none = F.col("port").isNull().alias("none")
    ends = cut.where("MMSI IS NOT NULL AND BaseDateTime IS NOT NULL").groupBy("MMSI", "_slice").agg(
        F.min(F.struct(since.alias("at"), none, "BaseDateTime", "port")).alias("_a"),
        F.min(F.struct((-since).alias("at"), none, "BaseDateTime", "port")).alias("_b"),
    )
    ends = written(ends, "ends")
    both = ends.select("MMSI", "_a.BaseDateTime", "_a.port").unionByName(ends.select("MMSI", "_b.BaseDateTime", "_b.port"))
    merged = both.groupBy("MMSI", "BaseDateTime").agg(F.min("port").alias("_best"))
    found = ends.select("MMSI", "_slice", F.col("_a.BaseDateTime").alias("_first"), F.col("_b.BaseDateTime").alias("_last"))
    for end in ("_first", "_last"):
        one = merged.withColumnsRenamed({"BaseDateTime": end, "_best": f"_best{end}"})
        found = found.join(one, ["MMSI", end])
    return found


def legs_with_port(
    pings: DataFrame,
    ports: DataFrame,
    radius_m: float = 35_000.0,
    globe: geo.Globe = geo.SPHERE,
    inclusive: bool = True,
    **limits,
) -> DataFrame:
    """``motion.next_leg`` and, as ``UNLOCODE``, the nearest port by another metric and radius ("None" without one)."""
    positions = pings.select(*POSITION_COLUMNS)
    own = proximity.own_port(positions, ports, radius_m, globe, inclusive)
    if own is None:
        tagged = proximity.pings_with_port_by_join(positions, ports, radius_m, globe, inclusive)
        return clean.default_port(motion.next_leg(tagged, **limits))
    return clean.default_port(proximity.shared_port(motion.next_leg(own, **limits)))


def _named(linked: DataFrame, legacy_sign: bool) -> DataFrame:
    return motion.with_gaps(linked, legacy_sign=legacy_sign).select(*OUTPUT_COLUMNS)


def run(
    spark: SparkSession,
    pings_root: str,
    ports: DataFrame,
    out_root: str,
    year: int,
    carry_over: bool = False,
    **options,
) -> None:
    """Aggregates one year of cleaned pings into ``out_root``.

    With ``carry_over`` the first ping of the year is measured against the last
    one of the year before; otherwise its gap is null. A year holds timed rows
    only: ingest keeps those without a time among its rejects.
    """
    with job(spark):
        positions = ping_source.positions(spark, pings_root, year)
        if carry_over:
            before = ping_source.positions(spark, pings_root, year - 1)
            positions = positions.unionByName(motion.last_pings(before))
        result = clean.with_months(time_analysis(positions, ports, **options)).where(F.col("year") == year)
        tables.write_months(result, out_root, balance=True)
