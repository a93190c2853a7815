import random

import pytest
from conftest import plan_of
from makers import START, positions, vincenty_m
from pyspark.sql import functions as F

from aisflow.operators import hotkeys, motion


def track(seed, ships, n, hot_share=0.4, same_second=0.1, copies=0.2):
    """Random rows; ship 0 holds a large share of them, some at one instant and some as copies."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        ship = 0 if r.random() < hot_share else r.randrange(1, ships)
        second = 1000 if r.random() < same_second else r.randrange(100_000)
        rows.append((f"{ship:09d}", second, round(r.uniform(-80, 80), 2), round(r.uniform(-60, 60), 2)))
    rows += [rows[r.randrange(len(rows) // 10)] for _ in range(int(n * copies))]
    rows += [(None, i, 1.0, 2.0 + i) for i in range(3)]
    r.shuffle(rows)
    return rows


def expected_gaps(rows):
    out = []
    last = {}
    for mmsi, second, lat, lon in sorted(rows, key=lambda row: (str(row[0]), *row[1:])):
        metres = minutes = None
        if mmsi in last:
            s, la, lo = last[mmsi]
            metres, minutes = vincenty_m(lo, la, lon, lat), (second - s) / 60
        last[mmsi] = (second, lat, lon)
        out.append((mmsi, second, lat, lon, metres, minutes))
    return out


def found_gaps(frame):
    start = F.to_timestamp_ntz(F.lit(START.isoformat()))
    seconds = (F.unix_timestamp("BaseDateTime") - F.unix_timestamp(start)).alias("s")
    found = frame.select("MMSI", seconds, "LAT", "LON", "MeterSincePrevPing", "MinSincePrevPing").collect()
    return [tuple(row) for row in found]


def in_order(rows):
    return sorted(rows, key=lambda r: (str(r[0]), r[1], r[2], r[3], -1 if r[4] is None else r[4]))


def same_gaps(found, expected):
    found, expected = in_order(found), in_order(expected)
    assert len(found) == len(expected)
    for left, right in zip(found, expected):
        assert left[:4] == right[:4]
        assert left[5] == right[5]
        assert (left[4] is None) == (right[4] is None)
        if left[4] is not None:
            assert left[4] == pytest.approx(right[4], rel=1e-5, abs=1e-3)


@pytest.mark.parametrize("hot_rows, slice_rows", [(10**9, 10**6), (100, 40), (0, 7), (20, 1), (2, 10**6)])
def test_gaps_equal_a_plain_loop_whatever_counts_as_hot(spark, hot_rows, slice_rows):
    rows = track(hot_rows, 8, 500)
    gaps = motion.previous_gaps(positions(spark, rows), hot_rows=hot_rows, slice_rows=slice_rows)
    same_gaps(found_gaps(gaps), expected_gaps(rows))


def test_all_rows_equal(spark):
    rows = [("000000001", 5, 1.0, 2.0)] * 300
    gaps = motion.previous_gaps(positions(spark, rows), hot_rows=10, slice_rows=20)
    same_gaps(found_gaps(gaps), expected_gaps(rows))


def test_all_rows_at_one_instant(spark):
    rows = [("000000001", 5, i / 10, i / 7) for i in range(300)]
    gaps = motion.previous_gaps(positions(spark, rows), hot_rows=10, slice_rows=20)
    same_gaps(found_gaps(gaps), expected_gaps(rows))


def test_next_leg_mirrors_the_loop_for_hot_and_ordinary_ships(spark, rows_of):
    pings = positions(spark, track(9, 5, 300))
    plain = motion.next_leg(pings)
    assert rows_of(motion.next_leg(pings, hot_rows=20, slice_rows=15)) == rows_of(plain)
    assert plain.columns == ["MMSI", "BaseDateTime", "LAT", "LON", "lead_LAT", "lead_LON", "lead_time", "d"]
    ends = plain.where("lead_time IS NULL").select("MMSI").collect()
    assert len(ends) == pings.select("MMSI").distinct().count()
    assert plain.where("lead_time < BaseDateTime").isEmpty()


def test_slices_stay_small(spark, monkeypatch):
    """The cut of the hot path has about as many slices, each as small, as asked for."""
    pings = positions(spark, track(2, 3, 2000, hot_share=0.9, same_second=0.9, copies=0.0))
    tables = []
    keep = motion.written
    monkeypatch.setattr(motion, "written", lambda frame, label: tables.append(keep(frame, label)) or tables[-1])
    linked = motion.link_hot(motion.fold(pings), "_prev_", 2000, slice_rows=100)
    assert linked.count() == pings.count()
    sizes = [row["count"] for row in tables[0].groupBy("_slice").count().collect()]
    assert len(sizes) > 15 and max(sizes) <= 300
    plan = plan_of(linked)
    assert "hashpartitioning(MMSI" in plan and "_slice" in plan


def test_tasks_of_the_hot_path_go_by_rows_not_by_slices(spark, monkeypatch):
    """Many small slices share a task, in the cut and where copies are laid out, and are still as small as asked for."""
    pings = positions(spark, track(5, 3, 1500, hot_share=0.9))
    tables = []
    keep = motion.written
    monkeypatch.setattr(motion, "written", lambda frame, label: tables.append(keep(frame, label)) or tables[-1])
    total = pings.count()
    linked = motion.link_hot(motion.fold(pings), "_prev_", total, slice_rows=20)
    assert linked.count() == total
    assert len(tables[0].inputFiles()) <= 2
    sizes = [row["count"] for row in tables[0].groupBy("_slice").count().collect()]
    assert len(sizes) >= tables[0].count() / 20 and max(sizes) <= 20
    assert f", {-(-total // 20)})" not in plan_of(linked)


def test_next_legs_over_many_slices_of_a_task(spark, rows_of, monkeypatch):
    pings = positions(spark, track(8, 3, 200, hot_share=0.9))
    tables, keep = [], motion.written
    monkeypatch.setattr(motion, "written", lambda frame, label: tables.append(keep(frame, label)) or tables[-1])
    found = rows_of(motion.next_leg(pings, hot_rows=20, slice_rows=7))
    folded, cut = tables
    assert len(cut.inputFiles()) <= 2 < cut.select("_slice").distinct().count()
    assert found == rows_of(motion.next_leg(pings))


def test_few_copies_are_laid_out_without_linking_twice(spark, rows_of):
    pings = positions(spark, track(11, 3, 300, hot_share=0.9))
    assert pings.groupBy(*pings.columns).count().agg(F.max("count")).first()[0] > 1
    found = motion.next_leg(pings, hot_rows=20, slice_rows=100)
    # one link of cold rows, one of hot ones, and one for the order of slices
    assert plan_of(found).count("Window [") == 3
    assert rows_of(found) == rows_of(motion.next_leg(pings))


@pytest.mark.parametrize("copies", [2, 12, 13, 17, 130])
def test_copies_on_both_sides_of_the_bound(spark, rows_of, copies):
    pings = positions(spark, [("000000001", 5, 1.0, 2.0)] * copies + [("000000001", s, 3.0, 4.0) for s in range(30)])
    for slice_rows in (7, 50, 1000):
        assert rows_of(motion.next_leg(pings, hot_rows=10, slice_rows=slice_rows)) == rows_of(motion.next_leg(pings))


def test_slices_ascend_in_the_order_of_a_ship(spark):
    cut = motion.cut_hot(motion.fold(positions(spark, track(6, 4, 300))), 360, slice_rows=10)
    ends = cut.groupBy("MMSI", "_slice").agg(F.min(F.struct(*motion.ORDER)), F.max(F.struct(*motion.ORDER)))
    rows = sorted((tuple(row) for row in ends.collect()), key=lambda row: (str(row[0]), row[1]))
    for (ship, _, _, last), (following, _, first, _) in zip(rows, rows[1:]):
        assert ship != following or last < first


def test_hot_tasks():
    assert motion.hot_tasks(10, 50) == 2
    assert motion.hot_tasks(6_000_000, 50) == 24
    assert motion.hot_tasks(20_000_000, 1_000_000) == 20


def test_legacy_sign_counts_backwards(spark):
    pings = positions(spark, [("1", 0, 1.0, 1.0), ("1", 90, 1.0, 1.0)])
    assert [r["MinSincePrevPing"] for r in motion.previous_gaps(pings).orderBy("BaseDateTime").collect()] == [None, 1.5]
    backwards = motion.previous_gaps(pings, legacy_sign=True).orderBy("BaseDateTime").collect()
    assert [r["MinSincePrevPing"] for r in backwards] == [None, -1.5]


def test_parts_of_seconds_are_cut_before_subtracting(spark):
    frame = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00.900' AS a, timestamp_ntz'2024-01-01 00:00:02.100' AS b"
    )
    assert frame.select(motion.minutes_between(F.col("a"), F.col("b"))).first()[0] == 2 / 60


def test_the_clock_change_adds_no_hour(spark):
    """START lies on the night when clocks change in the session's zone."""
    pings = positions(spark, [("1", 0, 1.0, 1.0), ("1", 4 * 3600, 1.0, 1.0)])
    assert motion.previous_gaps(pings).agg(F.max("MinSincePrevPing")).first()[0] == 240


def test_last_pings(spark):
    rows = track(4, 6, 200)
    last = {}
    for row in sorted(rows, key=lambda row: (str(row[0]), *row[1:])):
        last[row[0]] = row[2:]
    found = motion.last_pings(positions(spark, rows)).collect()
    assert {r["MMSI"]: (r["LAT"], r["LON"]) for r in found} == last


def test_ordinary_ships_take_one_shuffle_without_copied_columns(spark):
    plan = plan_of(motion.link_cold(positions(spark, track(1, 4, 50)), "_prev_"))
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "struct" not in plan.lower()


@pytest.mark.parametrize("listed", [0, 1, 100])
def test_split_hot_keeps_all_rows_apart(spark, listed):
    pings = positions(spark, track(7, 6, 400))
    parts = hotkeys.split_hot(pings, "MMSI", hot_rows=50, listed_keys=listed)
    hot = {r["MMSI"] for r in parts.hot.select("MMSI").distinct().collect()}
    cold = {r["MMSI"] for r in parts.cold.select("MMSI").distinct().collect()}
    assert hot and cold and not hot & cold and None in cold
    assert parts.hot.count() == parts.hot_rows
    assert parts.hot.count() + parts.cold.count() == pings.count()
    assert min(r["count"] for r in parts.hot.groupBy("MMSI").count().collect()) > 50


def test_many_hot_keys_are_counted_once_for_both_parts(spark):
    parts = hotkeys.split_hot(positions(spark, track(7, 6, 400)), "MMSI", hot_rows=50, listed_keys=0)
    for part in (parts.cold, parts.hot):
        assert "Aggregate" not in plan_of(part) and "BroadcastHashJoin" in plan_of(part)


def test_a_missing_key_can_be_hot(spark):
    pings = positions(spark, [(None, i, 1.0, 1.0) for i in range(30)] + [("1", 0, 1.0, 1.0)])
    parts = hotkeys.split_hot(pings, "MMSI", hot_rows=10)
    assert parts.hot.count() == 30 and parts.cold.count() == 1


def test_no_hot_key_leaves_the_frame_alone(spark):
    pings = positions(spark, [("1", 0, 1.0, 1.0)])
    parts = hotkeys.split_hot(pings, "MMSI", hot_rows=10)
    assert parts.hot is None and parts.cold is pings
