import os
from datetime import datetime

import pytest
from conftest import plan_of
from makers import pings, positions
from makers import ports as make_ports
from pyspark.sql import functions as F
from test_motion import track

from aisflow import schemas, storage
from aisflow.operators import audit, clean, profile, proximity
from aisflow.operators.profile import ProfileConflictError
from aisflow.plans import aggregate_year, clean_year
from aisflow.sinks.tables import write_days, write_months
from aisflow.sources import pings as ping_source


def raw_table(spark, tmp_path, *changes):
    root = str(tmp_path / "raw")
    raw = clean.with_months(pings(spark, *changes)).drop("YearMonth")
    write_days(raw.withColumn(schemas.FILE_DAY, F.to_date("BaseDateTime")), root)
    return root


def paths(tmp_path):
    return str(tmp_path / "profile"), str(tmp_path / "ais")


OLD = {"BaseDateTime": datetime(2023, 12, 31, 23, 59, 0), "VesselName": "OLD"}


def test_clean_year(spark, tmp_path):
    root = raw_table(spark, tmp_path, {}, {"COG": 360.0, "VesselName": None}, {"MMSI": "12"}, OLD)
    profile_root, ais_root = paths(tmp_path)
    clean_year.run(spark, root, profile_root, ais_root, 2024)
    (row,) = spark.read.parquet(profile_root).collect()
    assert row["VesselName"] == "ONE" and row.__fields__ == schemas.IDENTITY_COLUMNS
    ais = ping_source.read_parquet(spark, ais_root, None)
    assert ais.columns == [*schemas.KINEMATIC_COLUMNS, "YearMonth", "year", "month"]
    assert sorted(r["COG"] or 0 for r in ais.collect()) == [0, 2.0]
    clean_year.run(spark, root, profile_root, ais_root, 2023)
    assert ping_source.read_parquet(spark, ais_root, None).count() == 3


def test_strict_cleaning_writes_nothing_on_conflict(spark, tmp_path):
    root = raw_table(spark, tmp_path, {}, {"IMO": "IMO2"})
    profile_root, ais_root = paths(tmp_path)
    with pytest.raises(ProfileConflictError):
        clean_year.run(spark, root, profile_root, ais_root, 2024)
    assert not (tmp_path / "profile").exists() and not (tmp_path / "ais").exists()
    clean_year.run(
        spark, root, profile_root, ais_root, 2024, strict=False, conflicts_root=str(tmp_path / "conflicts")
    )
    assert spark.read.parquet(str(tmp_path / "conflicts")).first()["c_IMO"] == 2
    assert spark.read.parquet(profile_root).count() == 1


def test_profiles_of_invalid_reports_can_be_kept(spark, tmp_path):
    root = raw_table(spark, tmp_path, {}, {"MMSI": "12"})
    profile_root, ais_root = paths(tmp_path)
    clean_year.run(spark, root, profile_root, ais_root, 2024, scope="pings")
    assert spark.read.parquet(profile_root).count() == 2
    assert spark.read.parquet(ais_root).count() == 1


@pytest.mark.parametrize("carry_over, first", [(False, None), (True, 2.0)])
def test_aggregate_year(spark, tmp_path, carry_over, first):
    times = [datetime(2023, 12, 31, 23, 59), datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 2)]
    ais = str(tmp_path / "ais")
    write_months(clean.with_months(pings(spark, *[{"BaseDateTime": t} for t in times])), ais)
    out = str(tmp_path / "agg")
    ports = make_ports(spark, [("P1", 30.0, -90.0), ("P2", 50.0, 0.0)])
    aggregate_year.run(spark, ais, ports, out, 2024, carry_over=carry_over)
    found = spark.read.parquet(out).orderBy("BaseDateTime").collect()
    assert [r["MinSincePrevPing"] for r in found] == [first, 1.0]
    assert {r["NearPort"] for r in found} == {"P1"} and {r["YearMonth"] for r in found} == {"2024-01"}
    assert found[0].__fields__ == [*aggregate_year.OUTPUT_COLUMNS, "YearMonth", "year", "month"]


@pytest.fixture
def busy(spark):
    """Many pings of one ship, with copies and equal times, around a few ports."""
    rows = [(m, s, 30 + lat / 800, -90 + lon / 800) for m, s, lat, lon in track(11, 6, 400)]
    rows += [(m, None, 30.0, -90.0) for m in ("1", "2", None)] + [(None, 5, 30.0, -90.0)] * 2
    ports = make_ports(spark, [("A", 30.0, -90.0), ("B", 30.05, -90.05), ("C", 29.95, -89.96)])
    return positions(spark, rows), ports


@pytest.mark.parametrize(
    "options",
    [
        {"hot_rows": 60, "slice_rows": 25},
        {"hot_rows": 0, "slice_rows": 10},
        {"broadcast_cells": 0},
        {"broadcast_cells": 0, "hot_rows": 60, "slice_rows": 25},
    ],
)
def test_every_path_gives_the_same_analysis(spark, busy, rows_of, options):
    pings, ports = busy
    usual = aggregate_year.time_analysis(pings, ports)
    assert usual.columns == aggregate_year.OUTPUT_COLUMNS
    assert usual.where("NearPort IS NULL").count() > 20 and usual.where("NearPort IS NOT NULL").count() > 20
    assert rows_of(aggregate_year.time_analysis(pings, ports, **options)) == rows_of(usual)


def test_without_ship_or_time_there_is_no_port(busy):
    pings, ports = busy
    for options in ({}, {"broadcast_cells": 0}, {"hot_rows": 0, "slice_rows": 10}):
        found = aggregate_year.time_analysis(pings, ports, **options)
        assert found.where("MMSI IS NULL OR BaseDateTime IS NULL").where("NearPort IS NOT NULL").isEmpty()


def test_jobs_leave_no_intermediate_tables(spark, tmp_path, busy):
    pings, ports = busy
    write_months(clean.with_months(pings.where("BaseDateTime IS NOT NULL")), str(tmp_path / "ais"))
    folder = storage.shared_folder(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    aggregate_year.run(spark, str(tmp_path / "ais"), ports, str(tmp_path / "out"), 2024, hot_rows=20, slice_rows=10)
    assert spark.read.parquet(str(tmp_path / "out")).count() == pings.where("BaseDateTime IS NOT NULL").count()
    assert set(os.listdir(folder)) == before


def test_port_tagging_reads_and_shuffles_pings_once(busy):
    pings, ports = busy
    plan = plan_of(proximity.pings_with_port(pings, ports))
    assert plan.count("Exchange hashpartitioning(MMSI") == 1 and "SortMergeJoin" not in plan
    joined = plan_of(proximity.pings_with_port_by_join(pings, ports))
    assert "SortMergeJoin" in joined


def test_the_gate_writes_all_conflicts_before_it_stops(spark, tmp_path):
    changes = [{"MMSI": f"{k:09d}", "IMO": f"IMO{n}"} for k in range(30) for n in range(2)]
    root = raw_table(spark, tmp_path, *changes)
    profile_root, ais_root = paths(tmp_path)
    with pytest.raises(ProfileConflictError):
        clean_year.run(spark, root, profile_root, ais_root, 2024, conflicts_root=str(tmp_path / "conflicts"))
    assert spark.read.parquet(str(tmp_path / "conflicts")).count() == 30
    assert not (tmp_path / "profile").exists() and not (tmp_path / "ais").exists()


def test_maximum_is_looked_for_in_stored_rows(spark):
    rows = spark.range(100).selectExpr("id % 7 AS v", "id")
    found = audit.rows_at_maximum(rows, "v")
    assert {r["v"] for r in found.collect()} == {6} and "Window" not in plan_of(found)
    assert not [t for t in spark.catalog.listTables() if t.name == "pings_to_scan"]


def test_the_maximum_of_a_stored_table_is_looked_up_by_statistics(spark, tmp_path, rows_of, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id", "cast(id % 10 AS double) AS v", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS t").write.parquet(path)
    stored = spark.read.parquet(path)
    monkeypatch.setattr(audit, "written", None)
    found = audit.rows_at_maximum(stored, "v", stored=True)
    assert "EqualTo(v,9.0)" in plan_of(found) and found.count() == 100
    assert [r["id"] for r in audit.rows_at_maximum(stored, "t", stored=True).collect()] == [999]
    assert audit.rows_at_maximum(stored.limit(0), "v", stored=True).isEmpty()


def test_conflicts_are_counted_for_conflicting_ships_only(spark):
    identities = clean.clean_identity(pings(spark, {}, {"IMO": "IMO2"}, {"MMSI": "338000009"}))
    plan = plan_of(profile.conflicts(identities))
    assert plan.index("Expand") < plan.index("LeftSemi")
    assert [r["MMSI"] for r in profile.conflicts(identities).collect()] == ["338000001"]


def test_one_shuffle_of_pings(busy):
    pings, ports = busy
    plan = plan_of(aggregate_year.time_analysis(pings, ports))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2 and sum("(MMSI" in line for line in shuffles) == 1
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan


def test_a_number_never_breaks_the_ship_lookup(spark):
    raw = pings(spark, {"MMSI": "12AB"}, {"MMSI": "338000001"})
    assert audit.of_mmsi(raw, 338000001).count() == 1


def test_like_without_wildcards_is_equality(spark):
    raw = pings(spark, {"VesselName": "@"}, {"VesselName": "A@"}, {"VesselName": "@@"})
    assert audit.name_like(raw, "@").count() == 1 and audit.name_like(raw, "%@").count() == 3


def test_pings_per_port_sorts_busiest_first(spark):
    frame = spark.createDataFrame([("B",), ("A",), (None,), (None,), (None,), ("A",), ("B",)], "UNLOCODE string")
    assert [tuple(r) for r in audit.pings_per_port(frame).collect()] == [(None, 3), ("A", 2), ("B", 2)]


def test_hot_ships_take_one_port_lookup_and_one_cut(busy, monkeypatch):
    """Two ports look-ups in all, of ordinary and of hot rows, and no join of hot rows by instant."""
    pings, ports = busy
    looked, labels = [], []
    lookup, keep = proximity._own_port, aggregate_year.motion.written
    monkeypatch.setattr(proximity, "_own_port", lambda *a: looked.append(a) or lookup(*a))
    monkeypatch.setattr(aggregate_year.motion, "written", lambda frame, label: labels.append(label) or keep(frame, label))
    found = aggregate_year.time_analysis(pings, ports, hot_rows=20, slice_rows=10)
    assert found.count() == pings.count()
    assert len(looked) == 2 and labels == ["slices"]
    hot = plan_of(found).split("Union", 1)[1]
    joins = [line for line in hot.splitlines() if "Join" in line]
    assert not any("BaseDateTime" in line for line in joins)


@pytest.mark.parametrize("broadcast_cells", [proximity.BROADCAST_CELLS, 0])
def test_tasks_of_hot_ships_go_by_rows_not_by_slices(spark, monkeypatch, broadcast_cells):
    """Whichever way ports are found, neither the cut nor the further copies have a task for each slice of seven rows."""
    rows = track(3, 4, 400, hot_share=0.7)
    tables, keep = [], aggregate_year.motion.written
    monkeypatch.setattr(aggregate_year.motion, "written", lambda frame, label: tables.append(keep(frame, label)) or tables[-1])
    ports = make_ports(spark, [("A", 30.0, -90.0)])
    found = aggregate_year.time_analysis(positions(spark, rows), ports, hot_rows=2, slice_rows=7, broadcast_cells=broadcast_cells)
    assert found.count() == len(rows)
    assert len(tables) == 1 and len(tables[0].inputFiles()) <= 2
    chunks = [line for line in plan_of(found).splitlines() if "REPARTITION_BY_NUM" in line and "_chunk" in line]
    assert chunks and all(", 2), REPARTITION_BY_NUM" in line for line in chunks)


@pytest.mark.parametrize("slice_rows", [1, 3, 1000])
def test_an_instant_over_many_slices_shares_its_nearest_port(spark, rows_of, slice_rows):
    """All rows of a hot ship at one instant, or at two; one of them alone is near a port."""
    rows = [("000000001", 5, 10.0 + k, 10.0) for k in range(40)] + [("000000001", 5, 30.0, -90.0)] * 3
    rows += [("000000001", 6, 10.0 + k, 10.0) for k in range(20)] + [("000000001", 6, 30.03, -90.0)] + [(None, 6, 30.0, -90.0)] * 4
    ports = make_ports(spark, [("A", 30.0, -90.0), ("B", 30.03, -90.0)])
    found = aggregate_year.time_analysis(positions(spark, rows), ports, hot_rows=2, slice_rows=slice_rows)
    plain = aggregate_year.time_analysis(positions(spark, rows), ports)
    assert rows_of(found) == rows_of(plain)
    assert {r["NearPort"] for r in found.where("MMSI IS NOT NULL").collect()} == {"A", "B"}
