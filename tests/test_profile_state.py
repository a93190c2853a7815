"""Merged states against one pass over all identities."""

import random

from conftest import plan_of
from makers import pings

from aisflow import schemas
from aisflow.operators import clean, profile, profile_state
from aisflow.plans import clean_year


def changes(seed, n=200):
    draw = random.Random(seed)
    return [
        {
            "MMSI": draw.choice(["338000001", "338000002", "338000003", "338000004"]),
            "VesselName": draw.choice([None, "A", "B"]),
            "IMO": draw.choice([None, "IMO1", "NULL", "IMO0000000"] + ["IMO2"] * (k % 50 == 0)),
            "CallSign": draw.choice([None, "C"]),
            "VesselType": draw.choice([None, 0, 30, 31]),
            "Length": draw.choice([0.0, -0.0, 10.1, 9.0]),
            "Width": draw.choice([0.0, 3.3]),
        }
        for k in range(n)
    ] + [{"MMSI": "338000009", "VesselName": None, "IMO": None, "CallSign": None, "VesselType": None, "Length": None, "Width": None}]


def test_states_of_parts_equal_one_pass(spark, rows_of):
    whole = clean.clean_identity(pings(spark, *changes(1), *changes(2)))
    parts = [profile_state.facts(clean.clean_identity(pings(spark, *changes(s)))) for s in (1, 2, 1)]
    state = profile_state.merged(*parts)
    assert rows_of(profile_state.merge(state)) == rows_of(profile.merge(whole))
    assert rows_of(profile_state.conflicts(state)) == rows_of(profile.conflicts(whole)) != []
    assert profile_state.conflicts(state).columns == profile.conflicts(whole).columns
    assert rows_of(state) == rows_of(profile_state.facts(whole))


def test_one_scan_and_no_expand(spark):
    identities = clean.clean_identity(pings(spark, *changes(1, 20)))
    plan = plan_of(profile_state.conflicts(profile_state.facts(identities)))
    assert "Expand" not in plan and "Join" not in plan and plan.count("Scan") == 1


def test_a_missing_ship_is_a_ship(spark, rows_of):
    identities = clean.clean_identity(pings(spark, {"MMSI": None}, {"MMSI": None, "IMO": "IMO2"}))
    assert rows_of(profile_state.conflicts(profile_state.facts(identities))) == rows_of(profile.conflicts(identities)) != []


def test_a_period_replaces_its_own_part(spark, tmp_path, rows_of):
    root = str(tmp_path / "state")
    states = [profile_state.facts(clean.clean_identity(pings(spark, *changes(s)))) for s in (1, 2, 3)]
    assert profile_state.read(spark, root).isEmpty()
    for period, k in (("2023", 0), ("2024", 1), ("2024-01-05", 0), ("2024", 2)):
        profile_state.write(states[k], root, period)
    assert rows_of(profile_state.merged(profile_state.read(spark, root))) == rows_of(profile_state.merged(states[0], states[2]))


def test_yearly_runs_share_a_store(spark, tmp_path, rows_of):
    from datetime import datetime

    from test_plans import raw_table

    old = {"BaseDateTime": datetime(2023, 5, 1), "VesselName": "OLD"}
    root = raw_table(spark, tmp_path, {}, old, {**old, "MMSI": "338000002"}, {"MMSI": "338000003"})
    out = [str(tmp_path / n) for n in ("profile", "ais")]
    for year in (2023, 2024, 2023):
        clean_year.run(spark, root, *out, year, state_root=str(tmp_path / "state"))
    found = {r["MMSI"]: r["VesselName"] for r in spark.read.schema(schemas.PROFILE).parquet(out[0]).collect()}
    assert found == {"338000001": "OLD", "338000002": "OLD", "338000003": "ONE"}
