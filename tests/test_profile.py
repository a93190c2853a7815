import pytest
from makers import pings

from aisflow import schemas
from aisflow.operators import clean, profile


def identities(spark, *changes):
    return clean.clean_identity(pings(spark, *changes))


def test_merge_prefers_values_over_null(spark):
    merged = profile.merge(
        identities(
            spark,
            {"IMO": None, "CallSign": "NULL", "VesselType": None, "Length": 0.0},
            {"VesselName": None, "IMO": "IMO1", "CallSign": "C", "VesselType": 52, "Width": 0.0},
            {"VesselName": "ANOTHER", "IMO": "IMO0000000", "CallSign": None},
        )
    )
    assert merged.columns == schemas.IDENTITY_COLUMNS
    assert [tuple(row) for row in merged.collect()] == [("338000001", "ANOTHER", "IMO1", "C", 52, 10.0, 4.0)]


def test_merge_gives_one_row_per_mmsi(spark):
    rows = identities(spark, *[{"MMSI": f"33800000{i % 4}", "VesselName": f"N{i}"} for i in range(20)])
    merged = profile.merge(rows)
    assert merged.count() == merged.select("MMSI").distinct().count() == 4


@pytest.mark.parametrize(
    "change, column",
    [
        ({"IMO": "IMO2"}, "c_IMO"),
        ({"CallSign": "C2"}, "c_CallSign"),
        ({"Width": 5.0}, "c_Width"),
        ({"Length": 11.0}, "c_Length"),
        ({"VesselType": 31}, "c_VesselType"),
    ],
)
def test_two_values_conflict(spark, change, column):
    rows = identities(spark, {}, change, {"MMSI": "338000002"})
    (found,) = profile.conflicts(rows).collect()
    counts = found.asDict()
    assert counts.pop("MMSI") == "338000001" and counts.pop(column) == 2
    assert set(counts.values()) == {1}
    summary = profile.summarise(rows)
    assert [row["MMSI"] for row in summary.where("conflict").collect()] == ["338000001"]
    with pytest.raises(profile.ProfileConflictError, match="338000001"):
        profile.require_single_profiles(summary, rows)


@pytest.mark.parametrize(
    "change",
    [
        {"IMO": "IMO0000000"},
        {"IMO": "NULL"},
        {"CallSign": None},
        {"Width": 0.0},
        {"VesselType": 0},
        {"VesselType": None},
        {"VesselName": "OTHER"},
    ],
)
def test_missing_values_and_names_do_not_conflict(spark, change):
    rows = identities(spark, {}, change)
    assert profile.conflicts(rows).isEmpty()
    profile.require_single_profiles(profile.summarise(rows), rows)


def test_both_conflict_tests_agree(spark, rows_of):
    changes = [
        {"MMSI": f"33800{i % 7:04d}", "IMO": [None, "A", "B"][i % 3 if i % 7 < 2 else 0], "Length": float(i % 7 // 3 * (i % 2 + 1))}
        for i in range(60)
    ]
    rows = identities(spark, *changes)
    flagged = profile.summarise(rows).where("conflict").select("MMSI")
    assert rows_of(flagged) == rows_of(profile.conflicts(rows).select("MMSI")) != []
