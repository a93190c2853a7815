import struct

import pytest
from conftest import plan_of
from makers import pings
from pyspark.sql import functions as F

from aisflow import schemas
from aisflow.operators import clean


def single(value):
    """The value as a 4-byte float."""
    return struct.unpack("f", struct.pack("f", value))[0]


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({"MMSI": "12345678"}, False),
        ({"MMSI": "1234567890"}, False),
        ({"MMSI": None}, False),
        ({"LAT": 90.0}, True),
        ({"LAT": -90.0}, True),
        ({"LAT": 90.0001}, False),
        ({"LAT": None}, False),
        ({"LAT": float("nan")}, False),
        ({"LON": 180.0}, True),
        ({"LON": -180.0001}, False),
        ({"LON": None}, False),
    ],
)
def test_valid_pings(spark, change, kept):
    assert clean.valid_pings(pings(spark, change)).count() == int(kept)


def test_ranges_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    pings(spark, {}).write.parquet(path)
    plan = plan_of(clean.valid_pings(spark.read.schema(schemas.PING).parquet(path)))
    assert "LessThanOrEqual(LAT,90.0)" in plan and "GreaterThanOrEqual(LON,-180.0)" in plan


def test_split_scope(spark):
    raw = pings(spark, {}, {}, {"MMSI": "1", "VesselName": "SHORT"})
    identities, kinematics = clean.split(raw)
    assert identities.columns == schemas.IDENTITY_COLUMNS and identities.count() == 1
    assert kinematics.columns == schemas.KINEMATIC_COLUMNS and kinematics.count() == 2
    identities, kinematics = clean.split(raw, scope="pings")
    assert identities.count() == 2 and kinematics.count() == 2
    with pytest.raises(ValueError):
        clean.split(raw, scope="ships")


@pytest.mark.parametrize(
    "column, given, expected",
    [
        ("SOG", 102.3, None),
        ("SOG", -0.1, single(single(-0.1) + 102.4)),
        ("SOG", -25.0, single(77.4)),
        ("SOG", 102.2, single(102.2)),
        ("SOG", 0.0, 0.0),
        ("SOG", None, None),
        ("COG", 360.0, None),
        ("COG", -49.6, 360.0),
        ("COG", -100.0, single(309.6)),
        ("COG", 102.3, single(102.3)),
        ("COG", None, None),
        ("Heading", 511.0, None),
        ("Heading", 0.0, 0.0),
        ("Draft", 0.0, None),
        ("Draft", 5.5, 5.5),
        ("Status", None, 15),
        ("Status", 0, 0),
        ("Cargo", None, "0"),
        ("Cargo", "70", "70"),
    ],
)
def test_motion_codes(spark, column, given, expected):
    cleaned = clean.clean_motion(pings(spark, {column: given}))
    assert cleaned.columns == schemas.KINEMATIC_COLUMNS
    assert cleaned.schema[column].dataType == schemas.PING[column].dataType
    assert cleaned.first()[column] == expected


def test_course_of_102_3_does_not_hide_the_speed(spark):
    assert clean.clean_motion(pings(spark, {"COG": 102.3, "SOG": 7.0})).first()["SOG"] == 7.0


@pytest.mark.parametrize(
    "column, given, expected",
    [
        ("IMO", "IMO0000000", None),
        ("IMO", "NULL", None),
        ("IMO", "IMO1", "IMO1"),
        ("CallSign", "NULL", None),
        ("CallSign", "null", "null"),
        ("Length", 0.0, None),
        ("Width", 0.0, None),
        ("Width", 3.0, 3.0),
        ("VesselType", None, 0),
        ("VesselType", 0, 0),
        ("VesselName", "NULL", "NULL"),
    ],
)
def test_identity_codes(spark, column, given, expected):
    cleaned = clean.clean_identity(pings(spark, {column: given}))
    assert cleaned.schema[column].dataType == schemas.PING[column].dataType
    assert cleaned.first()[column] == expected


def test_cleaning_twice_changes_nothing(spark, rows_of):
    once = clean.clean_motion(pings(spark, {"SOG": -5.0, "COG": 360.0}, {"Heading": 511.0, "Draft": 0.0}))
    assert rows_of(clean.clean_motion(once)) == rows_of(once)


def test_months_do_not_depend_on_the_session_zone(spark):
    from datetime import datetime

    row = clean.with_months(pings(spark, {"BaseDateTime": datetime(2024, 12, 31, 23, 59, 59)})).first()
    assert (row["YearMonth"], row["year"], row["month"]) == ("2024-12", 2024, 12)


def test_default_port(spark):
    frame = spark.createDataFrame([("P1",), (None,)], "UNLOCODE string")
    assert [row[0] for row in clean.default_port(frame).collect()] == ["P1", "None"]


def test_cleaning_motion_needs_no_shuffle(spark):
    assert "Exchange" not in plan_of(clean.clean_motion(clean.valid_pings(pings(spark, {}))))


def test_select_list_keeps_column_order(spark):
    raw = pings(spark, {}).select(*reversed(schemas.KINEMATIC_COLUMNS), F.lit(1).alias("extra"))
    assert clean.decode_motion(raw).columns == raw.columns
