"""Validity filter, identity/kinematics split, decoding and defaults."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisflow.functions import decode
from aisflow.schemas import IDENTITY_COLUMNS, KINEMATIC_COLUMNS

MMSI_LENGTH = 9


def is_valid() -> Column:
    """Ranges are spelled as comparisons, so they reach the Parquet row-group statistics."""
    return (
        F.col("LAT").between(-90.0, 90.0)
        & F.col("LON").between(-180.0, 180.0)
        & (F.length("MMSI") == MMSI_LENGTH)
    )


def valid_pings(pings: DataFrame) -> DataFrame:
    return pings.where(is_valid())


def identity_rows(pings: DataFrame) -> DataFrame:
    """Distinct identity rows.

    Grouping by all columns is a hash aggregate with a map-side stage: what is
    shuffled is one row per spelling of an identity and input split, not pings.
    """
    return pings.select(*IDENTITY_COLUMNS).distinct()


def kinematic_rows(pings: DataFrame) -> DataFrame:
    return pings.select(*KINEMATIC_COLUMNS)


def split(pings: DataFrame, scope: str = "all") -> tuple[DataFrame, DataFrame]:
    """(identities, kinematics). With scope="pings" invalid reports still name their ship."""
    if scope not in ("all", "pings"):
        raise ValueError(f"scope must be 'all' or 'pings', not {scope!r}")
    valid = valid_pings(pings)
    return identity_rows(valid if scope == "all" else pings), kinematic_rows(valid)


def decode_identity(identities: DataFrame) -> DataFrame:
    return identities.withColumns(
        {
            "IMO": decode.without(F.col("IMO"), decode.NULL_TEXT, decode.NO_IMO),
            "CallSign": decode.without(F.col("CallSign"), decode.NULL_TEXT),
            "Length": decode.without(F.col("Length"), 0),
            "Width": decode.without(F.col("Width"), 0),
        }
    )


def decode_motion(kinematics: DataFrame) -> DataFrame:
    rules = {
        "COG": decode.course,
        "SOG": decode.speed,
        "Heading": lambda c: decode.without(c, decode.NO_HEADING),
        "Draft": lambda c: decode.without(c, 0),
    }
    return kinematics.withColumns({name: rule(F.col(name)) for name, rule in rules.items()})


def default_identity(identities: DataFrame) -> DataFrame:
    return identities.fillna({"VesselType": decode.TYPE_UNKNOWN})


def default_motion(kinematics: DataFrame) -> DataFrame:
    return kinematics.fillna({"Status": decode.STATUS_UNDEFINED, "Cargo": decode.CARGO_UNKNOWN})


def default_port(pings: DataFrame, column: str = "UNLOCODE") -> DataFrame:
    return pings.fillna({column: decode.NO_PORT})


def clean_identity(pings: DataFrame) -> DataFrame:
    """Valid pings -> decoded identity rows."""
    return default_identity(decode_identity(identity_rows(pings)))


def clean_motion(pings: DataFrame) -> DataFrame:
    """Valid pings -> decoded kinematics. No shuffle: filter and projection only."""
    return default_motion(decode_motion(kinematic_rows(pings)))


def with_months(pings: DataFrame) -> DataFrame:
    """Month label and the integer partition columns of the stored tables."""
    return pings.withColumns(
        {
            "YearMonth": F.date_format("BaseDateTime", "yyyy-MM"),
            "year": F.year("BaseDateTime"),
            "month": F.month("BaseDateTime"),
        }
    )
