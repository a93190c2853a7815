"""Decoding of "not available" codes and negative speeds and courses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of the position report standard and of the published files.
NULL_TEXT = "NULL"
NO_IMO = "IMO0000000"
NO_HEADING = 511
NO_COURSE = 360
NO_SPEED = 102.3
COURSE_WRAP = 409.6
SPEED_WRAP = 102.4
TYPE_UNKNOWN = 0
STATUS_UNDEFINED = 15
CARGO_UNKNOWN = "0"
NO_PORT = "None"


def without(column: Column, *codes) -> Column:
    """Null where the column holds one of the codes."""
    for code in codes:
        column = F.nullif(column, F.lit(code))
    return column


def course(cog: Column) -> Column:
    """Negative courses wrap by 409.6; a reported 360 means none. The first rule that fits wins."""
    return (
        F.when(cog < 0, cog + COURSE_WRAP).when(cog == NO_COURSE, None).otherwise(cog).cast("float")
    )


def speed(sog: Column) -> Column:
    """Negative speeds wrap by 102.4; a reported 102.3 means none.

    The column is a float, so the code is compared as a float too: as doubles
    the two would never be equal.
    """
    no_speed = F.lit(NO_SPEED).cast("float")
    return F.when(sog < 0, sog + SPEED_WRAP).when(sog == no_speed, None).otherwise(sog).cast("float")
