"""Profiles as a mergeable state: every distinct value that a ship has reported, by field.

The state of some days or of a year is a small table (MMSI, field, value). States
of several periods merge by a distinct, in any order and as often as one likes;
profiles, conflicts and the numbers of values come out of one aggregation of the
merged rows. A period that is read again replaces its own part, so no ping is
ever read for another period's sake. Rows are keyed by ship, field and value,
hence a shared MMSI with very many spellings stays spread out.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisflow import schemas
from aisflow.functions import decode
from aisflow.operators.profile import SHOWN_CONFLICTS, SINGLE_VALUED, ProfileConflictError

FIELDS = [name for name in schemas.IDENTITY_COLUMNS if name != "MMSI"]
PERIOD = "period"
STATE_SCHEMA = f"MMSI string, field string, value string, {PERIOD} string"

#: Every ship has a row of this field, with a null value if need be.
_PRESENT = "VesselName"


def _text(name: str) -> Column:
    """The value as text, from which it is cast back without loss; one zero for both signs."""
    numeric = schemas.PING[name].dataType.typeName() == "float"
    return (F.col(name) + F.lit(0).cast("float") if numeric else F.col(name)).cast("string")


def facts(identities: DataFrame) -> DataFrame:
    """MMSI, field, value of distinct identity rows; each only once."""
    each = F.array(*[F.struct(F.lit(name).alias("field"), _text(name).alias("value")) for name in FIELDS])
    rows = identities.select("MMSI", F.explode(each).alias("f")).select("MMSI", "f.*")
    return rows.where(F.col("value").isNotNull() | (F.col("field") == _PRESENT)).distinct()


def merged(*states: DataFrame) -> DataFrame:
    rows = states[0].select("MMSI", "field", "value")
    for other in states[1:]:
        rows = rows.unionByName(other.select("MMSI", "field", "value"))
    return rows.distinct()


def _value(name: str) -> Column:
    """The value of one field, typed; null in rows of other fields."""
    return F.when(F.col("field") == name, F.col("value").cast(schemas.PING[name].dataType))


def _counted(name: str) -> Column:
    """What counts as a value of a field that has one value at most."""
    value = _value(name)
    return F.when(value != decode.TYPE_UNKNOWN, value) if name == "VesselType" else value


_COUNTS = {f"c_{name}": name for name in [*SINGLE_VALUED, "VesselType"]}


def summarise(state: DataFrame) -> DataFrame:
    """The merged profile of each ship, the number of values of each single-valued field and whether any has two."""
    ships = {name: F.max(_value(name)) for name in FIELDS} | {"VesselName": F.min(_value("VesselName"))}
    counts = {alias: F.count(_counted(name)) for alias, name in _COUNTS.items()}
    found = state.groupBy("MMSI").agg(*[c.alias(n) for n, c in (ships | counts).items()])
    return found.withColumn("conflict", F.greatest(*_COUNTS) > 1)


def merge(state: DataFrame) -> DataFrame:
    return summarise(state).select(*schemas.IDENTITY_COLUMNS)


def conflicts(state: DataFrame) -> DataFrame:
    """MMSIs with several values in a single-valued field, and how many in each."""
    return summarise(state).where("conflict").select("MMSI", *_COUNTS)


def require_single_profiles(summary: DataFrame, conflicts_root: str | None = None) -> None:
    """Fail when the summary holds a conflict. All of them are written to ``conflicts_root``,
    if given, before; the message names a few."""
    found = summary.where("conflict").select("MMSI", *_COUNTS)
    if found.isEmpty():
        return
    if conflicts_root:
        found.write.mode("overwrite").parquet(conflicts_root)
    lines = "\n".join(str(row.asDict()) for row in found.orderBy("MMSI").limit(SHOWN_CONFLICTS).collect())
    raise ProfileConflictError(f"MMSI with more than one profile, the first ones:\n{lines}")


def write(state: DataFrame, root: str, period: str) -> None:
    """Replaces what the store at ``root`` holds of a period (a year, a day), and nothing else."""
    part = state.select("MMSI", "field", "value", F.lit(period).alias(PERIOD)).hint("rebalance")
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(root)


def read(spark: SparkSession, root: str) -> DataFrame:
    """STATE_SCHEMA of all periods; empty before the first."""
    try:
        return spark.read.schema(STATE_SCHEMA).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE_SCHEMA)
