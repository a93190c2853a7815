"""One profile per MMSI, with conflict checks.

Input is always the distinct identity rows of ``clean.clean_identity``, so the
group-bys here run over ship spellings, not over pings. Each has a map-side
stage, so a shared MMSI with very many spellings stays spread out as well.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisflow.functions import decode
from aisflow.schemas import IDENTITY_COLUMNS

# A ship may leave these empty, but may not report two values.
SINGLE_VALUED = ["IMO", "CallSign", "Width", "Length"]

# Of an error message only.
SHOWN_CONFLICTS = 20


class ProfileConflictError(ValueError):
    """Some MMSI reports more than one identity."""


def known_type():
    return F.when(F.col("VesselType") != decode.TYPE_UNKNOWN, F.col("VesselType"))


def summarise(identities: DataFrame) -> DataFrame:
    """Merged profile and conflict flag in one pass.

    A non-null value beats null. Two values differ exactly when the smallest
    and the largest do, which spares a distinct count per column.
    """
    names = [name for name in IDENTITY_COLUMNS if name != "MMSI"]
    merged = {name: F.max(name) for name in names}
    merged["VesselName"] = F.min("VesselName")
    differs = [F.min(name) != F.max(name) for name in SINGLE_VALUED]
    differs.append(F.min(known_type()) != F.max(known_type()))
    conflict = differs[0]
    for other in differs[1:]:
        conflict = F.coalesce(conflict, F.lit(False)) | F.coalesce(other, F.lit(False))
    return identities.groupBy("MMSI").agg(
        *[column.alias(name) for name, column in merged.items()],
        conflict.alias("conflict"),
    )


def merge(identities: DataFrame) -> DataFrame:
    return summarise(identities).select(*IDENTITY_COLUMNS)


def conflicts(identities: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """MMSIs with several values in a single-valued column, and how many in each.

    Conflicting ships are found by their smallest and largest values, in one
    pass; distinct values are counted for these ships alone.
    """
    flagged = (summarise(identities) if summary is None else summary).where("conflict").select(F.col("MMSI").alias("_ship"))
    rows = identities.join(flagged, F.col("MMSI").eqNullSafe(F.col("_ship")), "left_semi")
    counts = {f"c_{name}": F.count_distinct(name) for name in SINGLE_VALUED}
    counts["c_VesselType"] = F.count_distinct(known_type())
    return rows.groupBy("MMSI").agg(*[c.alias(name) for name, c in counts.items()])


def require_single_profiles(summary: DataFrame, identities: DataFrame, conflicts_root: str | None = None) -> None:
    """Fail when the summary holds a conflict. All of them are written to ``conflicts_root``,
    if given, before; the message names a few."""
    if summary.where("conflict").isEmpty():
        return
    found = conflicts(identities, summary)
    if conflicts_root:
        found.write.mode("overwrite").parquet(conflicts_root)
    shown = found.orderBy("MMSI").limit(SHOWN_CONFLICTS).collect()
    lines = "\n".join(str(row.asDict()) for row in shown)
    raise ProfileConflictError(f"MMSI with more than one profile, the first ones:\n{lines}")
