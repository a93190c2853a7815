"""Yearly cleaning: raw pings -> one profile per ship, and decoded kinematics by month."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aisflow import schemas
from aisflow.operators import clean, profile_state
from aisflow.sinks import tables
from aisflow.sources import pings as ping_source


def run(
    spark: SparkSession,
    raw_root: str,
    profile_root: str,
    pings_root: str,
    year: int,
    strict: bool = True,
    scope: str = "all",
    conflicts_root: str | None = None,
    state_root: str | None = None,
) -> None:
    """All conflicts are written to ``conflicts_root``, if given. ``strict`` then stops before
    any other write when a ship has two identities; otherwise the merge goes on.

    With ``state_root`` the profiles are those of all years in that store, to which
    this year's values are added; a year that is cleaned again replaces its own.
    Conflicts are then looked for across the years as well.
    """
    raw = ping_source.raw_year(spark, raw_root, year)
    valid = clean.valid_pings(raw)
    own = profile_state.facts(clean.clean_identity(valid if scope == "all" else raw)).persist()
    state = own
    if state_root:
        others = profile_state.read(spark, state_root).where(F.col(profile_state.PERIOD) != str(year))
        state = profile_state.merged(own, others)
    summary = profile_state.summarise(state).persist()
    try:
        if strict:
            profile_state.require_single_profiles(summary, conflicts_root)
        elif conflicts_root:
            profile_state.conflicts(state).write.mode("overwrite").parquet(conflicts_root)
        if state_root:
            # the summary may read the store, so it is computed before the store changes
            summary.count()
            profile_state.write(own, state_root, str(year))
        tables.write_profile(summary.select(*schemas.IDENTITY_COLUMNS), profile_root)
        tables.write_months(clean.with_months(clean.clean_motion(valid)), pings_root)
    finally:
        summary.unpersist()
        own.unpersist()
