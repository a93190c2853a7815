"""Which days a raw table has, as a versioned manifest.

Every version is a file of JSON lines that is made by one rename and never
changed. A run takes days by a version that claims them before it reads
anything; another run that wanted the same version finds it there, reads the
manifest again and leaves those days alone. A day is ingested once a later
version says so. A run that fails releases its claims; those of a run that died
lapse after a while.
"""

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisflow import storage_files as files

# The manifest lies within the raw table; readers of that skip names with an underscore.
FOLDER = "_manifest"
LEDGER_SCHEMA = "day date, path string, n_rows bigint, n_rejected bigint"
CLAIMED, DONE, RELEASED = "claimed", "done", "released"

#: Hours after which the claims of a run that has not ended count no more.
CLAIM_HOURS = 24.0


@dataclass(frozen=True)
class Manifest:
    """The last word on each day, and the number of versions."""

    version: int
    days: dict[str, dict]

    def taken(self, claim_hours: float = CLAIM_HOURS) -> set[str]:
        """Days that are ingested, or claimed by a run that may be under way."""
        since = time.time() - claim_hours * 3600
        return {day for day, e in self.days.items() if e["state"] == DONE or (e["state"] == CLAIMED and e["at"] > since)}


def load(spark: SparkSession, root: str) -> Manifest:
    versions = files.matching(spark, f"{root}/{FOLDER}/*.json")
    days: dict[str, dict] = {}
    for path in versions:
        for line in files.text_of(spark, path).splitlines():
            entry = json.loads(line)
            days[entry["day"]] = entry
    last = int(versions[-1].rsplit("/", 1)[1].removesuffix(".json")) if versions else 0
    return Manifest(last, days)


def _commit(spark: SparkSession, root: str, version: int, entries: list[dict]) -> bool:
    text = "".join(json.dumps(entry) + "\n" for entry in entries)
    return files.put_new(spark, f"{root}/{FOLDER}/{version:010d}.json", text)


def claim(spark: SparkSession, root: str, wanted: list[str], claim_hours: float = CLAIM_HOURS) -> tuple[str, list[str]]:
    """A run's id and the days, of those ``wanted``, that are now its own."""
    run = uuid.uuid4().hex
    while True:
        known = load(spark, root)
        own = sorted(set(wanted) - known.taken(claim_hours))
        entries = [{"day": day, "state": CLAIMED, "run": run, "at": time.time()} for day in own]
        if not own or _commit(spark, root, known.version + 1, entries):
            return run, own


def note(spark: SparkSession, root: str, run: str, state: str, entries: list[dict]) -> None:
    """Adds a version with ``entries``, each with its day, for days that still are the run's own."""
    while entries:
        known = load(spark, root)
        lost = [e["day"] for e in entries if known.days.get(e["day"], {}).get("run") != run]
        if lost:
            raise RuntimeError(f"the claims of these days lapsed and another run took them: {lost}")
        if _commit(spark, root, known.version + 1, [e | {"state": state, "run": run, "at": time.time()} for e in entries]):
            return


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per file that was ingested into the table at ``root``; empty before the first."""
    try:
        entries = spark.read.schema(LEDGER_SCHEMA + ", state string").json(f"{root}/{FOLDER}")
        return entries.where(F.col("state") == DONE).select("day", "path", "n_rows", "n_rejected")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)
