"""Pings and ports derived from the general test tables.

``events`` stands in for pings and ``nation`` for ports. The expressions below
use integer arithmetic and text that mean the same in Spark SQL and in ANSI
SQL, so that the check queries can start from the same rows. ``e`` is the event
id, ``u`` the user id, ``t`` the time, and ``d`` tells apart several reports
made of one event: some are exact copies, some share ship and time only.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisflow import schemas

SOURCE = ["coalesce(event_id, 0) AS e", "coalesce(user_id, 0) AS u", "ts AS t"]

PLACE = ["LAT", "LON"]

COPIES = {0: "e % 50 = 0", 1: "e % 101 = 0"}

PING_EXPRESSIONS = {
    "MMSI": """CASE WHEN e % 499 = 0 THEN NULL
        WHEN e % 97 = 0 THEN substr(cast(338000000 + u AS varchar(12)), 1, 8)
        ELSE cast(338000000 + u AS varchar(12)) END""",
    "BaseDateTime": "CASE WHEN e % 307 = 0 THEN NULL ELSE t + INTERVAL '36' DAY * (e % 20) END",
    "LAT": """CASE WHEN e % 211 = 0 THEN 91e0 WHEN e % 223 = 0 THEN NULL
        ELSE 25e0 + cast(e % 25 AS double) * 0.9e0
             + cast((e * 7919 + d * 613) % 2001 - 1000 AS double) / 10000e0 END""",
    "LON": """CASE WHEN e % 227 = 0 THEN -181e0
        ELSE -124e0 + cast(e % 25 AS double) * 2.3e0
             + cast((e * 104729 + d * 419) % 2001 - 1000 AS double) / 10000e0 END""",
    "SOG": """cast(CASE WHEN e % 17 = 0 THEN 102.3e0
        ELSE cast((e * 37) % 1300 - 250 AS double) / 10e0 END AS float)""",
    "COG": """cast(CASE WHEN e % 13 = 0 THEN 360e0
        ELSE cast((e * 31) % 4600 - 1000 AS double) / 10e0 END AS float)""",
    "Heading": "cast(CASE WHEN e % 7 = 0 THEN 511 ELSE e % 360 END AS float)",
    "VesselName": """CASE WHEN u % 29 = 0 THEN '@' WHEN u % 31 = 0 THEN NULL WHEN e % 10 = 3 THEN NULL
        WHEN e % 10 = 4 THEN concat('MV ', cast(u AS varchar(12)))
        ELSE concat('VESSEL ', cast(u AS varchar(12))) END""",
    "IMO": """CASE WHEN (u + e) % 5 = 0 THEN 'IMO0000000' WHEN (u + e) % 5 = 1 THEN 'NULL'
        WHEN u % 37 = 0 AND e % 2 = 0 THEN concat('IMO', cast(8000000 + u AS varchar(12)))
        ELSE concat('IMO', cast(9000000 + u AS varchar(12))) END""",
    "CallSign": """CASE WHEN e % 6 = 0 THEN NULL WHEN e % 7 = 0 THEN 'NULL'
        WHEN u % 41 = 0 AND e % 3 = 1 THEN concat('X', cast(u AS varchar(12)))
        ELSE concat('CS', cast(u AS varchar(12))) END""",
    "VesselType": """cast(CASE WHEN e % 4 = 0 THEN NULL WHEN e % 8 = 1 THEN 0
        WHEN u % 43 = 0 AND e % 8 = 3 THEN 99 ELSE 30 + u % 60 END AS smallint)""",
    "Status": "cast(CASE WHEN e % 11 = 0 THEN NULL ELSE e % 9 END AS smallint)",
    "Length": """cast(CASE WHEN e % 5 = 0 THEN 0 WHEN u % 47 = 0 AND e % 2 = 0 THEN 400
        ELSE 10 + u % 300 END AS float)""",
    "Width": """cast(CASE WHEN e % 5 = 1 THEN 0 WHEN u % 53 = 0 AND e % 2 = 0 THEN 60
        ELSE 4 + u % 40 END AS float)""",
    "Draft": """cast(CASE WHEN e % 9 = 0 THEN 0e0 WHEN e % 10 = 0 THEN NULL
        ELSE cast(e % 120 AS double) / 10e0 END AS float)""",
    "Cargo": "CASE WHEN e % 12 = 0 THEN NULL ELSE cast(u % 100 AS varchar(12)) END",
    "TransceiverClass": "CASE WHEN u % 2 = 0 THEN 'A' ELSE 'B' END",
}

PORT_EXPRESSIONS = {
    "UNLOCODE": "concat(CASE WHEN d = 0 THEN 'P' ELSE 'Q' END, cast(n_nationkey AS varchar(8)))",
    "NAME": "n_name",
    "STATE": "cast(n_regionkey AS varchar(8))",
    "LAT": "25e0 + cast(n_nationkey AS double) * 0.9e0 + cast(d AS double) * 0.02e0",
    "LON": "-124e0 + cast(n_nationkey AS double) * 2.3e0",
}


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in expressions.items()]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw pings with all 17 columns.

    Positions come out of a generator as values, so that a filter on them
    further up is not rewritten in terms of the expressions above.
    """
    copies = f"CASE WHEN {COPIES[0]} THEN array(0, 1) WHEN {COPIES[1]} THEN array(0, 0) ELSE array(0) END"
    place = f"struct({', '.join(_named({c: PING_EXPRESSIONS[c] for c in PLACE}))})"
    events = table(spark, folder, "events").selectExpr(*SOURCE)
    copied = events.selectExpr("e", "u", "t", f"explode({copies}) AS d")
    placed = copied.selectExpr("e", "u", "t", f"inline(array({place}))")
    return placed.selectExpr(*_named({**PING_EXPRESSIONS, **{c: c for c in PLACE}}))


def ports(spark: SparkSession, folder: str) -> DataFrame:
    """Two ports per nation, 0.02 degrees apart."""
    nations = table(spark, folder, "nation").withColumn("d", F.explode(F.array(F.lit(0), F.lit(1))))
    return nations.selectExpr(*_named(PORT_EXPRESSIONS))


HARBOUR_EXPRESSIONS = {
    "UNLOCODE": "concat(UNLOCODE, '-', cast(k AS varchar(8)))",
    "NAME": "NAME",
    "STATE": "STATE",
    "LAT": "LAT + cast(k % 8 AS double) * 0.000171e0",
    "LON": "LON + cast((k - k % 8) / 8 AS double) * 0.000137e0",
}


def harbours(spark: SparkSession, folder: str) -> DataFrame:
    """Forty ports for each port, close together."""
    copies = ports(spark, folder).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(39))))
    return copies.selectExpr(*_named(HARBOUR_EXPRESSIONS))


def harbour_sql() -> str:
    return f"SELECT {', '.join(_named(HARBOUR_EXPRESSIONS))} FROM (SELECT *, unnest(range(40)) AS k FROM ({port_sql()}))"


def ping_sql() -> str:
    """The same pings as ANSI SQL."""
    copies = f"CASE WHEN {COPIES[0]} THEN [0, 1] WHEN {COPIES[1]} THEN [0, 0] ELSE [0] END"
    events = f"SELECT {', '.join(SOURCE)} FROM events"
    events = f"SELECT e, u, t, unnest({copies}) AS d FROM ({events})"
    return f"SELECT {', '.join(_named(PING_EXPRESSIONS))} FROM ({events})"


def port_sql() -> str:
    return f"SELECT {', '.join(_named(PORT_EXPRESSIONS))} FROM (SELECT *, unnest([0, 1]) AS d FROM nation)"


def csv_text(raw: DataFrame, *more: Column) -> DataFrame:
    """The pings' columns as the text of a day file, whose times are whole seconds, and further columns."""
    text = {"BaseDateTime": F.date_format("BaseDateTime", "yyyy-MM-dd'T'HH:mm:ss")}
    return raw.select(*[text.get(name, F.col(name).cast("string")).alias(name) for name in schemas.PING.names], *more)


def files_by_day(raw: DataFrame) -> DataFrame:
    """Raw pings with ``file_day``, one of eight days, whatever their own times are."""
    shift = F.pmod(F.xxhash64(*raw.columns), F.lit(8)).cast("int")
    return raw.withColumn("file_day", F.date_add(F.lit("2024-01-01").cast("date"), shift))


def write_day_files(raw: DataFrame, folder: str) -> None:
    """Pings as CSV day files AIS_YYYY_MM_DD.csv, one for each ``file_day``."""
    spark = raw.sparkSession
    lines = csv_text(raw, F.date_format("file_day", "yyyy_MM_dd").alias("name"))
    lines.repartition(8, "name").write.option("header", True).option("quote", "").partitionBy("name").csv(f"{folder}-parts")
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}-parts")
    system = files.getFileSystem(spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    system.mkdirs(path(folder))
    for day in system.globStatus(path(f"{folder}-parts/name=*/part-*")):
        label = day.getPath().getParent().getName().removeprefix("name=")
        system.rename(day.getPath(), path(f"{folder}/AIS_{label}.csv"))


def zip_archives(raw: DataFrame) -> DataFrame:
    """Pings as rows (path, content) of zipped CSV, one archive per Arrow batch."""
    header = ",".join(schemas.PING.names)

    def pack(batches):
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            body = "\n".join([header, *batch["line"].to_pylist()]) + "\n"
            content = io.BytesIO()
            with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("day.csv", body)
            yield pa.RecordBatch.from_arrays([pa.array(["day.zip"]), pa.array([content.getvalue()])], ["path", "content"])

    lines = csv_text(raw).na.fill("").select(F.concat_ws(",", *raw.columns).alias("line"))
    return lines.mapInArrow(pack, "path string, content binary")
