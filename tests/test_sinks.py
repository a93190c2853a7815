import os
from datetime import datetime

import pytest
from makers import pings, positions

from aisflow import schemas, storage
from aisflow.operators import clean, profile
from aisflow.sinks import catalog, tables
from aisflow.sources import pings as ping_source

MONTH = 86_400 * 31


def stored(spark, path, rows_of):
    return rows_of(spark.read.parquet(path))


@pytest.mark.parametrize("balance", [False, True])
def test_only_touched_months_are_replaced(spark, tmp_path, rows_of, balance):
    path = str(tmp_path / "t")
    first = clean.with_months(positions(spark, [("1", 0, 1.0, 1.0), ("2", MONTH, 2.0, 2.0), ("3", 2 * MONTH, 3.0, 3.0)]))
    tables.write_months(first, path, balance)
    before = stored(spark, path, rows_of)
    tables.write_months(first, path, balance)
    assert stored(spark, path, rows_of) == before and len(before) == 3
    april = clean.with_months(positions(spark, [("9", MONTH, 9.0, 9.0), ("8", MONTH, 8.0, 8.0)]))
    tables.write_months(april, path, balance)
    assert {r[0] for r in stored(spark, path, rows_of)} == {"1", "9", "8", "3"}
    assert sorted(os.listdir(tmp_path / "t" / "year=2024"))[:3] == ["month=3", "month=4", "month=5"]


def test_balanced_months_have_few_files(spark, tmp_path):
    rows = positions(spark, [(str(i), (i % 3) * MONTH, 1.0, 1.0) for i in range(3000)]).repartition(16, "MMSI")
    tables.write_months(clean.with_months(rows), str(tmp_path / "t"), balance=True)
    for month in (3, 4, 5):
        files = [f for f in os.listdir(tmp_path / "t" / "year=2024" / f"month={month}") if f.endswith(".parquet")]
        assert len(files) == 1


def parquet_files(folder):
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def test_a_small_profile_is_one_file(spark, tmp_path):
    rows = clean.clean_identity(pings(spark, *[{"MMSI": f"{i:09d}"} for i in range(50)]).repartition(4))
    merged = profile.merge(rows)
    tables.write_profile(merged, str(tmp_path / "one"))
    assert len(parquet_files(tmp_path / "one")) == 1
    tables.write_profile_files(merged.repartition(3), str(tmp_path / "many"))
    assert len(parquet_files(tmp_path / "many")) == 3
    assert spark.read.parquet(str(tmp_path / "many")).count() == 50


def test_a_table_that_stays_the_same_is_never_gone(spark, tmp_path):
    for folder, code in (("a", "P1"), ("b", "P2")):
        rows = pings(spark, {"VesselName": code})
        tables.write_profile(profile.merge(clean.clean_identity(rows)), str(tmp_path / folder))
    spark.sql(f"CREATE DATABASE aisflow_moved LOCATION '{tmp_path}/db'")
    try:
        name = catalog.create_external(spark, catalog.PROFILE_TABLE, str(tmp_path / "a"), "aisflow_moved")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('mark' = 'kept')")
        catalog.create_external(spark, catalog.PROFILE_TABLE, str(tmp_path / "b"), "aisflow_moved")
        assert [r["VesselName"] for r in spark.table(name).collect()] == ["P2"]
        assert spark.sql(f"SHOW TBLPROPERTIES {name} ('mark')").first()["value"] == "kept"
    finally:
        spark.sql("DROP DATABASE aisflow_moved CASCADE")


def test_external_tables_and_views(spark, tmp_path):
    raw = pings(spark, {}, {"MMSI": "338000002", "SOG": 102.3})
    analysed = positions(spark, [("338000001", 0, 1.0, 1.0)]).selectExpr(
        "MMSI", "BaseDateTime", "'P1' AS NearPort", "1e0 AS MeterSincePrevPing", "2e0 AS MinSincePrevPing"
    )
    tables.write_profile(profile.merge(clean.clean_identity(raw)), str(tmp_path / "profile"))
    tables.write_months(clean.with_months(clean.clean_motion(raw)), str(tmp_path / "ais"))
    tables.write_months(clean.with_months(analysed), str(tmp_path / "agg"))
    spark.sql(f"CREATE DATABASE aisflow_test LOCATION '{tmp_path}/db'")
    try:
        for _ in range(2):
            catalog.create_external(spark, catalog.PROFILE_TABLE, str(tmp_path / "profile"), "aisflow_test")
            catalog.create_external(spark, catalog.PINGS_TABLE, str(tmp_path / "ais"), "aisflow_test")
            catalog.create_external(spark, catalog.ANALYSIS_TABLE, str(tmp_path / "agg"), "aisflow_test")
            for view in catalog.STAGING:
                catalog.create_staging_view(spark, view, "aisflow_test")
        ais = spark.table("aisflow_test.stg_ais")
        assert ais.columns[:3] == ["MMSI", "PingTime", "LAT"] and ais.columns[-1] == "Class"
        assert {r["MMSI"]: r["SOG"] for r in ais.collect()} == {"338000001": 1.0, "338000002": None}
        assert spark.table("aisflow_test.stg_profile").columns == ["MMSI", "Name", "IMO", "CallSign", "Type", "Length", "Width"]
        (row,) = spark.table("aisflow_test.stg_aggregate").collect()
        assert tuple(row)[2:] == ("P1", 1.0, 2.0) and row.__fields__[-1] == "MinuteSincePrevPing"
        parts = spark.sql("SHOW PARTITIONS aisflow_test.vessel_ais").collect()
        assert [r[0] for r in parts] == ["year=2024/month=3"]
        staged = catalog.staged(clean.clean_motion(raw), "stg_ais")
        assert staged.columns == ais.columns and staged.exceptAll(ais).isEmpty()
        spark.sql("DROP TABLE aisflow_test.vessel_ais")
        assert spark.read.parquet(str(tmp_path / "ais")).count() == 2
    finally:
        spark.sql("DROP DATABASE aisflow_test CASCADE")


class Session:
    """Just enough of a session for the choice of a folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": lambda self, key, default: folder or default})()


def test_intermediate_tables_go_to_the_named_folder():
    assert storage.scratch_path(Session("yarn", "hdfs://c/shared/"), "x").startswith("hdfs://c/shared/x-")
    assert storage.shared_folder(Session("local[2]", "/named")) == "/named"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session("local-cluster[2,1,1024]"))
    assert os.path.isdir(storage.shared_folder(Session("local[2]")))


def test_a_job_removes_what_it_wrote_on_the_way(spark):
    with pytest.raises(KeyError):
        with storage.job(spark) as folder:
            assert storage.written(spark.range(3), "x").count() == 3
            assert os.path.isdir(folder)
            raise KeyError
    assert not os.path.exists(folder)


def test_months_are_swapped_as_a_whole(spark, tmp_path, rows_of):
    """Between write and swap readers see the old months; a reader from before keeps them."""
    from aisflow.sinks import versions

    root = str(tmp_path / "ais")
    old = clean.with_months(pings(spark, {"Cargo": "old"}, {"Cargo": "old", "BaseDateTime": datetime(2024, 5, 1)}).select(*schemas.KINEMATIC_COLUMNS))
    tables.write_months(old, root)
    spark.sql(f"CREATE DATABASE swapped LOCATION '{tmp_path}/db'")
    try:
        table = catalog.create_external(spark, catalog.PINGS_TABLE, root, "swapped")
        cargo = spark.table(table).select("Cargo", "month")
        assert sorted(map(tuple, cargo.collect())) == [("old", 3), ("old", 5)]
        march = clean.with_months(pings(spark, {"Cargo": "new"}, {"Cargo": "new"}, {"Cargo": "new", "BaseDateTime": datetime(2024, 6, 1)}).select(*schemas.KINEMATIC_COLUMNS))
        version = versions.write(march, root)
        assert version.months == [(2024, 3), (2024, 6)]
        spark.catalog.refreshTable(table)
        assert sorted(map(tuple, spark.table(table).select("Cargo", "month").collect())) == [("old", 3), ("old", 5)]
        versions.swap(spark, table, version)
        now = [("new", 3), ("new", 3), ("new", 6), ("old", 5)]
        assert sorted(map(tuple, spark.table(table).select("Cargo", "month").collect())) == now
        assert ping_source.read_parquet(spark, root, None).count() == 2
        catalog.create_external(spark, catalog.PINGS_TABLE, root, "swapped")
        assert sorted(map(tuple, spark.table(table).select("Cargo", "month").collect())) == now
        second = versions.replace_months(march.where("month = 3").limit(1), table, root)
        assert versions.remove_unused(spark, table, root) == []
        versions.replace_months(march, table, root)
        assert [p.rsplit("/", 1)[1] for p in versions.remove_unused(spark, table, root)] == sorted(
            p.rsplit("/", 1)[1] for p in (version.path, second.path)
        )
        assert sorted(map(tuple, spark.table(table).select("Cargo", "month").collect())) == now
    finally:
        spark.sql("DROP DATABASE swapped CASCADE")
