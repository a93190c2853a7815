"""The driver's contract without the add-on, and intermediate folders of jobs in several threads."""

import os
import subprocess
import sys
import threading

from conftest import ROOT

from aisflow import storage

WITHOUT = """
import sys, warnings
warnings.simplefilter("ignore")
sys.modules["{absent}"] = None
import __spark_entry__ as contract
found, sql = contract.queries(), contract.oracle_sql()
assert "time_analysis" in found and "time_analysis" in sql
assert not [name for name in {{*found, *sql}} if name.startswith("op") or name == "pipeline"]
print(len(found))
"""


def count_without(absent):
    out = subprocess.run([sys.executable, "-c", WITHOUT.format(absent=absent)], cwd=ROOT, capture_output=True, text=True, check=True, env=os.environ)
    return int(out.stdout)


def test_core_queries_stay_without_the_add_on_or_one_of_its_libraries():
    from aisflow.plans import queries

    assert count_without("tiktoken") == count_without("aisflow.llm") == len(queries.REGISTERED)


def test_a_job_of_one_thread_is_not_seen_by_another(spark):
    inside, beside = threading.Event(), threading.Event()
    paths = {}

    def work():
        with storage.job(spark) as folder:
            paths["job"] = folder
            paths["inside"] = storage.scratch_path(spark, "x")
            storage.written(spark.range(3), "rows")
            inside.set()
            beside.wait(60)

    thread = threading.Thread(target=work)
    thread.start()
    assert inside.wait(60)
    held = storage.written(spark.range(5), "rows")
    paths["beside"] = storage.scratch_path(spark, "x")
    beside.set()
    thread.join()
    assert paths["inside"].startswith(paths["job"]) and not paths["beside"].startswith(paths["job"])
    assert not os.path.exists(paths["job"]) and held.count() == 5
    with storage.job(spark) as outer:
        with storage.job(spark) as inner:
            assert inner.startswith(outer) and storage.scratch_path(spark, "x").startswith(inner)
        assert storage.scratch_path(spark, "x").startswith(outer)
