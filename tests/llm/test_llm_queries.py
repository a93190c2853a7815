"""Every registered query against its SQL, where it has one, and the plans of the native ones."""

import check_oracle
import pytest
from conftest import SMALL, plan_of

import __spark_entry__ as contract
from aisflow.llm import oracle, queries

NATIVE = ["op2_jump_shards", "op6_rule_ledger", "op7_secret_ledger", "op10_merkle_prints"]
WITHOUT_SQL = {"op5_subword_quality", "op8_byte_bpe", "op13_byte_positions"}


def test_registry():
    assert set(queries.REGISTERED) == set(oracle.SQL) | WITHOUT_SQL
    assert set(queries.REGISTERED) | {"pipeline"} <= set(contract.queries())
    assert {name.split("_")[0] for name in queries.REGISTERED} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", oracle.SQL)
def test_query_agrees_with_sql(spark, name):
    frame = queries.REGISTERED[name](spark, SMALL)
    plan = plan_of(frame)
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    if name in NATIVE:
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    theirs = check_oracle.connect(SMALL).execute(oracle.SQL[name]).df()
    assert check_oracle.difference(frame.toPandas(), theirs) is None


def test_byte_bpe_query(spark):
    """Against the library on whole texts."""
    import hashlib

    from aisflow.llm import bpe

    coder = bpe.encoding()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op8_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = coder.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
