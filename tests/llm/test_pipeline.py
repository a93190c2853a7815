"""The pipeline's stages against plain versions of them."""

import corpus_pipeline
import pytest
from cases import clashing, documents, rows_of
from test_near_dups import brute as near_brute
from test_quality_rules import brute as rule_brute
from test_secret_scan import brute as secret_brute

from aisflow.llm import bpe, packing, quality_model

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that go into each stage, and the last one's."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return out


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near duplicates", "secret scan", "packing"]
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:-1])


def passes(text):
    n_words, chars, symbols, dup, repeat, lines, upper = rule_brute(text)
    few, repeated = n_words < 50, 100 * repeat > 50 * n_words
    return not (few or repeated or 10 * symbols > 3 * n_words or 2 * dup > lines or chars < 2 * n_words or chars > 15 * n_words or 2 * upper > chars)


def test_rules(stages):
    assert rows_of(stages[1]) == [r for r in rows_of(stages[0]) if passes(r[1])]
    assert 0 < stages[1].count() < stages[0].count()


def test_classifier(spark, stages):
    model = quality_model.train(stages[0].select("doc_id", "text"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality_model.classify(stages[1], model).where("predicted = 1").collect()}
    assert rows_of(stages[2]) == [r for r in rows_of(stages[1]) if r[0] in good]


def test_near_duplicates(stages):
    rows = rows_of(stages[2])
    kept = {d for d, _, _, k in near_brute([(r[0], r[1]) for r in rows], 5) if k}
    assert rows_of(stages[3]) == [r for r in rows if r[0] in kept]
    assert len(kept) < len(rows)


def test_secrets(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in (stages[3], stages[4]))
    assert set(before) == set(after)
    for doc_id, row in before.items():
        assert not secret_brute(after[doc_id].text)
        assert after[doc_id].n_chars == len(after[doc_id].text)
        if not secret_brute(row.text):
            assert after[doc_id] == row


def test_pieces_decode_to_the_masked_texts(stages):
    coder, found = bpe.encoding(), {}
    for row in stages[5].orderBy("doc_id", "piece").collect():
        assert row.n_tokens == len(row.ids) <= min(packing.CONTEXT, row.bound) and row.start == packing.CONTEXT * row.piece
        found.setdefault(row.doc_id, []).extend(row.ids)
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    assert {d: coder.decode_bytes(ids).decode() for d, ids in found.items()} == texts


def test_places_are_joined_or_broadcast(spark, stages, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_PIECES", 0)
    cut = bpe.id_pieces(stages[4], packing.CONTEXT)
    assert rows_of(packing.pack_pieces(cut)) == rows_of(stages[5])


def test_batches_keep_to_their_budget(stages):
    rows = stages[5].collect()
    places = {(r.bucket, r.batch, r.place) for r in rows}
    assert len(places) == len(rows)
    sizes = {}
    for r in rows:
        sizes.setdefault((r.bucket, r.batch, r.bound), []).append(r.place)
    for (_, _, bound), own in sizes.items():
        assert sorted(own) == list(range(len(own))) and (len(own) == 1 or len(own) * bound <= packing.BATCH_TOKENS)


def test_run_agrees_with_the_stages(spark, stages):
    assert rows_of(corpus_pipeline.run(spark, FOLDER)) == rows_of(stages[5])


def test_run_leaves_its_result_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("aisflow.storage.shared_folder", lambda session: str(tmp_path))
    out = corpus_pipeline.run(spark, FOLDER)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["packed"] and out.count()


def test_awkward_documents_pass_every_stage(spark):
    for docs in (clashing(documents(spark)), clashing(documents(spark)).limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            assert name == "packing" or docs.columns == columns
        docs.count()
