"""The classifier: folds, features, held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, clashing, documents, rows_of
from pyspark.sql import functions as F

from aisflow.llm import queries, quality_model

DATA = "/root/testdata/sf0.01"


def in_fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_features_of_each_text_do_not_depend_on_its_neighbours():
    texts = [t or "" for t in TEXTS[:-1]] + ["end", "end end", "x"]
    together = {}
    for data, bounds, row, _ in quality_model._parts(pa.array(texts)):
        found = quality_model.features(data, bounds)
        for bucket, place in zip(found.buckets, found.places):
            together.setdefault(row + int(np.searchsorted(bounds, place, side="right")) - 1, []).append(bucket)
    for k, text in enumerate(texts):
        data = np.frombuffer(text.encode(), np.uint8)
        alone = quality_model.features(data, np.array([0, len(data)]))
        assert sorted(together.get(k, [])) == sorted(alone.buckets), text
    words = {k: len(v) for k, v in together.items()}
    assert words[texts.index("two words")] == 2 + 4 + 1
    assert words[len(texts) - 2] == 2 + 2 + 1


def test_long_texts_in_parts(monkeypatch):
    text = "some words of a long text " * 3000
    whole = [len(quality_model.features(d, b).places) for d, b, _, _ in quality_model._parts(pa.array([text]))]
    monkeypatch.setattr(quality_model, "STEP_BYTES", 1000)
    cut = list(quality_model._parts(pa.array(["a", text, None, "b"])))
    assert sum(len(quality_model.features(d, b).places) for d, b, row, _ in cut if row == 1) == sum(whole)
    assert b"".join(d.tobytes() for d, _, _, _ in cut).decode() == "a" + text + "b"


@pytest.fixture(scope="module")
def scored(spark):
    return queries.op5_subword_quality(spark, DATA).toPandas()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").toPandas()
    joined = scored.merge(labels, on="doc_id")
    assert (scored.held_out == scored.doc_id.map(in_fold)).all()
    assert scored.score.between(0, 1).all() and (scored.predicted == (scored.score >= 0.7)).all()
    unseen = joined[joined.held_out]
    assert len(unseen) > 60
    assert (unseen.predicted == unseen.quality).mean() > 0.93
    assert unseen[unseen.quality == 1].predicted.mean() > 0.95
    good, bad = unseen[unseen.quality == 1].score, unseen[unseen.quality == 0].score
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_labels_of_the_fold_are_never_used(spark, scored):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    wrong = labels.withColumn("quality", F.when(quality_model.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_model.classify(docs, quality_model.train(docs, wrong.repartition(3))).toPandas()
    assert np.allclose(again.sort_values("doc_id").score, scored.sort_values("doc_id").score)


def test_awkward_documents(spark):
    docs = clashing(documents(spark))
    labels = spark.createDataFrame([(100 - k, k % 2, 0) for k in range(18)] + [(None, 1, 0), (90, 1, 0), (5, None, 0), (6, 7, 0)], "doc_id long, quality int, toxic int")
    assert quality_model.sample(docs, labels, 3).groupBy("label").count().agg(F.max("count")).first()[0] <= 3
    model = quality_model.train(docs, labels, 50)
    rows = quality_model.classify(docs, model).collect()
    assert len(rows) == len(TEXTS) + 3 and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[100].score == by_id[99].score == by_id[98].score and by_id[None].held_out is False
    kept = quality_model.keep(docs, model, 0.0)
    assert kept.columns == docs.columns and rows_of(kept) == rows_of(docs)


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality_model.classify(docs, quality_model.train(docs, none)).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.5, 0)}
    assert quality_model.classify(docs.limit(0), quality_model.Model.blank()).collect() == []


def test_a_repeated_id_counts_once(spark):
    rows = [(k % 5 if k % 5 else k, f"text {k}") for k in range(1, 400)] + [(1, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, quality int")
    first = sorted(quality_model.sample(docs, labels, 30).collect())
    assert all(sum(r.label == label for r in first) <= 30 for label in (0, 1))
    everything = quality_model.sample(docs, labels, 400).collect()
    known = {r.doc_id for r in docs.where(~quality_model.held_out(docs.doc_id)).collect()}
    assert len(everything) == len(known) < len(rows)
    assert sorted(quality_model.sample(docs.repartition(7), labels, 30).collect()) == first


def plain_score(text, model):
    """Average of the vectors of all words, n-grams and repeated words, one at a time, and a softmax of both classes."""
    import math

    data = text.encode()
    vectors, start, before = [], 0, None
    tables = quality_model._TABLES.tolist()
    for k in range(len(data) + 1):
        if k < len(data) and data[k] not in b"\t\n\v\f\r ":
            continue
        word = data[start:k]
        start = k + 1
        if not word:
            continue
        whole = 0
        for place, letter in enumerate(word):
            whole ^= tables[8 + (place & 15)][letter]
        found = [whole]
        for at in range(len(word) - 2):
            three = tables[0][word[at]] ^ tables[1][word[at + 1]] ^ tables[2][word[at + 2]]
            found.append(three)
            if at + 5 <= len(word):
                found.append(three ^ tables[3][word[at + 3]] ^ tables[4][word[at + 4]] ^ 0x9E3779B9)
        found += [int(quality_model._AGAIN)] * (word == before)
        before = word
        vectors += [model.vectors[h % quality_model.BUCKETS] for h in found]
    mean = sum(vectors) / len(vectors) if vectors else np.zeros(quality_model.WIDTH)
    logits = [float(model.weights[c] @ mean + model.bias[c]) for c in (0, 1)]
    return math.exp(logits[1]) / (math.exp(logits[0]) + math.exp(logits[1]))


def test_score_is_the_average_of_vectors_and_a_softmax(spark):
    from cases import TEXTS

    random = np.random.default_rng(3)
    shape = (quality_model.BUCKETS, quality_model.WIDTH)
    model = quality_model.Model(random.normal(0, 3, shape), random.normal(0, 1, (2, quality_model.WIDTH)), random.normal(0, 1, 2))
    texts = [*TEXTS, "same same same", "a bb ccc dddd eeeee ffffff", "x" * 40]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    found = {r.k: r.s for r in frame.select("k", quality_model.score(frame.text, model).alias("s")).collect()}
    for k, text in enumerate(texts):
        assert abs(found[k] - plain_score(text or "", model)) < 1e-5


def test_one_step_follows_the_numerical_gradient(monkeypatch):
    """A single step of ``fit`` on one batch moves every weight against the slope of the mean log loss."""
    monkeypatch.setattr(quality_model, "BUCKETS", 64)
    texts, classes = [b"good words here", b"bad things there", b"good again"], np.array([1, 0, 1])
    moved = quality_model.fit(texts, classes, steps=len(texts) / quality_model.BATCH)
    random = np.random.default_rng(1)
    start = quality_model.Model(random.uniform(-0.1, 0.1, (64, quality_model.WIDTH)), np.zeros((2, quality_model.WIDTH)), np.zeros(2))

    def means(model):
        out = []
        for text in texts:
            data = np.frombuffer(text, np.uint8)
            out.append(model.vectors[quality_model.features(data, np.array([0, len(data)])).buckets.astype(int)].mean(axis=0))
        return np.stack(out)

    def loss(model):
        logits = means(model) @ model.weights.T + model.bias
        chance = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
        return -np.log(chance[np.arange(len(texts)), classes]).sum()

    rate = quality_model.RATE / quality_model.BATCH
    for name in ("weights", "bias"):
        values = getattr(start, name)
        for at in np.ndindex(values.shape):
            held = values[at]
            values[at] = held + 1e-5
            up = loss(start)
            values[at] = held - 1e-5
            slope = (up - loss(start)) / 2e-5
            values[at] = held
            assert abs((getattr(moved, name)[at] - held) + rate * slope) < 1e-6
    # with weights of zero the vectors have no slope yet
    assert np.allclose(moved.vectors, start.vectors)
