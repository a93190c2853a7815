"""Length buckets against exhaustive search, batches against their budget."""

import itertools
from collections import Counter, defaultdict

import numpy as np
from cases import TEXTS, WORD, clashing, documents, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from aisflow.llm import packing


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in histogram.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 4))
def test_bounds_are_optimal(histogram, buckets):
    plan = packing.optimal_bounds(histogram, buckets)
    lengths = sorted(histogram)
    least = min(
        padding(histogram, [*chosen, lengths[-1]])
        for k in range(buckets)
        for chosen in itertools.combinations(lengths[:-1], min(k, len(lengths) - 1))
    )
    assert plan.padding == least == padding(histogram, plan.bounds)
    assert len(plan.bounds) <= buckets and plan.bounds == sorted(set(plan.bounds))


def test_no_lengths():
    assert packing.optimal_bounds({}, 4) == packing.Plan([], 0)
    assert packing.optimal_bounds({5: 3}, 4) == packing.Plan([5], 0)


def test_every_token_is_packed_once(spark):
    docs = documents(spark)
    out = packing.pack(docs, context=64, buckets=3, batch_tokens=200, slice_rows=40)
    rows = out.collect()
    lengths = Counter()
    for text in [*TEXTS, "row without an id", "repeated row", "repeated row"]:
        n = len(WORD.findall(text or ""))
        for start in range(0, max(n, 1), 64):
            lengths[(start, min(64, n - start))] += 1
    assert Counter((r.start, r.n_tokens) for r in rows) == lengths
    batches = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.bound and r.start == 64 * r.piece
        batches[(r.bucket, r.batch)].append(r)
    by_bucket = defaultdict(list)
    for (bucket, batch), held in batches.items():
        full = max(1, 200 // max(held[0].bound, 1))
        assert sorted(r.place for r in held) == list(range(len(held))) and len(held) <= full
        by_bucket[bucket].append((batch, len(held), full))
    for held in by_bucket.values():
        held.sort()
        assert [b for b, _, _ in held] == list(range(len(held)))
        assert all(n == full for _, n, full in held[:-1])
    bounds = sorted({r.bound for r in rows})
    assert padding(Counter(r.n_tokens for r in rows), bounds) == packing.optimal_bounds(Counter(r.n_tokens for r in rows), 3).padding


def test_runs_agree_and_other_columns_are_ignored(spark):
    docs = documents(spark)
    first = rows_of(packing.pack(docs, context=64, slice_rows=50))
    again = rows_of(packing.pack(clashing(docs).repartition(3), context=64, slice_rows=50))
    assert first == again


def test_slices_change_nothing(spark):
    docs = documents(spark)
    whole = rows_of(packing.pack(docs, context=64, buckets=3, batch_tokens=200))
    for slice_rows in (7, 40):
        assert rows_of(packing.pack(docs, context=64, buckets=3, batch_tokens=200, slice_rows=slice_rows)) == whole


def test_empty_table(spark):
    assert packing.pack(documents(spark).limit(0)).collect() == []


def test_piece_words(spark):
    docs = documents(spark).where("doc_id = 100 - 17")
    cut = packing.pieces(docs, packing.word_count(), 1000).join(docs.select("doc_id", "text"), "doc_id")
    from pyspark.sql import functions as F

    words = cut.select("piece", packing.piece_words(F.col("text"), F.col("start"), F.col("n_tokens")).alias("w")).orderBy("piece").collect()
    assert list(np.concatenate([r.w for r in words])) == WORD.findall(TEXTS[17])
