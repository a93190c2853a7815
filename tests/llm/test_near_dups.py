"""Near-duplicates against all pairs."""

import random

import numpy as np
import pyarrow as pa
from cases import TEXTS, WORD, clashing, documents, rows_of
from conftest import SMALL

from aisflow.llm import batches, near_dups

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) or frozenset([tuple(words)])


def brute(rows, size):
    """(doc_id, n_shingles, component_id, kept) from all pairs of distinct sets."""
    sets = [shingles(text, size) for _, text in rows]
    first = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            first[s] = min(first.get(s, doc_id), doc_id)
    distinct = list(first)
    root = {d: d for d in first.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if min(len(a), len(b)) * 100 < 80 * max(len(a), len(b)):
                continue
            common = len(a & b)
            if 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = find(first[a]), find(first[b])
                root[max(x, y)] = min(x, y)
    out = []
    for (doc_id, _), s in zip(rows, sets):
        component = doc_id if doc_id is None or not s else find(first[s])
        out.append((doc_id, len(s), component, doc_id is None or doc_id == component))
    return sorted(out, key=repr)


def variants(count, words, edits, seed):
    """Texts from one original with up to ``edits`` words replaced, and outliers further away."""
    rng = random.Random(seed)
    original = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for k in range(count):
        text = list(original)
        for _ in range(rng.randrange(edits + 1) if k % 5 else 2 * edits):
            text[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def test_shingle_sets():
    texts = [*TEXTS, "A b", "a B", " a\x0bb ", "one", "One two three four five six"]
    for size in (1, 2, 5):
        sets = batches.shingle_sets(pa.array(texts), size)
        expected = [shingles(t, size) for t in texts]
        assert [len(s) for s in sets] == [len(s) for s in expected]
        for i, a in enumerate(expected):
            for j, b in enumerate(expected):
                assert len(np.intersect1d(sets[i], sets[j])) == len(a & b)


def test_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (0, 1, 5, 50, 200, 280)]
    got = near_dups.intersections(sets[:4], sets[2:], columns=7)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:4]]


def test_awkward_documents(spark):
    docs = documents(spark, [*TEXTS, *variants(12, 40, 3, 1)])
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 2)
    assert rows_of(near_dups.near_duplicates(docs, 2)) == expected
    assert rows_of(near_dups.near_duplicates(clashing(docs), 2)) == expected


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 24)
    monkeypatch.setattr(near_dups, "SMALL_NODE", 12)
    texts = variants(150, 80, 7, 2) + variants(60, 50, 5, 3) + [f"alone {k} in {k * k} words {k + 7}" for k in range(40)]
    docs = documents(spark, texts + texts[:30])
    assert rows_of(near_dups.near_duplicates(docs, 2)) == brute([(r.doc_id, r.text) for r in docs.collect()], 2)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 2)
    assert rows_of(near_dups.near_duplicates(docs, 2)) == expected


def test_keep_and_empty_table(spark):
    docs = clashing(documents(spark, ["a b c d e f g"] * 3 + [None, ""]))
    kept = near_dups.keep(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {98, 97, 96, None, 7}
    assert near_dups.near_duplicates(docs.limit(0)).collect() == []


def test_groups_wait_without_the_batch_they_came_in():
    """Ten groups a batch, the last of which goes on in the next one; one waits, in memory of its own."""
    before, held, seen = pa.total_allocated_bytes(), [], []

    def rows():
        for k in range(5):
            held.append(pa.total_allocated_bytes() - before)
            nodes = np.repeat(np.arange(9 * k, 9 * k + 10), 100)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([bytes(5000)] * 1000)], ["node", "value"])
        yield pa.RecordBatch.from_arrays([pa.array([45] * 70), pa.array([b""] * 70)], ["node", "value"])

    def work(table, starts):
        nodes = table.column("node").to_numpy()
        seen.extend((int(nodes[a]), len(set(nodes[a:b])), b - a) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()))
        yield from ()

    assert list(batches.in_groups(["node"], work)(rows())) == []
    sizes = {k: 200 if k % 9 == 0 else 100 for k in range(45)} | {0: 100, 45: 170}
    assert seen == [(k, 1, n) for k, n in sorted(sizes.items())]
    assert max(held) < 2_000_000
