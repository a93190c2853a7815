"""SimHash fingerprints and components against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import clashing, documents, rows_of

from aisflow.llm import simhash


def plain_print(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """doc_id, fingerprint, component by comparing all pairs."""
    prints = [plain_print(t) for _, t in rows]
    roots = list(range(len(rows)))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = rows[a][0] == rows[b][0]
            if None not in (rows[a][0], rows[b][0]) and (same or (prints[a] ^ prints[b]).bit_count() <= 3):
                roots[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return sorted(((d, f"{p:016x}", None if d is None else least[find(k)]) for k, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def test_against_all_pairs(spark):
    for frame in (documents(spark), clashing(documents(spark))):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        assert rows_of(simhash.near_duplicates(frame)) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(simhash.near_duplicates(docs)) == found
    assert len({c for _, _, c in found}) < len(found)
    # every list that has two entries is long: all goes through the lists of five bytes
    assert rows_of(simhash.near_duplicates(docs, list_size=1)) == found


def test_empty_table(spark):
    out = simhash.near_duplicates(documents(spark).limit(0))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"Word{k % 97}\t{k}\n" for k in range(4000))
    whole = plain_print(text)
    for size in (1, 7, 1000):
        monkeypatch.setattr(simhash, "PART_BYTES", size)
        assert simhash.fingerprint(text) == whole
    assert simhash.fingerprint("x" * 50_000) == plain_print("x" * 50_000)


def test_every_close_pair_meets_in_a_list():
    """Any three differing bits leave a triple of a half untouched, and five bytes that hold it."""
    for bits in [(a, b, c) for a in range(0, 64, 3) for b in range(a, 64, 5) for c in range(b, 64, 7)]:
        changed = {b // 8 for b in bits}
        triples = [k for k, t in enumerate(simhash._TRIPLES) if not changed & set(t)]
        assert triples
        for k in triples:
            assert any(not changed & set(simhash._FIVES[f]) for f in simhash._WITHIN[k])


@pytest.mark.parametrize("dense", [4096, 10])
def test_lists_of_five_bytes(monkeypatch, dense):
    """Pair by pair and by look-up, the components of lists are the same as by all pairs."""
    monkeypatch.setattr(simhash, "DENSE", dense)
    draw = random.Random(3)
    prints = []
    for top in (0, 0xABCDEF0123 << 24, 0xFFFFFFFFFF << 24):
        prints += sorted({top | (draw.getrandbits(24) & 0xFF0FF3) for _ in range(300)})
    lists = np.array([0] + [k + 1 for k in range(len(prints)) if k + 1 == len(prints) or prints[k] >> 24 != prints[k + 1] >> 24])
    table = pa.table({"rep": pa.array(range(len(prints))), "print": pa.array(np.array(prints, np.uint64).view(np.int64))})
    linked = [(a, b) for out in simhash._links(table, lists) for a, b in zip(*(c.to_pylist() for c in out.columns))]
    assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a, b in linked) and len(linked) < len(prints)

    def parts(edges):
        root = list(range(len(prints)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return [find(x) for x in range(len(prints))]

    every = [(a, b) for s, e in zip(lists[:-1], lists[1:]) for a in range(s, e) for b in range(a) if b >= s and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert parts(linked) == parts(every)


def test_tally():
    x = np.array([0, 1, 0xFF00FF00FF, (1 << 64) - 1], np.uint64)
    assert simhash.shared_bytes(x).tolist() == [8, 7, 5, 0]
