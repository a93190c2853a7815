"""The prefix trie against plain Python."""

import hashlib
import random
import zlib

import pytest
from cases import rows_of

from aisflow.llm import prefix_trie
from aisflow.llm.prefix_trie import Tree, median_order

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The result rows from (conv_id, turn, role, text)."""
    turns = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(conv_id, []).append((turn is not None, turn or 0, key, len(text.split())))
    own = {c: [(key, words) for *_, key, words in sorted(found)] for c, found in turns.items()}
    whole = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(own.get(base, [])[:h] + found[h:])
    nodes = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * p[-1][1] for p in below if p)
        ends = ",".join(str(c) for c in sorted(members) if whole[c] == path)
        parent = min(nodes[path[:-1]]) if path else None
        children = sum(len(p) == len(path) + 1 for p in below)
        out.append((min(members), len(path), parent, len(members), children, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    draw = random.Random(5)
    rows = []
    for c in [*range(47), -3, 60, 200, 215, 10**12]:
        for turn in range(draw.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice(["a b", "c", "d e f\n g", ""])))
    rows += [(80, k, "user", f"word {k % 5} of many") for k in range(40)]
    rows += [(c, k, "user", f"word {k % 5} of many") for c in (81, 82, 99) for k in range(30 + c % 4)]
    rows += [(c, 0, "user", "the same beginning") for c in range(300, 330)]
    rows += [(None, 0, "user", "lost"), (400, None, None, None), (400, 0, "user", None), (400, 0, "user", None), (400, 0, "", "x"), (401, 1, "", ":")]
    return rows


@pytest.mark.parametrize("sizes", [(16, 20_000, 100_000), (2, 7, 5), (3, 1, 2), (16, 10, 4)])
def test_against_plain_version(spark, sizes):
    block, shard_rows, span = sizes
    rows = conversations()
    frame = spark.createDataFrame(rows, SCHEMA)
    found = prefix_trie.prefix_trie(frame, block, shard_rows, span=span, broadcast_nodes=1_000_000 if block == 16 else 3)
    assert rows_of(found) == brute(rows)


def test_segments_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 2)
    rows = [r for r in conversations() if r[0] in (80, 81, 82, 99, 60)]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), 2, 6, slice_rows=20)
    assert rows_of(found) == brute(rows)


def test_pieces_of_ends(spark, monkeypatch):
    rows = [(c, 0, "user", "hello") for c in range(1, 400)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 0]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_rows=9)) == brute(rows)


def test_empty_and_clashing_tables(spark):
    from pyspark.sql import functions as F

    rows = conversations()[:60]
    names = "key words slot depth total block path k1 shard kind _span n h base taken"
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("clash") for n in names.split()})
    assert rows_of(prefix_trie.prefix_trie(frame)) == brute(rows)
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0


def test_tree_is_balanced_by_median_insertion():
    tree = Tree()
    for k in median_order(1023):
        tree.insert([k], [0], [(k, k)])

    def height(x):
        return 0 if x < 0 else 1 + max(height(tree.low[x]), height(tree.high[x]))

    assert height(tree.equal[0]) == 10 and len(tree.preorder()) == 1024
    assert sorted(median_order(10)) == list(range(10))
