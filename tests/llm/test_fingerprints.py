"""Merkle fingerprints against plain Python, and the ring of neighbours."""

import hashlib
import re

from cases import TEXTS, clashing, documents, rows_of
from pyspark.sql import functions as F

from aisflow.llm import fingerprints as f

LEAF = re.compile(f.LEAF)
md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def brute(text):
    paragraphs = [".".join(md5(x)[: f.LEAF_DIGITS] for x in LEAF.findall(line)) for line in text.split("\n")]
    body = "".join(p + (";" if md5(p)[0] in "0123" else ",") for p in paragraphs)[:-1]
    sections = [md5(",".join(md5(p) for p in section.split(","))) for section in body.split(";")]
    return sha(",".join([*sections, sha(text)])) + "|" + body


def near(a, b):
    if a.split("|")[0] == b.split("|")[0]:
        return 1.0
    x, y = ({leaf for leaf in re.split("[.,;]", p.split("|")[1]) if leaf} for p in (a, b))
    return len(x & y) / len(x | y) if x | y else 0.0


def test_against_plain_python(spark):
    docs = documents(spark)
    order = sorted(((-r.doc_id if r.doc_id is not None else 10**30, md5(r.text or ""), r.text or "", r.doc_id) for r in docs.collect()))
    expected = []
    for k, (_, _, text, doc_id) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        prints = [brute(t) for t in (text, new, after)]
        expected.append((doc_id, len(text), sha(new), prints[0], prints[1], near(prints[0], prints[1]), near(prints[0], prints[2])))
    for slice_rows in (1000, 4, 1):
        assert rows_of(f.compare_with_edits(clashing(docs).repartition(3), slice_rows)) == sorted(expected, key=repr)


def test_single_row_and_empty_table(spark):
    docs = documents(spark)
    assert f.compare_with_edits(docs.limit(0)).collect() == []
    alone = f.compare_with_edits(docs.where("doc_id = 95")).first()
    assert alone.near_next == 1.0


def test_an_edit_is_located(spark):
    lines = [f"Paragraph {k} has a few words. And a second sentence." for k in range(60)]
    other = [*lines[:30], "One more.", *lines[30:]]
    frame = spark.createDataFrame([("\n".join(lines), "\n".join(other))], "a string, b string")
    a, b = f.fingerprint_of(F.col("a")), f.fingerprint_of(F.col("b"))
    row = frame.select(f.changed_sections(a, b).alias("places"), f.changed_sections(a, a).alias("same"), F.size(f.section_hashes(b)).alias("n"), f.likeness(a, b).alias("near")).first()
    assert 1 <= len(row.places) <= 2 < row.n and row.same == [] and row.near > 0.95


def test_equal_texts_only(spark):
    texts = ["a b", "a  b", "a b ", "a\nb", "a b"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    prints = [r.p for r in frame.select(f.fingerprint_of(F.col("t")).alias("p")).collect()]
    assert len(set(prints)) == 4 and prints[0] == prints[4]
    assert TEXTS[0] is None


def test_repeated_ids_and_texts_are_spread(spark):
    """An id with many texts, the missing id with many, and one row very often: the ring is the plain one, and no slice is long."""
    rows = [(5, f"text {k} of the id") for k in range(120)] + [(None, f"no id {k}") for k in range(60)] + [(7, "often")] * 150 + [(None, "often")] * 70
    rows += [(k, f"single {k}") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = sorted((-d if d is not None else 10**30, md5(t), t, d) for d, t in rows)
    expected = sorted(((d, t, order[(k + 1) % len(order)][2]) for k, (_, _, t, d) in enumerate(order)), key=repr)
    for slice_rows in (1000, 10, 3):
        assert rows_of(f.with_next(frame, slice_rows)) == expected


def test_slices_are_bounded_in_number(spark, monkeypatch):
    monkeypatch.setattr(f, "MOST_SLICES", 4)
    keys = spark.range(1000).selectExpr("id AS doc_id", "md5(cast(id AS string)) AS _m")
    points, busy, pairs = f._cut(keys, 1)
    assert len(points) <= 4 and busy == pairs == []


def test_a_comparison_goes_down_into_differing_sections(spark):
    """Equal to the share over flat sets of leaves, for all pairs of texts."""
    texts = [t or "" for t in TEXTS] + ["\n".join(f"Line {k % m} has words. And more of them {k}." for k in range(40)) for m in (3, 7, 40)]
    frame = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    rows = frame.select("a", "b", f.likeness(f.fingerprint_of(F.col("a")), f.fingerprint_of(F.col("b"))).alias("x")).collect()
    prints = {t: brute(t) for t in texts}
    assert all(r.x == near(prints[r.a], prints[r.b]) for r in rows)
