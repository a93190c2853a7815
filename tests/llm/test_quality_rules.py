"""Measurements against plain Python; policies and ablations on the bits."""

import re
from collections import Counter

from cases import TEXTS, WORD, clashing, documents, rows_of
from pyspark.sql import functions as F

from aisflow.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    n_symbols = len(re.findall(r"[#*$%&|<>]", text))
    n_upper = sum(c.isupper() and len(c) == 1 and c.lower() != c for c in text)
    return (len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(covered), len(lines), n_upper)


def test_measurements(spark):
    rows = q.measure(documents(spark)).collect()
    texts = {100 - k: t for k, t in enumerate(TEXTS)} | {None: "row without an id", 7: "repeated row"}
    assert len(rows) == len(TEXTS) + 3
    for row in rows:
        assert tuple(row)[1:] == brute(texts[row.doc_id]), texts[row.doc_id]


def test_ledger_bits_and_policies(spark):
    marks = q.ledger(clashing(documents(spark)))
    assert rows_of(marks) == rows_of(q.ledger(documents(spark)))
    bits = {r.name: 1 << r.bit for r in q.RULES}
    rows = marks.withColumn("base", q.fails(q.BASE)).withColumn("all", q.fails(q.PRODUCTION)).collect()
    for r in rows:
        few, repeated = r.n_words < 50, 100 * r.n_repeat_words > 50 * r.n_words
        assert bool(r.failed & bits["few_words"]) == few and bool(r.failed & bits["repeated_windows"]) == repeated
        assert r.base == (few or repeated) and r["all"] == (r.failed != 0)


def test_ablations_agree_with_a_second_evaluation(spark):
    marks = q.ledger(documents(spark))
    rows = marks.collect()
    mask = q.PRODUCTION.mask()
    got = {r.rule: (r.n_failed, r.n_only) for r in q.ablations(marks, q.PRODUCTION).collect()}
    for rule in q.RULES:
        bit = 1 << rule.bit
        failed = sum(bool(r.failed & bit) for r in rows)
        only = sum((r.failed & mask) != 0 and (r.failed & mask & ~bit) == 0 for r in rows)
        assert got[rule.name] == (failed, only)


def test_keep_returns_rows_as_they_are(spark):
    docs = clashing(documents(spark, [*TEXTS, " ".join(f"word{k}" for k in range(60))]))
    good = {r.doc_id for r in q.ledger(docs).where(~q.fails(q.PRODUCTION)).collect()}
    kept = q.keep(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept) == [r for r in rows_of(docs) if r[0] in good]
    assert good == {82}


def test_empty_table(spark):
    none = documents(spark).limit(0)
    assert q.ledger(none).collect() == [] and q.keep(none).collect() == []
    assert {tuple(r)[1:] for r in q.ablations(q.ledger(none), q.BASE).collect()} <= {(0, 0)}


def test_many_repeats(spark):
    text = " ".join(f"w{k % 50}" for k in range(30_000)) + " end of it all"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert tuple(q.measure(docs).first())[1:6] == brute(text)[:5]
    assert q.measure(docs.select("doc_id", F.lit(None).cast("string").alias("text"))).first().n_words == 0
