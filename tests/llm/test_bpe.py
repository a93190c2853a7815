"""Encoding against the library on whole texts, and exact round trips."""

from cases import TEXTS, clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aisflow.llm import bpe

MORE = [
    "<|endoftext|> is ordinary text",
    "it's we'll they'd 'sun's  x   \n\n  y\t\tz \u00a0 \u2003end ",
    "no break " * 40_000,
    "x" * 200_000,
    "漢字かな" * 30_000,
    "a \x1c b\x85c \u2028 d" * 9_000,
    "\r\n" * 70_000 + "tail",
]


def test_round_trip_and_ids(spark):
    texts = [*TEXTS, *MORE]
    encoded = clashing(documents(spark, texts)).select("doc_id", bpe.encode(F.col("text")).alias("ids"))
    rows = {r.doc_id: r for r in encoded.select("doc_id", "ids", bpe.decode(F.col("ids")).alias("back"), bpe.id_text(F.col("ids")).alias("t")).collect()}
    coder = bpe.encoding()
    for k, text in enumerate(texts):
        ids = coder.encode_ordinary(text or "")
        row = rows[100 - k]
        assert row.ids == ids and bytes(row.back) == (text or "").encode() and row.t == " ".join(map(str, ids))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab1 .'\n\t\r\u00a0é漢😀sdl\x1c\x85!-"), max_size=60), st.integers(1, 10))
def test_cuts_change_nothing(text, size):
    coder = bpe.encoding()
    parts = list(bpe.chunks(text, size))
    assert "".join(parts) == text
    assert [i for part in parts for i in coder.encode_ordinary(part)] == coder.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab1 .'\n\t\r\u00a0\u3000é漢s\x1c\x85!"), max_size=60), st.integers(1, 6))
def test_runs_apart_change_nothing(text, size):
    coder = bpe.encoding()
    assert "".join(part for part, _ in bpe.stretches(text, size)) == text
    assert bpe.ids_of(text, coder, size).tolist() == coder.encode_ordinary(text)


def test_runs_of_white_space_beyond_the_limit_of_the_library(spark):
    coder, n = bpe.encoding(), 1_000_010
    texts = ["a" + " " * n + "b " + "\n" * n, "\u00a0" * n + "漢", "\r\n" * n]
    rows = documents(spark, texts).select("doc_id", bpe.encode(F.col("text")).alias("ids"))
    rows = {r.doc_id: r for r in rows.select("*", bpe.decode(F.col("ids")).alias("back")).collect()}
    for k, text in enumerate(texts):
        assert bytes(rows[100 - k].back) == text.encode()
    # the match of the pattern, then the rest as the library encodes it
    one = coder._encode_single_piece
    assert rows[100].ids == [*one("a"), *one(" " * (n - 1)), *one(" b"), *one(" " + "\n" * n)]
    assert rows[99].ids == [*one("\u00a0" * (n - 1)), *one("\u00a0"), *one("漢")]
    assert rows[98].ids == one("\r\n" * n)


def test_parts_are_bounded():
    assert max(map(len, bpe.chunks("word " * 100_000))) < bpe.CHUNK_CHARS + 10


def test_partial_ids_and_empty_table(spark):
    ids = bpe.encoding().encode_ordinary("😀")
    assert len(ids) > 1
    frame = spark.createDataFrame([(ids[:1],), ([],), (None,)], "ids array<int>")
    back = [bytes(r.b) for r in frame.select(bpe.decode(F.col("ids")).alias("b")).collect()]
    assert back == [bpe.encoding().decode_bytes(ids[:1]), b"", b""]
    none = documents(spark).limit(0).select(bpe.encode(F.col("text")).alias("ids"))
    assert none.collect() == []


def test_pieces_of_ids(spark, monkeypatch):
    """Pieces of a text in order are its ids, whatever the size of batches."""
    from cases import clashing, documents

    from aisflow.llm import bpe

    docs = clashing(documents(spark))
    whole = sorted((r.doc_id or 0, tuple(r.ids)) for r in docs.select("doc_id", bpe.encode(docs.text).alias("ids")).collect())
    for size, batch in ((7, 1), (7, 1 << 20), (100_000, 500)):
        monkeypatch.setattr(bpe, "BATCH_IDS", batch)
        rows = bpe.id_pieces(docs, size).collect()
        assert all(r.n_tokens == len(r.ids) <= size and r.start == r.piece * size for r in rows)
        single = [r for r in rows if r.doc_id != 7]
        found = {}
        for r in sorted(single, key=lambda r: (r.doc_id or 0, r.piece)):
            found.setdefault(r.doc_id or 0, []).extend(r.ids)
        assert sorted((d, tuple(ids)) for d, ids in found.items()) == [w for w in whole if w[0] != 7]
        assert sum(r.n_tokens for r in rows if r.doc_id == 7) == sum(len(ids) for d, ids in whole if d == 7)


def test_long_texts_of_other_scripts_are_cut():
    """Two million characters of words in Chinese, Cyrillic and Arabic letters: no call gets more than a chunk or so."""
    from aisflow.llm import bpe

    coder = bpe.encoding()
    for word in ("漢字 ", "слово ", "كلمة\n", "é😀 "):
        text = word * (2_000_000 // len(word))
        parts = list(bpe.chunks(text))
        assert "".join(parts) == text and max(map(len, parts)) <= bpe.CHUNK_CHARS + len(word)
        short = word * 1000
        cut = [i for part in bpe.chunks(short, 50) for i in coder.encode_ordinary(part)]
        assert cut == coder.encode_ordinary(short)


def test_the_library_has_what_is_used_of_it():
    """Runs of white space rely on a method that the library does not document."""
    from aisflow.llm import bpe

    coder = bpe.encoding()
    assert coder._encode_single_piece("   ") == coder.encode_ordinary("   ")
