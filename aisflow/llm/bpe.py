"""Byte-level BPE encoding and decoding by the tiktoken library.

The rank file is a path on every machine, given as a parameter and read once a
worker. A text is encoded match by match of the split pattern; long texts are
first cut at places where no match can cross, so that the time and memory of one
call stay bounded. Long runs of white space, on which the library's regex gives
up, are found here and encoded without it.
"""

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters of one call, about.
CHUNK_CHARS = 1 << 16
#: Ids that a task hands over at a time.
BATCH_IDS = 1 << 20
#: Longest run of white space that the pattern sees; the library fails beyond 1,000,000.
RUN_CHARS = 1 << 16

#: White space as the library's regex has it; Python's also holds the separators 1C to 1F.
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Between any character but white space and a space or line end: every alternative of the pattern
#: has white space in front or is white space only, and none looks back.
_SAFE = re.compile(rf"(?<=[^{_SPACES}])(?=[ \n])")


@lru_cache(maxsize=4)
def encoding(ranks: str = RANKS, pattern: str = PATTERN) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})


def chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that end at safe places; longer where
    there is none: a text without any space or line end is one piece."""
    first = 0
    while len(text) - first > size:
        place = _SAFE.search(text, first + size)
        if place is None:
            break
        yield text[first : place.start()]
        first = place.start()
    yield text[first:]


@lru_cache(maxsize=4)
def _long_run(size: int) -> re.Pattern:
    # tried at the first character of a run only, so the search is linear
    return re.compile(rf"(?<![{_SPACES}])[{_SPACES}]{{{size + 1},}}")


def stretches(text: str, size: int = RUN_CHARS) -> Iterator[tuple[str, bool]]:
    """The text in parts, and whether a part is one match: white space from a run of more than ``size`` (at least 1).

    No match crosses into such a run from the left. Its first match is the whole
    run at the end of the text, or else all but the last character, which the
    pattern leaves to what follows.
    """
    first = 0
    for run in _long_run(size).finditer(text) if len(text) > size else ():
        last = run.end() if run.end() == len(text) else run.end() - 1
        yield text[first : run.start()], False
        yield text[run.start() : last], True
        first = last
    yield text[first:], False


def ids_of(text: str, coder: tiktoken.Encoding, run_chars: int = RUN_CHARS) -> np.ndarray:
    """Token ids of a whole text; strings that look like special tokens are ordinary text."""
    parts = []
    for stretch, whole in stretches(text, run_chars):
        if whole:
            parts.append(np.array(coder._encode_single_piece(stretch), np.uint32))
        else:
            parts += [coder.encode_to_numpy(part, disallowed_special=()) for part in chunks(stretch)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode(text: Column, ranks: str = RANKS, pattern: str = PATTERN) -> Column:
    """Token ids, array<int>; none for a null or empty text."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        coder = encoding(ranks, pattern)
        found = [ids_of(t.as_py() or "", coder) for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(ids) for ids in found])]).astype(np.int32)
        values = np.concatenate([np.empty(0, np.uint32), *found]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))

    return encoded(text)


def id_pieces(docs: DataFrame, size: int, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id, piece, start, n_tokens, ids: the ids of each whole text in runs of ``size`` and a rest.

    A null or empty text is one piece without ids; repeated rows stay, other
    columns are ignored. Batches are bounded by ids, so neither side ever holds
    the ids of many texts, or a long array of one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            rows, held, total = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py() or "", coder)
                for start in range(0, max(1, len(ids)), size):
                    held.append(ids[start : start + size].astype(np.int32))
                    rows.append((doc_id, start // size, start, len(held[-1])))
                    total += len(held[-1]) + 100
                    if total > BATCH_IDS:
                        yield _pieces_batch(rows, held)
                        rows, held, total = [], [], 0
            if rows:
                yield _pieces_batch(rows, held)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, piece long, start long, n_tokens long, ids array<int>")


def _pieces_batch(rows: list[tuple], ids: list[np.ndarray]) -> pa.RecordBatch:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids)))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in zip(*rows)), lists], ["doc_id", "piece", "start", "n_tokens", "ids"])


def decode(ids: Column, ranks: str = RANKS, pattern: str = PATTERN) -> Column:
    """The bytes that ids stand for, which need not be valid UTF-8 unless all ids of a text are
    there; empty for null. An id outside the vocabulary is an error."""

    @F.arrow_udf("binary")
    def decoded(lists: pa.Array) -> pa.Array:
        coder = encoding(ranks, pattern)
        # one text's ids at a time become Python numbers, each of which takes eight times its four bytes
        ids, bounds = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
        texts = (coder.decode_bytes(ids[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:]))
        return pa.array(texts, pa.binary(), size=len(lists))

    return decoded(ids)


def id_text(ids: Column) -> Column:
    """Decimal ids joined by single spaces."""
    return F.array_join(ids.cast("array<string>"), " ")
