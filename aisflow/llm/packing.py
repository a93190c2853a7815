"""Optimal length buckets and token-budget batches.

Sequences that are padded to a common length waste the difference. Bucket
bounds are chosen by dynamic programming over the histogram of all lengths, so
that the padding of the whole corpus is least for the number of buckets; each
bucket then forms batches of a constant token budget.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisflow.llm.columns import text_or_empty, words_of
from aisflow.llm.numbering import SLICE_ROWS, gapless
from aisflow.storage import written

#: Production parameters: longest sequence, buckets, tokens of a batch. Both lengths are in the unit
#: of ``length`` in ``pack``, which is white-space words unless another is given.
CONTEXT = 2048
BUCKETS = 8
BATCH_TOKENS = 65_536
#: Places of pieces that may be broadcast (40 bytes each).
BROADCAST_PIECES = 500_000


@dataclass(frozen=True)
class Plan:
    """Ascending upper bounds of the buckets and the padding they cost in all."""

    bounds: list[int]
    padding: int


def optimal_bounds(histogram: dict[int, int], buckets: int) -> Plan:
    """The bounds, at most ``buckets``, that minimise total padding.

    ``histogram`` maps lengths to counts. best[k][j] is the least padding of the
    lengths up to the j-th in k buckets; of equally good plans the one with the
    fewest buckets and then the smallest bounds is taken. An empty histogram
    has no buckets.
    """
    lengths = np.array(sorted(length for length, n in histogram.items() if n), dtype=np.int64)
    if not len(lengths):
        return Plan([], 0)
    counts = np.array([histogram[int(length)] for length in lengths], dtype=np.int64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    size = len(lengths)
    far = np.iinfo(np.int64).max // 4
    best = np.full(size + 1, far)
    best[0] = 0
    choices, totals = [], []
    for _ in range(min(buckets, size)):
        new, choice = np.full(size + 1, far), np.zeros(size + 1, dtype=np.int64)
        for j in range(1, size + 1):
            cost = best[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            choice[j] = int(np.argmin(cost))
            new[j] = cost[choice[j]]
        choices.append(choice)
        totals.append(int(new[size]))
        best = new
    k = int(np.argmin(totals))
    bounds, j = [], size
    for choice in reversed(choices[: k + 1]):
        bounds.append(int(lengths[j - 1]))
        j = int(choice[j])
    return Plan(bounds[::-1], totals[k])


def word_count(text: str = "text") -> Column:
    """Words of a text; a null or empty text has none."""
    return F.size(words_of(text_or_empty(text)))


def pieces(docs: DataFrame, length: Column, context: int = CONTEXT) -> DataFrame:
    """doc_id, piece, start, n_tokens: documents longer than ``context`` are cut into
    runs of ``context`` tokens and a rest; an empty one is one piece of no tokens."""
    measured = docs.select(F.col("doc_id").cast("long").alias("doc_id"), length.cast("long").alias("_length"))
    count = F.greatest(F.lit(1), F.ceil(F.col("_length") / context)).cast("long")
    numbered = measured.select("doc_id", "_length", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("piece"))
    start = F.col("piece") * context
    tokens = F.least(F.lit(context).cast("long"), F.col("_length") - start)
    return numbered.select("doc_id", "piece", start.alias("start"), tokens.alias("n_tokens"))


def length_histogram(cut: DataFrame) -> dict[int, int]:
    """Pieces by length, over all rows. At most ``context`` + 1 rows reach the driver."""
    return {row["n_tokens"]: row["n"] for row in cut.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}


def pack(
    docs: DataFrame,
    length: Column | None = None,
    context: int = CONTEXT,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """doc_id, piece, start, n_tokens, bucket, bound, batch, place: one row per piece.

    ``bound`` is the padded length of the piece's ``bucket``; a batch of it holds
    ``batch_tokens`` // bound rows (one at least), the last batch the rest;
    ``batch`` counts from 0 within the bucket and ``place`` within the batch.
    ``start`` is the offset of the piece's first token. Null and empty texts have
    length 0 and repeated rows are packed as often as they occur. An empty table
    gives an empty result. Other columns are ignored.
    """
    cut = pieces(docs, word_count() if length is None else length, context)
    plan = optimal_bounds(length_histogram(cut), buckets)
    bounds = plan.bounds or [0]
    slots = gapless(cut.withColumn("bucket", _bucket(bounds)), ["bucket"], ["doc_id", "piece"], slice_rows)
    return _in_batches(slots, bounds, batch_tokens).select("doc_id", "piece", "start", "n_tokens", "bucket", "bound", "batch", "place")


def _bucket(bounds: list[int]) -> Column:
    bucket = F.lit(0)
    for bound in bounds[:-1]:
        bucket = bucket + (F.col("n_tokens") > bound).cast("int")
    return bucket


def _in_batches(slots: DataFrame, bounds: list[int], batch_tokens: int) -> DataFrame:
    """Adds bound, batch and place from the bucket and the slot within it."""
    bound = F.get(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket"))
    per_batch = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(batch_tokens) / F.greatest(bound, F.lit(1).cast("long"))))
    placed = slots.withColumns({"bound": bound, "_rows": per_batch})
    return placed.withColumns({"batch": F.floor(F.col("slot") / F.col("_rows")), "place": F.col("slot") % F.col("_rows")})


def piece_words(text: Column, start: Column, n_tokens: Column) -> Column:
    """The words of a piece, when lengths are counted in words."""
    return F.slice(words_of(text), (start + 1).cast("int"), n_tokens.cast("int"))


def pack_pieces(
    cut: DataFrame,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The columns of ``pack`` and ``ids``, the tokens of each piece: what a training job reads.

    ``cut`` has doc_id, piece, start, n_tokens and ids, as ``bpe.id_pieces`` makes
    them. They are written once, so texts are encoded once; the order within a
    bucket is found from narrow rows and joined back by a row number that was
    stored with them. Repeated rows are packed as often as they occur, an empty
    table gives an empty result.
    """
    cut = written(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    plan = optimal_bounds(length_histogram(cut), buckets)
    bounds = plan.bounds or [0]
    narrow = cut.select("_row", "doc_id", "piece", "n_tokens").withColumn("bucket", _bucket(bounds))
    slots = gapless(narrow, ["bucket"], ["doc_id", "piece", "_row"], slice_rows)
    placed = _in_batches(slots, bounds, batch_tokens).select(F.col("_row").alias("_slot_row"), "bucket", "bound", "batch", "place")
    # few places are broadcast, so that the ids stay where they are; more are joined by shuffle
    few = cut.count() <= BROADCAST_PIECES
    joined = cut.join(F.broadcast(placed) if few else placed, F.col("_row") == F.col("_slot_row"))
    return joined.select("doc_id", "piece", "start", "n_tokens", "bucket", "bound", "batch", "place", "ids")
