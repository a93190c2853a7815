"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A key and the number of shards decide the shard; no table of ring positions is
kept. When shards are appended, a key stays where it is or moves into a new
shard, and only the necessary fraction moves.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisflow.llm.columns import text_or_empty
from aisflow.llm.numbering import SLICE_ROWS, gapless

# Fixed value: the multiplier of the published generator, x * MULTIPLIER + 1 modulo 2**64.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
_LOW0, _LOW1 = _LOW & 0xFFFF, _LOW >> 16
_MASK = 0xFFFFFFFF


def _next_halves(high: Column, low: Column) -> tuple[Column, Column]:
    """The next state of the generator as two halves of 32 bits. Products are
    taken in parts below 2**63, as integer overflow is an error in ANSI mode."""
    part0, part1 = low * _LOW0 + 1, low * _LOW1
    new_low = (part0 + F.shiftleft(part1.bitwiseAND(0xFFFF), 16)).bitwiseAND(F.lit(_MASK))
    carry = F.shiftright(F.shiftright(part0, 16) + part1, 16)
    cross = (low * _HIGH).bitwiseAND(F.lit(_MASK)) + high * _LOW0
    cross = cross + F.shiftleft((high * _LOW1).bitwiseAND(0xFFFF), 16)
    return (carry + cross).bitwiseAND(F.lit(_MASK)), new_low


def _jumps(key: Column, shards: int) -> Column:
    """Struct of the last shard below ``shards`` (b) and the jump beyond it (j)."""
    start = F.struct(
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(_MASK)).alias("low"),
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _next_halves(state["high"], state["low"])
        divisor = (F.shiftright(high, 1) + 1).cast("double")
        there = ((state["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / divisor)).cast("long")
        moved = F.struct(state["j"].alias("b"), there.alias("j"), high.alias("high"), low.alias("low"))
        return F.when(state["j"] < shards, moved).otherwise(state)

    # A key makes about ln(shards) jumps and never more than shards of them:
    # the second loop runs for the rare rows that the first does not finish.
    usual = min(shards, 8 + 4 * math.ceil(math.log(shards + 1)))
    state = F.aggregate(F.array_repeat(F.lit(0), usual), start, jump)
    if usual == shards:
        return state
    rest = F.array_repeat(F.lit(0), shards - usual)
    return F.aggregate(F.when(state["j"] < shards, rest).otherwise(F.array_repeat(F.lit(0), 0)), state, jump)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of an integer key (as unsigned 64 bits; null counts as 0), from 0 to ``shards`` - 1."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    return _jumps(F.coalesce(key.cast("long"), F.lit(0).cast("long")), shards)["b"].cast("int")


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard, slot: one row per document.

    ``size`` is the text's UTF-8 bytes plus 1 and ``text_crc32`` its CRC; a null
    text has neither bytes nor content, hence size 1 and CRC 0. ``grown_shard``
    is the shard once one more is appended: the same, or the new one. Rows with
    equal keys, null included (taken as 0), share a shard. Slots number a
    shard's rows without gaps, in order of key, CRC and size; equal rows get
    consecutive slots. Other columns are ignored.
    """
    key_or_zero = F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long"))
    narrow = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(text_or_empty(text)).cast("long") + 1).alias("size"),
        F.crc32(text_or_empty(text)).alias("text_crc32"),
        _jumps(key_or_zero, shards).alias("_jump"),
    )
    shard = F.col("_jump.b").cast("int")
    placed = narrow.select(
        "doc_id",
        "size",
        "text_crc32",
        shard.alias("shard"),
        F.when(F.col("_jump.j") == shards, F.lit(shards)).otherwise(shard).cast("int").alias("grown_shard"),
    )
    return gapless(placed, ["shard"], [F.col("doc_id").asc_nulls_first(), "text_crc32", "size"], slice_rows)


def write_shards(docs: DataFrame, root: str, shards: int, key: str = "doc_id") -> None:
    """Writes the documents below ``root``, a folder ``shard=k`` for each shard.
    Large shards are cut into files of the session's advisory size."""
    placed = docs.withColumn("shard", jump_shard(F.col(key), shards))
    placed.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(root)
