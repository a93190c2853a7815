"""Jump hashing against the published loop; slots without gaps."""

from collections import Counter, defaultdict

from cases import TEXTS, clashing, crc, documents, rows_of
from pyspark.sql import functions as F

from aisflow.llm import sharding


def jump(key, shards):
    key &= 2**64 - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * sharding.MULTIPLIER + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


KEYS = [0, 1, 2, 10, 12345, 2**31, 2**32 - 1, 2**32, 2**62 + 5, 2**63 - 1, -1, -2, -(2**63), *range(1000, 1200)]


def test_published_algorithm(spark):
    frame = spark.createDataFrame([(k,) for k in KEYS], "k long")
    for shards in (1, 2, 8, 9, 100, 5000):
        got = {r.k: r.s for r in frame.select("k", sharding.jump_shard(F.col("k"), shards).alias("s")).collect()}
        assert got == {k: jump(k, shards) for k in KEYS}


def test_known_values():
    # from published implementations
    assert [jump(10863919174838991, 11), jump(1, 1), jump(256, 1024)] == [6, 0, 520]


def test_growth_moves_rows_only_into_the_new_shard(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.assign(docs, 8).collect()
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert {(r.doc_id, r.grown_shard) for r in rows} == {(k, jump(k, 9)) for k in range(20_000)}
    moved = sum(r.grown_shard == 8 for r in rows)
    assert abs(moved - 20_000 / 9) < 200
    assert max(Counter(r.shard for r in rows).values()) < 1.1 * 20_000 / 8


def test_slots_have_no_gaps_and_do_not_depend_on_the_run(spark):
    docs = documents(spark)
    hot = docs.union(docs.where("doc_id = 7").crossJoin(spark.range(300)).drop("id"))
    first = sharding.assign(hot, 8, slice_rows=5)
    rows = rows_of(first)
    again = rows_of(sharding.assign(clashing(hot).repartition(5), 8, slice_rows=5))
    assert rows == again
    slots = defaultdict(list)
    for r in first.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())
    expected = Counter((d, len((t or "").encode()) + 1, crc(t)) for d, t, *_ in (tuple(r) for r in hot.collect()))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in first.collect()) == expected


def test_slots_follow_the_order_in_any_number_of_slices(spark):
    docs = documents(spark)
    hot = docs.union(docs.where("doc_id = 7").crossJoin(spark.range(300)).drop("id"))
    rows = sorted(sharding.assign(hot, 3, slice_rows=5).collect(), key=lambda r: (r.shard, r.slot))
    key = [(r.shard, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]) for r in rows]
    assert key == sorted(key)
    assert rows_of(sharding.assign(hot, 3)) == sorted((tuple(r) for r in rows), key=repr)


def test_null_texts_and_ids(spark):
    rows = {r.doc_id: r for r in sharding.assign(documents(spark), 8).collect()}
    assert (rows[100]["size"], rows[100].text_crc32) == (1, 0)
    assert rows[None].shard == jump(0, 8)
    assert rows[83]["size"] == len(TEXTS[17].encode()) + 1


def test_empty_table(spark):
    assert sharding.assign(documents(spark).limit(0), 8).collect() == []


def test_write_shards(spark, tmp_path):
    docs = documents(spark)
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back.drop("shard")) == rows_of(docs)
    assert all(r["shard"] == jump(r.doc_id or 0, 4) for r in back.collect())
