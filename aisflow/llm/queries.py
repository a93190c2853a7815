"""The registered queries of this subpackage: (spark, folder of the test tables) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisflow.llm import (
    bpe,
    fingerprints,
    near_dups,
    packing,
    prefix_trie,
    quality_model,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    turn_repair,
    url_filters,
    warc,
)
from aisflow.storage import scratch_path, written

Query = Callable[[SparkSession, str], DataFrame]

REGISTERED: dict[str, Query] = {}


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@registered
def op1_length_buckets(spark, folder):
    return packing.pack(_table(spark, folder, "documents"))


@registered
def op2_jump_shards(spark, folder):
    return sharding.assign(_table(spark, folder, "documents"), 8).withColumn("law", F.lit("key"))


#: The rules that the query applies.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@registered
def op3_url_sweep(spark, folder):
    rules = spark.createDataFrame(url_filters.parse_rules(URL_RULES), url_filters.RULE_SCHEMA)
    return url_filters.judge(_table(spark, folder, "pages"), rules)


@registered
def op4_warc_captures(spark, folder):
    archive = scratch_path(spark, "warc")
    warc.write(_table(spark, folder, "pages"), archive)
    records = written(warc.read(spark, archive, payloads=False), "records")
    captures = warc.page_ids(warc.assemble(records), records)
    return captures.select(
        "page_id",
        F.col("response.bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        "refers_to",
        F.col("request.uri").alias("request_uri"),
    )


@registered
def op5_subword_quality(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model.train(docs, _table(spark, folder, "labels"))
    return quality_model.classify(docs, model)


@registered
def op6_rule_ledger(spark, folder):
    marks = quality_rules.stored(_table(spark, folder, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality_rules.verdicts(marks).select("doc_id", *counts, "failed", "base_failed", "kept", "only_rule", "only_rule_docs")


@registered
def op7_secret_ledger(spark, folder):
    docs = _table(spark, folder, "documents")
    ledger = scratch_path(spark, "secret-ledger")
    secret_scan.update(docs, ledger)
    found = secret_scan.with_findings(docs.select("doc_id", "text"), ledger)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


@registered
def op8_byte_bpe(spark, folder):
    encoded = _table(spark, folder, "documents").select("doc_id", bpe.encode(F.col("text")).alias("ids"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.id_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


@registered
def op9_chosen_path(spark, folder):
    return near_dups.near_duplicates(_table(spark, folder, "documents"), shingle_words=2)


@registered
def op10_merkle_prints(spark, folder):
    found = fingerprints.compare_with_edits(_table(spark, folder, "documents"))
    places = fingerprints.changed_sections(F.col("fingerprint"), F.col("edited_fingerprint"))
    return found.withColumn("changed_sections", F.array_join(places.cast("array<string>"), ","))


@registered
def op11_lightest_repair(spark, folder):
    return turn_repair.repair_conversations(_table(spark, folder, "conversations"))


@registered
def op12_ternary_trie(spark, folder):
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


@registered
def op13_byte_positions(spark, folder):
    return simhash.near_duplicates(_table(spark, folder, "documents"))
