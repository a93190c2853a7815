"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all that the one before it kept and is written as Parquet
before the next one reads it, so a lost executor costs a part of one stage.

What holds for every stage: a null or empty text is a text without words, texts
are read whole whatever their length, repeated rows share one verdict, an empty
table gives an empty one, and further columns go along unread.
"""

from pyspark.sql import DataFrame, SparkSession

from aisflow.llm import bpe, near_dups, packing, quality_model, quality_rules, secret_scan
from aisflow.storage import job, scratch_path, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the production policy go; those with null, empty or short texts are among them."""
    return quality_rules.keep(docs, quality_rules.PRODUCTION)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go. It is fitted on a bounded
    sample of the labelled rows of the whole corpus, as rules have removed most bad examples here.
    A null or empty text has the score of the bias alone."""
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.keep(docs, quality_model.train(corpus, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id.
    Documents without words or without id all stay."""
    return near_dups.keep(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes, and a null text stays null."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as byte-level BPE ids, cut at the context length; each piece gets its bucket,
    batch and place. The ids of a document's pieces in order decode to its masked text; a null or
    empty text is one piece without ids."""
    return packing.pack_pieces(bpe.id_pieces(docs, packing.CONTEXT))


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("near duplicates", near_duplicates),
    ("secret scan", secrets),
    ("packing", pack),
]

#: SQL cannot express the trained classifier; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What the stages write on the way is removed."""
    packed = scratch_path(spark, "packed")
    with job(spark):
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for _, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), "stage")
        result = STAGES[-1][1](spark, docs, sf_dir)
        result.write.parquet(packed)
    return spark.read.schema(result.schema).parquet(packed)
