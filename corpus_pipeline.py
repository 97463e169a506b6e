"""From raw documents to packed training sequences, in four stages.

Each stage gets all that the one before kept, as written to the shared folder, and all but
the last return the columns of ``documents``. Null text counts as empty, rows with null or
repeated ids are documents like others, an empty table stays empty, and further columns
go along unchanged up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfold.llm import near_duplicates, packing, quality, secret_scan
from landfold.llm.shared import table
from landfold.workspace import materialise

#: SQL has no compressor, no minhash and no tokenizer: the tests compare with brute force.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    model = quality.train_on(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(model, F.col("text")) >= 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return near_duplicates.deduplicated(docs, words=5, percent=80)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by what kind they are."""
    clean = secret_scan.redact(docs.withColumn("_landfold_before", F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col("_landfold_before"))
    return clean.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    ).select(docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and its place there."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_filter),
    ("near dedup", near_dedup),
    ("secret scan", secret_redaction),
    ("packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
