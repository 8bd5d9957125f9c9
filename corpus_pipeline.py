"""From raw documents to packed sequences: five stages, each a written table.

Every stage reads what its predecessor kept. All but the last return the columns of
``documents``; the last returns the packing. Rows that share an id stay or go together.
The ids to drop are written first, so that the join that drops them knows how many they
are: few are broadcast and the texts stay where they are, many are joined by key. All stages
share the executors, so each bounds the batches of texts that go to Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilospan.llm import decontam, langid, near_dup, packing, substrings
from kilospan.llm.common import bound_batches, kept, scratch
from kilospan.llm.queries import table, tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text is in none of the languages; adds nothing. The model
    learns from the labels of its input."""
    bound_batches(spark)
    found = kept(
        langid.identify(docs).where("rejected").select(
            F.col("doc_id").alias("__id"), F.col("row_tag").alias("__tag")
        ).distinct(),
        "rejected",
    )
    same = docs["doc_id"].eqNullSafe(found["__id"]) & (F.xxhash64(docs["text"]) == found["__tag"])
    return docs.join(found, same, "left_anti")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the least id. Documents are linked from
    a similarity of 0.8 on; those without words or without an id are in no group and stay."""
    bound_batches(spark)
    found = kept(
        near_dup.near_duplicates(docs, percent=80).where("not kept").select(
            F.col("doc_id").alias("__id")
        ).distinct(),
        "copies",
    )
    return docs.join(found, docs["doc_id"] == found["__id"], "left_anti")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines and passages but the first of each; n_chars follows."""
    bound_batches(spark)
    return substrings.without_spans(docs, substrings.repeated_spans(docs, whole_lines=True))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    bound_batches(spark)
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = kept(
        found.where("n_hit > 0").select(F.col("doc_id").alias("__id")).distinct(), "contaminated"
    )
    return docs.join(hit, docs["doc_id"] == hit["__id"], "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset."""
    bound_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
