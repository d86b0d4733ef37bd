"""A corpus pipeline made of the text operators: each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, decontaminate, quality, repeats, simhash
from tagloom.llm.common import table
from tagloom.llm.queries import VOCABULARY
from tagloom.session import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the factorisation machine accepts; it is fitted on the labelled ones among them."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates."""
    return simhash.deduplicate(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that one with a smaller id holds."""
    shorter = repeats.cut_repeats(docs)
    return shorter.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else shorter


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their texts, and the text decoded from the ids."""
    vocabulary = bpe.read_vocabulary(VOCABULARY)
    return bpe.decode(bpe.encode(docs, vocabulary), vocabulary)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", encoding_stage),
]

#: SQL can express neither the fitted classifier nor encoding by ranked merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each one written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
