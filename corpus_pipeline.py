"""The corpus pipeline: documents to packed sequences, in four stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``. The first
learns from the ``labels`` table beside the documents; a stage of an empty
table returns an empty table.

All stages run in the same executors, whose Python workers keep what their
largest Arrow batch took, and what a stage returns runs when the caller writes
it. So each stage first bounds the session's Arrow batches (``small_batches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeshift.llm import bottom_k, bpe, decision_list, packing, sentence_spans
from lakeshift.llm.common import BATCH_BYTES_KEY, Stage, small_batches, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list rejects go (operator 4)."""
    small_batches(spark)
    return decision_list.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 or more (operator 6)."""
    small_batches(spark)
    return bottom_k.keep_first(docs, width=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of repeated spans go from all but the first document (operator 3)."""
    small_batches(spark)
    return sentence_spans.remove_repeats(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a packed sequence (operator 10)."""
    small_batches(spark)
    return packing.pack(docs, bpe.default_vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", substrings),
    ("packing", pack),
]

#: Learned rules and byte-pair ids can't be expressed in SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    written = Stage(spark, "pipeline")
    before = spark.conf.get(BATCH_BYTES_KEY)
    try:
        for k, (_, stage) in enumerate(STAGES):
            docs = written.write(stage(spark, docs, sf_dir), f"stage{k}")
    finally:
        spark.conf.set(BATCH_BYTES_KEY, before)
    return docs
