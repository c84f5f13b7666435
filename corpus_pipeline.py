"""Corpus pipeline: toxic documents go, then copies, then near copies; the rest is mixed by source and packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedfold.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from feedfold.llm.common import stage
from feedfold.llm.queries import RANKS, TOKENIZER

RUN_ROWS = packing.RUN_SLOTS * mixing.BLOCK_ROWS

#: None: classifier, exact comparison of shingle sets and tokenizer are not expressible in SQL.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go; labels teach, documents are those of the stage."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest stays."""
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (80 % of 5-word shingles) stays."""
    return near_dedup.drop_near_duplicates(docs, 5)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the schedule that gives each source its target weight."""
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 2048 tokens, in the order that the mixing stage has written.

    Along that order documents go by ranges of RUN_ROWS, within each by the curve. Rows that come from no table have no written
    order and are scheduled here.
    """
    written = packing.in_written_order(docs) is not None
    return packing.digests(packing.pack(docs, TOKENIZER, mixed=not written, kept_rows=RUN_ROWS if written else None, ranks=RANKS))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
