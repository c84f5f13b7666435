"""Named queries over the given tables, one per operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedfold.llm import (
    block_topk,
    embedding_dedup,
    exact_dedup,
    licenses,
    merkle,
    mixing,
    near_dedup,
    packing,
    quality,
    substring_dedup,
    toxicity,
    vector_codes,
    warc,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)  # the same vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op2_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents")).drop("chars")


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_notices(_table(spark, sf_dir, "documents"))


def op6_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER, ranks=RANKS))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


def op12_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_k(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc_transactions,
        op2_quality_discriminant,
        op3_exact_dedup,
        op4_repeated_passages,
        op5_license_scan,
        op6_hilbert_packing,
        op7_toxicity,
        op8_pfair_mixing,
        op9_minhash_dedup,
        op10_embedding_dedup,
        op11_vector_codes,
        op12_block_topk,
        op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = {
    "op1_warc_transactions": warc.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op5_license_scan": licenses.oracle(),
    "op11_vector_codes": vector_codes.ORACLE,
    "op12_block_topk": block_topk.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
