"""The operators bound to the driver's tables with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelprep.llm import (
    fm_decontam, katz, merkle, minhash, mixing, oracles, outliers, packing, quality_trees, repeats, shard_order, token_pairs, token_store, url_filters)
from panelprep.llm.common import table


def tokenizer_path() -> str:
    """The production tokenizer's file, which every executor has."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages")).drop("n_candidates")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_order.shard_plan(table(spark, sf_dir, "documents"), shards=24)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("key", "class_key")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op7_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(mixing.mix_plan(table(spark, sf_dir, "documents")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_pairs.align_documents(table(spark, sf_dir, "documents"), *paths)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.proofs(merkle.build(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], {"text": tampered}))


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_token_store, op3_quality, op4_sharding, op5_minhash, op6_repeats, op7_outliers, op8_katz, op9_mixing, op10_decontamination,
    op11_alignment, op12_packing, op13_merkle)}
ORACLES = oracles.ORACLES
