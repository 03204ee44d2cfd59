"""Registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import (
    byte_bpe, chat_format, language_id, license_scan, merkle, multi_index, packing, quality_rules, sharded_lloyd, sharding, simhash,
    url_filter, vector_packing,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judge(docs, carry=["doc_id"])


def packing_digest(docs: DataFrame) -> DataFrame:
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs, carry=["doc_id"])


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multi_index.search(rows, rows.where(F.col("vec_id") % 20 == 0))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of raw transcripts made from ``conversations``, turns run together; learned from three quarters of them."""
    pieces = chat_format.raw_transcripts(_table(spark, sf_dir, "conversations"))
    shown = pieces.where(~language_id.held_out(F.col("conv_id")))
    model = chat_format.learn(chat_format.lines(shown, "conv_id", "turn", "text", carry="role"))
    return chat_format.parse(chat_format.run_on(pieces.drop("role")), model)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).drop("url")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``key``: doc_id and the shard count decide."""
    placed = sharding.external_shuffle(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("key").alias("law"),
        "shard", "slot", sharding.grown(F.col("doc_id")).alias("grown_shard"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.coded_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = vector_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select(
        F.col("id").alias("doc_id"), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document, by the checksum of its id, is checked with its text in lower case."""
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(third, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    rows = merkle.manifest(_table(spark, sf_dir, "documents"), tampered={"text": text})
    return rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_lloyd.cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = (
    op1_quality_rules, op2_packing, op3_language_id, op4_multi_index, op5_license_scan, op6_chat_format, op7_url_filter, op8_sharding,
    op9_byte_bpe, op10_simhash, op11_vector_packing, op12_merkle, op13_sharded_lloyd,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}
