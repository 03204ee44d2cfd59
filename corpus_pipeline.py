"""Corpus pipeline: documents through quality rules, language ID, near-dedup and packing.

Each stage takes what its predecessor kept, written as Parquet. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import language_id, quality_rules, simhash
from cartwright.llm.queries import packing_digest
from cartwright.llm.store import fresh, saved

#: a text further from every language than this is in none of them
LEAST_SCORE = 0.25


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, repeated rows and null ids among them; a null text has no word and goes."""
    return quality_rules.judged(docs).where("kept").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter (null texts too), or unlike every learned profile, go.

    Equal texts fare alike, so repeated rows stay or go together; ties between languages do not matter here. If
    no row has a label, nothing is learned and nothing stays.
    """
    found = language_id.identified(docs)
    kept = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the smallest id, then the smallest text hash.

    Links are those of op10: fingerprints of three-word shingles that differ in three bits or fewer. Rows
    alike in id and text are one document. A null id stays only where its component has no other; texts without a
    word are one component. An empty table stays empty.
    """
    found = simhash.near_duplicates(docs)
    member = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    chosen = found.groupBy("root").agg(F.min(member).alias("m")).select(
        F.col("m.id").alias("id"), F.col("m.text_hash").alias("hash"))
    mark = fresh("text_hash", docs.columns)
    marked = docs.withColumn(mark, F.xxhash64("text")).alias("d")
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("c.id")) & (F.col(f"d.{mark}") == F.col("c.hash"))
    return marked.join(chosen.alias("c"), same, "left_semi").dropDuplicates(["doc_id", mark]).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 1024 tokens; null texts are their end token, repeated rows all count."""
    return packing_digest(docs)


STAGES = [("quality rules", quality), ("language id", language), ("near-dedup", near_dedup), ("best-fit packing", pack)]

# packing by a genetic algorithm is not SQL; tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
