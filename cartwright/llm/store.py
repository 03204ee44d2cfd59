"""Written intermediates of the operators in this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cartwright.session import delete_at_exit, shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside give their shuffle files back when they end, not when the application does."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder that all executors share and read it back.

    The result has no lineage before the written files, so a lost executor
    costs one scan and never a recomputation of what came before. The shuffle files behind it go at
    once, the written files when the application ends.
    """
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with more underscores in front while it is taken."""
    while name in columns:
        name = "_" + name
    return name
