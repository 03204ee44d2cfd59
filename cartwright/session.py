"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for. They are runtime settings, so a job can
# apply them to a session the cluster created.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # semi-joins of large line scans (10 GB and more, Spark's own threshold) drop unwanted rows by a
    # Bloom filter before the shuffle; the kept ids may come from up to this much, and take 32 MB at most
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "27000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "268435456",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


@lru_cache(maxsize=1)
def _test_root() -> str:
    return tempfile.mkdtemp(prefix="cartwright-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names the root in ``spark.checkpoint.dir``. Where that is unset,
    a local temporary folder serves a single-machine session, which has no other
    machine to share with; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _test_root()
    return f"{root.rstrip('/')}/cartwright/{name}-{uuid.uuid4().hex}"


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate when the application ends; results that read it work until then."""
    system, folder = file_system(spark, path)
    system.deleteOnExit(folder)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Runtime settings (dots written as ``__``) that hold inside."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for plans that read it several times."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
