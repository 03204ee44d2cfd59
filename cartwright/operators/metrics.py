"""Data-quality counters of a run, as a DataFrame instead of log lines."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def counted(df: DataFrame, metrics: Mapping[tuple[str, str], Column]) -> DataFrame:
    """(step, metric, value) rows of several steps from one aggregate over ``df``."""
    row = df.agg(*[c.cast("string").alias(f"_{i}") for i, c in enumerate(metrics.values())])
    names = ("step", "metric", "value")
    lines = [F.struct(*[c.alias(n) for c, n in zip((F.lit(s), F.lit(m), F.col(f"_{i}")), names)])
             for i, (s, m) in enumerate(metrics)]
    return row.select(F.inline(F.array(*lines)).alias(*names))


def counters(step: str, df: DataFrame, **metrics: Column) -> DataFrame:
    """The same for one step."""
    return counted(df, {(step, name): c for name, c in metrics.items()})


def observed(spark: SparkSession, step: str, values: Mapping[str, object]) -> DataFrame:
    """(step, metric, value) rows of values that a write has counted."""
    lines = [(step, name, None if v is None else str(v)) for name, v in values.items()]
    return spark.createDataFrame(lines, "step string, metric string, value string")


def rows(where: Column | None = None) -> Column:
    return F.count(F.lit(1)) if where is None else F.count_if(where)


def missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def hits(column: str) -> Column:
    return F.count_if(F.col(column))


def duplicate_keys(step: str, dim: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once in a dimension and so multiply facts."""
    per_key = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counters(step, per_key, duplicate_keys=F.count_if(F.col("_n") > 1))


def collect_counters(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
