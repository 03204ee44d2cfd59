"""Writers of the stage outputs.

An output is written beside its place and moved there when it is complete, so a job that is
killed while it writes leaves the old output as it was. The move is two renames; should a job
end between them, ``settle`` puts the old output back before the next one writes or reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.session import file_system

#: what stands behind a path while its output is replaced
STAGED, REPLACED = "__staged", "__replaced"
MONTH = "order_month"


def settle(spark: SparkSession, path: str) -> None:
    """Put back an output that was moved aside and never replaced, drop one that was."""
    system, place = file_system(spark, path)
    _, aside = file_system(spark, f"{path}{REPLACED}")
    if not system.exists(aside):
        return
    if system.exists(place):
        system.delete(aside, True)
    else:
        system.rename(aside, place)


def replace_table(df: DataFrame, path: str, *partitions: str) -> None:
    """Write Parquet beside ``path``, then take its place."""
    spark, path = df.sparkSession, path.rstrip("/")
    settle(spark, path)
    staged_path = f"{path}{STAGED}-{uuid.uuid4().hex}"
    system, staged = file_system(spark, staged_path)
    try:
        out = df.write.mode("errorifexists")
        (out.partitionBy(*partitions) if partitions else out).parquet(staged_path)
    except BaseException:
        system.delete(staged, True)
        raise
    _, place = file_system(spark, path)
    _, aside = file_system(spark, f"{path}{REPLACED}")
    if system.exists(place) and not system.rename(place, aside):
        raise OSError(f"{path} cannot be moved aside")
    if not system.rename(staged, place):
        settle(spark, path)
        raise OSError(f"{staged_path} cannot be moved to {path}")
    system.delete(aside, True)


def write_features(df: DataFrame, path: str, by_month: bool = False, only_months: bool = False,
                   counted: Mapping[str, Column] | None = None) -> dict[str, object]:
    """Parquet with the customer id as text.

    ``by_month`` lays order features out by order month, so that a customer
    run reads only the months after its cutoff. The rebalance hint evens out
    file sizes and splits a month that is much larger than the others. With ``only_months`` the months that the
    frame holds are replaced and all others stay.

    ``counted`` are aggregates of the rows that are written, observed in the tasks that write them (each of
    which counts once, however often it is tried); their values are returned.
    """
    out = df.withColumn(N.CUSTOMER_ID, F.col(N.CUSTOMER_ID).cast("string"))
    if by_month:
        out = out.withColumn(MONTH, F.date_format("order_placed_datetime", "yyyy-MM")).hint("rebalance", MONTH)
    seen = Observation() if counted else None
    if seen is not None:
        out = out.observe(seen, *[c.alias(name) for name, c in counted.items()])
    if only_months and by_month:
        settle(df.sparkSession, path.rstrip("/"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    else:
        replace_table(out, path, *([MONTH] if by_month else []))
    return {} if seen is None else dict(seen.get)
