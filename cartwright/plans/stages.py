"""Stages of a run and what is known to be done, so that a restarted run goes on where the last one ended.

After a stage has written its outputs, a record is written: a digest of the stage's settings
and of the files that went in, and of the files that came out. A stage is done if all of them are
still as recorded. Files are listed (path, length, time of change), not read.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.session import file_system
from cartwright.sources.sinks import replace_table, settle

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Stage:
    name: str
    #: paths or patterns that are read, and paths that are written
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    #: text of all parameters that the result depends on
    settings: str
    run: Callable[[], object]


def listing(spark: SparkSession, path: str) -> str:
    """Digest of the files under a path, whatever their order; a path without files has one too."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException:
        return "absent"
    one = F.xxhash64("path", "length", "modificationTime")
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.bit_xor(one).alias("x"),
                  F.sum(one.cast("decimal(38,0)")).alias("s")).first()
    return f"{r['n']}/{r['bytes']}/{r['x']}/{r['s']}"


def fingerprint(spark: SparkSession, settings: str, paths: Sequence[str]) -> str:
    parts = [settings, *(f"{p}={listing(spark, p)}" for p in paths)]
    return sha256("\n".join(parts).encode()).hexdigest()


class Records:
    """The records of a run, one small Parquet table per stage under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str) -> DataFrame | None:
        path = f"{self.root}/{name}"
        settle(self.spark, path)
        system, place = file_system(self.spark, path)
        return self.spark.read.parquet(path) if system.exists(place) else None

    def is_done(self, stage: Stage) -> bool:
        record = self._read(stage.name)
        row = None if record is None else record.first()
        for path in stage.outputs:
            settle(self.spark, path)
        return row is not None and (row["came_in"], row["went_out"]) == self._state(stage)

    def _state(self, stage: Stage) -> tuple[str, str]:
        return fingerprint(self.spark, stage.settings, stage.inputs), fingerprint(self.spark, "", stage.outputs)

    def forget(self, stage: Stage) -> None:
        system, place = file_system(self.spark, f"{self.root}/{stage.name}")
        system.delete(place, True)

    def write(self, stage: Stage) -> None:
        rows = self.spark.createDataFrame([(stage.name, *self._state(stage))], "stage string, came_in string, went_out string")
        replace_table(rows.coalesce(1), f"{self.root}/{stage.name}")


def run_stages(spark: SparkSession, stages: Sequence[Stage], root: str, resume: bool) -> list[str]:
    """Run the stages in order; with ``resume`` those that are done are passed over. Returns the names of those that ran."""
    records, ran = Records(spark, root), []
    for stage in stages:
        if resume and records.is_done(stage):
            log.info("stage %s is done", stage.name)
            continue
        records.forget(stage)  # while it runs, its outputs may be neither old nor new
        stage.run()
        records.write(stage)
        ran.append(stage.name)
    return ran
