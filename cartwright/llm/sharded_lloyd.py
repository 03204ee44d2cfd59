"""Centroid clustering by Lloyd's rounds, sharded by dimension, in exact integers.

Vectors are cut into ``shards`` column blocks. The rows are (chunk, shard): the block of ``CHUNK``
vectors as one matrix. In a round, a task holds the centroids' slice of a shard next to such a
row and computes the block's part of all squared distances; the parts of a chunk meet
under its number, are added, and the smallest sum names each vector's centroid (ties: the smaller
number). With that, every shard adds up its own columns by centroid, first within a
task, and puts the floor of the mean into its slice. A round reads the written chunks and leaves
nothing but the centroids (``k`` times the dimensions, both parameters), so rounds build no
lineage and a lost executor costs tasks of one round.

Components are integers, floor(``SCALE`` * x). Parts are computed as products of doubles only
where those are exact, otherwise in 64 bits.

Defined results: vectors that are null, of another length, or hold a null or non-finite
component take no part; a component beyond 2**27 after scaling is an error, as its
distances may not fit a long. Repeated rows all count; a null id passes through, and starts no
centroid unless there are fewer ids than centroids; equal ids start centroids in the order of their vectors. Fewer
vectors than ``k`` give as many centroids; an empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.store import saved, shuffles_freed

SCALE = 256
CHUNK = 1024
WIDEST = 1 << 27


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has ``size`` components, all of them finite; never null."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce((F.size(vector) == size) & ~F.exists(vector, bad), F.lit(False))


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exact."""
    scaled = np.floor(values * float(SCALE))
    if scaled.size and np.abs(scaled).max() > WIDEST:
        raise ValueError(f"a component is beyond {WIDEST} after scaling")
    return scaled.astype(np.int64)


def narrowed(values: np.ndarray) -> bytes:
    """Bytes of the smallest integer type that holds all values; the length tells which."""
    most = int(np.abs(values).max(initial=0))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return values.astype(kind).tobytes()


def widened(data: bytes, rows: int, columns: int) -> np.ndarray:
    kind = f"<i{len(data) // (rows * columns)}"
    return np.frombuffer(data, kind).reshape(rows, columns).astype(np.int64)


def blocks(size: int, shards: int) -> list[tuple[int, int]]:
    """(first, last + 1) column of every shard."""
    ends = [size * i // shards for i in range(shards + 1)]
    return list(zip(ends, ends[1:]))


CHUNKS = "chunk long, shard int, n int, ids array<long>, cells binary"


def _chunks(batches: Iterator[pa.RecordBatch], size: int, shards: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        values = integers(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size))
        ids = batch.column("id").to_pylist()
        for at in range(0, len(ids), CHUNK):
            rows = values[at:at + CHUNK]
            yield pa.RecordBatch.from_pylist([
                # the ids go with the first shard
                {"chunk": number, "shard": s, "n": len(rows), "ids": ids[at:at + CHUNK] if s == 0 else None, "cells": narrowed(rows[:, a:b])}
                for s, (a, b) in enumerate(blocks(size, shards))
            ], pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int64())), ("cells", pa.binary())]))
            number += 1


def partial_distances(cells: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of the rows to the centers in these columns."""
    reach = int(np.abs(cells).max(initial=0)) * int(np.abs(centers).max(initial=0)) * cells.shape[1]
    if reach < 1 << 53:
        product = (cells.astype(np.float64) @ centers.T.astype(np.float64)).astype(np.int64)
    else:
        product = cells @ centers.T
    return (cells * cells).sum(axis=1)[:, None] - 2 * product + (centers * centers).sum(axis=1)[None, :]


def _parts(batches: Iterator[pa.RecordBatch], centers: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    cuts = blocks(centers.shape[1], shards)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            (a, b), n = cuts[row.column("shard")[0].as_py()], row.column("n")[0].as_py()
            found = partial_distances(widened(row.column("cells")[0].as_py(), n, b - a), centers[:, a:b])
            # what exceeds the least of a row needs fewer bytes than the distances themselves
            least = found.min(axis=1)
            more = [pa.array([narrowed(x)], pa.binary()) for x in (found - least[:, None], least)]
            yield pa.RecordBatch.from_arrays([*row.columns, *more], names=[*row.schema.names, "part", "least"])


def _added(group: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, distance) of each vector of a chunk, from the parts of its shards."""
    n = int(group["n"].iloc[0])
    total = np.zeros((n, k), np.int64)
    for part, least in zip(group["part"], group["least"]):
        total += widened(part, n, k) + widened(least, n, 1)
    label = total.argmin(axis=1)  # the first of equal ones
    return label, total[np.arange(n), label]


def _sums(group: pd.DataFrame, k: int, size: int, shards: int) -> pd.DataFrame:
    """Per shard and centroid: members and the sums of the shard's columns over them."""
    label, _ = _added(group, k)
    order = np.argsort(label, kind="stable")
    found, first, counts = np.unique(label[order], return_index=True, return_counts=True)
    cuts = blocks(size, shards)
    out = []
    for shard, n, cells in zip(group["shard"], group["n"], group["cells"]):
        a, b = cuts[shard]
        sums = np.add.reduceat(widened(cells, n, b - a)[order], first, axis=0)
        out += [(shard, int(c), int(m), row.tolist()) for c, m, row in zip(found, counts, sums)]
    return pd.DataFrame(out, columns=["shard", "cluster", "members", "sums"])


def _labels(group: pd.DataFrame, k: int) -> pd.DataFrame:
    label, distance = _added(group, k)
    ids = next(x for x in group.sort_values("shard")["ids"])
    return pd.DataFrame({"ids": [ids], "cluster": [label.astype(np.int32)], "distance": [distance]})


def _met(chunks: DataFrame, centers: np.ndarray, shards: int):
    return chunks.mapInArrow(partial(_parts, centers=centers, shards=shards), f"{CHUNKS}, part binary, least binary").groupBy("chunk")


def updated(chunks: DataFrame, centers: np.ndarray, shards: int) -> np.ndarray:
    """The centroids after one round; one that has no vector stays."""
    k, size = centers.shape
    sums = _met(chunks, centers, shards).applyInPandas(
        lambda group: _sums(group, k, size, shards), "shard int, cluster int, members long, sums array<long>")
    columns = sums.select("shard", "cluster", "members", F.posexplode("sums").alias("column", "value"))
    slices = columns.groupBy("shard", "cluster", "column").agg(F.sum("members").alias("n"), F.sum("value").alias("total"))
    means = slices.select("shard", "cluster", "column", F.expr("(total - pmod(total, n)) div n").alias("mean"))
    moved, cuts = centers.copy(), blocks(size, shards)
    with shuffles_freed(chunks.sparkSession):
        found = means.collect()  # as many rows as the centroids have components, at most
    for r in found:
        moved[r["cluster"], cuts[r["shard"]][0] + r["column"]] = r["mean"]
    return moved


def first_centers(kept: DataFrame, k: int, size: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose id has the smallest hash."""
    mark = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), "UTF-8"), 256)
    rows = kept.orderBy(mark.asc_nulls_last(), "v").limit(k).collect()
    return integers(np.array([r["v"] for r in rows], np.float64).reshape(-1, size))


def digest(center: np.ndarray) -> str:
    return sha256(",".join(map(str, center.tolist())).encode()).hexdigest()


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, size: int = 64,
            shards: int = 4, seed: int = 2) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    spark = rows.sparkSession
    kept = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(usable(F.col("v"), size))
    centers = first_centers(kept, k, size, seed)
    if not len(centers):
        return spark.createDataFrame([], RESULT)
    chunks = saved(kept.mapInArrow(partial(_chunks, size=size, shards=shards), CHUNKS), "lloyd-chunks")
    for _ in range(rounds):
        centers = updated(chunks, centers, shards)
    lists = _met(chunks, centers, shards).applyInPandas(
        lambda group: _labels(group, len(centers)), "ids array<long>, cluster array<int>, distance array<long>")
    found = saved(lists.select(F.inline(F.arrays_zip("ids", "cluster", "distance")).alias("vec_id", "cluster", "distance")), "lloyd-labels")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per centroid
    whole = sum(sums.values())
    stats = spark.createDataFrame([(c, s, whole, digest(centers[c])) for c, s in sums.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(stats), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
