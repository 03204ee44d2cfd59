"""Nearest neighbours by inner product through an inverted multi-index.

Vectors are cut into two halves, each quantised by a codebook of its own; a cell is
a pair of centroids. A query visits cells in the order of the summed distance of its
halves to the two centroids, taken from a heap over the two sorted lists, until it has
seen ``cells`` of them. Their entries are reranked by the exact inner product in double
precision. Codebooks are fitted on a bounded sample and grow with the data, up to an eighth of the
sample each; every vector is indexed. The number of cells is not guessed: for a bounded sample of queries
the true neighbours are found by a full scan, and it is what ``recall`` of them need. No table of cells exists
anywhere: a query is sent on with the summed distance at which its heap stopped, and that opens the cells.

Equal vectors are one entry with its smallest ids (no query can return more of them);
equal query vectors are searched once. Cell rows (first centroids) that lie together form groups of about
``entry_block`` entries; a larger row is cut by hash. Groups meet blocks of queries, so no task holds a whole hot cell.

Defined results: vectors that are null, zero, hold a null or a non-finite component, or
whose length is not the most frequent one (ties: the longer) take no part, as query
or candidate; so do null ids. With no more candidates than ``least_budget`` the result is
exact. Repeated rows (same id and vector) are one; a repeated id with other vectors
is a candidate with each of them. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.store import saved


#: so many pairs of group and query block are broadcast, to send entries only where a query asks; beyond, all blocks meet
MEETINGS = 1 << 20


@dataclass(frozen=True)
class Index:
    top: int = 20
    #: the sample that codebooks are fitted on: so many rows, and so many components in all; rows of the one that sets the budget
    fit_sample: int = 20_000
    fit_values: int = 8_000_000
    probe_sample: int = 128
    recall: float = 0.96
    #: cells enough for so many entries are visited at least
    least_budget: int = 1000
    iterations: int = 10
    entry_block: int = 4096
    query_block: int = 2048
    seed: int = 3


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part; v as doubles."""
    v = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.where(F.size("v") == (sizes["size"] if sizes else 0))


def fit(sample: np.ndarray, k: int, iterations: int, seed: int) -> np.ndarray:
    """k-means centroids of a bounded sample."""
    rng = np.random.default_rng(seed)
    points = np.unique(sample, axis=0)
    k = min(k, len(points))
    centroids = points[rng.choice(len(points), k, replace=False)]
    for _ in range(iterations):
        nearest = assign(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        n = np.bincount(nearest, minlength=k)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def assign(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(axis=1)[None, :] - 2 * points @ centroids.T).argmin(axis=1)


def distances(q: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    half = books[0].shape[1]
    return ((books[0] - q[:half]) ** 2).sum(axis=1), ((books[1] - q[half:]) ** 2).sum(axis=1)


def visited(first: np.ndarray, second: np.ndarray, cells: int) -> Iterator[tuple[float, int, int]]:
    """(summed distance, centroid, centroid) of the nearest ``cells`` cells, nearest first."""
    rows, columns = first.argsort(kind="stable").tolist(), second.argsort(kind="stable").tolist()
    a, b = first[rows].tolist(), second[columns].tolist()
    heap = [(a[0] + b[0], 0, 0)]
    while heap and cells:
        total, i, j = heap[0]
        yield total, rows[i], columns[j]
        cells -= 1
        if j + 1 < len(b):
            heapq.heapreplace(heap, (a[i] + b[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


def reach(first: np.ndarray, second: np.ndarray, cells: int) -> float:
    """The summed distance at which the heap has seen ``cells`` cells."""
    total = 0.0
    for total, _, _ in visited(first, second, cells):
        pass
    return total


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _cells(batches: Iterator[pa.RecordBatch], books) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        m = _matrix(batch.column("v"))
        half = books[0].shape[1]
        made = [pa.array(assign(m[:, :half], books[0]).astype(np.int32)), pa.array(assign(m[:, half:], books[1]).astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "c1", "c2"])


def _full_scan(batches: Iterator[pa.RecordBatch], ids: list[int], q: np.ndarray, top: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        own = np.array(batch.column("eid"))
        scores = q @ _matrix(batch.column("v")).T
        scores[np.array(ids)[:, None] == own[None, :]] = -np.inf
        best = np.argsort(-scores, axis=1, kind="stable")[:, :top]
        n = best.shape[1]
        columns = [np.repeat(np.arange(len(ids)), n), np.take_along_axis(scores, best, 1).ravel()]
        cells = [np.array(batch.column(c))[best.ravel()].astype(np.int32) for c in ("c1", "c2")]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, *cells)], names=["q", "score", "c1", "c2"])


def cells_for(entries: DataFrame, sample: list, books, n: int, index: Index) -> int:
    """Cells to visit so that ``recall`` of the true neighbours of the sampled queries are among them."""
    q = np.array([r["v"] for r in sample])
    found = entries.select("eid", "v", "c1", "c2").mapInArrow(
        partial(_full_scan, ids=[r["eid"] for r in sample], q=q, top=index.top), "q long, score double, c1 int, c2 int")
    true = found.where(F.col("score") > float("-inf")).withColumn("r", F.row_number().over(
        Window.partitionBy("q").orderBy(F.desc("score")))).where(F.col("r") <= index.top).select("q", "c1", "c2").collect()
    needed = []
    for r in true:  # ``top`` of every sampled query
        first, second = distances(q[r["q"]], books)
        # cells that are no farther, row by row
        needed.append(int(np.searchsorted(np.sort(second), first[r["c1"]] + second[r["c2"]] - first, side="right").sum()))
    every = len(books[0]) * len(books[1])
    least = -(-every * index.least_budget // n)
    return min(every, max(least, int(np.quantile(needed, index.recall)) + 1 if needed else 0))


@dataclass(frozen=True)
class Groups:
    """Cell rows in groups of about equal size; ``of`` gives the group of a row, ``blocks`` the blocks of a group."""

    of: np.ndarray
    blocks: np.ndarray


def grouped(book: np.ndarray, sizes: np.ndarray, block: int) -> Groups:
    """Rows that lie together along the main direction of their centroids share a group of up to ``block`` entries."""
    centered = book - book.mean(axis=0)
    along = centered @ np.linalg.svd(centered, full_matrices=False)[2][0] if book.shape[1] else np.zeros(len(book))
    of, held = np.zeros(len(book), np.int32), [0]
    for row in np.argsort(along, kind="stable").tolist():
        if held[-1] and held[-1] + sizes[row] > block:
            held.append(0)
        of[row] = len(held) - 1
        held[-1] += int(sizes[row])
    return Groups(of, np.maximum(1, -(-np.array(held) // block)).astype(np.int32))


def _dealt(batches: Iterator[pa.RecordBatch], groups: Groups) -> Iterator[pa.RecordBatch]:
    """Entries with their group and its number of blocks."""
    for batch in batches:
        grp = groups.of[np.array(batch.column("c1"))] if batch.num_rows else np.empty(0, np.int32)
        made = [pa.array(grp, pa.int32()), pa.array(groups.blocks[grp], pa.int32())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "grp", "blocks"])


def _probes(batches: Iterator[pa.RecordBatch], books, cells: int, groups: Groups) -> Iterator[pa.RecordBatch]:
    """(q, v, far, grp, blocks) per group that a query visits; its open cells are those no farther than ``far``."""
    for batch in batches:
        at, far, grp = [], [], []
        for i, v in enumerate(_matrix(batch.column("v")) if batch.num_rows else []):
            first, second = distances(v, books)
            stop = reach(first, second, cells)
            visits = np.unique(groups.of[first + second.min() <= stop])
            at += [i] * len(visits)
            far += [stop] * len(visits)
            grp.append(visits)
        found = np.concatenate(grp) if grp else np.empty(0, np.int32)
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("q").take(rows), batch.column("v").take(rows), pa.array(far, pa.float64()),
             pa.array(found, pa.int32()), pa.array(groups.blocks[found], pa.int32())], names=["q", "v", "far", "grp", "blocks"])


def _rerank(entries: pd.DataFrame, probes: pd.DataFrame, top: int, books) -> pd.DataFrame:
    """Best entries of one block for every query that visits some of its cells."""
    if not len(entries) or not len(probes):
        return pd.DataFrame({"q": [], "eids": [], "scores": []})
    entries = entries.sort_values("eid")
    eids, c1, c2 = (entries[c].to_numpy() for c in ("eid", "c1", "c2"))
    e = np.stack(entries["v"].to_numpy())
    out = []
    for key, v, far in zip(probes["q"], probes["v"], probes["far"]):
        first, second = distances(v, books)
        seen = np.flatnonzero(first[c1] + second[c2] <= far)
        if not len(seen):
            continue
        scores = e[seen] @ v
        if len(seen) > 4 * top:  # ties at the border stay in
            border = np.partition(scores, len(seen) - top)[len(seen) - top]
            seen, scores = seen[scores >= border], scores[scores >= border]
        best = np.argsort(-scores, kind="stable")[:top]
        out.append((key, eids[seen[best]], scores[best]))
    return pd.DataFrame(out, columns=["q", "eids", "scores"])


def search(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", index: Index = Index()) -> DataFrame:
    """(query_id, rank, vec_id, score): nearest first, ties to the smaller id, never the query itself.

    ``queries`` has the columns of ``vectors``; both are taken whole.
    """
    more = index.top + 1  # the query itself may be among them
    rows = usable(vectors, key, vector).distinct()
    first = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= more)
    entries = saved(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("eid"), "ids", "v"), "entries")
    n = entries.count()
    asked = usable(queries, key, vector).distinct()
    if not n:
        return asked.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    at_random = F.xxhash64(F.lit(index.seed), "eid")
    width = entries.select(F.size("v")).first()[0]
    drawn = entries.orderBy(at_random).limit(min(index.fit_sample, max(1, index.fit_values // width))).select("v").toArrow()
    sample = _matrix(drawn.column("v").combine_chunks())
    k = max(1, min(-(-len(sample) // 8), int(n**0.4)))
    half = max(1, sample.shape[1] // 2)
    books = (fit(sample[:, :half], k, index.iterations, index.seed), fit(sample[:, half:], k, index.iterations, index.seed + 1))
    schema = "eid long, ids array<long>, v array<double>, c1 int, c2 int"
    entries = saved(entries.mapInArrow(partial(_cells, books=books), schema), "multi-index")
    sizes = np.zeros(len(books[0]), np.int64)
    for r in entries.groupBy("c1").count().collect():  # a row per centroid
        sizes[r["c1"]] = r["count"]
    groups = grouped(books[0], sizes, index.entry_block)

    distinct = saved(asked.groupBy("v").agg(F.min("id").alias("q")), "queries")
    probe = distinct.orderBy(F.xxhash64(F.lit(index.seed + 1), "q")).limit(index.probe_sample)
    cells = cells_for(entries, probe.select(F.col("q").alias("eid"), "v").collect(), books, n, index)

    n_queries = distinct.count()
    probes = saved(distinct.repartition(max(1, n_queries // 256), "q").mapInArrow(
        partial(_probes, books=books, cells=cells, groups=groups), "q long, v array<double>, far double, grp int, blocks int"), "probes")
    query_blocks = max(1, -(-n_queries // index.query_block))
    probes = probes.withColumn("qb", F.pmod(F.xxhash64("q"), F.lit(query_blocks)).cast("int"))
    # both sides are dealt by group, query block and entry block
    dealt = entries.mapInArrow(partial(_dealt, groups=groups), f"{schema}, grp int, blocks int").withColumn(
        "eb", F.pmod(F.xxhash64("eid"), F.col("blocks")).cast("int"))
    if len(groups.blocks) * query_blocks <= MEETINGS:
        met = probes.groupBy("grp").agg(F.collect_set("qb").alias("qbs"))
        dealt = dealt.join(F.broadcast(met), "grp")
    else:
        dealt = dealt.withColumn("qbs", F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    dealt = dealt.withColumn("qb", F.explode("qbs"))
    asked_blocks = probes.withColumn("eb", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    best = dealt.select("grp", "qb", "eb", "eid", "v", "c1", "c2").groupBy("grp", "qb", "eb").cogroup(
        asked_blocks.select("grp", "qb", "eb", "q", "v", "far").groupBy("grp", "qb", "eb")).applyInPandas(
        lambda e, p: _rerank(e, p, more, books), "q long, eids array<long>, scores array<double>")
    spread = best.select("q", F.explode(F.arrays_zip("eids", "scores")).alias("x")).select("q", F.col("x.eids").alias("eid"), F.col("x.scores").alias("score"))
    near = Window.partitionBy("q").orderBy(F.desc("score"), "eid")
    kept = spread.withColumn("r", F.row_number().over(near)).where(F.col("r") <= more).drop("r")
    named = kept.join(entries.select("eid", "ids"), "eid").select("q", "score", F.explode("ids").alias("vec_id"))
    near = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = named.withColumn("r", F.row_number().over(near)).where(F.col("r") <= more).groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("found"))
    # back to all queries: those with one vector share its list
    by_vector = distinct.join(lists, "q").select("v", "found")
    each = asked.join(by_vector, "v").select(F.col("id").alias("query_id"), F.slice(
        F.filter("found", lambda x: x["vec_id"] != F.col("id")), 1, index.top).alias("found"))
    return each.select("query_id", F.posexplode("found").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))
