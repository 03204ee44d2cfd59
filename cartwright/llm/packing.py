"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents are cut into pieces of at most ``CAPACITY`` tokens (only longer ones are
cut; the first piece takes what is left over, so all others are full). Full pieces
are sequences of their own. The others are dealt at random into pools of bounded
size. Each pool is evolved by several islands, one task row each, from best-fit
starts: a crossover injects whole well-filled sequences of one parent into
another, drops the sequences that hold a document twice, lets the displaced documents replace
worse-filling ones, and best-fits the rest, longest first. An island ends at the least number of
sequences that its tokens need. Between epochs the best packing of each island moves
to the next island of its pool. What the best packing leaves in poorly filled
sequences is dealt anew into fewer pools, so pools exchange their leftovers.

Pieces of equal length are alike to the algorithm, so islands see the sorted
lengths of a pool, and its answer is joined to the pieces by their rank.

Defined results: a null text counts as empty and is packed as its end token alone;
repeated rows are packed each; a null id passes through; an empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

import json
import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.store import saved

CAPACITY = 1024
END = 2


@dataclass(frozen=True)
class Plan:
    pool: int = 4096
    islands: int = 3
    epochs: int = 2
    population: int = 4
    #: pieces that the children of an island place in one epoch, at most; in the last round, when pools are few, more
    work: int = 20_000
    last_work: int = 150_000
    rounds: int = 3
    #: sequences filled less than this are dealt anew, but for the last round
    well_filled: float = 0.9995
    seed: int = 5


# ---- one pool ------------------------------------------------------------------------------


def best_fit(sizes: list[int], items: list[int], bins: list[list[int]], capacity: int, fills: list[int] | None = None) -> list[list[int]]:
    """Put items, in order, each into the fullest bin that has room; opens bins as needed. Extends ``bins``, and ``fills`` if given."""
    if fills is None:
        fills = [sum(sizes[i] for i in b) for b in bins]
    holding: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by their room
    mask = 0
    for b, fill in enumerate(fills):
        holding[capacity - fill].append(b)
        mask |= 1 << capacity - fill
    for i in items:
        size = sizes[i]
        above = mask >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            b = holding[room].pop()
            if not holding[room]:
                mask ^= 1 << room
            bins[b].append(i)
            fills[b] += size
            room -= size
        else:
            b, room = len(bins), capacity - size
            bins.append([i])
            fills.append(size)
        holding[room].append(b)
        mask |= 1 << room
    return bins


@dataclass(frozen=True)
class Packing:
    """Bins with their fills; fewer bins rank first, then uneven filling (room gathered in few of them)."""

    bins: list[list[int]]
    fills: list[int]
    rank: tuple[int, float]

    @staticmethod
    def of(bins: list[list[int]], fills: list[int], capacity: int) -> "Packing":
        return Packing(bins, fills, (-len(bins), sum(f * f for f in fills) / capacity**2))


def refill(sizes: list[int], bins: list[list[int]], fills: list[int], free: list[int], capacity: int) -> list[int]:
    """Let a free item replace one or two of a bin that it fills better, as often as that helps; returns what is free then.

    Bins only get fuller (``fills`` is kept up), and the items that come free are smaller, so they find room more easily.
    """
    holding: list[list[int]] = [[] for _ in range(capacity + 1)]  # free items by size
    mask = 0
    for i in free:
        holding[sizes[i]].append(i)
        mask |= 1 << sizes[i]
    for at, members in enumerate(bins):
        while fills[at] < capacity:
            room = capacity - fills[at]
            gain, out = 0, ()
            for pair in [(), *((i,) for i in members), *combinations(members, 2)]:
                held = sum(sizes[i] for i in pair)
                fit = (mask & ((1 << (held + room + 1)) - 1)).bit_length() - 1  # the longest that would fit
                if fit - held > gain:
                    gain, out, size = fit - held, pair, fit
                    if gain == room:
                        break
            if not gain:
                break
            members.append(holding[size].pop())
            if not holding[size]:
                mask ^= 1 << size
            for i in out:
                members.remove(i)
                holding[sizes[i]].append(i)
                mask |= 1 << sizes[i]
            fills[at] += gain
    return [i for same in holding for i in same]


def crossover(sizes: list[int], giver: Packing, taker: Packing, capacity: int, rng: random.Random) -> Packing:
    """``taker`` with some of the well-filled bins of ``giver`` injected.

    Bins of the taker that hold an injected item are dissolved, and so are its least filled ones and a few more; free
    items first replace worse ones in the bins that stay, then go in by best fit, longest first.
    """
    border = sorted(giver.fills, reverse=True)[(len(giver.bins) - 1) * 3 // 4]
    share = rng.random() ** 3 / 2
    chosen = [b for b, fill in enumerate(giver.fills) if fill >= border and rng.random() < share]
    inside = {i for b in chosen for i in giver.bins[b]}
    kept, displaced = [], []
    for b, members in enumerate(taker.bins):
        if inside.isdisjoint(members):
            kept.append(b)
        else:
            displaced += [i for i in members if i not in inside]
    rng.shuffle(kept)
    kept.sort(key=lambda b: -taker.fills[b])
    for _ in range(min(2, len(kept))):
        displaced += taker.bins[kept.pop()]
    for _ in range(min(rng.randint(1, 12), len(kept))):
        displaced += taker.bins[kept.pop(rng.randrange(len(kept)))]
    rng.shuffle(kept)
    bins, fills = [list(taker.bins[b]) for b in kept], [taker.fills[b] for b in kept]
    free = refill(sizes, bins, fills, displaced, capacity)
    free.sort(key=lambda i: (-sizes[i], rng.random()))
    bins += [list(giver.bins[b]) for b in chosen]
    fills += [giver.fills[b] for b in chosen]
    best_fit(sizes, free, bins, capacity, fills)
    return Packing.of(bins, fills, capacity)


def evolve(sizes: list[int], start: list[list[list[int]]], plan: Plan, capacity: int, rng: random.Random) -> list[Packing]:
    """Some generations of one island; returns its packings, best first. Ends early at the least possible number of sequences."""
    least = -(-sum(sizes) // capacity)

    def fitted(order: list[int]) -> Packing:
        bins: list[list[int]] = []
        fills: list[int] = []
        best_fit(sizes, order, bins, capacity, fills)
        return Packing.of(bins, fills, capacity)

    crowd = [Packing.of(bins, [sum(sizes[i] for i in b) for b in bins], capacity) for bins in start] or [fitted(list(range(len(sizes))))]
    if min(len(p.bins) for p in crowd) > least:
        while len(crowd) < plan.population:
            noise = [s * (1 + rng.uniform(-0.15, 0.15)) for s in sizes]
            crowd.append(fitted(sorted(range(len(sizes)), key=lambda i: -noise[i])))
    crowd.sort(key=lambda p: p.rank, reverse=True)
    for _ in range(max(1, plan.work // len(sizes))):
        if len(crowd[0].bins) <= least:
            break
        giver, taker = rng.sample(range(len(crowd)), 2)
        child = crossover(sizes, crowd[giver], crowd[taker], capacity, rng)
        # a child replaces its taker if it is as good, so that better packings spread and the others stay
        if child.rank >= crowd[taker].rank:
            crowd[taker] = child
            crowd.sort(key=lambda p: p.rank, reverse=True)
    return crowd


# ---- pieces --------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def encoder(path: str):
    """(encode, special) for a byte-level BPE file of the tokenizers library.

    The vocabulary and its merge order are read from the file; a test holds the ids
    against that library, which is several times slower on these texts.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in whole["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=2)
def whole_encoder(path: str):
    """The tokenizers library itself."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encode(path: str, text: str) -> list[int]:
    """The ids of a text. tiktoken raises on a run of about a million blanks: such a text goes to the tokenizers library."""
    try:
        return encoder(path).encode(text, allowed_special="all")
    except ValueError:
        return whole_encoder(path).encode(text, add_special_tokens=False).ids


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first can be shorter than full."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, ids_too: bool) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    serial = 0
    for batch in batches:
        rows: list[tuple] = []
        for key, text in zip(batch.column("id").to_pylist(), batch.column("_text")):
            ids = np.array(encode(path, text.as_py() or "") + [END], "<u4")
            for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                own = ids[start:start + length]
                serial += 1
                rows.append((key, piece, start, length, zlib.crc32(own.tobytes()), part << 36 | serial,
                             own.astype(np.int64).tolist() if ids_too else None))
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        names = ["id", "piece", "start", "length", "crc", "serial", "ids"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def tokenized_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                     ids_too: bool = False) -> DataFrame:
    """(id, piece, start, length, crc, serial, ids); ``serial`` is unique once the table is written."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("_text"))
    return rows.mapInArrow(partial(_pieces, path=path, capacity=capacity, ids_too=ids_too),
                           "id long, piece int, start long, length long, crc long, serial long, ids array<long>")


# ---- islands -------------------------------------------------------------------------------


def _islands(batches: Iterator[pa.RecordBatch], plan: Plan, capacity: int, epoch: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            rng = random.Random(f"{plan.seed}/{row['pool']}/{row['island']}/{epoch}")
            sizes = row["lengths"]
            start = []
            for packing in (row["own"], row["guest"]):
                if packing:
                    bins: list[list[int]] = [[] for _ in range(max(packing) + 1)]
                    for i, b in enumerate(packing):
                        bins[b].append(i)
                    start.append(bins)
            best = evolve(sizes, start, plan, capacity, rng)[0]
            place = [0] * len(sizes)
            for b, members in enumerate(best.bins):
                for i in members:
                    place[i] = b
            out.append((row["pool"], row["island"], sizes, place, *best.rank))
        columns = list(zip(*out)) if out else [()] * 6
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["pool", "island", "lengths", "place", "count", "even"])


ISLAND = "pool long, island int, lengths array<int>, place array<int>, count long, even double"


def evolved(pools: DataFrame, plan: Plan, capacity: int, tasks: int) -> DataFrame:
    """(pool, place): the best packing of each pool; ``place[i]`` is the sequence of its i-th longest piece."""
    none = F.lit(None).cast("array<int>")
    crowd = pools.select("pool", F.explode(F.sequence(F.lit(0), F.lit(plan.islands - 1))).alias("island"), "lengths",
                         none.alias("own"), none.alias("guest"))
    for epoch in range(plan.epochs):
        # one row is one island: rows are dealt out evenly, whatever their pool
        dealt = crowd.repartition(tasks, "pool", "island")
        done = saved(dealt.mapInArrow(partial(_islands, plan=plan, capacity=capacity, epoch=epoch), ISLAND), "islands")
        guests = done.select("pool", F.pmod(F.col("island") + 1, F.lit(plan.islands)).cast("int").alias("island"), F.col("place").alias("guest"))
        crowd = done.withColumnRenamed("place", "own").join(guests, ["pool", "island"]).select("pool", "island", "lengths", "own", "guest")
    return done.groupBy("pool").agg(F.max_by("place", F.struct("count", "even", -F.col("island"))).alias("place"))


def packed(pieces: DataFrame, plan: Plan = Plan(), capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces (columns length and serial are used)."""
    columns = pieces.columns
    full = pieces.where(F.col("length") == capacity)
    out = full.select(*columns, (-1 - F.col("serial")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = pieces.where(F.col("length") < capacity)
    base = 0
    for turn in range(plan.rounds):
        n = left.count()
        if not n:
            break
        n_pools = -(-n // plan.pool)
        last = turn == plan.rounds - 1 or n_pools == 1
        pooled = left.withColumn("pool", F.pmod(F.xxhash64(F.lit(plan.seed + turn), "serial"), F.lit(n_pools)).cast("long"))
        lengths = pooled.groupBy("pool").agg(F.reverse(F.sort_array(F.collect_list(F.col("length").cast("int")))).alias("lengths"))
        effort = replace(plan, work=plan.last_work) if last else plan
        best = evolved(lengths, effort, capacity, n_pools * plan.islands)
        ranked = pooled.withColumn("_r", F.row_number().over(Window.partitionBy("pool").orderBy(F.desc("length"), "serial")) - 1)
        # a packing is one row per pool and bounded by the pool's size
        placed = ranked.join(best, "pool").withColumn("_bin", F.get("place", F.col("_r"))).drop("place", "_r")
        inside = Window.partitionBy("pool", "_bin")
        placed = saved(placed.withColumns({
            "_fill": F.sum("length").over(inside),
            "offset": F.coalesce(F.sum("length").over(
                inside.orderBy(F.desc("length"), "serial").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "sequence_id": F.lit(base) + F.col("pool") * plan.pool * 4 + F.col("_bin"),
        }), "packed")
        done = placed if last else placed.where(F.col("_fill") >= plan.well_filled * capacity)
        out = out.unionByName(done.select(*columns, "sequence_id", "offset"))
        if last:
            break
        left = placed.where(F.col("_fill") < plan.well_filled * capacity).select(*columns)
        base += n_pools * plan.pool * 4
    return out


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", plan: Plan = Plan(), capacity: int = CAPACITY,
         ids_too: bool = False) -> DataFrame:
    """(id, piece, start, length, crc, serial, ids, sequence_id, offset) of every piece; ``ids`` only if asked for."""
    return packed(saved(tokenized_pieces(docs, path, key, text, capacity, ids_too), "pieces"), plan, capacity)
