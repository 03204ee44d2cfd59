"""SimHash near-duplicates found through deletion-variant signatures.

64-bit fingerprints link at ``LIMIT`` = 3 differing bits or fewer. Cut into two
halves of 32 bits, one half of a linked pair differs in one bit at most. So every
distinct fingerprint is indexed under each half with each of its bits wiped out:
two linked fingerprints meet under a common key. Keys that many fingerprints
share are cut once more: the other half, in two pieces of 16 bits, differs in
three bits at most, so one piece differs in one bit at most. Below such a second
key only 18 bits are free, which bounds a group by 2**18 members; there, partners
are looked up by flipping bits instead of comparing pairs. Only links that join
groups are emitted (a star per group and key), never all pairs; every link is
verified. Components come from alternating large-star and small-star joins over
written tables; the edges of a node are spread over ``PARTS`` tasks.

Fingerprints are per text, so exact copies are one node however many they are.

Defined results: a null or empty text, or one without a word, has fingerprint
zero and links like any other. A null id never is the smallest; a component of
null ids only has a null ``component_id``. Repeated rows all stay. Only the named
columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.store import saved

LIMIT = 3
SHINGLE = 3
SEED = 42
#: groups under one key up to this size are compared in memory, larger ones are cut again
GROUP = 256
CHUNK = 1 << 16
#: parts that the edges of one node are spread over
PARTS = 256


def fingerprint(text: str | None) -> int:
    """SimHash of the ``SHINGLE``-word shingles; a bit is 1 if set in over half of the hashes."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(words))
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    n = len(words) - width + 1
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in pairs), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[i:i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([fingerprint(t.as_py()) for t in batch.column("_text")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), pa.array(made, pa.int64())],
                                         names=["id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, fp) of every row; fp as a signed long."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    return rows.mapInArrow(_fingerprints, "id long, text_hash long, fp long")


def first_keys(fp: Column) -> Column:
    """Array of the 64 keys: half (1 bit), wiped position (5 bits), wiped half (32 bits)."""
    keys = []
    for half in (0, 1):
        segment = F.shiftrightunsigned(fp, 32) if half else fp.bitwiseAND(F.lit(0xFFFFFFFF))
        for pos in range(32):
            keys.append(segment.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << pos))).bitwiseOR(F.lit(half << 37 | pos << 32)))
    return F.array(*keys)


def second_keys(key: Column, fp: Column) -> Column:
    """Array of the 32 keys below a first key: that key, piece (1 bit), position (4 bits), wiped piece (16 bits)."""
    other = F.when(key.bitwiseAND(F.lit(1 << 37)) == 0, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    keys = []
    for piece in (0, 1):
        segment = F.shiftright(other, 16 * piece).bitwiseAND(F.lit(0xFFFF))
        for pos in range(16):
            low = segment.bitwiseAND(F.lit(0xFFFF ^ (1 << pos))).bitwiseOR(F.lit(piece << 20 | pos << 16))
            keys.append(F.shiftleft(key, 21).bitwiseOR(low))
    return F.array(*keys)


def star_edges(fps: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, smallest member) of the linked groups among a few hundred fingerprints."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= LIMIT
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (least == label).all():
            return [(int(fps[i]), int(fps[k])) for i, k in enumerate(label) if i != k]
        label = least


def free_bits(key: int) -> list[int]:
    """The 18 positions in which members under a second key can differ."""
    first, low = key >> 21, key & 0x1FFFFF
    half, pos, piece, at = first >> 37, first >> 32 & 31, low >> 20, low >> 16 & 15
    own, other = 32 * half, 32 * (1 - half)
    return [own + pos, other + 16 * piece + at, *range(other + 16 * (1 - piece), other + 16 * (1 - piece) + 16)]


def flipped_edges(key: int, fps: np.ndarray) -> list[tuple[int, int]]:
    """Like ``star_edges`` for any number of members under one second key: partners by flipping free bits."""
    codes = np.zeros(len(fps), np.int64)
    for i, bit in enumerate(free_bits(key)):
        codes |= (((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)) << i
    label = np.full(1 << 18, len(fps), np.int64)
    label[codes] = np.arange(len(fps))
    masks = [sum(1 << b for b in bits) for n in range(1, LIMIT + 1) for bits in combinations(range(18), n)]
    while True:
        before = label[codes]
        for mask in masks:
            label[codes] = np.minimum(label[codes], label[codes ^ mask])
        after = label[codes]
        if (after == before).all():
            return [(int(fps[i]), int(fps[k])) for i, k in enumerate(after) if i != k]


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, fps, run starts) of whole runs of equal keys; a run that outgrows ``most`` is passed on in parts."""
    tail_k, tail_f = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        k = np.concatenate((tail_k, batch.column("key").to_numpy()))
        f = np.concatenate((tail_f, batch.column("fp").to_numpy().view(np.uint64)))
        if not len(k):
            continue
        starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        cut = starts[-1] if len(k) - starts[-1] <= most else len(k)
        yield k[:cut], f[:cut], starts[starts < cut]
        # a run that was passed on in part stays marked as large by its last members
        keep = cut if cut < len(k) else len(k) - most - 1
        tail_k, tail_f = k[keep:], f[keep:]
    if len(tail_k):
        yield tail_k, tail_f, np.flatnonzero(np.concatenate(([True], tail_k[1:] != tail_k[:-1])))


def _found(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    kind, key, a, b = zip(*rows) if rows else ((), (), (), ())
    signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int8()), pa.array(key, pa.int64()), signed(a), signed(b)],
                                      names=["kind", "key", "a", "b"])


def _pairs(keys: np.ndarray, f: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    x, y = f[first], f[first + 1]
    ok = np.bitwise_count(x ^ y) <= LIMIT
    return [(0, 0, int(a), int(b)) for a, b in zip(np.maximum(x, y)[ok], np.minimum(x, y)[ok])]


def _link_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (kind 0) below first keys; members (kind 1) of groups that are too large."""
    for k, f, starts in _groups(batches, GROUP):
        sizes = np.diff(np.append(starts, len(k)))
        rows = _pairs(k, f, starts[sizes == 2])
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            if n > GROUP:
                rows += [(1, int(k[s]), int(x), 0) for x in f[s:s + n]]
                continue
            key = int(k[s])
            half, pos = key >> 37, key >> 32 & 31
            bits = f[s:s + n] >> np.uint64(32 * half + pos) & np.uint64(1)
            if pos and (bits == bits[0]).all():
                continue  # all have the same half, and meet at position 0 too
            rows += [(0, 0, a, b) for a, b in star_edges(np.sort(f[s:s + n]))]
        yield _found(rows)


def _link_second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for k, f, starts in _groups(batches, 1 << 18):
        sizes = np.diff(np.append(starts, len(k)))
        rows = _pairs(k, f, starts[sizes == 2])
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            members = np.sort(f[s:s + n])
            edges = star_edges(members) if n <= GROUP else flipped_edges(int(k[s]), np.unique(members))
            rows += [(0, 0, a, b) for a, b in edges]
        yield _found(rows)


FOUND = "kind tinyint, key long, a long, b long"


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what is linked among the distinct ``fp``."""
    by_key = fps.select("fp", F.explode(first_keys(F.col("fp"))).alias("key"))
    found = saved(by_key.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_link_first, FOUND), "simhash-links")
    edges = found.where("kind = 0").select("a", "b").distinct()
    large = found.where("kind = 1").select("key", F.col("a").alias("fp")).distinct()
    if large.isEmpty():
        return edges
    below = large.select("fp", F.explode(second_keys(F.col("key"), F.col("fp"))).alias("key"))
    more = below.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_link_second, FOUND)
    return saved(edges.unionByName(more.select("a", "b")).distinct(), "simhash-edges")


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every node that is not the smallest of its component, and the smallest."""
    def with_least(e: DataFrame, node: str, other: str) -> DataFrame:
        """Edges with ``m``, the smallest neighbour of ``node`` in them; the edges of a hub are spread over ``PARTS`` tasks."""
        parted = e.withColumn("part", F.pmod(F.xxhash64(other), F.lit(PARTS)))
        # at most one row per edge here, and PARTS per node
        least = parted.groupBy(node, "part").agg(F.min(other).alias("m")).groupBy(node).agg(
            F.min("m").alias("m"), F.collect_set("part").alias("parts"))
        return parted.join(least.select(node, "m", F.explode("parts").alias("part")), [node, "part"]).select(node, other, "m")

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        return with_least(both, "u", "v").where("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        # the edge to the smallest neighbour stays, the others are handed on to it
        handed = F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a"))
        return with_least(e, "a", "b").select(handed.alias("a"), F.col("m").alias("b")).distinct()

    def digest(e: DataFrame):
        return e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()

    current = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    mark = digest(current)
    while mark["n"]:
        current = saved(small_star(large_star(current)), "stars")
        now = digest(current)
        if now == mark:
            break
        mark = now
    return current


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, fp, root, component_id) of every row; ``root`` tells components apart, also those of null ids."""
    rows = saved(fingerprints(docs, key, text), "simhash")
    fps = saved(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    stars = components(links(fps.select("fp")))
    rooted = fps.join(stars.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(smallest, "root")
    return rows.join(named, "fp").select("id", "text_hash", "fp", "root", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
