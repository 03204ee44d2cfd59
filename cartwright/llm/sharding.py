"""Sharding as a two-pass external shuffle, with built-in functions only.

Pass one scatters every record to a memory-sized bucket by seeded hashes: the
shard by rendezvous hashing of the key (so one more shard takes records only
into itself), the bucket inside the shard by a hash of the record and of its
number in the scan that read it, so that copies of one record spread too. Pass two
brings each bucket together, shuffles it with the built-in Fisher-Yates
``shuffle`` and writes it. Positions inside a shard are the bucket's offset
plus the place in the bucket; offsets come from the counts of the written
buckets, one short row per bucket.

Defined results: a null key hashes like any other value (one shard, many
buckets); a null or empty text weighs one byte; repeated rows all stay and get
slots of their own; an empty table gives an empty result. A bucket is sorted
before the seeded shuffle, so a task that is run again places its rows alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.store import saved

BUCKET_BYTES = 16 << 20
BUCKETS_PER_TASK = 2
# offsets of so many buckets (about 24 bytes each) are sent to every executor; more are joined by a shuffle
BROADCAST_BUCKETS = 1 << 20


def rendezvous(key: Column, n_shards: int, seed: int) -> Column:
    """The shard whose seeded hash of the key is largest (ties to the smaller)."""
    bids = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("bid"), F.lit(-s).alias("s")) for s in range(n_shards)]
    return -(F.greatest(*bids) if n_shards > 1 else bids[0]).getField("s")


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def external_shuffle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n_shards: int = 8,
    seed: int = 11,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Every record with ``size``, ``shard``, ``bucket`` and ``slot`` (0.. in its shard).

    The written buckets hold whole records. Input columns of those four names are replaced.
    """
    added = {"size", "shard", "bucket", "slot"}
    columns = [c for c in docs.columns if c not in added]
    record = [F.col(f"`{c}`") for c in columns]
    total = docs.agg(F.sum(record_size(F.col(text))).alias("b")).first()["b"] or 0
    per_shard = max(1, -(-total // (bucket_bytes * n_shards)))
    spread = F.xxhash64(F.lit(seed), F.col(key), F.col(text), F.monotonically_increasing_id())
    # the record travels as a struct of its own, so that no input column can clash with a working one
    scattered = docs.select(
        rendezvous(F.col(key), n_shards, seed).alias("shard"),
        F.pmod(spread, F.lit(per_shard)).cast("int").alias("bucket"),
        F.struct(F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("h"), record_size(F.col(text)).alias("size"),
                 F.struct(*record).alias("rec")).alias("r"),
    )
    # a task holds a few buckets at once, however many there are
    tasks = max(1, -(-per_shard * n_shards // BUCKETS_PER_TASK))
    scattered = scattered.repartition(tasks, "shard", "bucket")
    together = scattered.groupBy("shard", "bucket").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    together = together.sortWithinPartitions("shard", "bucket")
    dealt = together.select("shard", "bucket", F.posexplode(F.shuffle("rs", F.lit(seed))).alias("at", "r"))
    written = saved(dealt.select("shard", "bucket", "at", F.col("r.size").alias("size"), F.col("r.rec").alias("rec")), "shards")

    counts = written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    if per_shard * n_shards <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    return written.join(offsets, ["shard", "bucket"]).select(
        *[F.col(f"rec.`{c}`") for c in columns], "size", "shard", "bucket", (F.col("start") + F.col("at")).alias("slot")
    )


def grown(key: Column, n_shards: int = 8, seed: int = 11) -> Column:
    """The shard of a key once there is one shard more."""
    return rendezvous(key, n_shards + 1, seed)
