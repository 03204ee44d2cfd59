"""Rows equal in id and text in one scan split."""

from collections import Counter

from llm_cases import documents

from cartwright.llm import sharding


def test_equal_rows_of_one_split_spread(spark):
    docs = documents(spark, [(5, "one and the same row", "en")] * 4000).coalesce(1)
    placed = sharding.external_shuffle(docs, bucket_bytes=1000).collect()
    buckets = Counter((r.shard, r.bucket) for r in placed)
    assert sorted(r.slot for r in placed) == list(range(4000))
    assert len(buckets) > 8 and max(buckets.values()) < 1000


def test_tasks_follow_the_buckets(spark):
    """As many reduce tasks as the buckets need, whatever the session's number of shuffle partitions."""
    docs = documents(spark, [(i, f"row {i} " * 20, "en") for i in range(2000)])
    placed = sharding.external_shuffle(docs, bucket_bytes=1000)
    assert placed.count() == 2000 and placed.select("shard", "bucket").distinct().count() > 250
    parts = [f for f in placed.inputFiles() if "/shards-" in f]
    assert len(parts) > 100 > 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
