"""Registered queries against their SQL on the small given tables."""

import pytest

import __spark_entry__ as entry
from checks import oracle
from checks.compare import connect, difference
from checks.queries import registered

SF_DIR = "/root/testdata/sf0.001"
# column slices of customer_features, which is compared whole
SLICES = {
    "avg_discount_pct", "unique_base_per_customer", "unique_dri_per_customer", "customer_order_metrics",
    "channel_label", "channel_count", "recency_tenure", "daypart_counts", "daypart_combos",
    "price_bucket_orders", "category_orders", "avg_delivery_minutes", "create_flags",
    "segment_load_filter", "rule_segments", "microcluster_sizes", "sink_customer_features", "sink_segments", "sink_microsegments",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered()) == set(oracle.statements())
    assert set(registered()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(registered()) - SLICES))
def test_query(spark, con, name):
    assert difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert "Segment" in df.columns and df.count() > 0
