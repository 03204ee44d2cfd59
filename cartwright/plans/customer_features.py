"""One feature row per own-app customer, from written order features or straight from the feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators import customers as C
from cartwright.operators import items as I
from cartwright.operators import orders as O
from cartwright.operators.items import bucket_columns
from cartwright.operators.labels import Catalog
from cartwright.plans.order_features import Dimensions, OrderWindow
from cartwright.session import written


def customer_features(
    ownapp: DataFrame,
    swiggy: DataFrame,
    instore: DataFrame,
    catalog: Catalog,
    cutoff: date,
    reference: date,
    buckets: Sequence[str] = N.BUCKET_LABELS,
    groups: Sequence[C.MetricGroup] | None = None,
) -> DataFrame:
    """Union, then aggregates by customer, then customers with an own-app order.

    That last condition already implies that a customer appears in the own-app
    orders, so the other channels need no semi-join here. Labels are counted in long form, in a second
    pass over the union; with ``groups`` there are only those metrics, from one pass.
    """
    columns = bucket_columns(buckets)
    unified = C.union_channels(
        {N.OWNAPP: ownapp, N.SWIGGY: swiggy, N.INSTORE: instore}, catalog, columns, cutoff
    )
    if groups:
        return C.aggregate_customers(unified, groups)
    wide = C.aggregate_customers(unified, [*C.narrow_groups(reference), C.bucket_metrics(columns)])
    counts = C.label_counts(unified, catalog.present_in_flags(), [column for column, _ in C.LISTS])
    return C.with_label_counts(wide, counts, catalog, C.LISTS)


@dataclass(frozen=True)
class Feed:
    """Orders and lines of one channel as they are read."""

    orders: DataFrame
    items: DataFrame


CLOCKS = ("order_placed_datetime", "order_delivery_datetime")


def encoded_orders(feeds: Mapping[str, Feed], dims: Dimensions, window: OrderWindow, cutoff: date) -> DataFrame:
    """One narrow row per order of a known customer since the cutoff, item features as bitsets, without its clock features.

    The lines of all feeds fold in one aggregate, and the orders of both delivery feeds meet the
    customer map in one join, so three channels cost little more than one.
    """
    bounds = (window.run_date, window.months, window.test_store)
    shared = (N.CUSTOMER_ID, "_order", *CLOCKS, "total_price", "discounted_price", "price_without_taxes")
    none = F.lit(None).cast("timestamp_ntz")
    delivery, parts, lines = [], [], []
    for at, (channel, feed) in enumerate(feeds.items()):
        if channel == N.INSTORE:
            recent = O.since_cutoff(O.store_window(feed.orders, "BussTime", *bounds), cutoff, "BussTime")
            base = O.instore_base(O.map_customers_instore(recent, dims.customer_map)).where(F.col(N.CUSTOMER_ID).isNotNull())
            priced = C.price_without_taxes(base, channel).withColumns({
                "order_delivery_datetime": none, "_order": I.feed_key(at, F.col("order_id").cast("bigint"))})
            parts.append(priced.select(*shared))
            lines.append((at, O.store_window(feed.items, "OrderDatetime", *bounds), I.IN_STORE))
        else:
            recent = O.since_cutoff(O.local_window(feed.orders, CLOCKS, window.run_date, window.months, window.zone), cutoff)
            delivered = F.col("order_delivery_datetime") if channel == N.OWNAPP else none
            priced = C.price_without_taxes(recent, channel).withColumns({
                "order_delivery_datetime": delivered, "_order": I.feed_key(at, F.col("id").cast("bigint"))})
            delivery.append(priced.select("id", *shared[1:]))
            lines.append((at, feed.items, I.DELIVERY))
    if delivery:
        parts.insert(0, O.map_customers(reduce(DataFrame.unionByName, delivery), dims.customer_map).select(*shared))
    orders = reduce(DataFrame.unionByName, parts).withColumn(N.CUSTOMER_ID, F.col(N.CUSTOMER_ID).cast("string"))
    categories, combos = I.united_dimensions(dims.categories, dims.combos, [keys for _, _, keys in lines])
    encoded = I.encoded_item_features(I.united_lines(lines), categories, combos, dims.catalog, I.UNITED, dims.bins)
    joined = orders.join(encoded.drop("item_count", "promo_items").withColumnRenamed(N.ORDER_ID, "_order"), "_order", "left")
    named = F.get(F.array(*[F.lit(channel) for channel in feeds]), F.col("_order.feed"))
    return joined.withColumn("channel", named).drop("_order")


def customer_features_of_feeds(
    feeds: Mapping[str, Feed], dims: Dimensions, window: OrderWindow, cutoff: date, reference: date
) -> DataFrame:
    """The same features as ``customer_features`` without written order features in between.

    The narrow encoded orders are written once, as two aggregates read them: the metrics of a
    customer, and its labels in long form. They are written by customer (a hot one is split), so that both
    aggregates combine nearly all of a customer's rows before their shuffles. No column per label exists before the last projection.
    """
    orders = O.add_order_clock(written(encoded_orders(feeds, dims, window, cutoff).hint("rebalance", N.CUSTOMER_ID), "encoded-orders"))
    wide = C.aggregate_customers(orders, C.encoded_groups(dims.catalog, bucket_columns(dims.buckets), reference))
    words = {kind: [f"coalesce(_{kind}_seen{w}, 0L)" for w in range(ls.words)] for kind, ls in
             (("base", dims.catalog.base), ("dri", dims.catalog.dri))}
    counts = C.label_counts(orders.where("_any"), dims.catalog.present_in_words(words))
    return C.with_label_counts(wide, counts, dims.catalog)
