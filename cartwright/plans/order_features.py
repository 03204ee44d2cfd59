"""One feature row per order, for delivery channels and for in-store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators import items as I
from cartwright.operators import orders as O
from cartwright.operators.labels import Catalog

CLOCKS = ("order_placed_datetime", "order_delivery_datetime", "schedule_datetime")


@dataclass(frozen=True)
class OrderWindow:
    run_date: date
    months: int
    zone: str = "Asia/Kolkata"
    test_store: int | None = 9993


@dataclass(frozen=True)
class Dimensions:
    """Tables shared by the channels, with the vocabularies of the categories."""

    customer_map: DataFrame
    store_map: DataFrame
    store_master: DataFrame
    categories: DataFrame
    combos: DataFrame
    catalog: Catalog
    bins: Sequence[float] = N.PRICE_BINS
    buckets: Sequence[str] = N.BUCKET_LABELS


def windowed_customer_orders(orders: DataFrame, dims: Dimensions, window: OrderWindow) -> DataFrame:
    recent = O.local_window(orders, CLOCKS, window.run_date, window.months, window.zone)
    return O.map_customers(recent, dims.customer_map)


def ownapp_customers(ownapp_orders: DataFrame, dims: Dimensions, window: OrderWindow) -> DataFrame:
    """Distinct customers of the own app in the window; touches no items."""
    return O.customer_ids(windowed_customer_orders(ownapp_orders, dims, window))


def _only_customers(dims: Dimensions, customers: DataFrame | None) -> Dimensions:
    """Restrict the customer map instead of the orders.

    Map rows are narrow, and the orders keep their hash on the order id from
    the map join through to the item join.
    """
    if customers is None:
        return dims
    kept = O.keep_customers(dims.customer_map, customers, "customer_code_ty")
    return Dimensions(**{**dims.__dict__, "customer_map": kept})


def _with_items(orders: DataFrame, encoded: DataFrame, base: Mapping[str, str], order_id: str) -> DataFrame:
    """Orders with their encoded item features, before the names of their stores make them wide.

    Only input columns of the base go through this join, each of them once.
    """
    inputs = [c for c in dict.fromkeys(base.values()) if c in orders.columns]
    return orders.select(*inputs).join(encoded.withColumnRenamed(N.ORDER_ID, order_id), order_id, "left")


def _base_with_items(orders: DataFrame, encoded: DataFrame, base: Mapping[str, str]) -> DataFrame:
    return O.project(orders, {**base, **{c: c for c in encoded.columns if c != N.ORDER_ID}})


def delivery_order_features(
    orders: DataFrame,
    items: DataFrame,
    dims: Dimensions,
    window: OrderWindow,
    complaints: DataFrame | None = None,
    customers: DataFrame | None = None,
) -> DataFrame:
    """Own-app or aggregator orders; ``customers`` limits the aggregator to own-app users."""
    dims = _only_customers(dims, customers)
    mapped = windowed_customer_orders(orders, dims, window)
    flagged = O.flag_complaints(mapped, complaints)
    if customers is not None:  # most orders are not wanted, so their lines are dropped first
        items = I.items_of_orders(items, mapped.withColumnRenamed("id", I.DELIVERY.order), I.DELIVERY.order)
    encoded = I.encoded_item_features(
        items, dims.categories, dims.combos, dims.catalog, I.DELIVERY, dims.bins, by_order=customers is not None
    )
    met = _with_items(flagged, encoded, N.DELIVERY_BASE, "id")
    base = _base_with_items(O.store_details(met, dims.store_map, dims.store_master), encoded, N.DELIVERY_BASE)
    joined = I.decode_item_features(base, dims.catalog, dims.buckets)
    filled = joined.withColumn("promo_items", F.coalesce("promo_items", F.lit(0)).cast("bigint"))
    return O.add_order_clock(filled)


def instore_order_features(
    orders: DataFrame,
    items: DataFrame,
    dims: Dimensions,
    window: OrderWindow,
    customers: DataFrame | None,
) -> DataFrame:
    """In-store orders, limited to ``customers`` of the own app where given.

    Lines are limited to kept invoices before they are folded where ``customers`` is
    given; without it the window of the lines keeps nearly the same ones.
    """
    dims = _only_customers(dims, customers)
    bounds = (window.run_date, window.months, window.test_store)
    recent = O.store_window(orders, "BussTime", *bounds)
    mapped = O.map_customers_instore(recent, dims.customer_map)
    known = mapped.where(F.col(N.CUSTOMER_ID).isNotNull())
    lines = O.store_window(items, "OrderDatetime", *bounds)
    if customers is not None:
        lines = I.items_of_orders(lines, known)
    encoded = I.encoded_item_features(
        lines, dims.categories, dims.combos, dims.catalog, I.IN_STORE, dims.bins, by_order=customers is not None
    )
    met = _with_items(known, encoded, N.INSTORE_BASE, "InvoiceNo")
    base = _base_with_items(O.store_details_instore(met, dims.store_master), encoded, N.INSTORE_BASE)
    return O.add_order_clock(I.decode_item_features(base, dims.catalog, dims.buckets))
