"""Order-grain filters, key mapping and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import names as N
from cartwright.functions import scalars as X


def _type_of(df: DataFrame, column: str):
    return df.schema[column].dataType


# -- clocks and windows -----------------------------------------------------

def localize(df: DataFrame, columns: Sequence[str], zone: str) -> DataFrame:
    """Turn UTC columns into wall clocks of ``zone``; bad values become NULL."""
    return df.withColumns(
        {c: X.local_clock(F.col(c), _type_of(df, c), zone) for c in columns if c in df.columns}
    )


def in_window(df: DataFrame, column: str, run_date: date, months: int, zone: str) -> Column:
    """Whether a UTC column lies in [run - months, run), local midnights.

    The bounds are moved instead of the column, so the predicate stays on the
    stored value and reaches the scan: UTC wall clocks for a column without
    zone, instants for a TIMESTAMP.
    """
    dtype = _type_of(df, column)
    if isinstance(dtype, T.TimestampType):
        placed, (start, end) = F.col(column), X.window_instants(run_date, months, zone)
    else:
        placed, (start, end) = X.utc_clock(F.col(column), dtype), X.window_bounds(run_date, months, zone)
    return (placed >= start) & (placed < end)


def local_window(
    df: DataFrame, columns: Sequence[str], run_date: date, months: int, zone: str
) -> DataFrame:
    """Keep the window of the first column, then localize all of them."""
    return localize(df.where(in_window(df, columns[0], run_date, months, zone)), columns, zone)


def store_window(
    df: DataFrame, column: str, run_date: date, months: int, test_store: int | None
) -> DataFrame:
    """The same window on a local clock, without the test store; a missing store is kept."""
    start, end = X.window_bounds(run_date, months)
    ts = F.col(column)
    kept = df.where((ts >= start) & (ts < end))
    return kept if test_store is None else kept.where(~F.col("StoreCode").eqNullSafe(F.lit(test_store)))


def since_cutoff(df: DataFrame, cutoff: date, column: str = "order_placed_datetime") -> DataFrame:
    return df.where(F.col(column) >= F.lit(cutoff).cast("timestamp_ntz"))


# -- customers --------------------------------------------------------------

def map_customers(orders: DataFrame, customer_map: DataFrame, order_id: str = "id") -> DataFrame:
    """Attach the customer id by order id and drop orders without one.

    The map is as large as the orders: both sides are hashed on the order id,
    and the items join later reuses that partitioning.
    """
    mapping = customer_map.where(F.col("customer_code_ty").isNotNull()).select(
        F.col("invoice_no").alias(order_id), F.col("customer_code_ty").alias(N.CUSTOMER_ID)
    )
    return orders.join(mapping, order_id, "inner")


def with_customers(orders: DataFrame, customer_map: DataFrame, order_id: str = "id") -> DataFrame:
    """Every order with its customer id, NULL where the map has none (for counting)."""
    mapping = customer_map.select(F.col("invoice_no").alias(order_id), F.col("customer_code_ty").alias(N.CUSTOMER_ID))
    return orders.join(mapping, order_id, "left")


def map_customers_instore(orders: DataFrame, customer_map: DataFrame) -> DataFrame:
    """Attach the customer id by invoice, business date and store (left join)."""
    mapping = customer_map.select(
        F.col("invoice_no").alias("InvoiceNo"),
        F.col("invoice_date").alias("Business_Date"),
        F.col("store_code").alias("StoreCode"),
        F.col("customer_code_ty").alias(N.CUSTOMER_ID),
    )
    dated = orders.withColumn("Business_Date", F.to_date("BussTime"))
    return dated.join(mapping, ["InvoiceNo", "Business_Date", "StoreCode"], "left")


def customer_ids(orders: DataFrame, column: str = N.CUSTOMER_ID) -> DataFrame:
    return orders.where(F.col(column).isNotNull()).select(column).distinct()


def keep_customers(df: DataFrame, customers: DataFrame, column: str = N.CUSTOMER_ID) -> DataFrame:
    """Semi-join on distinct customer ids; works on orders and on the customer map."""
    keys = customers.select(F.col(customers.columns[0]).alias(column))
    return df.join(keys, column, "left_semi")


# -- stores and complaints --------------------------------------------------

def store_details(orders: DataFrame, store_map: DataFrame, store_master: DataFrame) -> DataFrame:
    """Orders -> store map -> store master, both left joins on trimmed codes.

    Each dimension joins the orders on its own, so Spark sees its true size
    when it decides whether to broadcast it.
    """
    codes = store_map.where(F.col("MDS ID").isNotNull()).select(
        "MDS ID", F.trim(F.col("DSR Code").cast("string")).alias("DSR Code")
    )
    master = store_master.select(
        F.trim(F.col("Store Code").cast("string")).alias("_code"), *_present(store_master)
    )
    coded = orders.join(codes, orders["store_id_id"] == codes["MDS ID"], "left")
    return coded.join(master, coded["DSR Code"] == master["_code"], "left").drop("_code")


def store_details_instore(orders: DataFrame, store_master: DataFrame) -> DataFrame:
    master = store_master.select(
        F.trim(F.col("Store Code").cast("string")).alias("Store Code"), *_present(store_master)
    )
    code = orders["StoreCode"].cast("string")
    return orders.join(master, code == master["Store Code"], "left")


def _present(store_master: DataFrame) -> list[Column]:
    return [F.col(c) for c in N.STORE_COLUMNS if c in store_master.columns]


def flag_complaints(
    orders: DataFrame, complaints: DataFrame | None, order_id: str = "id"
) -> DataFrame:
    """Boolean ``has_query``; False for a channel without a complaints feed.

    An existence test needs neither distinct complaint ids nor a join back.
    """
    if complaints is None:
        return orders.withColumn("has_query", F.lit(False))
    ids = complaints.select(F.col("order_id").cast("bigint").alias("_complaint"))
    hit = ids.where(F.col("_complaint") == F.col(order_id).outer()).exists()
    return orders.withColumn("has_query", hit)


# -- projections ------------------------------------------------------------

def project(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Output -> input map; inputs the table lacks are skipped."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{src}`").alias(out) for out, src in columns.items() if src in have])


def delivery_base(orders: DataFrame) -> DataFrame:
    return project(orders, N.DELIVERY_BASE)


def instore_base(orders: DataFrame) -> DataFrame:
    return project(orders, N.INSTORE_BASE)


def add_order_clock(df: DataFrame) -> DataFrame:
    """Daypart and weekend flag of the local order time."""
    placed = F.col("order_placed_datetime")
    return df.withColumns(
        {"order_time_of_day": X.daypart(placed), "is_weekend": X.weekend_flag(placed)}
    )
