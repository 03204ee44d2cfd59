"""The given star-schema tables as retail domain tables.

Every row of the given tables is used: ``channel`` partitions the orders into
three feeds that are all processed. All expressions are plain projections
except the combo master, which needs a self-join and is written once per
application and data folder, as the dimension table it stands for.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators.labels import Catalog
from cartwright.plans.order_features import Dimensions, OrderWindow
from cartwright.session import delete_at_exit, shared_dir

WINDOW = OrderWindow(run_date=date(2001, 6, 1), months=72, zone="Asia/Kolkata", test_store=13)
CUTOFF = date(1996, 1, 1)
REFERENCE = date(2001, 5, 31)

_written: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Write a derived table once to the shared folder and read it back."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = shared_dir(spark, name)
        build().write.parquet(path)
        delete_at_exit(spark, path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def channel_of(order_key: Column) -> Column:
    slot = order_key % 10
    return F.when(slot <= 7, N.OWNAPP).when(slot == 8, N.SWIGGY).otherwise(N.INSTORE)


@dataclass(frozen=True)
class Stage:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- orders -------------------------------------------------------------

    @cached_property
    def raw_orders(self) -> DataFrame:
        """All orders in the delivery schema, UTC clocks, with customer and channel."""
        key, cust, total = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
        hours = F.make_dt_interval(F.lit(0), ((key * 7) % 24).cast("int"))
        minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.lit(20) + key % 41).cast("int"))
        placed = F.col("o_orderdate").cast("timestamp_ntz") + hours
        discount = (
            F.when(key % 97 == 0, F.lit(0.0))
            .when(key % 89 == 0, F.lit(-1.0))
            .otherwise(total * (key % 11) / F.lit(100))
        )
        merged = F.when(cust % 10 == 0, cust - cust % 30).otherwise(cust)
        code = F.when(key % 37 != 0, merged.cast("string"))
        return self.table("orders").select(
            key.alias("id"),
            cust.cast("string").alias("user_id"),
            (cust % 26).cast("int").alias("store_id_id"),
            placed.alias("order_placed_datetime"),
            (placed + minutes).alias("order_delivery_datetime"),
            placed.alias("schedule_datetime"),
            F.col("o_orderpriority").alias("platform"),
            F.col("o_orderstatus").alias("status_id"),
            discount.alias("discounted_price"),
            F.when(key % 97 == 0, F.lit(0.0)).otherwise(total).alias("sub_total_price"),
            total.alias("total_price"),
            total.alias("gross_price"),
            channel_of(key).alias("channel"),
            code.alias("_code"),
        )

    def delivery_orders(self, channel: str) -> DataFrame:
        return self.raw_orders.where(F.col("channel") == channel).drop("_code")

    @property
    def all_orders(self) -> DataFrame:
        return self.raw_orders.drop("_code")

    @cached_property
    def customer_map(self) -> DataFrame:
        local = F.col("order_placed_datetime") + F.expr("INTERVAL 330 MINUTE")
        return self.raw_orders.select(
            F.col("id").alias("invoice_no"),
            F.col("_code").alias("customer_code_ty"),
            F.to_date(local).alias("invoice_date"),
            F.col("store_id_id").alias("store_code"),
        )

    def _instore_form(self, orders: DataFrame) -> DataFrame:
        return orders.select(
            F.col("id").alias("InvoiceNo"),
            (F.col("order_placed_datetime") + F.expr("INTERVAL 330 MINUTE")).alias("BussTime"),
            F.col("store_id_id").alias("StoreCode"),
            F.col("total_price").alias("GrossAmount"),
            F.col("discounted_price").alias("Discount"),
            F.col("total_price").alias("BaseAmount"),
            F.col("platform").alias("TransType"),
            F.col("status_id").alias("SaleType"),
        )

    @property
    def instore_orders(self) -> DataFrame:
        return self._instore_form(self.raw_orders.where(F.col("channel") == N.INSTORE))

    @property
    def all_as_instore_orders(self) -> DataFrame:
        return self._instore_form(self.raw_orders)

    @property
    def complaints(self) -> DataFrame:
        fifth = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderkey"))
        late = self.table("orders").where(F.col("o_orderstatus") == "F")
        return late.select(fifth.alias("order_id")).where(F.col("order_id").isNotNull())

    # -- items --------------------------------------------------------------

    @property
    def all_items(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("sales_id"),
            F.col("l_partkey").cast("string").alias("item_id_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / 100).alias("original_price"),
            (F.col("l_returnflag") == "R").alias("promo_item"),
            (F.col("l_returnflag") == "A").alias("is_customized"),
            (F.col("l_linestatus") == "O").alias("is_veg"),
        )

    def delivery_items(self, channel: str) -> DataFrame:
        return self.all_items.where(channel_of(F.col("sales_id")) == channel)

    @property
    def all_as_instore_items(self) -> DataFrame:
        """All lines in the in-store schema, dated and placed by their order."""
        orders = self.all_as_instore_orders.select(
            "InvoiceNo", F.col("BussTime").alias("OrderDatetime"), "StoreCode"
        )
        lines = self.all_items.select(
            F.col("sales_id").alias("InvoiceNo"),
            F.concat(F.lit("P"), F.col("item_id_id")).alias("ProductCode"),
            "quantity",
            F.col("original_price").alias("PriceNet"),
        )
        return lines.join(orders, "InvoiceNo")

    @property
    def instore_items(self) -> DataFrame:
        return self.all_as_instore_items.where(channel_of(F.col("InvoiceNo")) == N.INSTORE)

    # -- dimensions ---------------------------------------------------------

    @property
    def categories(self) -> DataFrame:
        key, brand = F.col("p_partkey"), F.col("p_brand")
        base = (
            F.when(key % 29 == 0, F.lit(None).cast("string"))
            .when(brand == "Brand#25", F.lit(" Exclude "))
            .otherwise(brand)
        )
        return self.table("part").select(
            key.cast("string").alias("item_id_id"),
            F.concat(F.lit("P"), key.cast("string")).alias("ProductCode"),
            base.alias(N.BASE_LABEL),
            F.when(key % 23 != 0, F.col("p_type")).alias(N.DRI_LABEL),
        )

    @cached_property
    def combos(self) -> DataFrame:
        """A first line is the header of the second lines of its order."""

        def build() -> DataFrame:
            line = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
            # dealt by order, so that the distinct rows of both sides meet without another shuffle
            header = line.where("l_linenumber = 1").select("l_orderkey", F.col("l_partkey").alias("h")).repartition("l_orderkey").distinct()
            choice = line.where("l_linenumber = 2").select("l_orderkey", F.col("l_partkey").alias("c")).repartition("l_orderkey").distinct()
            pairs = header.join(choice, "l_orderkey").select("h", "c").distinct()
            return pairs.select(
                F.col("h").cast("string").alias("header_item_id_id"),
                F.col("c").cast("string").alias("choice_item_id_id"),
                F.concat(F.lit("P"), F.col("h")).alias("HeaderItemId"),
                F.concat(F.lit("P"), F.col("c")).alias("ChoiceItemId"),
                F.lit(25).alias("Qty"),
            )

        return written(self.spark, self.sf_dir, "combos", build)

    @property
    def store_map(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.alias("MDS ID"), F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("DSR Code")
        )

    @property
    def store_master(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
        return joined.select(
            F.col("n_nationkey").cast("string").alias("Store Code"),
            F.concat(F.lit("Store "), F.col("n_name")).alias("Store Name"),
            F.col("r_name").alias("Store Type"),
            F.col("n_name").alias("Geographical City"),
            F.col("n_name").alias("Key City"),
            F.concat(F.lit("G"), F.col("n_regionkey")).alias("Generator New"),
        )

    @cached_property
    def catalog(self) -> Catalog:
        return Catalog.from_categories(self.categories)

    @cached_property
    def dims(self) -> Dimensions:
        return Dimensions(
            self.customer_map, self.store_map, self.store_master,
            self.categories, self.combos, self.catalog,
        )
