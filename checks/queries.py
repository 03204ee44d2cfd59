"""The registered queries: one per operator, over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.functions import scalars as X
from cartwright.operators import centroids as M
from cartwright.operators import customers as C
from cartwright.operators import items as I
from cartwright.operators import metrics as Q
from cartwright.operators import orders as O
from cartwright.operators import segments as S
from cartwright.operators.labels import Catalog
from cartwright.plans import order_features as P
from cartwright.plans import segmentation as G
from cartwright.plans.customer_features import Feed, customer_features, customer_features_of_feeds
from cartwright.plans.workflow import read_order_features
from cartwright.session import delete_at_exit, shared_dir, written
from cartwright.sources import readers as R
from cartwright.sources import sinks
from checks import spec
from checks.staging import CUTOFF, REFERENCE, WINDOW, Stage

ZONE = WINDOW.zone
BUCKETS = I.bucket_columns()


def r6(c: Column) -> Column:
    """Order-independent value of a double sum or mean, for comparison only."""
    return F.round(c + F.lit(3e-9), 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in columns})


# -- scans and sinks --------------------------------------------------------

def scan_orders(st: Stage) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
    return R.read_parquet(st.spark, f"{st.sf_dir}/orders.parquet", columns)


def scan_order_items(st: Stage) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
    lines = R.read_parquet(st.spark, f"{st.sf_dir}/lineitem.parquet", columns)
    return lines.withColumn("l_partkey", X.text_key(F.col("l_partkey")))


def _two_orders_csv(st: Stage, df: DataFrame, key: str) -> str:
    """CSV files of two parts with their columns in opposite order; a pattern for both."""
    path = shared_dir(st.spark, "csv")
    df.where(F.col(key) % 2 == 0).write.csv(f"{path}/a", header=True)
    df.where(F.col(key) % 2 != 0).select(*df.columns[::-1]).write.csv(f"{path}/b", header=True)
    delete_at_exit(st.spark, path)
    return f"{path}/*/*.csv"


def scan_instore_csv(st: Stage) -> DataFrame:
    return R.read_instore_orders(st.spark, _two_orders_csv(st, st.all_as_instore_orders, "InvoiceNo"))


def scan_instore_items_csv(st: Stage) -> DataFrame:
    items = st.all_as_instore_items.withColumnRenamed("quantity", "Qty")
    return R.read_instore_items(st.spark, _two_orders_csv(st, items, "InvoiceNo"))


def scan_dimensions_csv(st: Stage) -> DataFrame:
    path = shared_dir(st.spark, "dimensions")
    st.categories.write.csv(f"{path}/categories", header=True)
    st.combos.write.csv(f"{path}/combos", header=True)
    delete_at_exit(st.spark, path)
    categories = R.read_csv(st.spark, f"{path}/categories/*.csv", R.CATEGORIES)
    combos = R.read_csv(st.spark, f"{path}/combos/*.csv", R.COMBO_MASTER)
    left = categories.select(
        F.lit("categories").alias("dimension"), F.col("item_id_id").alias("a"), F.col("ProductCode").alias("b"),
        F.trim(N.BASE_LABEL).alias("c"), F.col(N.DRI_LABEL).alias("d"))
    return left.union(combos.select(
        F.lit("combos"), "header_item_id_id", "choice_item_id_id", "HeaderItemId", "ChoiceItemId"))


def scan_complaints(st: Stage) -> DataFrame:
    path = shared_dir(st.spark, "complaints")
    st.complaints.write.parquet(path)
    delete_at_exit(st.spark, path)
    return R.read_complaints(st.spark, path)


def sink_order_features(st: Stage) -> DataFrame:
    path = shared_dir(st.spark, "order-features")
    orders = O.add_order_clock(O.delivery_base(P.windowed_customer_orders(st.all_orders, st.dims, WINDOW)))
    sinks.write_features(orders, path, by_month=True)
    delete_at_exit(st.spark, path)
    back = R.read_parquet(st.spark, path)
    return back.select(
        N.ORDER_ID, N.CUSTOMER_ID, "order_placed_datetime", "total_price", "order_time_of_day",
        "is_weekend", F.col("order_month").cast("string").alias("order_month"),
    )


def scan_csv_columns(st: Stage) -> DataFrame:
    """Files with more columns than are declared, one set with some of them in another order."""
    extra = st.all_as_instore_orders.withColumns({
        "Cashier": F.concat(F.lit("c "), F.col("InvoiceNo")), "Note": F.lit('said "no, thanks"'), "Zone": F.col("StoreCode")})
    return R.read_instore_orders(st.spark, _two_orders_csv(st, extra, "InvoiceNo"))


def _written(st: Stage, name: str, write) -> str:
    """A fresh path that ``write`` has written to; it goes when the application ends."""
    path = shared_dir(st.spark, name)
    write(path)
    delete_at_exit(st.spark, path)
    return path


def reread_ownapp_customers(st: Stage) -> DataFrame:
    """Customers of the own app from its written order features, one column of them."""
    orders = O.delivery_base(P.windowed_customer_orders(st.delivery_orders(N.OWNAPP), st.dims, WINDOW))
    path = _written(st, "own-features", lambda p: sinks.write_features(orders, p))
    return O.customer_ids(st.spark.read.parquet(path))


def reread_recent_orders(st: Stage) -> DataFrame:
    """Order features written by month, of which the months since the cutoff are read."""
    orders = O.add_order_clock(O.delivery_base(P.windowed_customer_orders(st.all_orders, st.dims, WINDOW)))
    path = _written(st, "by-month", lambda p: sinks.write_features(orders, p, by_month=True))
    recent = O.since_cutoff(read_order_features(st.spark, path, CUTOFF), CUTOFF)
    return recent.select(N.ORDER_ID, N.CUSTOMER_ID, "order_placed_datetime", "total_price", "order_time_of_day")


def sink_customer_features(st: Stage) -> DataFrame:
    path = _written(st, "customers", lambda p: sinks.write_features(_customers(st), p))
    return rounded(R.read_parquet(st.spark, path), "omnichannel_avg_discount_pct", *MEANS, *GAPS, "ownapp_avg_delivery_time_minutes")


def sink_segments(st: Stage) -> DataFrame:
    path = _written(st, "segments", lambda p: sinks.write_features(rule_segments(st), p))
    return st.spark.read.parquet(path)


def sink_microsegments(st: Stage) -> DataFrame:
    path = _written(st, "micro", lambda p: sinks.write_features(microsegments(st), p))
    return st.spark.read.parquet(path)


def model_table(st: Stage) -> DataFrame:
    """Models written as a table and read again, which score every order line as a customer."""
    path = _written(st, "models", M.model_rows(st.spark, spec.MODELS).write.parquet)
    columns = [F.expr(e.replace("VARCHAR", "STRING")).alias(c) for c, e in spec.grid_columns().items()]
    models = st.spark.read.schema(M.MODEL_SCHEMA).parquet(path)
    scored = G.micro_segments(st.table("lineitem").select(*columns), spec.SPEC, models)
    return scored.select(N.CUSTOMER_ID, "Segment", "microcluster")


# -- filters ----------------------------------------------------------------

def filter_date_window(st: Stage) -> DataFrame:
    out = O.local_window(st.all_orders, P.CLOCKS, WINDOW.run_date, WINDOW.months, ZONE)
    return out.select("id", *P.CLOCKS)


def filter_exclude_store_window(st: Stage) -> DataFrame:
    out = O.store_window(
        st.all_as_instore_orders, "BussTime", WINDOW.run_date, WINDOW.months, WINDOW.test_store
    )
    return out.select("InvoiceNo", "BussTime", "StoreCode")


def filter_window_missing_store(st: Stage) -> DataFrame:
    """Every seventh order without a store: those stay, whatever the test store."""
    orders = st.all_as_instore_orders.withColumn("StoreCode", F.when(F.col("InvoiceNo") % 7 != 0, F.col("StoreCode")))
    out = O.store_window(orders, "BussTime", WINDOW.run_date, WINDOW.months, WINDOW.test_store)
    return out.select("InvoiceNo", "BussTime", "StoreCode")


def _categorized(st: Stage) -> DataFrame:
    return I.map_categories(st.all_items, st.categories)


def _labels(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({N.BASE_LABEL: "base_label", N.DRI_LABEL: "dri_label"})


def filter_unmapped_excluded(st: Stage) -> DataFrame:
    kept = I.drop_unmapped(_categorized(st))
    return _labels(kept).select("sales_id", "item_id_id", "quantity", "base_label", "dri_label")


def filter_promo_items(st: Stage) -> DataFrame:
    return I.payable_items(st.all_items).select("sales_id", "item_id_id", "quantity", "promo_item")


def filter_cutoff_window(st: Stage) -> DataFrame:
    local = O.localize(st.all_orders, P.CLOCKS, ZONE)
    return O.since_cutoff(local, CUTOFF).select("id", "order_placed_datetime")


# -- projections ------------------------------------------------------------

def project_base_features(st: Stage) -> DataFrame:
    orders = O.map_customers(O.localize(st.all_orders, P.CLOCKS, ZONE), st.customer_map)
    flagged = O.flag_complaints(orders, st.complaints)
    return O.delivery_base(O.store_details(flagged, st.store_map, st.store_master))


def project_instore_base(st: Stage) -> DataFrame:
    orders = O.map_customers_instore(st.all_as_instore_orders, st.customer_map)
    return O.instore_base(O.store_details_instore(orders, st.store_master))


def price_without_taxes(st: Stage) -> DataFrame:
    delivery = C.price_without_taxes(st.all_orders.where(F.col("channel") != N.INSTORE), N.OWNAPP)
    instore = C.price_without_taxes(
        st.instore_orders.withColumnRenamed("Discount", "discounted_price"), N.INSTORE
    )
    columns = ["discounted_price", "price_without_taxes"]
    return delivery.select("id", *columns).union(instore.select("InvoiceNo", *columns))


def normalize_keys(st: Stage) -> DataFrame:
    key = F.col("o_orderkey")
    return st.table("orders").select(
        key.alias("id"),
        X.text_key(F.concat(F.lit(" "), F.col("o_custkey"), F.lit(".0 "))).alias("text_id"),
        X.long_key(F.concat(key, F.lit(".0"))).alias("long_id"),
        F.to_date(X.local_clock(F.col("o_orderdate"), st.table("orders").schema["o_orderdate"].dataType, ZONE)).alias("business_date"),
    )


# -- joins ------------------------------------------------------------------

def join_customer_map(st: Stage) -> DataFrame:
    return O.map_customers(st.all_orders, st.customer_map).select("id", "user_id", N.CUSTOMER_ID)


def join_customer_map_composite(st: Stage) -> DataFrame:
    out = O.map_customers_instore(st.all_as_instore_orders, st.customer_map)
    return out.select("InvoiceNo", "Business_Date", "StoreCode", N.CUSTOMER_ID)


def semi_ownapp_customers(st: Stage) -> DataFrame:
    users = P.ownapp_customers(st.delivery_orders(N.OWNAPP), st.dims, WINDOW)
    mapped = O.map_customers(st.all_orders, st.customer_map)
    others = mapped.where(F.col("channel") != N.OWNAPP)
    return O.keep_customers(others, users).select("id", "channel", N.CUSTOMER_ID)


def join_store_details(st: Stage) -> DataFrame:
    out = O.store_details(st.all_orders, st.store_map, st.store_master)
    return out.select(
        "id", "store_id_id",
        *[F.col(c).alias(c.lower().replace(" ", "_")) for c in ("DSR Code", *N.STORE_COLUMNS)],
    )


def flag_orders_with_queries(st: Stage) -> DataFrame:
    return O.flag_complaints(st.all_orders, st.complaints).select("id", "has_query")


def join_item_categories(st: Stage) -> DataFrame:
    return _labels(_categorized(st)).select(
        "sales_id", "item_id_id", "quantity", "ProductCode", "base_label", "dri_label"
    )


def semi_items_in_orders(st: Stage) -> DataFrame:
    orders = O.store_window(
        st.all_as_instore_orders, "BussTime", WINDOW.run_date, WINDOW.months, WINDOW.test_store
    )
    kept = I.items_of_orders(st.all_as_instore_items, orders)
    return kept.select("InvoiceNo", "ProductCode", "quantity", "PriceNet")


def choice_counts(st: Stage) -> DataFrame:
    return I.pair_counts(st.all_items)


def remove_choice_items(st: Stage) -> DataFrame:
    kept = I.remove_choices(st.all_items, st.combos)
    return kept.select("sales_id", "item_id_id", "quantity", "original_price")


def remove_choice_items_instore(st: Stage) -> DataFrame:
    kept = I.remove_choices(st.all_as_instore_items, st.combos, I.IN_STORE)
    return kept.select("InvoiceNo", "ProductCode", "quantity", "PriceNet")


# -- order-level aggregates -------------------------------------------------

def _clean(st: Stage) -> DataFrame:
    return I.drop_unmapped(I.payable_items(_categorized(st)))


def price_bucket_presence(st: Stage) -> DataFrame:
    return I.bucket_presence(_clean(st))


def dri_category_presence(st: Stage) -> DataFrame:
    return I.label_presence(_clean(st), N.DRI_LABEL, st.catalog.dri)


def base_category_presence(st: Stage) -> DataFrame:
    return I.label_presence(_clean(st), N.BASE_LABEL, st.catalog.base)


def order_item_stats(st: Stage) -> DataFrame:
    return I.item_stats(st.all_items)


def instore_item_count(st: Stage) -> DataFrame:
    return I.item_count(st.all_as_instore_items)


def promo_items(st: Stage) -> DataFrame:
    return I.promo_quantity(st.all_items)


def unique_dri_in_order(st: Stage) -> DataFrame:
    return I.label_lists(_clean(st), N.DRI_LABEL, st.catalog.dri, N.DRI_LIST)


def unique_base_in_order(st: Stage) -> DataFrame:
    return I.label_lists(_clean(st), N.BASE_LABEL, st.catalog.base, N.BASE_LIST)


# -- order features ---------------------------------------------------------

def _ownapp(st: Stage) -> DataFrame:
    return P.delivery_order_features(
        st.delivery_orders(N.OWNAPP), st.delivery_items(N.OWNAPP), st.dims, WINDOW, st.complaints
    )


def _users(st: Stage) -> DataFrame:
    return P.ownapp_customers(st.delivery_orders(N.OWNAPP), st.dims, WINDOW)


def _swiggy(st: Stage, users: DataFrame | None) -> DataFrame:
    return P.delivery_order_features(
        st.delivery_orders(N.SWIGGY), st.delivery_items(N.SWIGGY), st.dims, WINDOW, None, users
    )


def _instore(st: Stage, users: DataFrame | None) -> DataFrame:
    return P.instore_order_features(st.instore_orders, st.instore_items, st.dims, WINDOW, users)


def order_features(st: Stage) -> DataFrame:
    """Own-app form of every order."""
    return P.delivery_order_features(st.all_orders, st.all_items, st.dims, WINDOW, st.complaints)


def order_features_aggregator(st: Stage) -> DataFrame:
    """Aggregator form of every order: customers of the own app only, no complaints."""
    return P.delivery_order_features(st.all_orders, st.all_items, st.dims, WINDOW, None, _users(st))


def order_features_instore(st: Stage) -> DataFrame:
    """In-store form of every order."""
    return P.instore_order_features(st.all_as_instore_orders, st.all_as_instore_items, st.dims, WINDOW, _users(st))


# -- customer features ------------------------------------------------------

def union_channels(st: Stage) -> DataFrame:
    users = _users(st)
    channels = {N.OWNAPP: _ownapp(st), N.SWIGGY: _swiggy(st, users), N.INSTORE: _instore(st, users)}
    return C.union_channels(channels, st.catalog, BUCKETS, CUTOFF)


def _customers(st: Stage, *groups: C.MetricGroup) -> DataFrame:
    """Without own-app semi-joins: the customer aggregate drops the others anyway."""
    if groups:
        return customer_features(
            _ownapp(st), _swiggy(st, None), _instore(st, None), st.catalog, CUTOFF, REFERENCE, groups=groups)
    feeds = {c: Feed(st.delivery_orders(c), st.delivery_items(c)) for c in (N.OWNAPP, N.SWIGGY)}
    feeds[N.INSTORE] = Feed(st.instore_orders, st.instore_items)
    return customer_features_of_feeds(feeds, st.dims, WINDOW, CUTOFF, REFERENCE)


MEANS = ("omnichannel_aov", "omnichannel_avg_discount")
GAPS = ("omnichannel_avg_days_between_orders", "ownapp_avg_days_between_orders")


def avg_discount_pct(st: Stage) -> DataFrame:
    return rounded(_customers(st, C.discount_metrics()), "omnichannel_avg_discount_pct")


def unique_base_per_customer(st: Stage) -> DataFrame:
    return _customers(st, C.unique_label_metrics(
        N.BASE_LIST, st.catalog.base, "unique_category_base_products_count"))


def unique_dri_per_customer(st: Stage) -> DataFrame:
    return _customers(st, C.unique_label_metrics(
        N.DRI_LIST, st.catalog.dri, "unique_dri_category_count"))


def unique_labels_after_dimension_change(st: Stage) -> DataFrame:
    """The dimension has lost half of its categories since the order features were written."""
    prices = ("discounted_price", "sub_total_price", "BaseAmount")
    channels = [
        written(c.select(N.CUSTOMER_ID, "order_placed_datetime", N.DRI_LIST, N.BASE_LIST, *[p for p in prices if p in c.columns]), "label-lists")
        for c in (_ownapp(st), _swiggy(st, None), _instore(st, None))
    ]
    fewer = Catalog.from_categories(st.categories.where(F.col(N.DRI_LABEL) < "M"))
    catalog = fewer.covering([c.select(N.DRI_LIST, N.BASE_LIST) for c in channels])
    group = C.unique_label_metrics(N.DRI_LIST, catalog.dri, "unique_dri_category_count")
    return customer_features(*channels, catalog, CUTOFF, REFERENCE, groups=(group,))


def _metrics(st: Stage) -> DataFrame:
    return _customers(st, C.order_metrics(REFERENCE))


def customer_order_metrics(st: Stage) -> DataFrame:
    return rounded(_metrics(st), *MEANS).select(
        N.CUSTOMER_ID, "ownapp_order_count", "swiggy_order_count", "instore_order_count",
        "omnichannel_order_count", "omnichannel_weekend_order_count", "omnichannel_weekday_order_count",
        *MEANS, "omnichannel_first_order_at", "omnichannel_last_order_at",
        "ownapp_first_order_at", "ownapp_last_order_at",
    )


def channel_label(st: Stage) -> DataFrame:
    return _metrics(st).select(N.CUSTOMER_ID, "channels_ordered_from")


def channel_count(st: Stage) -> DataFrame:
    return _metrics(st).select(
        N.CUSTOMER_ID, "omnichannel_weekend_order_count", "omnichannel_weekday_order_count", "channel_count"
    )


def recency_tenure(st: Stage) -> DataFrame:
    return rounded(_metrics(st), *GAPS).select(
        N.CUSTOMER_ID, *[f"{p}_{m}" for p in C.PREFIXES for m in ("recency", "tenure_days")], *GAPS
    )


def daypart_counts(st: Stage) -> DataFrame:
    return _customers(st, C.daypart_metrics(combos=False))


def daypart_combos(st: Stage) -> DataFrame:
    return _customers(st, C.daypart_metrics())


def price_bucket_orders(st: Stage) -> DataFrame:
    return _customers(st, C.bucket_metrics(BUCKETS))


def category_orders(st: Stage) -> DataFrame:
    return _customers(st, C.category_metrics(st.catalog))


def avg_delivery_minutes(st: Stage) -> DataFrame:
    return rounded(_customers(st, C.delivery_metrics()), "ownapp_avg_delivery_time_minutes")


def all_customer_features(st: Stage) -> DataFrame:
    return rounded(
        _customers(st), "omnichannel_avg_discount_pct", *MEANS, *GAPS, "ownapp_avg_delivery_time_minutes"
    )


# -- scalars ----------------------------------------------------------------

def _local_events(st: Stage) -> DataFrame:
    return O.localize(st.table("events"), ["ts"], ZONE)


def localize_timestamps(st: Stage) -> DataFrame:
    return _local_events(st).select("event_id", F.col("ts").alias("local_ts"))


def order_time_of_day(st: Stage) -> DataFrame:
    return _local_events(st).select("event_id", X.daypart(F.col("ts")).alias("order_time_of_day"))


def is_weekend(st: Stage) -> DataFrame:
    return _local_events(st).select("event_id", X.weekend_flag(F.col("ts")).alias("is_weekend"))


def price_bucket(st: Stage) -> DataFrame:
    return st.all_items.select(
        "sales_id", "item_id_id", "original_price",
        X.price_bucket(F.col("original_price")).alias("price_bucket"),
    )


def normalize_category(st: Stage) -> DataFrame:
    raw = F.concat(F.lit(" Café "), "p_name", F.lit(" & ("), "p_brand", F.lit(") "))
    return st.table("part").select("p_partkey", X.normalize_label(raw).alias("label"))


def ensure_list(st: Stage) -> DataFrame:
    text = F.when(
        F.col("p_partkey") % 29 != 0,
        F.concat(F.lit("['"), "p_brand", F.lit("', '"), "p_type", F.lit("']")),
    )
    parts = st.table("part").select("p_partkey", text.alias("text"))
    return parts.select("p_partkey", X.as_list(F.col("text"), parts.schema["text"].dataType).alias("labels"))


# -- segmentation -----------------------------------------------------------

def _light_counts(st: Stage) -> DataFrame:
    return _customers(st, C.order_metrics(REFERENCE), C.daypart_metrics(combos=False)).select(
        N.CUSTOMER_ID, N.TARGET, "channel_count", *spec.WEEK_COUNTS, *spec.DAYPART_COUNTS
    )


def create_flags(st: Stage) -> DataFrame:
    return S.create_flags(_light_counts(st), [*spec.WEEK_COUNTS, *spec.DAYPART_COUNTS])


def rename_features(st: Stage) -> DataFrame:
    return S.rename_features(create_flags(st), spec.RENAMES)


def segment_load_filter(st: Stage) -> DataFrame:
    return G.segment_base(_customers(st), spec.SPEC).select(*spec.KEEP)


def segment_band(st: Stage) -> DataFrame:
    counts = _light_counts(st).select(N.CUSTOMER_ID, N.TARGET)
    parts = [S.band(counts, b).withColumn("band", F.lit(b)) for b in S.BANDS]
    return reduce(DataFrame.unionByName, parts)


GRID_COUNTS = (1, 5, 6, 15, 16, 100)
GRID_UNIQUE = (0, 2, 3, 6, 7, 8, 9, 11, 12, 16, 17)


def _grid(st: Stage) -> DataFrame:
    """Every order line as a point of the rule grid."""
    pick = lambda values, key: F.get(F.array(*map(F.lit, values)), key.cast("int"))
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    odd = lambda c: (c % 2).cast("int")
    return st.table("lineitem").select(
        supp.cast("string").alias(N.CUSTOMER_ID),
        pick(GRID_COUNTS, order % 6).cast("bigint").alias(N.TARGET),
        pick(GRID_UNIQUE, part % 11).cast("bigint").alias("unique_cat_base_count"),
        (1 + odd(supp)).alias("channel_count"),
        odd(F.col("l_linenumber")).alias("Weekend_flag"),
        odd(F.col("l_quantity").cast("int")).alias("Weekday_flag"),
        (F.col("l_returnflag") == "A").cast("int").alias("Premium_price_flag"),
        (F.col("l_linestatus") == "O").cast("int").alias("Lunch_flag"),
        odd(F.round(F.col("l_discount") * 100).cast("int")).alias("Late_Night_flag"),
        odd(F.round(F.col("l_tax") * 100).cast("int")).alias("Breakfast_flag"),
        odd(F.floor(part / 11)).alias("Evening_flag"),
    )


def segment_rules_grid(st: Stage) -> DataFrame:
    return S.add_segment(_grid(st))


def segment_dedupe(st: Stage) -> DataFrame:
    return S.assign_segments(_grid(st))


def segment_summary(st: Stage) -> DataFrame:
    flagged = G.flagged(G.segment_base(_customers(st), spec.SPEC), spec.SPEC)
    n, orders = F.col("Customer Count"), F.col("Total Orders")
    return S.segment_summary(flagged).select(
        "Segment", n.alias("customer_count"), orders.alias("total_orders"),
        F.col("Avg Orders per Customer").alias("avg_orders"),
    )


def rule_segments(st: Stage) -> DataFrame:
    return G.rule_segments(_customers(st), spec.SPEC)


def segments_with_features(st: Stage) -> DataFrame:
    return G.segments_with_features(_customers(st), spec.SPEC)


# -- capping and scoring ----------------------------------------------------

def cap_outliers(st: Stage) -> DataFrame:
    columns = ["channel_count", *spec.WEEK_COUNTS, *spec.DAYPART_COUNTS]
    return rounded(M.cap_outliers(_light_counts(st)), *columns)


def kmeans_assign(st: Stage) -> DataFrame:
    label = M.nearest_center("transform(embedding, x -> CAST(x AS DOUBLE))", spec.EMBEDDING_MODEL)
    return st.table("embeddings").select("vec_id", label.alias("microcluster"))


def microsegments(st: Stage) -> DataFrame:
    return G.micro_segments(_customers(st), spec.SPEC, spec.MODELS)


def microsegments_grid(st: Stage) -> DataFrame:
    """Every order line as a customer: all plans have members, the capped ones among them."""
    columns = [F.expr(e.replace("VARCHAR", "STRING")).alias(c) for c, e in spec.grid_columns().items()]
    scored = G.micro_segments(st.table("lineitem").select(*columns), spec.SPEC, spec.MODELS)
    return scored.select(N.CUSTOMER_ID, "Segment", "microcluster")


def fit_models(st: Stage) -> DataFrame:
    """Models of all plans fitted on every order line as a customer; the scaler in full, the centers by number."""
    columns = [F.expr(e.replace("VARCHAR", "STRING")).alias(c) for c, e in spec.grid_columns().items()]
    wanted = {p.model_key: spec.MODEL_FEATURES for p in spec.PLANS}
    models = G.fitted_models(st.table("lineitem").select(*columns), spec.SPEC, wanted)
    each = models.select("model_key", F.size("centers").alias("centers"), F.inline(F.arrays_zip("features", "mean", "scale")))
    return rounded(each.withColumnRenamed("features", "feature"), "mean", "scale")


def microcluster_sizes(st: Stage) -> DataFrame:
    return M.microcluster_sizes(microsegments(st))


# -- counters ---------------------------------------------------------------

def quality_counters(st: Stage) -> DataFrame:
    """One aggregate over the orders, one over the lines, one over the categories."""
    orders = O.with_customers(O.flag_complaints(
        O.store_details(st.all_orders, st.store_map, st.store_master), st.complaints), st.customer_map)
    recent = O.in_window(orders, "order_placed_datetime", WINDOW.run_date, WINDOW.months, ZONE)
    marked = O.localize(orders.withColumn("_recent", recent), ["order_placed_datetime"], ZONE)
    placed = F.when(F.col("_recent"), F.col("order_placed_datetime"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    lines = _categorized(st)
    kept = I.is_payable_and_mapped()
    return Q.collect_counters(
        Q.counted(marked, {
            ("orders", "rows"): Q.rows(), ("window", "rows"): Q.rows(F.col("_recent")),
            ("window", "first"): day(F.min(placed)), ("window", "last"): day(F.max(placed)),
            ("customers", "rows"): Q.rows(F.col(N.CUSTOMER_ID).isNotNull()),
            ("customers", "missing"): Q.missing(N.CUSTOMER_ID),
            ("stores", "missing_store"): Q.missing("Store Name"), ("complaints", "flagged"): Q.hits("has_query"),
            **{(channel, end): day(f(F.when(F.col("channel") == channel, placed)))
               for channel in N.CHANNELS for end, f in (("first", F.min), ("last", F.max))},
        }),
        Q.counted(lines, {
            ("items", "rows"): Q.rows(), ("items", "missing_category"): Q.missing(N.DRI_LABEL),
            ("kept_items", "rows"): Q.rows(kept), ("kept_items", "removed"): Q.rows(~kept),
        }),
        Q.duplicate_keys("categories", st.categories, "item_id_id"),
    )


# name -> function; the names are the operator keys of the survey
QUERIES: dict[str, Callable[[Stage], DataFrame]] = {
    f.__name__: f
    for f in (
        scan_orders, scan_order_items, scan_instore_csv, scan_instore_items_csv, scan_dimensions_csv,
        scan_complaints, sink_order_features, scan_csv_columns, reread_ownapp_customers, reread_recent_orders,
        sink_customer_features, sink_segments, sink_microsegments, model_table,
        filter_date_window, filter_exclude_store_window, filter_window_missing_store, filter_unmapped_excluded,
        filter_promo_items, filter_cutoff_window, project_base_features, project_instore_base,
        price_without_taxes, normalize_keys, join_customer_map, join_customer_map_composite,
        semi_ownapp_customers, join_store_details, flag_orders_with_queries, join_item_categories,
        semi_items_in_orders, choice_counts, remove_choice_items, remove_choice_items_instore,
        price_bucket_presence, dri_category_presence, base_category_presence, order_item_stats,
        instore_item_count, promo_items, unique_dri_in_order, unique_base_in_order,
        order_features, order_features_aggregator, order_features_instore, union_channels, avg_discount_pct,
        unique_base_per_customer, unique_dri_per_customer, unique_labels_after_dimension_change, customer_order_metrics, channel_label,
        channel_count, recency_tenure, daypart_counts, daypart_combos, price_bucket_orders,
        category_orders, avg_delivery_minutes, localize_timestamps, order_time_of_day, is_weekend,
        price_bucket, normalize_category, ensure_list, create_flags, rename_features,
        segment_load_filter, segment_band, segment_rules_grid, segment_dedupe, segment_summary,
        rule_segments, segments_with_features, cap_outliers, kmeans_assign, microsegments,
        microsegments_grid, fit_models, microcluster_sizes, quality_counters,
    )
}
QUERIES["customer_features"] = all_customer_features


@lru_cache(maxsize=16)
def _stage(spark: SparkSession, sf_dir: str) -> Stage:
    return Stage(spark, sf_dir.rstrip("/"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(_stage(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}
