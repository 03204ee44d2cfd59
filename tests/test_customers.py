import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators import customers as C
from cartwright.operators.items import bucket_columns
from cartwright.operators.labels import Catalog, LabelSet
from cartwright.plans.customer_features import customer_features

CATALOG = Catalog(
    dri=LabelSet(N.DRI_PREFIX, ("Core", "Value"), ("core", "value")),
    base=LabelSet(N.BASE_PREFIX, ("Coffee", "Fries"), ("coffee", "fries")),
)
REFERENCE = date(2025, 6, 30)
CUTOFF = date(2024, 7, 1)
COMMON = (
    f"{N.CUSTOMER_ID} string, order_id long, order_placed_datetime timestamp_ntz, total_price double, "
    "discounted_price double, order_time_of_day string, is_weekend int, "
    f"{N.DRI_LIST} array<string>, {N.BASE_LIST} array<string>, Add_ons_items_count int, Economy_items_count int, "
    "dri_categ_core int, categ_base_product_fries int"
)
DELIVERY = COMMON + ", sub_total_price double, order_delivery_datetime timestamp_ntz"
INSTORE = COMMON + ", BaseAmount double"
BUCKETS = ("Add_ons", "Economy")


def order(cust, oid, placed, total=10.0, disc=1.0, part="Lunch", weekend=0, dri=None, base=None,
          b1=None, b2=None, core=None, fries=None):
    return (cust, oid, placed, total, disc, part, weekend, dri, base, b1, b2, core, fries)


def run(spark, own, swiggy=(), instore=(), groups=None):
    frame = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    return {
        r[N.CUSTOMER_ID]: r
        for r in customer_features(
            frame(own, DELIVERY), frame(swiggy, DELIVERY), frame(instore, INSTORE), CATALOG,
            CUTOFF, REFERENCE, BUCKETS, groups,
        ).collect()
    }


def own(*args, sub=9.0, delivered=None, **kw):
    return (*order(*args, **kw), sub, delivered)


def test_single_order_customer(spark):
    placed = datetime(2025, 6, 30, 10)
    out = run(spark, [own("a", 1, placed, dri=["Core"], base=["Fries", "Coffee"], b1=1, core=1, fries=0,
                          delivered=placed + timedelta(minutes=30, seconds=30))])
    r = out["a"]
    assert r["omnichannel_recency"] == -1 and r["ownapp_tenure_days"] == 1
    assert r["omnichannel_avg_days_between_orders"] is None
    assert r["channels_ordered_from"] == "OC only" and r["channel_count"] == 1
    assert r["ownapp_avg_delivery_time_minutes"] == 30.5
    assert r["omnichannel_avg_discount_pct"] == pytest.approx(0.1)
    assert (r["unique_category_base_products_count"], r["unique_dri_category_count"]) == (2, 1)
    assert r[N.BASE_LIST] == ["Coffee", "Fries"]
    assert r["omnichannel_order_count_with_Economy_price_range_items"] == 0  # missing flags sum to 0
    assert r["ownapp_dri_categ_core_count"] == 1 and r["ownapp_categ_base_product_fries_count"] == 0


def test_no_categories_give_empty_lists(spark):
    r = run(spark, [own("a", 1, datetime(2025, 1, 1))])["a"]
    assert r[N.BASE_LIST] == [] and r["unique_dri_category_count"] == 0


def test_discount_rules(spark):
    t = datetime(2025, 1, 1)
    out = run(spark, [
        own("zero", 1, t, disc=0.0, sub=0.0),
        own("neg", 2, t, disc=-2.0, sub=12.0),
        own("mix", 3, t, disc=0.0, sub=0.0), own("mix", 4, t, disc=5.0, sub=5.0),
    ], groups=[C.discount_metrics()])
    assert {k: r["omnichannel_avg_discount_pct"] for k, r in out.items()} == {"zero": None, "neg": 0.0, "mix": 0.5}


def test_only_recent_ownapp_customers_remain(spark):
    old, new = datetime(2024, 6, 30, 23, 59), datetime(2024, 7, 1)
    out = run(
        spark,
        [own("kept", 1, new), own("stale", 2, old)],
        [(*order("stale", 3, new), 9.0, None), (*order("never", 4, new), 9.0, None)],
        [(*order("kept", 5, new, disc=None), 10.0)],
    )
    assert set(out) == {"kept"}
    assert (out["kept"]["instore_order_count"], out["kept"]["channel_count"]) == (1, 2)
    assert out["kept"]["channels_ordered_from"] == "OC + Dine in"
    assert out["kept"]["omnichannel_avg_discount"] == 0.5  # missing in-store discount counts as 0


def test_aggregator_delivery_times_are_ignored(spark):
    t = datetime(2025, 1, 1)
    out = run(spark, [own("a", 1, t, delivered=t + timedelta(minutes=10))],
              [(*order("a", 2, t), 9.0, t + timedelta(minutes=90))])
    assert out["a"]["ownapp_avg_delivery_time_minutes"] == 10.0


def test_counts_add_up_and_combos_are_sums(spark):
    rng = random.Random(3)
    rows = {"o": [], "s": [], "i": []}
    for i in range(200):
        base = order(f"c{rng.randrange(6)}", i, datetime(2024, 7, 1) + timedelta(hours=rng.randrange(8000)),
                     part=rng.choice(N.DAYPARTS), weekend=rng.randrange(2))
        kind = rng.choice("osi")
        rows[kind].append((*base, 10.0) if kind == "i" else (*base, 9.0, None))
    for r in run(spark, rows["o"], rows["s"], rows["i"]).values():
        r = r.asDict()
        total = r["omnichannel_order_count"]
        assert r["ownapp_order_count"] + r["swiggy_order_count"] + r["instore_order_count"] == total
        assert r["omnichannel_weekend_order_count"] + r["omnichannel_weekday_order_count"] == total
        for prefix, n in (("omnichannel", total), ("ownapp", r["ownapp_order_count"])):
            assert sum(r[f"{prefix}_{d}_order_count"] for d in N.DAYPARTS) == n
            assert r[f"{prefix}_{'_'.join(N.DAYPARTS)}_order_count"] == n
            assert r[f"{prefix}_Breakfast_Dinner_order_count"] == \
                r[f"{prefix}_Breakfast_order_count"] + r[f"{prefix}_Dinner_order_count"]
        assert len([c for c in r if c.startswith("ownapp_") and any(d in c for d in N.DAYPARTS)]) == 31


def test_union_sorts_columns_and_fills_missing(spark):
    t = datetime(2025, 1, 1)
    a = spark.createDataFrame([own("a", 1, t)], DELIVERY)
    b = spark.createDataFrame([(*order("a", 2, t), 5.0)], INSTORE).drop("dri_categ_core")
    u = C.union_channels({N.OWNAPP: a, N.INSTORE: b}, CATALOG, bucket_columns(BUCKETS), None)
    assert u.columns == sorted(u.columns)
    row = u.where(F.col("channel") == N.INSTORE).first()
    assert row["dri_categ_core"] is None and row["price_without_taxes"] == 6.0
    assert row["order_delivery_datetime"] is None


def test_catalog_from_written_features(spark):
    a = spark.createDataFrame([(["Core"], ["Fries"]), (None, [])], f"{N.DRI_LIST} array<string>, {N.BASE_LIST} array<string>")
    b = spark.createDataFrame([(["Value", "Core"], ["Coffee"])], a.schema)
    assert Catalog.from_order_features([a, b]) == CATALOG


def test_many_labels(spark):
    """Twenty thousand labels: none of them in the plan, sets and counts right."""
    rows = spark.range(20_000).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias(N.CUSTOMER_ID), F.lit(N.OWNAPP).alias("channel"),
        F.array(F.concat(F.lit("label "), F.col("id")), F.lit("shared"), F.lit(None).cast("string")).alias("labels"),
        F.array(F.col("id").cast("int"), F.lit(7)).alias("at"))
    found = C.label_counts(rows, "array_distinct(at)", ["labels"])
    assert "label 1" not in found._jdf.queryExecution().optimizedPlan().toString()
    by = {r[N.CUSTOMER_ID]: r for r in found.collect()}
    for c in range(3):
        ids = range(c, 20_000, 3)
        assert by[f"c{c}"]["_list_1"] == sorted([f"label {i}" for i in ids] + ["shared"])
        counts = by[f"c{c}"]["_counts"]
        assert counts[7]["orders"] == len(ids) and counts[7]["own"] == len(ids) and len(counts) == len(set(ids) | {7})


def test_feeds_and_written_order_features_agree(spark):
    """Channels that share order ids, items without labels, orders without lines or customers, NULL quantities."""
    from cartwright.plans import order_features as P
    from cartwright.plans.customer_features import Feed, customer_features_of_feeds
    from checks.compare import rows_of

    rng = random.Random(11)
    base = datetime(2025, 1, 1)
    ids = range(60)
    frame = spark.createDataFrame
    delivery = "id long, store_id_id int, order_placed_datetime timestamp_ntz, order_delivery_datetime timestamp_ntz, discounted_price double, sub_total_price double, total_price double"

    def orders(n):
        return frame([(i, 1, base + timedelta(hours=rng.randrange(4000)), base if i % 5 else None, float(i % 4), 9.0, 10.0) for i in ids if i % n], delivery)

    def lines(n):
        return frame([(i if i % 11 else None, rng.choice(["1", "2", "3", "4", None]), rng.choice([1, 2, None]), rng.choice([None, 10.0, 120.0, 700.0]),
                       rng.choice([True, False, False, None]), True, False) for i in ids for _ in range(i % n)],
                     "sales_id long, item_id_id string, quantity int, original_price double, promo_item boolean, is_customized boolean, is_veg boolean")

    instore = frame([(i, base + timedelta(hours=i), 1, 10.0, 1.0, 9.0, "t", "s") for i in ids if i % 4],
                    "InvoiceNo long, BussTime timestamp_ntz, StoreCode int, GrossAmount double, Discount double, BaseAmount double, TransType string, SaleType string")
    instore_lines = frame([(i, base, 1, rng.choice(["P1", "P2", "P9"]), 1, 50.0) for i in ids for _ in range(3)],
                          "InvoiceNo long, OrderDatetime timestamp_ntz, StoreCode int, ProductCode string, quantity int, PriceNet double")
    mapped = [(i, f"u{i % 7}" if i % 13 else None) for i in ids]
    # the map dates the in-store business; delivery orders are found by invoice alone
    maps = frame([(i, c, (base + timedelta(hours=i)).date(), 1) for i, c in mapped], "invoice_no long, customer_code_ty string, invoice_date date, store_code int")
    dims = P.Dimensions(
        maps, frame([(1, "1")], "`MDS ID` int, `DSR Code` string"), frame([("1", "S", "T", "C", "K", "G")], ", ".join(f"`{c}` string" for c in (
            "Store Code", "Store Name", "Store Type", "Geographical City", "Key City", "Generator New"))),
        frame([("1", "P1", "Coffee", "Core"), ("2", "P2", " Fries ", "Value"), ("2", "P2", "Fries", "Value"), ("3", None, "Exclude", "Core"), (None, "P9", "Coffee", None)],
              f"item_id_id string, ProductCode string, `{N.BASE_LABEL}` string, `{N.DRI_LABEL}` string"),
        frame([("1", "2", "P1", "P2", 1)], "header_item_id_id string, choice_item_id_id string, HeaderItemId string, ChoiceItemId string, Qty long"), CATALOG)
    window = P.OrderWindow(date(2025, 12, 1), 24)
    feeds = {N.OWNAPP: Feed(orders(3), lines(4)), N.SWIGGY: Feed(orders(2), lines(5)), N.INSTORE: Feed(instore, instore_lines)}
    direct = customer_features_of_feeds(feeds, dims, window, CUTOFF, REFERENCE)
    own_orders, other = (P.delivery_order_features(feeds[c].orders, feeds[c].items, dims, window) for c in (N.OWNAPP, N.SWIGGY))
    stepwise = customer_features(own_orders, other, P.instore_order_features(instore, instore_lines, dims, window, None), CATALOG, CUTOFF, REFERENCE)
    columns = sorted(direct.columns)
    assert columns == sorted(stepwise.columns) and dict(direct.dtypes) == dict(stepwise.dtypes)
    # sums of doubles depend on the order of their rows in the last digits
    even = [F.round(f"`{c}`", 9).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in sorted(direct.dtypes)]
    got = rows_of(columns, direct.select(*even).collect())
    assert len(got) == 7 and got == rows_of(columns, stepwise.select(*even).collect())


def test_label_counts_are_dealt_by_customer_once(spark):
    """Labels of encoded orders are shuffled as bits, not as (customer, label) rows."""
    rows = [("a", N.OWNAPP, 5), ("a", N.SWIGGY, 1), ("b", N.INSTORE, 0), (None, N.OWNAPP, 7)]
    orders = spark.createDataFrame(rows, f"{N.CUSTOMER_ID} string, channel string, w long")
    out = C.label_counts(orders, "filter(array(0, 1, 2), i -> (w & shiftleft(1L, i)) <> 0)")
    got = {r[N.CUSTOMER_ID]: {k: tuple(v) for k, v in r["_counts"].items()} for r in out.collect()}
    assert got == {"a": {0: (2, 1), 2: (1, 1)}}
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
