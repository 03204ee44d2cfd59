from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators import orders as O


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


def test_window_includes_start_excludes_run_date(spark):
    clocks = [
        (1, datetime(2023, 3, 31, 18, 30)),   # local start midnight
        (2, datetime(2023, 3, 31, 18, 29, 59)),
        (3, datetime(2025, 6, 30, 18, 29, 59)),
        (4, datetime(2025, 6, 30, 18, 30)),   # local run date
        (5, None),
    ]
    df = spark.createDataFrame(clocks, "id long, order_placed_datetime timestamp_ntz")
    out = O.local_window(df, ["order_placed_datetime", "absent"], date(2025, 7, 1), 27, "Asia/Kolkata")
    assert {r["id"]: r["order_placed_datetime"] for r in out.collect()} == {
        1: datetime(2023, 4, 1), 3: datetime(2025, 6, 30, 23, 59, 59),
    }


def test_window_predicate_is_on_the_stored_column(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.sql("SELECT 1L AS id, timestamp'2025-01-01 00:00:00' AS order_placed_datetime, 2.0D AS other").write.parquet(path)
    df = O.local_window(spark.read.parquet(path).select("id", "order_placed_datetime"),
                        ["order_placed_datetime"], date(2025, 7, 1), 27, "Asia/Kolkata")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan


def test_store_window_drops_test_store(spark):
    df = spark.createDataFrame(
        [(1, datetime(2025, 1, 1), 9993), (2, datetime(2025, 1, 1), 5), (3, datetime(2025, 7, 1), 5)],
        "InvoiceNo long, BussTime timestamp_ntz, StoreCode int",
    )
    assert ids(O.store_window(df, "BussTime", date(2025, 7, 1), 27, 9993), "InvoiceNo") == [2]
    assert ids(O.store_window(df, "BussTime", date(2025, 7, 1), 27, None), "InvoiceNo") == [1, 2]


def test_customer_map_drops_unknown_and_keeps_duplicates(spark):
    orders = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id long")
    mapping = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "z")], "invoice_no long, customer_code_ty string"
    )
    got = sorted((r["id"], r[N.CUSTOMER_ID]) for r in O.map_customers(orders, mapping).collect())
    assert got == [(1, "a"), (1, "b")]


def test_composite_map_needs_all_three_keys(spark):
    orders = spark.createDataFrame(
        [(1, datetime(2025, 1, 1, 23), 5), (1, datetime(2025, 1, 2, 1), 5), (1, datetime(2025, 1, 1, 2), 6)],
        "InvoiceNo long, BussTime timestamp_ntz, StoreCode int",
    )
    mapping = spark.createDataFrame(
        [(1, "a", date(2025, 1, 1), 5)], "invoice_no long, customer_code_ty string, invoice_date date, store_code int"
    )
    got = sorted(str(r[N.CUSTOMER_ID]) for r in O.map_customers_instore(orders, mapping).collect())
    assert got == ["None", "None", "a"]


def test_semi_join_does_not_multiply(spark):
    orders = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], f"id long, {N.CUSTOMER_ID} string")
    users = spark.createDataFrame([("a",), ("a",), (None,)], f"{N.CUSTOMER_ID} string")
    assert ids(O.keep_customers(orders, O.customer_ids(users))) == [1, 2]


def test_store_details_trim_and_left(spark):
    orders = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "id long, store_id_id int")
    codes = spark.createDataFrame([(10, " A1 "), (11, "A2")], "`MDS ID` int, `DSR Code` string")
    master = spark.createDataFrame([("A1 ", "Fort", "Mall")], "`Store Code` string, `Store Name` string, `Store Type` string")
    out = {r["id"]: (r["DSR Code"], r["Store Name"]) for r in O.store_details(orders, codes, master).collect()}
    assert out == {1: ("A1", "Fort"), 2: ("A2", None), 3: (None, None)}


def test_complaints(spark):
    orders = spark.createDataFrame([(1,), (2,)], "id long")
    complaints = spark.createDataFrame([(2,), (2,), (None,)], "order_id long")
    assert {r["id"]: r["has_query"] for r in O.flag_complaints(orders, complaints).collect()} == {1: False, 2: True}
    assert {r["has_query"] for r in O.flag_complaints(orders, None).collect()} == {False}


def test_projection_skips_absent_inputs(spark):
    df = spark.sql("SELECT 7L AS id, 1.5D AS gross_price, 'x' AS `Store Type`")
    out = O.delivery_base(df)
    assert out.columns == ["order_id", "pre_discount_order_value", "gross_price", "store_type"]
    assert tuple(out.first()) == (7, 1.5, 1.5, "x")


def test_order_clock(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 4, 12),)], "order_placed_datetime timestamp_ntz")
    row = O.add_order_clock(df).first()
    assert (row["order_time_of_day"], row["is_weekend"]) == ("Lunch", 1)
    assert O.since_cutoff(df, date(2025, 1, 4)).count() == 1
    assert O.since_cutoff(df, date(2025, 1, 5)).count() == 0


def test_a_missing_store_is_kept(spark):
    df = spark.createDataFrame([(1, 13), (2, None), (3, 4)], "id long, StoreCode long").withColumn(
        "BussTime", F.lit("2024-01-10 10:00:00").cast("timestamp_ntz"))
    kept = O.store_window(df, "BussTime", date(2024, 2, 1), 1, 13)
    assert sorted(r["id"] for r in kept.collect()) == [2, 3]


def test_window_of_instants_reaches_the_scan(spark, tmp_path):
    """Both bounds are pushed for TIMESTAMP, and mean local midnights in any session zone."""
    zone, path = "Asia/Kolkata", str(tmp_path / "t")
    stamps = ["2023-12-31 18:29:59", "2023-12-31 18:30:00", "2024-01-31 18:29:59", "2024-01-31 18:30:00"]
    spark.createDataFrame([(s,) for s in stamps], "s string").select(
        F.col("s"), F.col("s").cast("timestamp").alias("placed")).write.parquet(path)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            out = O.local_window(spark.read.parquet(path), ["placed"], date(2024, 2, 1), 1, zone)
            assert sorted(r["s"] for r in out.collect()) == stamps[1:3]
            plan = out._jdf.queryExecution().executedPlan().toString()
            pushed = plan[plan.index("PushedFilters"):].split("]")[0]
            assert "GreaterThanOrEqual(placed" in pushed and "LessThan(placed" in pushed
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_csv_by_name(spark, tmp_path):
    """Files may order their columns differently; a missing column is an error; an optional one is NULL."""
    from cartwright.sources.readers import read_csv

    (tmp_path / "a.csv").write_text("InvoiceNo,StoreCode,Note\n1,7,x\n")
    (tmp_path / "b.csv").write_text('StoreCode,Note,InvoiceNo\n8,"two\nlines",2\n')
    columns = {"InvoiceNo": "long", "StoreCode": "long", "Note": "raw"}
    got = read_csv(spark, f"{tmp_path}/*.csv", columns, multi_line=True)
    assert sorted(map(tuple, got.collect())) == [(1, 7, "x"), (2, 8, "two\nlines")]
    (tmp_path / "c.csv").write_text("InvoiceNo,StoreCode\n3,9\n")
    with pytest.raises(ValueError, match="Note"):
        read_csv(spark, f"{tmp_path}/*.csv", columns)
    some = read_csv(spark, f"{tmp_path}/*.csv", columns, optional=["Note"], multi_line=True)
    assert sorted((r["InvoiceNo"], r["Note"]) for r in some.collect()) == [(1, "x"), (2, "two\nlines"), (3, None)]


def test_lines_are_restricted_before_the_fold(spark):
    """The semi-join with kept invoices stands below the aggregate over (order, item)."""
    from checks.staging import WINDOW, Stage
    from cartwright.plans import order_features as P

    st = Stage(spark, "/root/testdata/sf0.001")
    users = P.ownapp_customers(st.delivery_orders("ownapp"), st.dims, WINDOW)
    out = P.instore_order_features(st.all_as_instore_orders, st.all_as_instore_items, st.dims, WINDOW, users)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    fold = next(i for i, x in enumerate(plan) if "Aggregate [InvoiceNo" in x and "ProductCode" in x and "_paid_qty" in x)
    depth = len(plan[fold]) - len(plan[fold].lstrip(" :+-"))
    below = [x for x in plan[fold + 1:] if len(x) - len(x.lstrip(" :+-")) > depth]
    assert any("LeftSemi" in x for x in below)


def test_store_names_join_after_the_items(spark):
    """Orders are dealt to their lines without store columns and with every input once."""
    from checks.staging import WINDOW, Stage
    from cartwright.plans import order_features as P

    st = Stage(spark, "/root/testdata/sf0.001")
    for out in (P.delivery_order_features(st.all_orders, st.all_items, st.dims, WINDOW, st.complaints),
                P.instore_order_features(st.all_as_instore_orders, st.all_as_instore_items, st.dims, WINDOW, None)):
        plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
        fold = next(i for i, x in enumerate(plan) if "Aggregate [" in x and "_any" in x)
        depth = len(plan[fold]) - len(plan[fold].lstrip(" :+-"))
        above = [x for x in plan[:fold] if len(x) - len(x.lstrip(" :+-")) < depth and "Join LeftOuter" in x]
        assert "Code" in above[0] and not any(c in above[-1] for c in ("Code", "MDS"))
