"""The whole job from files and JSON config, against the registered queries."""

import json
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.config import FeatureConfig, SegmentConfig, micro_plans
from cartwright.operators.centroids import MODEL_SCHEMA
from cartwright.plans import segmentation as G
from cartwright.plans import workflow as W
from cartwright.plans.stages import Records
from cartwright.sources import readers as R
from checks import queries as Q
from checks import spec
from checks.compare import rows_of
from checks.staging import CUTOFF, REFERENCE, WINDOW, Stage

SF_DIR = "/root/testdata/sf0.001"
ITEM_COLUMNS = ["sales_id", "quantity", "item_id_id", "is_customized", "is_veg", "promo_item", "original_price"]
ORDER_COLUMNS = [
    "id", "user_id", "store_id_id", "order_placed_datetime", "order_delivery_datetime", "schedule_datetime",
    "discounted_price", "sub_total_price", "gross_price", "total_price", "platform", "channel", "status_id",
]


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    st = Stage(spark, SF_DIR)
    for ch in (N.OWNAPP, N.SWIGGY):
        st.delivery_orders(ch).write.parquet(f"{root}/{ch}/orders")
        st.delivery_items(ch).write.parquet(f"{root}/{ch}/items")
    st.complaints.withColumn("order_id", F.col("order_id").cast("double")).write.parquet(f"{root}/complaints")
    csv = {
        "map": st.customer_map, "store_map": st.store_map, "store_master": st.store_master,
        "categories": st.categories, "combos": st.combos,
        "instore_orders": st.instore_orders,
        "instore_items": st.instore_items.withColumnRenamed("quantity", "Qty"),
    }
    for name, df in csv.items():
        df.select(*reversed(df.columns)).write.option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(f"{root}/{name}", header=True)
    delivery = lambda ch, has_query: {
        "orders_data_path": f"{root}/{ch}/orders", "orders_columns": ORDER_COLUMNS,
        "order_items_data_path": f"{root}/{ch}/items", "order_items_columns": ITEM_COLUMNS,
        "output_path": f"{root}/out/{ch}", "orderqueries_path": f"{root}/complaints" if has_query else "",
        "has_query": has_query,
    }
    features = {
        N.OWNAPP: delivery(N.OWNAPP, True),
        N.SWIGGY: delivery(N.SWIGGY, False),
        N.INSTORE: {
            "orders_file_pattern": f"{root}/instore_orders/*.csv",
            "order_items_file_pattern": f"{root}/instore_items/*.csv",
            "output_path": f"{root}/out/instore",
        },
        "common": {
            "current_run_date": WINDOW.run_date.isoformat(), "months_offset": WINDOW.months,
            "timezone": WINDOW.zone, "test_store_code": WINDOW.test_store, "mapping_file": f"{root}/map",
            "store_mds_dsr_path": f"{root}/store_map", "store_master_path": f"{root}/store_master",
            "categories_path": f"{root}/categories", "clear_master_path": f"{root}/combos",
            "order_features_by_month": True,
            "price_config": {"price_bins": list(N.PRICE_BINS), "bucket_labels": list(N.BUCKET_LABELS)},
        },
        "customer": {"cutoff_date": CUTOFF.isoformat(), "reference_date": REFERENCE.isoformat(),
                     "output_path": f"{root}/out/customers"},
    }
    segments = {
        "input_path": f"{root}/elsewhere", "output_segments_path": f"{root}/out/segments",
        "output_microsegments_path": f"{root}/out/micro",
        "cols_to_keep": list(spec.KEEP), "convert_to_flag": list(spec.FLAGS),
        "rename_dict": spec.RENAMES, "rename_dict_microsegments": spec.MICRO_RENAMES,
        "micro_plan": [{"name": p.name, "source_segments": list(p.source_segments), "model_key": p.model_key}
                       for p in spec.PLANS],
    }
    for key, m in spec.MODELS.items():
        path = f"{root}/models/{key}"
        spark.createDataFrame([(m.key, list(m.features), list(m.mean), list(m.scale), [list(c) for c in m.centers])],
                              MODEL_SCHEMA).write.parquet(path)
        segments[key] = path
    for name, raw in (("features", features), ("segments", segments)):
        with open(f"{root}/{name}.json", "w", encoding="utf-8") as f:
            json.dump(raw, f)
    fc, sc = FeatureConfig.load(f"{root}/features.json"), SegmentConfig.load(f"{root}/segments.json")
    W.run_all(spark, fc, sc)
    return root, fc, sc, st


def same(left, right, drop=()):
    columns = sorted(set(right.columns) - set(drop))
    a, b = left.select(*[f"`{c}`" for c in columns]), right.select(*[f"`{c}`" for c in columns])
    assert rows_of(columns, a.collect()) == rows_of(columns, b.collect())


def test_order_outputs(spark, job):
    _, fc, _, st = job
    both = R.read_parquet(spark, fc.delivery[N.OWNAPP].output_path).unionByName(
        R.read_parquet(spark, fc.delivery[N.SWIGGY].output_path))
    assert both.count() > 500
    users = Q._users(st)
    same(both, Q._ownapp(st).unionByName(Q._swiggy(st, users)))
    same(R.read_parquet(spark, fc.instore.output_path), Q._instore(st, users))


def test_customer_output(spark, job):
    root, fc, _, st = job
    written = R.read_parquet(spark, fc.customer_output_path)
    means = ("omnichannel_avg_discount_pct", *Q.MEANS, *Q.GAPS, "ownapp_avg_delivery_time_minutes")
    same(Q.rounded(written, *means), Q.all_customer_features(st))


def test_segment_outputs(spark, job):
    _, _, sc, st = job
    same(spark.read.parquet(sc.segments_path), Q.rule_segments(st))
    same(spark.read.parquet(sc.micro_path), Q.microsegments(st))


def test_micro_from_stored_assignments(spark, job):
    _, fc, sc, _ = job
    base = G.segment_base(spark.read.parquet(fc.customer_output_path), sc.spec)
    joined = G.micro_segments_from_assignments(base, spark.read.parquet(sc.segments_path), sc.spec, spec.MODELS)
    same(joined, spark.read.parquet(sc.micro_path))


def test_month_layout_is_pruned(spark, job):
    _, fc, _, _ = job
    df = W.read_order_features(spark, fc.delivery[N.OWNAPP].output_path, date(2001, 1, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert "order_month" not in df.columns


def test_shipped_style_config_errors():
    good = {"name": "x", "source_segments": ["Seg1_5_1"], "model_key": "m"}
    assert micro_plans([good], {"m": "path"})[0].enabled
    with pytest.raises(ValueError):
        micro_plans([{"name": "x"}], {})
    with pytest.raises(ValueError):
        micro_plans([{**good, "source_segments": []}], {"m": "p"})
    with pytest.raises(KeyError):
        micro_plans([good], {})


def test_bins_must_match_labels(job):
    _, fc, _, _ = job
    assert replace(fc, by_month=False).window == WINDOW
    with pytest.raises(ValueError):
        FeatureConfig.from_dict({
            "ownapp": {}, "swiggy": {}, "instore": {}, "customer": {},
            "common": {"price_config": {"price_bins": [0, 1], "bucket_labels": ["a", "b"]}},
        })


def test_reader_normalises_csv(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("StoreCode,InvoiceNo,BussTime,GrossAmount,Extra,Discount,BaseAmount,TransType,SaleType\n"
                    "7.0,123.0,2025-01-01 10:00:00,NaN,z,1,2,a,b\n8,x,bad,2.5,z,1,2,a,b\n")
    rows = R.read_instore_orders(spark, str(path)).orderBy("StoreCode").collect()
    assert [r["InvoiceNo"] for r in rows] == [123, None]
    assert [r["GrossAmount"] for r in rows] == [None, 2.5]
    assert rows[1]["BussTime"] is None and "Extra" not in rows[0].asDict()


def test_counters_and_summaries_are_written(spark, job):
    _, fc, sc, st = job
    counted = {(r["step"], r["metric"]): r["value"] for p in (*(c.output_path for c in fc.delivery.values()), fc.instore.output_path)
               for r in spark.read.parquet(p + W.COUNTERS).collect()}
    own = spark.read.parquet(fc.delivery[N.OWNAPP].output_path)
    assert counted["ownapp output", "rows"] == str(own.count())
    assert counted["ownapp output", "flagged"] == str(own.where("has_query").count())
    assert counted["ownapp output", "last_order"] == str(own.agg({"order_placed_datetime": "max"}).first()[0])
    assert int(counted["ownapp window", "rows"]) == own.count() + int(counted["ownapp window", "without_customer"])
    dims = {(r["step"], r["metric"]): r["value"] for r in spark.read.parquet(fc.customer_output_path + W.COUNTERS).collect()}
    assert dims["categories by item", "duplicate_keys"] == "0"
    summary = spark.read.parquet(sc.segments_path + W.SUMMARY)
    assert summary.count() == 27 and summary.agg({"customer_count": "sum"}).first()[0] == spark.read.parquet(sc.segments_path).count()
    sizes = spark.read.parquet(sc.micro_path + W.SUMMARY)
    assert sizes.agg({"customers": "sum"}).first()[0] == spark.read.parquet(sc.micro_path).count()


def test_grid_reaches_every_plan(spark):
    st = Q.Stage(spark, "/root/testdata/sf0.001")
    assert Q.microsegments_grid(st).select("Segment").distinct().count() == len(spec.PLANS)



def moved(fc, sc, root):
    """The same job with its outputs under ``root``."""
    delivery = {c: replace(d, output_path=f"{root}/{c}") for c, d in fc.delivery.items()}
    fc = replace(fc, delivery=delivery, instore=replace(fc.instore, output_path=f"{root}/instore"), customer_output_path=f"{root}/customers")
    return fc, replace(sc, segments_path=f"{root}/segments", micro_path=f"{root}/micro")


def test_restarted_run_passes_over_finished_stages(spark, job, tmp_path, monkeypatch):
    """A failure in the aggregator stage, then one restart that goes on there, then nothing left to do; changed settings count."""
    _, fc, sc, _ = job
    fc, sc = moved(fc, sc, str(tmp_path))
    ran = []
    run_orders = W.run_orders

    def failing(spark, cfg, channel, dims=None):
        if channel == N.SWIGGY:
            raise RuntimeError("lost")
        ran.append(channel)
        return run_orders(spark, cfg, channel, dims)

    monkeypatch.setattr(W, "run_orders", failing)
    with pytest.raises(RuntimeError, match="lost"):
        W.run_all(spark, fc, sc, resume=True)
    assert ran == [N.OWNAPP]
    monkeypatch.setattr(W, "run_orders", run_orders)
    root = f"{fc.customer_output_path}{W.RECORDS}"
    left = W.run_stages(spark, W.stages(spark, fc, sc), root, resume=True)
    assert left == [f"orders-{N.SWIGGY}", f"orders-{N.INSTORE}", "customers", "segments"]
    same(spark.read.parquet(sc.segments_path), spark.read.parquet(job[2].segments_path))
    todo = lambda a, b: [s.name for s in W.stages(spark, a, b) if not Records(spark, root).is_done(s)]
    assert todo(fc, sc) == []
    assert todo(replace(fc, cutoff=date(1997, 1, 1)), sc) == ["customers"]
    spark.read.parquet(sc.segments_path).limit(1).coalesce(1).write.mode("append").parquet(sc.segments_path)
    assert todo(fc, sc) == ["segments"]


def test_model_fit_writes_tables_that_score(spark, job, tmp_path):
    _, fc, sc, _ = job
    paths = {k: f"{tmp_path}/{k}" for k in sc.model_paths}
    cfg = replace(sc, model_paths=paths)
    W.run_model_fit(spark, cfg, {k: spec.MODEL_FEATURES for k in paths}, fc.customer_output_path, clusters=2)
    fitted = {r["model_key"] for p in paths.values() for r in spark.read.parquet(p).collect()}
    base = G.segments_with_features(R.read_parquet(spark, fc.customer_output_path), cfg.spec)
    held = {r["Segment"] for r in base.select("Segment").distinct().collect()}
    assert fitted == {p.model_key for p in spec.PLANS if held & set(p.source_segments)} and fitted
