"""The whole job: stage by stage through written tables.

Each stage writes its output and the next one reads it back. That cuts the
lineage at storage every executor can reach: a lost executor repeats tasks of
one stage, never the stages before it.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.config import FeatureConfig, SegmentConfig
from cartwright.operators import centroids as M
from cartwright.operators import metrics as Q
from cartwright.operators import orders as O
from cartwright.operators import segments as S
from cartwright.operators.labels import Catalog
from cartwright.operators.orders import customer_ids
from cartwright.plans import order_features as P
from cartwright.plans import segmentation as G
from cartwright.plans.customer_features import customer_features
from cartwright.plans.stages import Stage, run_stages
from cartwright.session import delete_at_exit, shared_dir
from cartwright.sources import readers as R
from cartwright.sources.sinks import replace_table, write_features

# written next to the outputs they describe
COUNTERS, SUMMARY, RECORDS = "_counters", "_summary", "_stages"

log = logging.getLogger(__name__)


def dimensions(spark: SparkSession, cfg: FeatureConfig) -> P.Dimensions:
    categories = R.read_csv(spark, cfg.categories_path, R.CATEGORIES)
    return P.Dimensions(
        customer_map=R.read_csv(spark, cfg.customer_map_path, R.CUSTOMER_MAP),
        store_map=R.read_csv(spark, cfg.store_map_path, R.STORE_MAP),
        store_master=R.read_csv(spark, cfg.store_master_path, R.STORE_MASTER),
        categories=categories,
        combos=R.read_csv(spark, cfg.combos_path, R.COMBO_MASTER),
        catalog=Catalog.from_categories(categories),
        bins=cfg.bins,
        buckets=cfg.buckets,
    )


def ownapp_users(spark: SparkSession, cfg: FeatureConfig) -> DataFrame:
    """Customers of the written own-app order features (one column read)."""
    return customer_ids(spark.read.parquet(cfg.delivery[N.OWNAPP].output_path))


def output_metrics(features: DataFrame) -> dict[str, Column]:
    """What is counted of a channel's order features while they are written."""
    placed = F.col("order_placed_datetime")
    found = {
        "rows": Q.rows(), "missing_store": Q.missing("store_type"), "without_items": Q.missing("item_count"),
        "first_order": F.min(placed).cast("string"), "last_order": F.max(placed).cast("string"),
    }
    if "has_query" in features.columns:
        found["flagged"] = Q.hits("has_query")
    return found


def channel_counters(channel: str, written: Mapping[str, object], recent: DataFrame, dims: P.Dimensions) -> DataFrame:
    """(step, metric, value) of one channel: one aggregate over its orders in the window, and what the write has counted."""
    if channel == N.INSTORE:
        known = O.map_customers_instore(recent, dims.customer_map)
    else:
        known = O.with_customers(recent, dims.customer_map)
    seen = {"rows": Q.rows(), "without_customer": Q.missing(N.CUSTOMER_ID)}
    return Q.collect_counters(Q.counters(f"{channel} window", known, **seen), Q.observed(recent.sparkSession, f"{channel} output", written))


def dimension_counters(dims: P.Dimensions) -> DataFrame:
    """Keys that stand more than once in a dimension, and so multiply facts."""
    return Q.collect_counters(
        Q.duplicate_keys("categories by item", dims.categories, "item_id_id"),
        Q.duplicate_keys("categories by product", dims.categories, "ProductCode"),
        Q.duplicate_keys("store map", dims.store_map, "MDS ID"),
        Q.duplicate_keys("store master", dims.store_master, "Store Code"),
        Q.duplicate_keys("customer map", dims.customer_map, "invoice_no", "invoice_date", "store_code"),
    )


def run_orders(spark: SparkSession, cfg: FeatureConfig, channel: str, dims: P.Dimensions | None = None) -> str:
    """Order features of one channel; the own app has to be written first."""
    dims = dims or dimensions(spark, cfg)
    if channel == N.INSTORE:
        orders = R.read_instore_orders(spark, cfg.instore.orders_pattern)
        recent = O.store_window(orders, "BussTime", cfg.window.run_date, cfg.window.months, cfg.window.test_store)
        features = P.instore_order_features(
            orders,
            R.read_instore_items(spark, cfg.instore.items_pattern),
            dims, cfg.window, ownapp_users(spark, cfg),
        )
        path = cfg.instore.output_path
    else:
        feed = cfg.delivery[channel]
        orders = R.read_orders(spark, feed.orders_path, feed.order_columns)
        recent = O.local_window(orders, P.CLOCKS, cfg.window.run_date, cfg.window.months, cfg.window.zone)
        features = P.delivery_order_features(
            orders,
            R.read_order_items(spark, feed.items_path, feed.item_columns),
            dims, cfg.window,
            None if feed.complaints_path is None else R.read_complaints(spark, feed.complaints_path),
            None if channel == N.OWNAPP else ownapp_users(spark, cfg),
        )
        path = feed.output_path
    written = write_features(features, path, cfg.by_month, counted=output_metrics(features))
    counted = channel_counters(channel, written, recent, dims)
    replace_table(counted.coalesce(1), f"{path}{COUNTERS}")
    log.info("order features of %s written to %s", channel, path)
    return path


def read_order_features(spark: SparkSession, path: str, cutoff: date) -> DataFrame:
    """Written order features; a layout by month is pruned to the cutoff."""
    df = R.read_parquet(spark, path)
    if "order_month" in df.columns:
        month = F.col("order_month").cast("string")
        df = df.where(month >= cutoff.strftime("%Y-%m")).drop("order_month")
    return df


def run_customers(spark: SparkSession, cfg: FeatureConfig, dims: P.Dimensions | None = None) -> str:
    dims = dims or dimensions(spark, cfg)
    read = lambda path: read_order_features(spark, path, cfg.cutoff)
    channels = [read(p) for p in (
        cfg.delivery[N.OWNAPP].output_path, cfg.delivery[N.SWIGGY].output_path, cfg.instore.output_path)]
    # the order features may be older than the dimension: count every label that they hold
    features = customer_features(
        *channels, dims.catalog.covering(channels), cfg.cutoff, cfg.reference, cfg.buckets,
    )
    write_features(features, cfg.customer_output_path)
    log.info("customer features written to %s", cfg.customer_output_path)
    return cfg.customer_output_path


def read_models(spark: SparkSession, cfg: SegmentConfig) -> DataFrame:
    """The model rows of the enabled plans, each key from the table that the configuration names for it."""
    paths: dict[str, list[str]] = {}
    for key in sorted({p.model_key for p in cfg.spec.plans if p.enabled}):
        paths.setdefault(cfg.model_paths[key], []).append(key)
    parts = [spark.read.schema(M.MODEL_SCHEMA).parquet(path).where(F.col("model_key").isin(keys)) for path, keys in paths.items()]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], M.MODEL_SCHEMA))


def run_model_fit(spark: SparkSession, cfg: SegmentConfig, wanted: Mapping[str, Sequence[str]], features_path: str | None = None,
                  clusters: int = 4) -> list[str]:
    """Fit the models of the enabled plans on written customer features and write each to its configured table."""
    features = R.read_parquet(spark, features_path or cfg.input_path)
    models = G.fitted_models(features, cfg.spec, wanted, clusters)
    paths = sorted({cfg.model_paths[p.model_key] for p in cfg.spec.plans if p.enabled})
    for path in paths:
        keys = [k for k in wanted if cfg.model_paths.get(k) == path]
        replace_table(models.where(F.col("model_key").isin(keys)).coalesce(1), path)
    return paths


def run_segments(spark: SparkSession, cfg: SegmentConfig, features_path: str | None = None) -> tuple[str, str]:
    """Rule segments and micro-segments from written customer features."""
    features = R.read_parquet(spark, features_path or cfg.input_path)
    write_features(G.rule_segments(features, cfg.spec), cfg.segments_path)
    write_features(G.micro_segments(features, cfg.spec, read_models(spark, cfg), write_once=False), cfg.micro_path)
    base = G.flagged(G.segment_base(features, cfg.spec), cfg.spec)
    summary = S.segment_summary(base).withColumnsRenamed({c: c.lower().replace(" ", "_") for c in S.SUMMARY})
    replace_table(summary, f"{cfg.segments_path}{SUMMARY}")
    sizes = M.microcluster_sizes(spark.read.parquet(cfg.micro_path))
    replace_table(sizes, f"{cfg.micro_path}{SUMMARY}")
    log.info("segments written to %s and %s", cfg.segments_path, cfg.micro_path)
    return cfg.segments_path, cfg.micro_path


def parsed_once(spark: SparkSession, dims: P.Dimensions) -> P.Dimensions:
    """The customer map is as large as the orders: parse its text once, not once per channel."""
    path = shared_dir(spark, "customer-map")
    dims.customer_map.write.parquet(path)
    delete_at_exit(spark, path)
    return replace(dims, customer_map=spark.read.schema(dims.customer_map.schema).parquet(path))


def stages(spark: SparkSession, features: FeatureConfig, segments: SegmentConfig) -> list[Stage]:
    """The stages of a whole run with what they read and write."""
    held: list[P.Dimensions] = []

    def dims() -> P.Dimensions:
        if not held:
            held.append(parsed_once(spark, dimensions(spark, features)))
        return held[0]

    def count_dimensions() -> None:
        replace_table(dimension_counters(dims()).coalesce(1), f"{features.customer_output_path}{COUNTERS}")

    shared = (features.customer_map_path, features.store_map_path, features.store_master_path, features.categories_path, features.combos_path)
    own = features.delivery[N.OWNAPP].output_path
    common = f"{features.window} {features.bins} {features.buckets} {features.by_month}"
    out = [Stage("dimensions", shared, (f"{features.customer_output_path}{COUNTERS}",), "", count_dimensions)]
    outputs = []
    for channel in N.CHANNELS:
        feed = features.instore if channel == N.INSTORE else features.delivery[channel]
        if channel == N.INSTORE:
            read = (feed.orders_pattern, feed.items_pattern, own)
        else:
            read = (feed.orders_path, feed.items_path, *([feed.complaints_path] if feed.complaints_path else []), *([own] if channel != N.OWNAPP else []))
        outputs.append(feed.output_path)
        out.append(Stage(f"orders-{channel}", (*shared, *read), (feed.output_path, f"{feed.output_path}{COUNTERS}"), f"{common} {feed}",
                         lambda channel=channel: run_orders(spark, features, channel, dims())))
    out.append(Stage("customers", (*shared, *outputs), (features.customer_output_path,), f"{common} {features.cutoff} {features.reference}",
                     lambda: run_customers(spark, features, dims())))
    models = sorted({segments.model_paths[p.model_key] for p in segments.spec.plans if p.enabled})
    written_by_segments = [f"{p}{end}" for p in (segments.segments_path, segments.micro_path) for end in ("", SUMMARY)]
    out.append(Stage("segments", (features.customer_output_path, *models), tuple(written_by_segments), f"{segments.spec}",
                     lambda: run_segments(spark, segments, features.customer_output_path)))
    return out


def run_all(spark: SparkSession, features: FeatureConfig, segments: SegmentConfig, resume: bool = False) -> tuple[str, str]:
    """The whole job. With ``resume``, stages whose settings, inputs and outputs are as a former run left them are passed over."""
    run_stages(spark, stages(spark, features, segments), f"{features.customer_output_path}{RECORDS}", resume)
    return segments.segments_path, segments.micro_path
