"""Parameters of the check queries: segmentation columns and centroid models.

The models stand in for fitted artifacts, which are inputs of the job. Means
are integers, scales powers of two and centers halves, so that distances are
exact in both engines and ties are decided by the rule, not by rounding.
"""

from __future__ import annotations

from cartwright import names as N
from cartwright.operators.centroids import CentroidModel, MicroPlan
from cartwright.operators.items import bucket_columns
from cartwright.plans.segmentation import SegmentSpec

BRANDS = [f"brand_{i}" for i in range(1, 25)]
TYPES = ["economy", "large", "medium", "promo", "small", "standard"]

KEEP = (
    N.CUSTOMER_ID, N.TARGET, "unique_category_base_products_count",
    "unique_dri_category_count", "channel_count",
)
DAYPART_COUNTS = [f"omnichannel_{d}_order_count" for d in N.DAYPARTS]
WEEK_COUNTS = ["omnichannel_weekend_order_count", "omnichannel_weekday_order_count"]
BUCKET_COUNTS = [
    "omnichannel_order_count_with_" + c.replace("_items_count", "_price_range_items")
    for c in bucket_columns()
]
BASE_COUNTS = [f"omnichannel_categ_base_product_{b}_count" for b in BRANDS]
FLAGS = (*DAYPART_COUNTS, *WEEK_COUNTS, *BUCKET_COUNTS, *BASE_COUNTS)

RENAMES = {
    "unique_category_base_products_count": "unique_cat_base_count",
    "unique_dri_category_count": "unique_cat_dri_count",
    **{f"{d}_order_flag": f"{d.replace(' ', '_')}_flag" for d in N.DAYPARTS},
    **{f"{w}_order_flag": f"{w.capitalize()}_flag" for w in ("weekend", "weekday")},
    **{f"order_flag_with_{b}_price_range_items": f"{b}_price_flag" for b in N.BUCKET_LABELS},
    **{f"categ_base_product_{b}_flag": f"base_{b}_flag" for b in BRANDS},
}
MICRO_RENAMES = {f"categ_base_product_{b}_count": f"base_{b}_count" for b in BRANDS}

# Micro plan name, its source segments and its model key.
PLAN_SOURCES = (
    ("Seg1_5_1_and_2", ("Seg1_5_1", "Seg1_5_2"), "segment_1_5_1_2_model"),
    ("Seg1_5_3", ("Seg1_5_3",), "segment_1_5_3_model"),
    ("Seg1_5_5", ("Seg1_5_5",), "segment_1_5_5_model"),
    ("Seg1_5_6", ("Seg1_5_6",), "segment_1_5_6_model"),
    ("Seg_6_15_02", ("Seg_6_15_02",), "segment_6_15_02_model"),
    ("Seg_6_15_03", ("Seg_6_15_03",), "segment_6_15_03_model"),
    ("Seg_6_15_08", ("Seg_6_15_08",), "segment_6_15_08_model"),
    ("Seg_6_15_10", ("Seg_6_15_10",), "segment_6_15_10_model"),
    ("Seg15_plus_1", ("Seg15_plus_1",), "segment_15_plus_1_model"),
    ("Seg15_plus_8", ("Seg15_plus_8",), "segment_15_plus_8_model"),
    ("Seg15_plus_9", ("Seg15_plus_9",), "segment_15_plus_9_model"),
)
PLANS = tuple(MicroPlan(*p) for p in PLAN_SOURCES)
SPEC = SegmentSpec(KEEP, FLAGS, RENAMES, MICRO_RENAMES, PLANS)

MODEL_FEATURES = (
    "ownapp_order_count", "channel_count", "unique_category_base_products_count",
    "Breakfast_order_count", "Lunch_order_count", "Dinner_order_count", "weekend_order_count",
    "order_count_with_Premium_price_range_items", "base_brand_1_count", "base_brand_7_count",
)


def _model(index: int, key: str) -> CentroidModel:
    width = len(MODEL_FEATURES)
    return CentroidModel(
        key,
        MODEL_FEATURES,
        mean=tuple(float((index + j) % 4) for j in range(width)),
        scale=tuple(float(2 ** ((index + j) % 3)) for j in range(width)),
        centers=tuple(
            tuple(((index + 3 * c + 2 * j) % 7) / 2 - 1.0 for j in range(width)) for c in range(4)
        ),
    )


MODELS = {key: _model(i, key) for i, (_, _, key) in enumerate(PLAN_SOURCES)}

DIM = 64
EMBEDDING_MODEL = CentroidModel(
    "embeddings",
    tuple(f"x{j}" for j in range(DIM)),
    mean=(0.0,) * DIM,
    scale=(0.125,) * DIM,
    centers=tuple(tuple(((c + 2) * (j + 3) % 5 - 2) / 2 for j in range(DIM)) for c in range(5)),
)


def grid_columns() -> dict[str, str]:
    """Column -> SQL over ``lineitem``: every order line as a customer, so that each rule and plan has members."""
    mixed = "(l_orderkey * {a} + l_partkey * {b} + l_linenumber * {c})"
    counts = {
        N.TARGET: mixed.format(a=1, b=3, c=5) + " % 24 + 1",
        "unique_category_base_products_count": mixed.format(a=5, b=1, c=3) + " % 20",
        "unique_dri_category_count": mixed.format(a=1, b=1, c=1) + " % 5 + 1",
        "channel_count": mixed.format(a=3, b=1, c=7) + " % 3 + 1",
    }
    for i, c in enumerate(FLAGS):
        counts[c] = mixed.format(a=1 + i % 7, b=2 + i % 5, c=1 + i % 3) + f" % {2 + i % 4}"
    return {N.CUSTOMER_ID: "CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)", **{c: f"CAST({e} AS BIGINT)" for c, e in counts.items()}}


def grid_sql() -> list[str]:
    return [f'{e} AS "{c}"' for c, e in grid_columns().items()]
