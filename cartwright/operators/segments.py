"""Rule segmentation: flags, renames, bands, rules and summaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.functions.scalars import ratio

# Band -> target condition, and the rules of each band in the
# order in which they are tried. Conditions are Spark SQL.
BANDS = {
    "1_5": "ownapp_order_count < 6",
    "6_15": "ownapp_order_count > 5 AND ownapp_order_count <= 15",
    "15_plus": "ownapp_order_count > 15",
}

RULES = {
    "1_5": (
        ("Seg1_5_1", "unique_cat_base_count <= 2.5 AND Weekend_flag = 0"),
        ("Seg1_5_2", "unique_cat_base_count <= 2.5 AND Weekend_flag = 1 AND Weekday_flag = 0"),
        ("Seg1_5_3", "unique_cat_base_count <= 2.5 AND Weekend_flag = 1 AND Weekday_flag = 1"),
        ("Seg1_5_4", "unique_cat_base_count > 2.5 AND Weekday_flag = 0 AND channel_count <= 1.5"),
        ("Seg1_5_5", "unique_cat_base_count > 2.5 AND Weekday_flag = 1 AND channel_count <= 1.5"),
        ("Seg1_5_6", "unique_cat_base_count > 2.5 AND channel_count > 1.5 AND Premium_price_flag = 1"),
        ("Seg1_5_7", "unique_cat_base_count > 2.5 AND channel_count > 1.5 AND Premium_price_flag = 0 AND Weekend_flag = 0"),
        ("Seg1_5_8", "unique_cat_base_count > 2.5 AND channel_count > 1.5 AND Premium_price_flag = 0 AND Weekend_flag = 1"),
    ),
    "6_15": (
        ("Seg_6_15_01", "unique_cat_base_count <= 6.5 AND Weekend_flag = 0"),
        ("Seg_6_15_02", "unique_cat_base_count <= 6.5 AND Lunch_flag = 0 AND Weekend_flag = 1"),
        ("Seg_6_15_03", "unique_cat_base_count <= 6.5 AND Lunch_flag = 1 AND Weekend_flag = 1"),
        ("Seg_6_15_04", "unique_cat_base_count > 6.5 AND Lunch_flag = 0 AND Premium_price_flag = 0"),
        ("Seg_6_15_05", "unique_cat_base_count > 6.5 AND Lunch_flag = 1 AND Premium_price_flag = 0 AND Late_Night_flag = 0"),
        ("Seg_6_15_06", "unique_cat_base_count > 6.5 AND Lunch_flag = 1 AND Premium_price_flag = 0 AND Late_Night_flag = 1"),
        ("Seg_6_15_07", "unique_cat_base_count > 6.5 AND channel_count <= 1.5 AND Lunch_flag = 0 AND Premium_price_flag = 1"),
        ("Seg_6_15_08", "unique_cat_base_count > 6.5 AND channel_count <= 1.5 AND Lunch_flag = 1 AND Premium_price_flag = 1"),
        ("Seg_6_15_09", "unique_cat_base_count > 6.5 AND channel_count > 1.5 AND Late_Night_flag = 0 AND Premium_price_flag = 1"),
        ("Seg_6_15_10", "unique_cat_base_count > 6.5 AND channel_count > 1.5 AND Late_Night_flag = 1 AND Premium_price_flag = 1"),
    ),
    "15_plus": (
        ("Seg15_plus_1", "unique_cat_base_count <= 11.5 AND Breakfast_flag = 0 AND Late_Night_flag = 0"),
        ("Seg15_plus_2", "unique_cat_base_count <= 11.5 AND Breakfast_flag = 0 AND Late_Night_flag = 1 AND Evening_flag = 0"),
        ("Seg15_plus_3", "unique_cat_base_count <= 11.5 AND unique_cat_base_count > 8.5 AND Breakfast_flag = 0 AND Late_Night_flag = 1 AND Evening_flag = 1"),
        ("Seg15_plus_4", "unique_cat_base_count <= 8.5 AND Breakfast_flag = 0 AND Late_Night_flag = 1 AND Evening_flag = 1"),
        ("Seg15_plus_5", "unique_cat_base_count <= 11.5 AND Breakfast_flag = 1"),
        ("Seg15_plus_6", "unique_cat_base_count > 11.5 AND unique_cat_base_count <= 16.5 AND Breakfast_flag = 0 AND Late_Night_flag = 0"),
        ("Seg15_plus_7", "unique_cat_base_count > 16.5 AND Breakfast_flag = 0 AND Late_Night_flag = 0"),
        ("Seg15_plus_8", "unique_cat_base_count > 11.5 AND Breakfast_flag = 0 AND Late_Night_flag = 1"),
        ("Seg15_plus_9", "unique_cat_base_count > 11.5 AND Breakfast_flag = 1"),
    ),
}


def rule_list() -> list[tuple[str, str, str]]:
    """(band, segment, condition) in rule order."""
    return [(band, name, cond) for band, rules in RULES.items() for name, cond in rules]


# -- preparation ------------------------------------------------------------

def in_domain(features: DataFrame, max_orders: int = 100) -> DataFrame:
    """Target at most ``max_orders`` and a DRI count that is not 0 (missing passes)."""
    return features.where(
        (F.col(N.TARGET) <= max_orders) & ~F.col("unique_dri_category_count").eqNullSafe(F.lit(0))
    )


def keep_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in columns if c in have])


def create_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each count by its 0/1 flag, ``_count`` in the name by ``_flag``."""
    bad = [c for c in columns if "_count" not in c and c != N.CUSTOMER_ID]
    if bad:
        raise ValueError(f"flag sources need '_count' in their name: {bad}")
    wanted = {c for c in columns if c != N.CUSTOMER_ID}
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in wanted],
        *[
            F.when(F.col(f"`{c}`") > 0, 1).otherwise(0).alias(c.replace("_count", "_flag"))
            for c in df.columns if c in wanted
        ],
    )


def rename_features(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Strip the ``omnichannel_`` prefix, then apply the rename map."""
    new = []
    for c in df.columns:
        new.append(F.col(f"`{c}`").alias(N.feature_name(c, renames)))
    return df.select(*new)


def flag_features(df: DataFrame, flags: Sequence[str], renames: Mapping[str, str]) -> DataFrame:
    """The view of the features that the rules are written for."""
    return rename_features(create_flags(df, flags), renames)


def with_segment(base: DataFrame, flags: Sequence[str], renames: Mapping[str, str]) -> DataFrame:
    """Base columns unchanged plus ``Segment``, without a join back.

    The base row rides along as a struct that the optimizer takes apart again.
    """
    packed = base.select(F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("_base"), "*")
    return add_segment(flag_features(packed, flags, renames)).select("_base.*", "Segment")


# -- bands and rules --------------------------------------------------------

def band(df: DataFrame, name: str) -> DataFrame:
    if name not in BANDS:
        raise ValueError(f"{name!r} is no band; bands are {', '.join(BANDS)}")
    return df.where(BANDS[name])


def band_column() -> Column:
    out = None
    for name, cond in BANDS.items():
        out = F.when(F.expr(cond), name) if out is None else out.when(F.expr(cond), name)
    return out


def rule_rank() -> Column:
    """Number of the first matching rule (bands are disjoint), else NULL."""
    out = None
    for rank, (band_name, _, cond) in enumerate(rule_list()):
        hit = F.expr(f"({BANDS[band_name]}) AND ({cond})")
        out = F.when(hit, rank) if out is None else out.when(hit, rank)
    return out


def rank_to_segment(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for _, name, _ in rule_list()]), rank)


def rank_to_band(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(b) for b, _, _ in rule_list()]), rank)


def add_segment(flagged: DataFrame) -> DataFrame:
    """Every row with its segment; rows that match no rule get NULL."""
    return flagged.withColumn("Segment", rank_to_segment(rule_rank()))


def assign_segments(flagged: DataFrame) -> DataFrame:
    """(customer, Segment): the first rule per customer and band.

    A minimum per key instead of a sorted window: it combines before the
    shuffle, and needs none after the customer aggregate.
    """
    ranked = flagged.select(N.CUSTOMER_ID, rule_rank().alias("_rank")).where(F.col("_rank").isNotNull())
    first = ranked.groupBy(N.CUSTOMER_ID, rank_to_band(F.col("_rank")).alias("_band")).agg(
        F.min("_rank").alias("_rank")
    )
    return first.select(N.CUSTOMER_ID, rank_to_segment(F.col("_rank")).alias("Segment"))


SUMMARY = ("Customer Count", "Total Orders", "Avg Orders per Customer")


def segment_summary(flagged: DataFrame, bands: Sequence[str] = tuple(BANDS)) -> DataFrame:
    """Customers, orders and mean orders per segment, also for empty segments."""
    listed = [F.lit(name) for b, name, _ in rule_list() if b in bands]
    sizes = (
        add_segment(flagged)
        .where(F.col("Segment").isNotNull())
        .groupBy("Segment")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(N.TARGET).cast("bigint").alias("orders"))
    )
    every = flagged.sparkSession.range(1).select(F.explode(F.array(*listed)).alias("Segment"))
    n, orders = F.coalesce("n", F.lit(0)), F.coalesce("orders", F.lit(0))
    mean = ratio(orders.cast("double"), n.cast("double"))
    return (
        every.join(sizes, "Segment", "left")
        .select(
            "Segment",
            n.cast("bigint").alias("Customer Count"),
            orders.cast("bigint").alias("Total Orders"),
            F.bround(mean, 2).alias("Avg Orders per Customer"),
        )
        .orderBy("Segment")
    )


