"""Customer-grain features: one aggregate over the unioned channels.

All metrics are groups of aggregate columns (``MetricGroup``) over the same
union, so any choice of groups is a single ``groupBy(customer)``. Partial sums
combine before the shuffle: a customer with a third of all orders arrives as
one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.functions import scalars as X
from cartwright.operators.labels import Catalog, LabelSet

PREFIXES = ("omnichannel", "ownapp")


# -- union of the channels --------------------------------------------------

def price_without_taxes(df: DataFrame, channel: str) -> DataFrame:
    """Pre-tax price; in-store also turns a missing discount into 0."""
    if channel == N.INSTORE:
        discount = F.coalesce(F.col("discounted_price"), F.lit(0.0))
        base = F.coalesce(F.col("BaseAmount"), F.lit(0.0))
        return df.withColumns({"discounted_price": discount, "price_without_taxes": base + discount})
    return df.withColumn("price_without_taxes", F.col("discounted_price") + F.col("sub_total_price"))


UNIFIED = (
    N.CUSTOMER_ID, N.ORDER_ID, "order_placed_datetime", "order_delivery_datetime",
    "total_price", "discounted_price", "price_without_taxes", "order_time_of_day",
    "is_weekend", N.DRI_LIST, N.BASE_LIST,
)


def unified_channel(df: DataFrame, channel: str, columns: Sequence[str]) -> DataFrame:
    """One channel with the unified columns; absent ones are added by the union."""
    priced = price_without_taxes(df, channel)
    lists = {
        c: X.as_list(F.col(c), priced.schema[c].dataType)
        for c in (N.DRI_LIST, N.BASE_LIST) if c in priced.columns
    }
    wanted = [c for c in (*UNIFIED, *columns) if c in priced.columns]
    if channel != N.OWNAPP:
        wanted = [c for c in wanted if c != "order_delivery_datetime"]
    return (
        priced.withColumns(lists)
        .select(*wanted)
        .withColumns({N.CUSTOMER_ID: F.col(N.CUSTOMER_ID).cast("string"), "channel": F.lit(channel)})
    )


def union_channels(
    channels: dict[str, DataFrame], catalog: Catalog, buckets: Sequence[str], cutoff: date | None
) -> DataFrame:
    """Union-all by name after the cutoff; columns are sorted by name."""
    out = None
    for channel, df in channels.items():
        recent = df if cutoff is None else df.where(
            F.col("order_placed_datetime") >= F.lit(cutoff).cast("timestamp_ntz")
        )
        part = unified_channel(recent, channel, [*buckets, *catalog.columns])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    unsold = {c: F.lit(None).cast("int") for c in [*buckets, *catalog.columns] if c not in out.columns}
    out = out.withColumns(unsold) if unsold else out
    return out.select(*sorted(out.columns))


# -- metric groups ----------------------------------------------------------

@dataclass(frozen=True)
class MetricGroup:
    """Aggregates to compute and the projection that turns them into features."""

    aggs: list[Column]
    project: list[Column]
    name: str = field(default="")


def _is(channel: str) -> Column:
    return F.col("channel") == channel


def _scoped(prefix: str, value: Column) -> Column:
    return value if prefix == "omnichannel" else F.when(_is(N.OWNAPP), value)


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def discount_metrics() -> MetricGroup:
    pct = F.avg(X.ratio(F.col("discounted_price"), F.col("price_without_taxes")))
    out = X.floor_negative(F.col("_pct")).alias("omnichannel_avg_discount_pct")
    return MetricGroup([pct.alias("_pct")], [out], "discount")


def unique_label_metrics(column: str, labels: LabelSet, count_name: str) -> MetricGroup:
    """Distinct labels over all orders; none gives an empty list and 0."""
    words = [f"_{column}{w}" for w in range(labels.words)]
    aggs = [F.bit_or(labels.word_of_array(column, w)).alias(n) for w, n in enumerate(words)]
    bits = [f"coalesce({n}, 0L)" for n in words]
    return MetricGroup(
        aggs, [labels.to_array(bits).alias(column), labels.count(bits).alias(count_name)], column
    )


def order_metrics(reference: date) -> MetricGroup:
    placed = F.col("order_placed_datetime")
    own_placed = F.when(_is(N.OWNAPP), placed)
    aggs = [
        *[_count_if(_is(ch)).alias(f"{ch}_order_count") for ch in N.CHANNELS],
        F.count("is_weekend").alias("omnichannel_order_count"),
        _total(F.col("is_weekend")).alias("_weekend"),
        F.avg("total_price").alias("omnichannel_aov"),
        F.avg("discounted_price").alias("omnichannel_avg_discount"),
        F.min(placed).alias("omnichannel_first_order_at"),
        F.max(placed).alias("omnichannel_last_order_at"),
        F.min(own_placed).alias("ownapp_first_order_at"),
        F.max(own_placed).alias("ownapp_last_order_at"),
    ]
    weekday = F.col("omnichannel_order_count") - F.col("_weekend")
    project = [
        *[F.col(f"{ch}_order_count") for ch in N.CHANNELS],
        F.col("omnichannel_order_count"),
        (F.col("omnichannel_order_count") - weekday).alias("omnichannel_weekend_order_count"),
        weekday.alias("omnichannel_weekday_order_count"),
        *[F.col(c) for c in (
            "omnichannel_aov", "omnichannel_avg_discount",
            "omnichannel_first_order_at", "omnichannel_last_order_at",
            "ownapp_first_order_at", "ownapp_last_order_at",
        )],
        channels_label().alias("channels_ordered_from"),
        *[c for p in PREFIXES for c in date_metrics(p, reference)],
        channel_count().alias("channel_count"),
    ]
    return MetricGroup(aggs, project, "orders")


def channels_label() -> Column:
    return X.channel_label({ch: F.col(f"{ch}_order_count") > 0 for ch in N.CHANNELS})


def channel_count() -> Column:
    parts = [(F.col(f"{ch}_order_count") > 0).cast("int") for ch in N.CHANNELS]
    return parts[0] + parts[1] + parts[2]


def date_metrics(prefix: str, reference: date) -> list[Column]:
    """Recency, tenure and mean gap of one scope; a single order has no gap."""
    first, last = F.col(f"{prefix}_first_order_at"), F.col(f"{prefix}_last_order_at")
    tenure = X.floor_days(first, last) + 1
    gap = X.ratio(tenure.cast("double"), (F.col(f"{prefix}_order_count") - 1).cast("double"))
    return [
        X.floor_days(last, F.lit(reference).cast("timestamp_ntz")).alias(f"{prefix}_recency"),
        tenure.alias(f"{prefix}_tenure_days"),
        gap.alias(f"{prefix}_avg_days_between_orders"),
    ]


def daypart_column(prefix: str, *dayparts: str) -> str:
    return f"{prefix}_{'_'.join(dayparts)}_order_count"


def daypart_metrics(combos: bool = True) -> MetricGroup:
    """Orders per daypart; combinations are plain sums of those counts."""
    aggs, project = [], []
    for prefix in PREFIXES:
        for part in N.DAYPARTS:
            name = daypart_column(prefix, part)
            own = "" if prefix == "omnichannel" else f" AND channel = '{N.OWNAPP}'"
            aggs.append(F.expr(f"count_if(order_time_of_day = '{part}'{own})").alias(name))
            project.append(F.col(name))
        if combos:
            project += daypart_combos(prefix)
    return MetricGroup(aggs, project, "dayparts")


def daypart_combos(prefix: str) -> list[Column]:
    """Every combination of two to five dayparts as the sum of its counts."""
    out = []
    for size in range(2, len(N.DAYPARTS) + 1):
        for combo in combinations(N.DAYPARTS, size):
            total = " + ".join(f"`{daypart_column(prefix, part)}`" for part in combo)
            out.append(F.expr(total).alias(daypart_column(prefix, *combo)))
    return out


def bucket_metrics(buckets: Sequence[str]) -> MetricGroup:
    named = {
        f"{prefix}_order_count_with_{col.replace('_items_count', '_price_range_items')}": (prefix, col)
        for prefix in PREFIXES
        for col in buckets
    }
    return _scoped_totals(named, "buckets")


def category_metrics(catalog: Catalog) -> MetricGroup:
    named = {f"{p}_{col}_count": (p, col) for p in PREFIXES for col in catalog.columns}
    return _scoped_totals(named, "categories")


def _scoped_totals(named: dict[str, tuple[str, str]], group: str) -> MetricGroup:
    own = f" FILTER (WHERE channel = '{N.OWNAPP}')"
    aggs = [
        F.expr(f"coalesce(sum(`{col}`){'' if p == 'omnichannel' else own}, 0L)").alias(name)
        for name, (p, col) in named.items()
    ]
    return MetricGroup(aggs, [F.col(name) for name in named], group)


def encoded_bucket_metrics(buckets: Sequence[str]) -> MetricGroup:
    """The same as ``bucket_metrics`` from the bucket bits of encoded orders."""
    aggs, names = [], []
    for prefix in PREFIXES:
        own = "" if prefix == "omnichannel" else f" AND channel = '{N.OWNAPP}'"
        for i, col in enumerate(buckets):
            name = f"{prefix}_order_count_with_{col.replace('_items_count', '_price_range_items')}"
            names.append(name)
            aggs.append(F.expr(f"count_if(_any AND (_bucket & {1 << i}) <> 0{own})").alias(name))
    return MetricGroup(aggs, [F.col(n) for n in names], "buckets")


def encoded_label_metrics(kind: str, labels: LabelSet, column: str, count_name: str) -> MetricGroup:
    """The same as ``unique_label_metrics`` from the bitsets of encoded orders."""
    words = [f"_{kind}_list{w}" for w in range(labels.words)]
    aggs = [F.expr(f"bit_or({w})").alias(f"_all{w}") for w in words]
    bits = [f"coalesce(_all{w}, 0L)" for w in words]
    return MetricGroup(aggs, [labels.to_array(bits).alias(column), labels.count(bits).alias(count_name)], column)


def delivery_metrics() -> MetricGroup:
    """Mean own-app minutes from order to delivery, both on the same clock."""
    minutes = X.minutes_between(F.col("order_placed_datetime"), F.col("order_delivery_datetime"))
    out = F.avg(_scoped("ownapp", minutes)).alias("ownapp_avg_delivery_time_minutes")
    return MetricGroup([out], [F.col("ownapp_avg_delivery_time_minutes")], "delivery")


def aggregate_customers(unified: DataFrame, groups: Sequence[MetricGroup]) -> DataFrame:
    """One row per customer that has an own-app order in the window."""
    base = _count_if(_is(N.OWNAPP)).alias("_own")
    aggs = [a for g in groups for a in g.aggs]
    wide = (
        unified.where(F.col(N.CUSTOMER_ID).isNotNull())
        .groupBy(N.CUSTOMER_ID)
        .agg(base, *aggs)
        .where(F.col("_own") > 0)
    )
    return wide.select(N.CUSTOMER_ID, *[c for g in groups for c in g.project])


def label_counts(unified: DataFrame, present: str, lists: Sequence[str] = ()) -> DataFrame:
    """Orders per customer and label, and distinct labels, in long form: the plan does not grow with the labels.

    ``present`` is the SQL text of an order's label positions; ``lists`` are array columns of label names.
    With ``lists`` every (customer, label) folds before the shuffle; without, the bits of an order are
    shuffled once. Either way a buffer holds one (customer, label) or the labels of one customer. Output: the customer, ``_counts`` (position -> orders, own-app orders) and ``_list_i`` for each
    of the lists, sorted; customers without any label are absent.
    """
    if not lists:
        # dealt by customer while labels are still bits: narrower than (customer, label) rows, and both folds follow without a shuffle
        known = unified.where(F.col(N.CUSTOMER_ID).isNotNull()).withColumn("_own", _is(N.OWNAPP)).repartition(N.CUSTOMER_ID)
        each = known.select(N.CUSTOMER_ID, "_own", F.expr(f"explode({present})").alias("at"))
        counted = each.groupBy(N.CUSTOMER_ID, "at").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("_own")).alias("own"))
        return counted.groupBy(N.CUSTOMER_ID).agg(F.expr("map_from_entries(transform(collect_list(struct(at, orders, own)), x -> struct(x.at, struct(x.orders, x.own))))").alias("_counts"))
    entries = [f"transform({present}, i -> named_struct('kind', 0, 'at', i, 'label', CAST(NULL AS STRING)))"]
    entries += [f"transform(array_distinct({c}), x -> named_struct('kind', {k}, 'at', 0, 'label', x))" for k, c in enumerate(lists, 1)]
    each = unified.where(F.col(N.CUSTOMER_ID).isNotNull()).select(
        N.CUSTOMER_ID, _is(N.OWNAPP).alias("_own"), F.expr(f"inline(concat({', '.join(entries)}))"))
    counted = each.where("kind = 0 OR label IS NOT NULL").groupBy(N.CUSTOMER_ID, "kind", "at", "label").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("_own")).alias("own"))
    return counted.groupBy(N.CUSTOMER_ID).agg(
        F.expr("map_from_entries(collect_list(struct(at, struct(orders, own))) FILTER (WHERE kind = 0))").alias("_counts"),
        *[F.expr(f"array_sort(collect_list(label) FILTER (WHERE kind = {k}))").alias(f"_list_{k}") for k in range(1, len(lists) + 1)])


def with_label_counts(wide: DataFrame, counts: DataFrame, catalog: Catalog, lists: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Spell the long form out: two counts per label column, and (column, count column) for each list."""
    joined = wide.join(counts, N.CUSTOMER_ID, "left")
    spelled = [
        f"coalesce(try_element_at(_counts, {i}).{field}, 0L) AS `{prefix}_{col}_count`"
        for prefix, field in zip(PREFIXES, ("orders", "own")) for i, col in enumerate(catalog.columns)
    ]
    for k, (column, count) in enumerate(lists, 1):
        spelled += [f"coalesce(_list_{k}, array()) AS `{column}`", f"CAST(coalesce(size(_list_{k}), 0) AS BIGINT) AS `{count}`"]
    return joined.selectExpr(*[f"`{c}`" for c in wide.columns], *spelled)


LISTS = ((N.BASE_LIST, "unique_category_base_products_count"), (N.DRI_LIST, "unique_dri_category_count"))


def narrow_groups(reference: date) -> list[MetricGroup]:
    """Metrics that need neither labels nor price buckets."""
    return [discount_metrics(), order_metrics(reference), daypart_metrics(), delivery_metrics()]


def encoded_groups(catalog: Catalog, buckets: Sequence[str], reference: date) -> list[MetricGroup]:
    sets = {"base": catalog.base, "dri": catalog.dri}
    lists = [encoded_label_metrics(kind, ls, *names) for (kind, ls), names in zip(sets.items(), LISTS)]
    return [*narrow_groups(reference), encoded_bucket_metrics(buckets), *lists]
