"""Item-grain operators: categories, combo choices and per-order aggregates.

Column names of the item feed are parameters (``ItemKeys``) because delivery
and in-store feeds name the same things differently.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.functions import scalars as X
from cartwright.operators.labels import Catalog, LabelSet


@dataclass(frozen=True)
class ItemKeys:
    order: str
    item: str
    price: str
    header: str
    choice: str
    promo: str | None = None
    quantity: str = "quantity"
    details: bool = False  # feed has is_customized / is_veg

    def payable(self) -> Column:
        """Lines the customer chose: not promo. A feed without promo has only those."""
        return F.lit(True) if self.promo is None else ~F.col(self.promo)


DELIVERY = ItemKeys(
    order="sales_id", item="item_id_id", price="original_price",
    header="header_item_id_id", choice="choice_item_id_id", promo="promo_item", details=True,
)
IN_STORE = ItemKeys(
    order="InvoiceNo", item="ProductCode", price="PriceNet",
    header="HeaderItemId", choice="ChoiceItemId",
)


#: lines of several feeds in one frame, see ``united_lines``
UNITED = ItemKeys(order="_order", item="_item", price="_price", header="_header", choice="_choice", promo="_promo")


# -- row-grain operators ----------------------------------------------------

def map_categories(items: DataFrame, categories: DataFrame, keys: ItemKeys = DELIVERY) -> DataFrame:
    """Left join of item lines to their two category labels."""
    wanted = ["item_id_id", "ProductCode", N.BASE_LABEL, N.DRI_LABEL]
    dim = categories.where(F.col(keys.item).isNotNull()).select(*wanted)
    return items.join(dim, keys.item, "left")


def payable_items(items: DataFrame, keys: ItemKeys = DELIVERY) -> DataFrame:
    """Keep non-promo lines; a missing promo marker is not kept."""
    return items if keys.promo is None else items.where(keys.payable())


def is_mapped(exclude: str = N.EXCLUDE_LABEL) -> Column:
    """A DRI category, and a base category that is not ``exclude``."""
    return F.col(N.DRI_LABEL).isNotNull() & ~F.trim(F.col(N.BASE_LABEL)).eqNullSafe(F.lit(exclude))


def is_payable_and_mapped(keys: ItemKeys = DELIVERY, exclude: str = N.EXCLUDE_LABEL) -> Column:
    """Whether a line with its categories is kept; never NULL."""
    return F.coalesce(keys.payable(), F.lit(False)) & is_mapped(exclude)


def drop_unmapped(items: DataFrame, exclude: str = N.EXCLUDE_LABEL) -> DataFrame:
    """Keep lines with a DRI category whose base category is not ``exclude``."""
    return items.where(is_mapped(exclude)).withColumn(N.BASE_LABEL, F.trim(F.col(N.BASE_LABEL)))


def pair_counts(items: DataFrame, keys: ItemKeys = DELIVERY) -> DataFrame:
    """Line count and summed quantity of every (order, item) among payable lines."""
    return (
        payable_items(items, keys)
        .where(F.col(keys.order).isNotNull() & F.col(keys.item).isNotNull())
        .groupBy(keys.order, keys.item)
        .agg(
            F.count(F.lit(1)).alias("choice_count"),
            F.coalesce(F.sum(keys.quantity), F.lit(0)).cast("bigint").alias("order_quantity"),
        )
    )


def header_covers(combos: DataFrame, keys: ItemKeys) -> DataFrame:
    """(header, choice, limit); of several limits for one pair only the largest can decide."""
    known = combos.select(
        F.col(keys.header).alias(keys.item), F.col(keys.choice).alias("_choice"), F.col("Qty").alias("_limit")
    ).dropna()
    return known.groupBy(keys.item, "_choice").agg(F.max(F.col("_limit").cast("bigint")).alias("_limit"))


def fold_pairs(lines: DataFrame, aggs: Sequence[Column], sold: DataFrame, combos: DataFrame, keys: ItemKeys) -> DataFrame:
    """Fold lines to one row per (order, item), with ``_limit``: the largest quantity that a header of the order covers.

    Sold items meet the combos they head in a plain join, which may be broadcast or
    split where a header is hot. It emits narrow (order, choice, limit) rows, and these meet
    the lines in the one aggregate on (order, item), which combines before the shuffle. No
    task holds an order, and every line is shuffled once. ``aggs`` see only NULL in the emitted rows.
    """
    offers = sold.select(keys.order, keys.item).join(header_covers(combos, keys), keys.item).select(
        keys.order, F.col("_choice").alias(keys.item), "_limit")
    own = lines.withColumns({"_limit": F.lit(None).cast("bigint"), "_own": F.lit(True)})
    return fold_met(own.unionByName(offers, allowMissingColumns=True), aggs, keys)


def fold_met(met: DataFrame, aggs: Sequence[Column], keys: ItemKeys) -> DataFrame:
    """Lines (``_own``) and offers in one frame, folded to one row per (order, item) that has a line."""
    return (
        met.groupBy(keys.order, keys.item)
        .agg(*aggs, F.max("_limit").alias("_limit"), F.max("_own").alias("_own"))
        .where(F.col("_own"))
        .drop("_own")
    )


def lines_and_offers(lines: DataFrame, rows: DataFrame, payable: Column, keys: ItemKeys, by_order: bool = False) -> DataFrame:
    """Every line with what is known of its item (``_own``), and (order, choice, limit) rows for the choices that it heads.

    One join on the item, in which a hot item is split, gives both: of ``item_rows`` a line meets the
    one without choice, or none, and that is the line itself. Lines that are not payable head nothing.

    Most choices are not in the order, and their rows find no line in the fold. With ``by_order`` (lines that a join has dealt
    by order already) those go at once whose bit is not among the bits of the order's items.
    """
    values = [c for c in lines.columns if c not in (keys.order, keys.item)]
    rows = rows.withColumn("_choice", F.col("_choice").cast(lines.schema[keys.item].dataType))
    heads = payable
    if by_order:
        lines = lines.withColumn("_bits", F.bit_or(_item_bit(F.col(keys.item))).over(Window.partitionBy(keys.order)))
        heads = payable & (F.col("_bits").bitwiseAND(_item_bit(F.col("_choice"))) != 0)
    own = F.col("_choice").isNull()
    return lines.join(rows, keys.item, "left").where(own | heads).select(
        keys.order, F.coalesce("_choice", keys.item).alias(keys.item), *[F.when(own, F.col(c)).alias(c) for c in values],
        *[c for c in rows.columns if c not in (keys.item, "_choice")], F.when(own, F.lit(True)).alias("_own"))


def _item_bit(item: Column) -> Column:
    """One of the 32 bits of an INT, by the item's hash."""
    return F.call_function("shiftleft", F.lit(1), F.pmod(F.hash(item), F.lit(32)))


def offers_of(sold: DataFrame, combos: DataFrame, keys: ItemKeys) -> DataFrame:
    """Narrow (``_at``, ``_choice``, ``_limit``) rows: the choices that every sold line heads in its order ``_at``.

    A plain join, which may be broadcast or split where a header is hot. Its rows outnumber the lines and are narrow.
    """
    return sold.select(F.col(keys.order).alias("_at"), keys.item).join(header_covers(combos, keys), keys.item).select(
        "_at", "_choice", "_limit")


def with_limits(pairs: DataFrame, offers: DataFrame, keys: ItemKeys) -> DataFrame:
    """Folded pairs with ``_limit``: the largest quantity that a header of the order covers.

    Offers fold by (order, choice) before their shuffle, with one number as buffer, whatever columns the pairs have.
    """
    limits = offers.groupBy("_at", "_choice").agg(F.max("_limit").alias("_limit"))
    return pairs.join(limits, (F.col(keys.order) == F.col("_at")) & (F.col(keys.item) == F.col("_choice")), "left").drop("_at", "_choice")


def covered(quantity: Column) -> Column:
    """Whether a header of the order covers the whole quantity of this pair."""
    return F.coalesce(F.col("_limit") >= quantity, F.lit(False))


def choice_pairs(items: DataFrame, combos: DataFrame, keys: ItemKeys = DELIVERY) -> DataFrame:
    """(order, item) pairs that are choices of a combo in the same order.

    Only pairs are folded; what sold headers emit goes straight to the semi-join.
    """
    known = payable_items(items, keys).where(F.col(keys.order).isNotNull() & F.col(keys.item).isNotNull())
    pairs = known.groupBy(keys.order, keys.item).agg(F.coalesce(F.sum(keys.quantity), F.lit(0)).cast("bigint").alias("order_quantity"))
    meets = (F.col(keys.order) == F.col("_at")) & (F.col(keys.item) == F.col("_choice")) & covered(F.col("order_quantity"))
    return pairs.join(offers_of(known, combos, keys), meets, "left_semi").select(keys.order, keys.item)


def remove_choices(items: DataFrame, combos: DataFrame, keys: ItemKeys = DELIVERY) -> DataFrame:
    """Drop every line of a choice pair, then promo lines."""
    pairs = choice_pairs(items, combos, keys)
    return payable_items(items.join(pairs, [keys.order, keys.item], "left_anti"), keys)


def items_of_orders(items: DataFrame, orders: DataFrame, order: str = "InvoiceNo") -> DataFrame:
    """Lines whose order was kept (order key only)."""
    return items.join(orders.where(F.col(order).isNotNull()).select(order), order, "left_semi")


# -- one aggregate each, on cleaned or raw item lines -----------------------

def bucket_columns(labels: Sequence[str] = N.BUCKET_LABELS) -> list[str]:
    return [f"{label}_items_count" for label in labels]


def _bucket_flags(
    mask: str, labels: Sequence[str] = N.BUCKET_LABELS, known: str = "true"
) -> list[Column]:
    return [
        F.expr(f"CASE WHEN {known} THEN CAST(({mask} & {1 << i}) <> 0 AS INT) END").alias(name)
        for i, name in enumerate(bucket_columns(labels))
    ]


def _bucket_bit(price: Column, counted: Column, bins: Sequence[float] = N.PRICE_BINS) -> Column:
    return F.when(counted, F.call_function("shiftleft", F.lit(1), X.bin_index(price, bins)))


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def bucket_presence(
    items: DataFrame,
    keys: ItemKeys = DELIVERY,
    bins: Sequence[float] = N.PRICE_BINS,
    labels: Sequence[str] = N.BUCKET_LABELS,
) -> DataFrame:
    """0/1 per price bucket and order."""
    bit = _bucket_bit(F.col(keys.price), F.col(keys.quantity).isNotNull(), bins)
    mask = items.groupBy(F.col(keys.order).alias(N.ORDER_ID)).agg(F.bit_or(bit).alias("_m"))
    return mask.select(N.ORDER_ID, *_bucket_flags("coalesce(_m, 0)", labels))


def _label_words(items: DataFrame, label: str, labels: LabelSet, keys: ItemKeys, counted: bool) -> DataFrame:
    """Bitset words ``_w0, _w1, ...`` of the labels of every order."""
    pos = labels.position(f"`{label}`")
    if counted:
        pos = F.when(F.col(keys.quantity).isNotNull(), pos)
    words = [
        F.expr(f"coalesce(bit_or({labels.word_of_position('_pos', w)}), 0L)").alias(f"_w{w}")
        for w in range(labels.words)
    ]
    marked = items.select(F.col(keys.order).alias(N.ORDER_ID), pos.alias("_pos"))
    return marked.groupBy(N.ORDER_ID).agg(*words)


def label_presence(
    items: DataFrame, label: str, labels: LabelSet, keys: ItemKeys = DELIVERY
) -> DataFrame:
    """0/1 per category and order, from one ``bit_or`` per 63 labels."""
    masks = _label_words(items, label, labels, keys, counted=True)
    return masks.select(N.ORDER_ID, *labels.flags(masks.columns[1:]))


def label_lists(
    items: DataFrame, label: str, labels: LabelSet, out: str, keys: ItemKeys = DELIVERY
) -> DataFrame:
    """Sorted distinct labels per order, for orders that have any."""
    masks = _label_words(items.where(F.col(label).isNotNull()), label, labels, keys, counted=False)
    return masks.select(N.ORDER_ID, labels.to_array(masks.columns[1:]).alias(out))


def item_stats(items: DataFrame, keys: ItemKeys = DELIVERY) -> DataFrame:
    """Per order over all lines: any customised, all veg, quantity, veg lines."""
    veg = F.col("is_veg").cast("int")
    return items.groupBy(F.col(keys.order).alias(N.ORDER_ID)).agg(
        F.max("is_customized").alias("customization_flag"),
        F.min(veg).alias("veg_indicator"),
        F.sum(keys.quantity).cast("bigint").alias("item_count"),
        F.sum(veg).cast("bigint").alias("veg_count"),
    )


def item_count(items: DataFrame, keys: ItemKeys = IN_STORE) -> DataFrame:
    return items.groupBy(F.col(keys.order).alias(N.ORDER_ID)).agg(
        F.sum(keys.quantity).cast("bigint").alias("item_count")
    )


def promo_quantity(items: DataFrame, keys: ItemKeys = DELIVERY) -> DataFrame:
    """Promo quantity per order, 0 when there is none."""
    promo = F.when(F.col(keys.promo), F.col(keys.quantity))
    return items.groupBy(F.col(keys.order).alias(N.ORDER_ID)).agg(
        _or_zero(F.sum(promo)).cast("bigint").alias("promo_items")
    )


# -- the fused form used by the order plans ---------------------------------

def category_dim(
    categories: DataFrame, catalog: Catalog, keys: ItemKeys, exclude: str = N.EXCLUDE_LABEL
) -> DataFrame:
    """One row per item: label bitsets over its mapped rows, and its row count.

    An item listed twice in the dimension doubles its lines; ``_copies`` keeps
    that effect on sums without fanning out the fact side.
    """
    return _fold_items(_labelled_items(categories, catalog, keys, exclude), catalog, keys)


def _labelled_items(categories: DataFrame, catalog: Catalog, keys: ItemKeys, exclude: str) -> DataFrame:
    base = F.trim(F.col(N.BASE_LABEL))
    mapped = F.col(N.DRI_LABEL).isNotNull() & ~base.eqNullSafe(F.lit(exclude))
    return categories.where(F.col(keys.item).isNotNull()).select(
        keys.item,
        F.lit(1).alias("_row"),
        mapped.alias("_mapped"),
        catalog.dri.position(f"`{N.DRI_LABEL}`").alias("_dri"),
        catalog.base.position(f"trim(`{N.BASE_LABEL}`)").alias("_base"),
    )


def _fold_items(rows: DataFrame, catalog: Catalog, keys: ItemKeys) -> DataFrame:
    bits = [
        F.expr(f"bit_or(IF(_mapped, {ls.word_of_position(f'_{kind}', w)}, NULL))").alias(f"_{kind}{w}")
        for kind, ls in (("dri", catalog.dri), ("base", catalog.base))
        for w in range(ls.words)
    ]
    return rows.groupBy(keys.item).agg(
        F.nullif(F.count("_row"), F.lit(0)).alias("_copies"), F.max("_mapped").alias("_mapped"), *bits
    )


def item_rows(
    categories: DataFrame, combos: DataFrame, catalog: Catalog, keys: ItemKeys, exclude: str = N.EXCLUDE_LABEL
) -> DataFrame:
    """All that a line has to meet by its item: one row of ``category_dim`` per item, one (``_choice``, ``_limit``) row per choice it heads.

    A header that no category names has a row without labels, so that every line of a listed item meets exactly one row without choice.
    """
    covers = header_covers(combos, keys)
    named = _labelled_items(categories, catalog, keys, exclude)
    items = _fold_items(named.unionByName(covers.select(keys.item), allowMissingColumns=True), catalog, keys)
    return items.unionByName(covers, allowMissingColumns=True)


#: what is true of a line or an (order, item) pair, below the bits of its price buckets
PAYABLE, COUNTED, PROMO, BUCKET_SHIFT = 1, 2, 4, 3


def _marked(mark: int) -> Column:
    return F.col("_marks").bitwiseAND(F.lit(mark)) != 0


def encoded_item_features(
    items: DataFrame,
    categories: DataFrame,
    combos: DataFrame,
    catalog: Catalog,
    keys: ItemKeys = DELIVERY,
    bins: Sequence[float] = N.PRICE_BINS,
    by_order: bool = False,
) -> DataFrame:
    """Every item-derived feature of an order, bitsets undecoded, in one pass over the lines.

    1. Lines meet the labels and the choices of their item in one join on the item, and are shuffled once for both.
    2. Lines and the narrow choice limits of sold headers are dealt by order and fold to one row per (order, item) there.
    3. These fold to one row per order without another shuffle. No buffer holds more than one pair or one order's bitsets.

    All buffers are fixed-width numbers and bitsets; what is true or false of a pair shares one. The separate
    operators above compute the same columns one at a time.
    """
    payable, qty = keys.payable(), F.col(keys.quantity)
    promo = F.lit(False) if keys.promo is None else F.col(keys.promo)
    counted = payable & qty.isNotNull()
    bucket = F.coalesce(_bucket_bit(F.col(keys.price), counted, bins).cast("bigint"), F.lit(0))
    marks = F.call_function("shiftleft", bucket, F.lit(BUCKET_SHIFT))
    for mark, cond in ((PAYABLE, payable), (COUNTED, counted), (PROMO, promo)):
        marks = marks.bitwiseOR(F.when(cond, F.lit(mark)).otherwise(F.lit(0)))
    inputs = {"_qty": qty, "_marks": marks}
    first = [
        F.sum("_qty").alias("_qty"), F.coalesce(F.sum(F.when(_marked(PAYABLE), F.col("_qty"))), F.lit(0)).alias("_paid_qty"),
        F.bit_or("_marks").alias("_marks"),
    ]
    if keys.details:
        inputs |= {"_custom": F.col("is_customized"), "_veg": F.col("is_veg").cast("int")}
        first += [F.max("_custom").alias("_custom"), F.min("_veg").alias("_veg_min"), F.sum("_veg").alias("_veg_sum")]
    if keys.promo is not None:
        first.append(F.sum(F.when(_marked(PROMO), F.col("_qty"))).alias("_promo_qty"))

    known = items.where(F.col(keys.order).isNotNull())
    lines = known.select(keys.order, keys.item, *[c.alias(n) for n, c in inputs.items()])
    rows = item_rows(categories, combos, catalog, keys)
    facts = [F.max(c).alias(c) for c in rows.columns if c not in (keys.item, "_choice", "_limit")]
    met = lines_and_offers(lines, rows, _marked(PAYABLE), keys, by_order)
    marked = fold_met(met.repartition(keys.order), [*first, *facts], keys)
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    kept = _marked(PAYABLE) & F.col("_mapped") & ~covered(F.col("_paid_qty") * copies)
    marked = marked.withColumns({
        "_kept": F.coalesce(kept, F.lit(False)), "_counted": _marked(COUNTED),
        "_bucket": F.call_function("shiftright", F.col("_marks"), F.lit(BUCKET_SHIFT)).cast("int")})

    is_kept = F.col("_kept")
    seen = is_kept & F.col("_counted")
    second = [F.sum(F.col("_qty") * copies).cast("bigint").alias("item_count"), F.max(is_kept).alias("_any")]
    if keys.details:
        second += [
            F.max("_custom").alias("customization_flag"),
            F.min("_veg_min").alias("veg_indicator"),
            F.sum(F.col("_veg_sum") * copies).cast("bigint").alias("veg_count"),
        ]
    if keys.promo is not None:
        promo = F.sum(F.col("_promo_qty") * copies)
        second.append(_or_zero(promo).cast("bigint").alias("promo_items"))
    second.append(F.bit_or(F.when(is_kept, F.col("_bucket"))).alias("_bucket"))
    for kind, ls in (("dri", catalog.dri), ("base", catalog.base)):
        for w in range(ls.words):
            bits = F.col(f"_{kind}{w}")
            second.append(F.bit_or(F.when(seen, bits)).alias(f"_{kind}_seen{w}"))
            second.append(F.bit_or(F.when(is_kept, bits)).alias(f"_{kind}_list{w}"))
    return marked.groupBy(F.col(keys.order).alias(N.ORDER_ID)).agg(*second)


def feed_key(feed: int, key: Column) -> Column:
    """A key that tells equal keys of different feeds apart; NULL stays NULL."""
    return F.when(key.isNotNull(), F.struct(F.lit(feed).alias("feed"), key.alias("key")))


def item_key(feed: int, key: Column) -> Column:
    """The same for item keys, as one text: narrower than a struct in every shuffle."""
    return F.concat(F.lit(f"{feed}:"), key.cast("string"))


def _item_feed(keys: ItemKeys) -> int:
    """Feeds that name items alike share their dimension rows."""
    return (DELIVERY.item, IN_STORE.item).index(keys.item)


def united_lines(feeds: Sequence[tuple[int, DataFrame, ItemKeys]]) -> DataFrame:
    """Lines of all feeds with the columns of ``UNITED``, so that one fold serves every channel."""
    parts = [
        lines.select(
            feed_key(feed, F.col(keys.order).cast("bigint")).alias("_order"),
            item_key(_item_feed(keys), F.col(keys.item)).alias("_item"),
            F.col(keys.price).cast("double").alias("_price"),
            F.col(keys.quantity).cast("bigint").alias("quantity"),
            (F.lit(False) if keys.promo is None else F.col(keys.promo)).alias("_promo"),
        )
        for feed, lines, keys in feeds
    ]
    return reduce(DataFrame.unionByName, parts)


def united_dimensions(categories: DataFrame, combos: DataFrame, forms: Sequence[ItemKeys]) -> tuple[DataFrame, DataFrame]:
    """Categories and combos under the item keys of ``UNITED``, for the forms of keys that occur."""
    forms = list({_item_feed(k): k for k in forms}.values())
    labels = [categories.select(item_key(_item_feed(k), F.col(k.item)).alias("_item"), N.BASE_LABEL, N.DRI_LABEL) for k in forms]
    covers = [combos.select(item_key(_item_feed(k), F.col(k.header)).alias("_header"),
                            item_key(_item_feed(k), F.col(k.choice)).alias("_choice"), "Qty") for k in forms]
    return reduce(DataFrame.unionByName, labels), reduce(DataFrame.unionByName, covers)


def decode_item_features(
    df: DataFrame, catalog: Catalog, labels: Sequence[str] = N.BUCKET_LABELS
) -> DataFrame:
    """Spell the bitsets out as flag and list columns.

    Done after the join to the orders, which then sorts a dozen numbers per
    order instead of every output column. An order none of whose lines
    survived has missing, not zero, features.
    """
    def words(kind: str, what: str, ls: LabelSet) -> list[str]:
        return [f"coalesce(_{kind}_{what}{w}, 0L)" for w in range(ls.words)]

    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if not c.startswith("_")],
        *_bucket_flags("coalesce(_bucket, 0)", labels, "_any"),
        *catalog.dri.flags(words("dri", "seen", catalog.dri), "_any"),
        *catalog.base.flags(words("base", "seen", catalog.base), "_any"),
        catalog.dri.to_array(words("dri", "list", catalog.dri), "_any").alias(N.DRI_LIST),
        catalog.base.to_array(words("base", "list", catalog.base), "_any").alias(N.BASE_LIST),
    )


def order_item_features(
    items: DataFrame,
    categories: DataFrame,
    combos: DataFrame,
    catalog: Catalog,
    keys: ItemKeys = DELIVERY,
    bins: Sequence[float] = N.PRICE_BINS,
    labels: Sequence[str] = N.BUCKET_LABELS,
) -> DataFrame:
    """Item features of every order that has lines."""
    encoded = encoded_item_features(items, categories, combos, catalog, keys, bins)
    return decode_item_features(encoded, catalog, labels)
