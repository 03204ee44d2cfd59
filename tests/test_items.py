"""Item operators against brute force on small random fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators import items as I
from cartwright.operators.labels import Catalog, LabelSet, label_set

ITEMS = ("sales_id long, item_id_id string, quantity int, original_price double, "
         "promo_item boolean, is_customized boolean, is_veg boolean")
CATS = f"item_id_id string, ProductCode string, `{N.BASE_LABEL}` string, `{N.DRI_LABEL}` string"
COMBOS = "header_item_id_id string, choice_item_id_id string, Qty int"


def random_case(seed):
    rng = random.Random(seed)
    lines = [
        (
            rng.choice([1, 2, 3, 4, 5]), str(rng.randrange(8)), rng.choice([None, 1, 2, 3]),
            rng.choice([None, -1.0, 20.0, 35.0, 120.0, 260.0, 700.0]),
            rng.choice([True, False, False, None]), rng.random() < 0.3, rng.random() < 0.5,
        )
        for _ in range(60)
    ]
    bases = ["Fries", " Fries ", "Exclude ", None, "Coffee", "Coffee!", "Wrap & Roll"]
    dris = [None, "Core", "Value", "Core "]
    cats = [(str(i), f"P{i}", rng.choice(bases), rng.choice(dris)) for i in range(7)]
    cats += [(str(i), f"P{i}", rng.choice(bases), rng.choice(dris)) for i in (1, 2)]  # duplicate keys
    combos = [(str(rng.randrange(8)), str(rng.randrange(8)), rng.choice([None, 1, 3, 6])) for _ in range(8)]
    return lines, cats, combos


def expand(lines, cats):
    """Left join of lines to categories, duplicates multiplying."""
    for line in lines:
        hits = [c for c in cats if c[0] == line[1]] or [(None, None, None, None)]
        for c in hits:
            yield (*line, c[2], c[3])


def brute_removed(rows, combos):
    paid = [r for r in rows if r[4] is False]
    quantity = {}
    for r in paid:
        quantity[r[0], r[1]] = quantity.get((r[0], r[1]), 0) + (r[2] or 0)
    out = set()
    for r in paid:
        for h, c, allowed in combos:
            if h == r[1] and allowed is not None and (r[0], c) in quantity and allowed >= quantity[r[0], c]:
                out.add((r[0], c))
    return out


def frames(spark, case):
    lines, cats, combos = case
    return (spark.createDataFrame(lines, ITEMS), spark.createDataFrame(cats, CATS),
            spark.createDataFrame(combos, COMBOS))


@pytest.mark.parametrize("seed", range(4))
def test_remove_choices(spark, seed):
    lines, cats, combos = random_case(seed)
    items, _, combo_df = frames(spark, (lines, cats, combos))
    gone = brute_removed(lines, combos)
    want = sorted(map(repr, (r for r in lines if r[4] is False and (r[0], r[1]) not in gone)))
    got = sorted(repr(tuple(r)) for r in I.remove_choices(items, combo_df).select(*items.columns).collect())
    assert got == want


@pytest.mark.parametrize("seed", range(6))
def test_order_item_features(spark, seed):
    lines, cats, combos = random_case(seed)
    items, cat_df, combo_df = frames(spark, (lines, cats, combos))
    catalog = Catalog.from_categories(cat_df)
    got = {r[N.ORDER_ID]: r.asDict() for r in
           I.order_item_features(items, cat_df, combo_df, catalog).collect()}

    rows = list(expand(lines, cats))
    gone = brute_removed(rows, combos)
    norm = dict(zip(catalog.base.raw, catalog.base.normalized)) | dict(zip(catalog.dri.raw, catalog.dri.normalized))
    assert set(got) == {r[0] for r in rows}
    for order, row in got.items():
        mine = [r for r in rows if r[0] == order]
        kept = [
            r for r in mine
            if r[4] is False and (r[0], r[1]) not in gone and r[8] is not None
            and (r[7] is None or r[7].strip() != "Exclude")
        ]
        quantities = [r[2] for r in mine if r[2] is not None]
        assert row["item_count"] == (sum(quantities) if quantities else None)
        assert row["customization_flag"] == any(r[5] for r in mine)
        assert row["veg_indicator"] == min(int(r[6]) for r in mine)
        assert row["veg_count"] == sum(int(r[6]) for r in mine)
        assert row["promo_items"] == sum(r[2] or 0 for r in mine if r[4])
        counted = [r for r in kept if r[2] is not None]
        for label, lo, hi in zip(N.BUCKET_LABELS, N.PRICE_BINS, N.PRICE_BINS[1:]):
            hit = int(any(r[3] is not None and lo <= r[3] < hi for r in counted))
            assert row[f"{label}_items_count"] == (hit if kept else None)
        for column in catalog.dri.columns:
            hit = int(any(N.DRI_PREFIX + norm[r[8]] == column for r in counted))
            assert row[column] == (hit if kept else None)
        for column in catalog.base.columns:
            hit = int(any(r[7] is not None and N.BASE_PREFIX + norm[r[7].strip()] == column for r in counted))
            assert row[column] == (hit if kept else None)
        assert row[N.DRI_LIST] == (sorted({r[8] for r in kept}) if kept else None)
        assert row[N.BASE_LIST] == (sorted({r[7].strip() for r in kept if r[7] is not None}) if kept else None)


def test_fused_features_match_the_separate_operators(spark):
    items, cats, combos = frames(spark, random_case(11))
    cats = cats.dropDuplicates(["item_id_id"])
    cats = spark.createDataFrame(cats.collect(), CATS)  # fix the chosen duplicates
    catalog = Catalog.from_categories(cats)
    fused = I.order_item_features(items, cats, combos, catalog)
    clean = I.drop_unmapped(I.map_categories(I.remove_choices(items, combos), cats))

    def same(separate):
        columns = separate.columns
        kept = fused.where(F.col(N.DRI_LIST).isNotNull()).select(*columns)
        key = lambda r: repr(tuple(r))
        assert sorted(map(key, kept.collect())) == sorted(map(key, separate.collect()))

    same(I.bucket_presence(clean))
    same(I.label_presence(clean, N.DRI_LABEL, catalog.dri))
    same(I.label_presence(clean, N.BASE_LABEL, catalog.base))
    same(I.label_lists(clean, N.DRI_LABEL, catalog.dri, N.DRI_LIST))


def test_choice_removed_at_the_limit_and_kept_above(spark):
    def kept(quantity):
        items = spark.createDataFrame(
            [(1, "meal", 1, 100.0, False, False, True), (1, "coke", quantity, 50.0, False, False, True)], ITEMS)
        combos = spark.createDataFrame([("meal", "coke", 2)], COMBOS)
        return sorted(r["item_id_id"] for r in I.remove_choices(items, combos).collect())

    assert kept(2) == ["meal"]
    assert kept(3) == ["coke", "meal"]


def test_instore_has_no_promo_filter(spark):
    items = spark.createDataFrame(
        [(1, "P1", 2, 50.0), (1, "P2", 1, 20.0)], "InvoiceNo long, ProductCode string, quantity int, PriceNet double")
    combos = spark.createDataFrame([("P1", "P2", 1)], "HeaderItemId string, ChoiceItemId string, Qty int")
    assert [r["ProductCode"] for r in I.remove_choices(items, combos, I.IN_STORE).collect()] == ["P1"]
    assert I.item_count(items).first()["item_count"] == 3


def test_semi_items_and_promo(spark):
    items = spark.createDataFrame(
        [(1, "a", 2, 1.0, True, False, True), (2, "a", 3, 1.0, None, False, True)], ITEMS)
    orders = spark.createDataFrame([(1,), (1,), (None,)], "sales_id long")
    assert I.items_of_orders(items, orders, "sales_id").count() == 1
    assert I.payable_items(items).count() == 0
    assert {r["order_id"]: r["promo_items"] for r in I.promo_quantity(items).collect()} == {1: 2, 2: 0}


def test_wide_vocabulary_spans_words(spark):
    raw = [f"L {i:03d}" for i in range(150)]
    df = spark.createDataFrame([(r,) for r in raw], "label string")
    ls = label_set(df, F.col("label"), "x_")
    assert ls.words == 3 and len(ls.columns) == 150
    pos = df.select("label", ls.position("label").alias("pos"))
    words = [F.expr(f"bit_or({ls.word_of_position('pos', w)})").alias(f"w{w}") for w in range(3)]
    some = {raw[0], raw[62], raw[63], raw[149]}
    agg = pos.where(F.col("label").isin(*some)).agg(*words)
    row = agg.select(ls.to_array(agg.columns).alias("a"), ls.count(agg.columns).alias("n"), *ls.flags(agg.columns)).first()
    assert row["a"] == sorted(some) and row["n"] == 4
    assert {c for c in ls.columns if row[c] == 1} == {"x_l_000", "x_l_062", "x_l_063", "x_l_149"}
    back = spark.createDataFrame([(sorted(some),)], "a array<string>")
    assert [r[0] for r in back.select(*[ls.word_of_array("a", w) for w in range(3)]).unionAll(agg).collect()] == \
        [r[0] for r in agg.unionAll(agg).collect()]


def test_labels_with_quotes(spark):
    ls = LabelSet("x_", ("a'b", "c\\d"), ("a_b", "c_d"))
    df = spark.createDataFrame([("a'b",), ("c\\d",), ("e",)], "label string")
    got = [r[0] for r in df.select(ls.position("label")).collect()]
    assert got == [0, 1, None]


def test_a_vocabulary_may_be_large(spark):
    labels = label_set(spark.range(6000).select(F.format_string("l%04d", "id").alias("l")), F.col("l"), "x_")
    assert len(labels.raw) == 6000 and labels.columns[-1] == "x_l5999"


def test_catalog_covers_written_labels(spark):
    """Labels that the dimension has lost since count like the others."""
    from cartwright import names as N
    from cartwright.operators.labels import Catalog

    orders = spark.createDataFrame([(["a", "new"], ["b"])], f"{N.DRI_LIST} array<string>, {N.BASE_LIST} array<string>")
    catalog = Catalog(LabelSet(N.DRI_PREFIX, ("a", "z"), ("a", "z")), LabelSet(N.BASE_PREFIX, (), ())).covering([orders])
    assert catalog.dri.raw == ("a", "new", "z") and catalog.base.raw == ("b",)
    words = orders.select(catalog.dri.word_of_array(N.DRI_LIST, 0).alias("w"))
    assert words.select(catalog.dri.count(["w"])).first()[0] == 2


def test_limits_of_a_hot_order(spark):
    """Choice limits of an order with all items come from a join and an aggregate on (order, item)."""
    from cartwright.operators.items import DELIVERY, fold_pairs

    pairs = spark.range(300).select(F.lit(1).alias("sales_id"), F.col("id").cast("string").alias("item_id_id"), F.lit(2).alias("_qty"))
    combos = spark.range(300).select(
        F.col("id").cast("string").alias("header_item_id_id"), ((F.col("id") + 1) % 300).cast("string").alias("choice_item_id_id"),
        (F.col("id") % 5).alias("Qty")).union(spark.createDataFrame([("7", "8", 99), (None, "9", 50), ("400", "9", 50)], "a string, b string, c long"))
    out = fold_pairs(pairs.union(pairs), [F.sum("_qty").alias("_qty")], pairs, combos, DELIVERY)
    got = {r["item_id_id"]: r["_limit"] for r in out.collect()}
    want = {str((i + 1) % 300): i % 5 for i in range(300)} | {"8": 99}
    assert got == want and {r["_qty"] for r in out.collect()} == {4}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "REPARTITION_BY_COL" not in plan
    assert plan.split("Initial Plan")[0].count("hashpartitioning(sales_id") == 1  # lines and offers meet in one shuffle


def test_limits_meet_folded_pairs_in_a_join(spark):
    """No aggregate of lines holds the offers of their order, which outnumber them."""
    from cartwright.operators.items import DELIVERY, offers_of, with_limits

    lines = spark.createDataFrame([(1, "a", 2), (1, "a", 3), (1, "b", 1), (2, "b", 1), (3, None, 4)], "sales_id long, item_id_id string, q int")
    combos = spark.createDataFrame([("a", "b", 5), ("b", "b", 7), ("a", "z", 1), (None, "a", 9), ("b", "a", None)], COMBOS)
    pairs = lines.groupBy("sales_id", "item_id_id").agg(F.sum("q").alias("_qty"))
    out = with_limits(pairs, offers_of(lines, combos, DELIVERY), DELIVERY)
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a", 5, None), (1, "b", 1, 7), (2, "b", 1, 7), (3, None, 4, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join LeftOuter" in plan


def test_choice_pairs_do_not_aggregate_offers(spark):
    lines = spark.createDataFrame([(1, "a", 2, False), (1, "b", 1, False), (1, "b", 3, False), (2, "b", 1, False), (2, "a", 1, None)],
                                  "sales_id long, item_id_id string, quantity int, promo_item boolean")
    combos = spark.createDataFrame([("a", "b", 4), ("a", "b", 1), ("b", "b", None)], COMBOS)
    pairs = I.choice_pairs(lines, combos)
    assert [tuple(r) for r in pairs.collect()] == [(1, "b")]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join LeftSemi" in plan


@pytest.mark.parametrize("by_order", [False, True])
def test_lines_are_dealt_once_by_item_and_once_by_order(spark, by_order):
    """Labels and choices meet the lines in one join, and both folds follow one shuffle by order."""
    from cartwright.session import settings

    items, cats, combos = frames(spark, random_case(5))
    items = spark.createDataFrame(items.collect() + [(9, None, 2, 20.0, False, False, True), (None, "1", 1, 20.0, False, False, True)], ITEMS)
    catalog = Catalog.from_categories(cats)
    want = I.order_item_features(items, cats, combos, catalog)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        out = I.decode_item_features(I.encoded_item_features(items, cats, combos, catalog, by_order=by_order), catalog)
        assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    lines = [x for x in plan.split("\n") if "Exchange hashpartitioning(sales_id" in x]
    assert len(lines) == (2 if by_order else 1)  # what a join has dealt by order needs no first one


def test_a_header_without_labels_still_heads(spark):
    items = spark.createDataFrame([(1, "h", 2, 20.0, False, False, True), (1, "c", 1, 20.0, False, False, True), (2, "c", 3, 20.0, False, False, True)], ITEMS)
    cats = spark.createDataFrame([("c", "Pc", "Coffee", "Core"), ("c", "Pc", "Coffee", "Core")], CATS)
    combos = spark.createDataFrame([("h", "c", 2), ("h", "x", 9), ("h", "c", 1)], COMBOS)
    out = I.order_item_features(items, cats, combos, Catalog.from_categories(cats))
    # the dimension lists the choice twice, so it counts twice; that of order 1 is covered by its header
    assert sorted((r[N.ORDER_ID], r["item_count"], r[N.DRI_LIST]) for r in out.collect()) == [(1, 4, None), (2, 6, ["Core"])]
