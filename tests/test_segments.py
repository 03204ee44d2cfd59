from itertools import product

import pytest
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators import segments as S
from checks import spec

FLAGS = ("Weekend_flag", "Weekday_flag", "Premium_price_flag", "Lunch_flag", "Late_Night_flag", "Breakfast_flag", "Evening_flag")


def grid(spark):
    axes = [("ownapp_order_count", (1, 5, 6, 15, 16, 100)),
            ("unique_cat_base_count", (0, 2, 3, 6, 7, 8, 9, 11, 12, 16, 17)),
            ("channel_count", (1, 2)), *[(f, (0, 1)) for f in FLAGS]]
    df = spark.range(1).select(F.lit("x").alias(N.CUSTOMER_ID))
    for name, values in axes:
        df = df.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return df


def test_every_grid_row_matches_exactly_one_rule(spark):
    df = grid(spark)
    matches = sum(
        (F.expr(f"CAST(({S.BANDS[b]}) AND ({cond}) AS INT)") for b, _, cond in S.rule_list()), F.lit(0)
    )
    assert df.count() == 16896
    assert [r[0] for r in df.select(matches.alias("n")).distinct().collect()] == [1]
    assert S.add_segment(df).select("Segment").distinct().count() == 27
    assert len(S.rule_list()) == 27


def test_missing_inputs_leave_a_customer_unassigned(spark):
    df = grid(spark).limit(1).withColumn("unique_cat_base_count", F.lit(None).cast("int"))
    assert S.add_segment(df).first()["Segment"] is None
    assert S.assign_segments(df).count() == 0


def test_bands(spark):
    df = spark.createDataFrame([(n,) for n in (1, 5, 6, 15, 16)], "ownapp_order_count long")
    got = {b: sorted(r[0] for r in S.band(df, b).collect()) for b in S.BANDS}
    assert got == {"1_5": [1, 5], "6_15": [6, 15], "15_plus": [16]}
    with pytest.raises(ValueError):
        S.band(df, "16_20")


def test_domain_keeps_missing_dri_count(spark):
    rows = [("a", 5, None), ("b", 5, 0), ("c", 101, 3), ("d", 100, 1), ("e", None, 1)]
    df = spark.createDataFrame(rows, f"{N.CUSTOMER_ID} string, ownapp_order_count long, unique_dri_category_count long")
    assert sorted(r[0] for r in S.in_domain(df).collect()) == ["a", "d"]


def test_flags_and_renames(spark):
    df = spark.createDataFrame([("a", 2, 0, None)], f"{N.CUSTOMER_ID} string, omnichannel_x_count int, y_count_z int, w_count int")
    flagged = S.create_flags(df, [N.CUSTOMER_ID, "omnichannel_x_count", "y_count_z", "w_count", "absent_count"])
    assert flagged.columns == [N.CUSTOMER_ID, "omnichannel_x_flag", "y_flag_z", "w_flag"]
    assert tuple(flagged.first()) == ("a", 1, 0, 0)
    assert S.rename_features(flagged, {"x_flag": "X"}).columns == [N.CUSTOMER_ID, "X", "y_flag_z", "w_flag"]
    with pytest.raises(ValueError):
        S.create_flags(df, ["omnichannel_x"])


def test_spec_yields_the_names_the_rules_use(spark):
    empty = spark.createDataFrame([], ", ".join(f"`{c}` {'string' if c == N.CUSTOMER_ID else 'long'}" for c in (*spec.KEEP, *spec.FLAGS)))
    columns = set(S.flag_features(empty, spec.FLAGS, spec.RENAMES).columns)
    assert {*FLAGS, "unique_cat_base_count", "channel_count", "ownapp_order_count"} <= columns


def test_first_rule_per_customer_and_band(spark):
    rows = [("a", 1, 3, 1, 1), ("a", 1, 0, 1, 0), ("a", 20, 0, 1, 0)]
    df = spark.createDataFrame(rows, f"{N.CUSTOMER_ID} string, ownapp_order_count long, unique_cat_base_count long, channel_count int, Weekend_flag int")
    for f in FLAGS[1:]:
        df = df.withColumn(f, F.lit(0))
    got = sorted(r["Segment"] for r in S.assign_segments(df).collect())
    assert got == ["Seg15_plus_1", "Seg1_5_1"]


def test_summary_lists_empty_segments_and_rounds_half_even(spark):
    df = grid(spark).where("ownapp_order_count < 6").limit(0)
    eight = [("x", n, 0, 1, *[0] * 7) for n in (1, 0, 0, 0, 0, 0, 0, 0)]
    some = spark.createDataFrame(eight, df.schema)
    summary = {r["Segment"]: r for r in S.segment_summary(some).collect()}
    assert len(summary) == 27
    assert summary["Seg1_5_1"]["Avg Orders per Customer"] == 0.12  # 0.125 half-even
    empty = [r for s, r in summary.items() if s.startswith("Seg15_plus")]
    assert len(empty) == 9
    assert {(r["Customer Count"], r["Total Orders"], r["Avg Orders per Customer"]) for r in empty} == {(0, 0, None)}


def test_with_segment_keeps_base_columns(spark):
    values = {c: ("a" if c == N.CUSTOMER_ID else i % 3) for i, c in enumerate((*spec.KEEP, *spec.FLAGS))}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{c}` {'string' if c == N.CUSTOMER_ID else 'long'}" for c in values))
    out = S.with_segment(df, spec.FLAGS, spec.RENAMES)
    assert out.columns == [*df.columns, "Segment"]
    row = out.first().asDict()
    assert {c: row[c] for c in values} == values
    via = S.assign_segments(S.flag_features(df, spec.FLAGS, spec.RENAMES)).first()["Segment"]
    assert row["Segment"] == via is not None


def test_only_planned_customers_are_scored(spark):
    """Customers of segments that no enabled plan takes are not written for scoring."""
    from cartwright.operators.centroids import MicroPlan
    from cartwright.plans.segmentation import SegmentSpec, planned_customers

    keep = (N.CUSTOMER_ID, N.TARGET, "unique_dri_category_count", "unique_cat_base_count", "channel_count")
    flags = ("Weekend_count", "Weekday_count", "Premium_price_count", "Lunch_count", "Late_Night_count", "Breakfast_count", "Evening_count")
    rows = [("a", 1, 1, 1, 1, *[0] * 7), ("b", 1, 1, 1, 1, 1, 0, *[0] * 5), ("c", 1, 1, 1, 1, 1, 1, *[0] * 5)]
    df = spark.createDataFrame(rows, f"{N.CUSTOMER_ID} string, " + ", ".join(f"{c} long" for c in (*keep[1:], *flags)))
    plans = (MicroPlan("one", ("Seg1_5_1",), "m"), MicroPlan("off", ("Seg1_5_2",), "m", enabled=False))
    got = planned_customers(df, SegmentSpec(keep, flags, {}, {}, plans)).collect()
    assert [(r[N.CUSTOMER_ID], r["Segment"]) for r in got] == [("a", "Seg1_5_1")]
