import math
import random

import pytest
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators import centroids as M


def model(key="m", features=("a_count", "b_count"), mean=(0.0, 0.0), scale=(1.0, 1.0), centers=((0.0, 0.0), (2.0, 0.0))):
    return M.CentroidModel(key, features, mean, scale, centers)


def label(spark, m, *vectors):
    df = spark.createDataFrame([(i, list(v)) for i, v in enumerate(vectors)], "i int, v array<double>")
    return [r[0] for r in df.orderBy("i").select(M.nearest_center("v", m)).collect()]


def test_nearest_and_tie(spark):
    assert label(spark, model(), (0.0, 1.0), (1.9, 0.0), (1.0, 5.0)) == ["0", "1", "0"]


def test_constant_column_has_unit_scale(spark):
    assert label(spark, model(scale=(0.0, 1.0)), (1.9, 0.0)) == ["1"]


def test_against_brute_force(spark):
    rng = random.Random(5)
    width, k = 6, 5
    m = model("r", tuple(f"f{i}" for i in range(width)), tuple(rng.uniform(-1, 1) for _ in range(width)),
              tuple(rng.uniform(0.5, 2) for _ in range(width)),
              tuple(tuple(rng.uniform(-2, 2) for _ in range(width)) for _ in range(k)))
    vectors = [tuple(rng.uniform(-3, 3) for _ in range(width)) for _ in range(80)]

    def brute(v):
        z = [(x - a) / s for x, a, s in zip(v, m.mean, m.scale)]
        d = [sum((p - q) ** 2 for p, q in zip(z, c)) for c in m.centers]
        return str(d.index(min(d)))

    assert label(spark, m, *vectors) == [brute(v) for v in vectors]


def test_model_widths_are_checked():
    with pytest.raises(ValueError):
        model(mean=(0.0,))
    with pytest.raises(ValueError):
        model(centers=())


def test_load_models(spark):
    row = lambda key: (key, ["a"], [0.0], [1.0], [[0.0], [1.0]])
    table = spark.createDataFrame([row("m1"), row("m2"), row("m3")], M.MODEL_SCHEMA)
    assert set(M.load_models(table, ["m1", "m3"])) == {"m1", "m3"}
    with pytest.raises(KeyError):
        M.load_models(table, ["m9"])
    with pytest.raises(ValueError):
        M.load_models(table.union(table), ["m1"])


def test_cap_bounds_and_clip(spark):
    df = spark.createDataFrame([("k", float(v) if v is not None else None) for v in (1, 2, 3, 4, 10, None)],
                               f"{N.CUSTOMER_ID} string, x double")
    row = M.cap_bounds(df, ["x"]).first()
    assert [round(b, 6) for b in row[0]] == [1.04, 9.76]
    got = sorted((r["x"] for r in M.cap_outliers(df).collect()), key=lambda v: math.inf if v is None else v)
    assert [v if v is None else round(v, 6) for v in got] == [1.04, 2.0, 3.0, 4.0, 9.76, None]


def test_cap_skips_id_and_target(spark):
    df = spark.createDataFrame([(1, 5, "t", 2)], f"{N.CUSTOMER_ID} long, {N.TARGET} long, name string, y_count int")
    assert M.numeric_columns(df) == ["y_count"]


PLANS = (
    M.MicroPlan("both", ("Seg1_5_1", "Seg1_5_2"), "m"),
    M.MicroPlan("again", ("Seg1_5_1",), "n"),
    M.MicroPlan("capped", ("Seg1_5_6",), "m"),
    M.MicroPlan("off", ("Seg1_5_3",), "m", enabled=False),
)
MODELS = {
    "m": model(features=("x_count", "bee")),
    "n": model("n", ("x_count",), (0.0,), (1.0,), ((5.0,), (0.0,))),
}
RENAMES = {"b_count": "bee"}
SCHEMA = f"{N.CUSTOMER_ID} string, {N.TARGET} long, omnichannel_x_count long, b_count long, Segment string"


def test_micro_segments(spark):
    rows = [("a", 1, 0, 0, "Seg1_5_1"), ("b", 1, 2, 0, "Seg1_5_2"), ("c", 1, 2, 0, "Seg1_5_3"),
            ("d", 1, 2, None, "Seg1_5_6"), ("e", 1, 9, 9, None), ("f", 1, 2, 0, "Seg9")]
    out = M.micro_segments(spark.createDataFrame(rows, SCHEMA), PLANS, MODELS, RENAMES)
    got = sorted((r[N.CUSTOMER_ID], r["Segment"], r["microcluster"]) for r in out.collect())
    assert got == [("a", "again", "1"), ("a", "both", "0"), ("b", "both", "1"), ("d", "capped", "1")]
    assert out.columns == [N.CUSTOMER_ID, N.TARGET, "omnichannel_x_count", "b_count", "microcluster", "Segment"]


def test_capping_uses_only_the_plans_own_customers(spark):
    rows = [(f"k{i}", 1, 1, 0, "Seg1_5_6") for i in range(200)] + [("top", 1, 1000, 0, "Seg1_5_6")]
    rows += [(f"z{i}", 1, 10_000, 0, "Seg1_5_2") for i in range(50)]
    far = {"m": model(features=("x_count", "bee"), centers=((1.0, 0.0), (900.0, 0.0))), "n": MODELS["n"]}
    out = M.micro_segments(spark.createDataFrame(rows, SCHEMA), PLANS, far, RENAMES)
    by = {r[N.CUSTOMER_ID]: (r["microcluster"], r["omnichannel_x_count"]) for r in out.collect()}
    assert by["top"] == ("0", 1000)  # scored with the capped value, reported with the original
    assert by["z0"] == ("1", 10_000)


def test_partitioning_does_not_change_scores(spark):
    rows = [(f"k{i}", 1, i % 7, i % 3, "Seg1_5_6") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    key = lambda d: sorted(map(tuple, M.micro_segments(d, PLANS, MODELS, RENAMES).collect()))
    assert key(df.repartition(7)) == key(df.coalesce(1))


def test_missing_features_are_named(spark):
    df = spark.createDataFrame([("a", 1, 1, 1, "Seg1_5_1")], SCHEMA).drop("b_count")
    with pytest.raises(KeyError, match="bee"):
        M.micro_segments(df, PLANS, MODELS, RENAMES)


def test_assignments_join_back(spark):
    base = spark.createDataFrame([("a", 1, 2, 3)], f"{N.CUSTOMER_ID} string, {N.TARGET} long, omnichannel_x_count long, b_count long")
    pairs = spark.createDataFrame([("a", "Seg1_5_2"), ("a", "Seg1_5_2")], f"{N.CUSTOMER_ID} string, Segment string")
    rows = M.attach_assignments(base, pairs).collect()
    assert len(rows) == 1 and rows[0]["b_count"] == 3


def test_caps_of_a_continuous_column(spark):
    """More values than are kept exactly: bracketed, and still the exact interpolated quantiles."""
    n = M.EXACT_ROWS + 5000
    df = spark.range(n).select(
        (F.xxhash64("id") / F.lit(2.0**60)).alias("x"), (F.col("id") % 3).cast("string").alias("p"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("half"))
    values = sorted(r["x"] for r in df.select("x").collect())
    halves = sorted(r["half"] for r in df.select("half").collect() if r["half"] is not None)

    def quantile(v, q):
        at = q * (len(v) - 1)
        low = int(at)
        return v[low] + (at - low) * (v[min(low + 1, len(v) - 1)] - v[low])

    row = M.cap_bounds(df, ["x", "half"]).first()
    assert row["_cap_0"] == pytest.approx([quantile(values, 0.01), quantile(values, 0.99)], rel=1e-12)
    assert row["_cap_1"] == pytest.approx([quantile(halves, 0.01), quantile(halves, 0.99)], rel=1e-12)
    assert M.cap_bounds(df, ["x"], by="p").count() == 3

