from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions import scalars as X


def one(spark, values, dtype, build):
    """Apply a column function to a list of values, keeping order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    out = df.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]


def test_bucket_edges(spark):
    prices = [0.0, 34.99, 35.0, 100.0, 175.0, 250.0, 325.0, 400.0, 600.0, 99999.9, 100000.0, -1.0, None, float("nan")]
    assert one(spark, prices, "double", X.price_bucket) == [
        "Add_ons", "Add_ons", "Economy", "Value", "Mid_Tier", "Premium", "Indulgence", "Ultimate",
        "Group", "Group", None, None, None, None,
    ]


def test_daypart_of_every_hour(spark):
    hours = [datetime(2025, 1, 1, h, 30) for h in range(24)]
    got = one(spark, hours, "timestamp_ntz", X.daypart)
    want = ["Late Night"] * 6 + ["Breakfast"] * 5 + ["Lunch"] * 4 + ["Evening"] * 4 + ["Dinner"] * 5
    assert got == want


def test_weekend(spark):
    days = [datetime(2025, 1, d, 12) for d in range(3, 7)] + [None]  # Friday to Monday
    assert one(spark, days, "timestamp_ntz", X.weekend_flag) == [0, 1, 1, 0, 0]


def test_local_clock_of_ntz_and_text(spark):
    ntz = one(spark, [datetime(2025, 1, 1, 20)], "timestamp_ntz",
              lambda c: X.local_clock(c, T.TimestampNTZType(), "Asia/Kolkata"))
    assert ntz == [datetime(2025, 1, 2, 1, 30)]
    texts = ["2025-01-01 20:00:00", "2025-01-01T20:00:00Z", "2025-01-01 22:00:00+02:00", "rubbish", None]
    got = one(spark, texts, "string", lambda c: X.local_clock(c, T.StringType(), "Asia/Kolkata"))
    assert got == [datetime(2025, 1, 2, 1, 30)] * 3 + [None, None]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_local_clock_of_instants_ignores_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        df = spark.sql("SELECT timestamp'2025-01-01 20:00:00Z' AS v, '2025-01-01 20:00:00Z' AS t")
        row = df.select(
            X.local_clock(F.col("v"), T.TimestampType(), "Asia/Kolkata").alias("v"),
            X.local_clock(F.col("t"), T.StringType(), "Asia/Kolkata").alias("t"),
        ).first()
        assert row["v"] == row["t"] == datetime(2025, 1, 2, 1, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_window_bounds(spark):
    start, end = X.window_bounds(date(2025, 7, 1), 27)
    utc_start, utc_end = X.window_bounds(date(2025, 7, 1), 27, "Asia/Kolkata")
    row = spark.range(1).select(start.alias("a"), end.alias("b"), utc_start.alias("c"), utc_end.alias("d")).first()
    assert tuple(row) == (
        datetime(2023, 4, 1), datetime(2025, 7, 1), datetime(2023, 3, 31, 18, 30), datetime(2025, 6, 30, 18, 30),
    )


def test_days_round_down(spark):
    ref = F.lit(date(2025, 6, 30)).cast("timestamp_ntz")
    last = [datetime(2025, 6, 30, 10), datetime(2025, 6, 30), datetime(2025, 6, 29, 23), datetime(2025, 6, 28, 1)]
    assert one(spark, last, "timestamp_ntz", lambda c: X.floor_days(c, ref)) == [-1, 0, 0, 1]


def test_missing_number_rules(spark):
    nan = float("nan")
    assert one(spark, [1.0, nan, None], "double", X.null_if_nan) == [1.0, None, None]
    assert one(spark, [1.0, 0.0, None], "double", lambda c: X.ratio(F.lit(2.0), c)) == [2.0, None, None]
    assert one(spark, ["1.5", "x", None, "NaN"], "string", X.number_or_zero) == [1.5, 0.0, 0.0, 0.0]
    assert one(spark, [-0.2, 0.3, None], "double", X.floor_negative) == [0.0, 0.3, None]
    assert one(spark, [0.0, 5.0, 20.0, None], "double", lambda c: X.clip(c, F.lit(1.0), F.lit(10.0))) == [1.0, 5.0, 10.0, None]


def test_keys(spark):
    assert one(spark, [" 12.0 ", "P7", "12", None, "1.50"], "string", X.text_key) == ["12", "P7", "12", None, "1.50"]
    assert one(spark, ["123.0", "9007199254740993", "x", None], "string", X.long_key) == [123, 9007199254740993, None, None]


def test_normalize_label(spark):
    raw = ["Café Food & Co ", "  A--B  ", "plain", "100% Juice!", "!!!", None]
    assert one(spark, raw, "string", X.normalize_label) == ["café_food_co", "a_b", "plain", "100_juice", "", None]


def test_as_list(spark):
    assert one(spark, ["['a', 'b']", '["c"]', "[]", "nonsense", None], "string",
               lambda c: X.as_list(c, T.StringType())) == [["a", "b"], ["c"], [], [], []]
    arr = T.ArrayType(T.StringType())
    assert one(spark, [["a"], None], "array<string>", lambda c: X.as_list(c, arr)) == [["a"], []]


def test_channel_label(spark):
    df = spark.createDataFrame(
        [(0, 1, 0, 0), (1, 1, 0, 1), (2, 1, 1, 1), (3, 0, 1, 0)], "i int, o int, n int, s int"
    )
    label = X.channel_label({"ownapp": F.col("o") > 0, "instore": F.col("n") > 0, "swiggy": F.col("s") > 0})
    got = [r["l"] for r in df.select("i", label.alias("l")).orderBy("i").collect()]
    assert got == ["OC only", "OC + Swiggy", "OC + Dine in + Swiggy", "Dine in"]
