import os

import pytest
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators.items import items_of_orders
from cartwright.session import settings
from cartwright.sources import readers as R
from cartwright.sources import sinks

COLUMNS = {"a": "long", "b": "text"}


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    """Columns in any order, extra ones, a byte order mark, blank lines ahead, an empty file: one job finds them all."""
    for i in range(200):
        head, row = ("a,b", f"{i},x{i}") if i % 3 else ("z,b,a", f"?,x{i},{i}")
        (tmp_path / f"{i}.csv").write_text(("﻿" if i == 5 else "") + ("\n\n" if i == 8 else "") + f"{head}\n{row}\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    groups, jobs = jobs_of(spark, "headers", lambda: R.csv_headers(spark, str(tmp_path)))
    assert jobs == 1 and sorted((h, len(f)) for h, f in groups.items()) == [(("a", "b"), 133), (("z", "b", "a"), 67)]
    rows = R.read_csv(spark, str(tmp_path), COLUMNS).collect()
    assert sorted((r["a"], r["b"]) for r in rows) == [(i, f"x{i}") for i in range(200)]


def test_long_files_are_not_read_for_their_header(spark, tmp_path):
    """A task stops after its first lines; files are large enough for several splits."""
    for name in "ab":
        with open(tmp_path / f"{name}.csv", "w", encoding="utf-8") as f:
            f.write("b,a\n")
            f.writelines(f"x{i},{i}\n" for i in range(300_000))
    with settings(spark, spark__sql__files__maxPartitionBytes="1m"):
        groups = R.csv_headers(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1m"
    assert list(map(len, groups.values())) == [2]
    assert R.read_csv(spark, str(tmp_path), COLUMNS).agg(F.sum("a")).first()[0] == 2 * sum(range(300_000))


def test_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,x\n")
    (tmp_path / "bad.csv").write_text("a,c\n1,x\n")
    with pytest.raises(ValueError, match="bad.csv"):
        R.read_csv(spark, str(tmp_path), COLUMNS)
    got = {tuple(r) for r in R.read_csv(spark, str(tmp_path), COLUMNS, optional=["b"]).collect()}
    assert got == {(1, "x"), (1, None)}


def test_quoted_headers(spark, tmp_path):
    (tmp_path / "q.csv").write_text('"a","x\ny","b, or c"\n1,2,3\n')
    got = R.read_csv(spark, str(tmp_path), {"a": "long", "b, or c": "text"}, multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, "3")]
    with pytest.raises(ValueError, match="no CSV header"):
        (tmp_path / "none").mkdir()
        (tmp_path / "none" / "e.csv").write_text("\n")
        R.read_csv(spark, str(tmp_path / "none"), COLUMNS)


def orders(spark, *rows):
    return spark.createDataFrame([(str(i), f"{m}-15 10:00:00", i) for i, m in rows], f"{N.CUSTOMER_ID} string, t string, v int").select(
        N.CUSTOMER_ID, F.col("t").cast("timestamp_ntz").alias("order_placed_datetime"), "v")


def values(spark, path):
    return sorted(r["v"] for r in spark.read.parquet(path).collect())


def broken(df):
    """Fails in a task, after other tasks have written."""
    return df.withColumn("v", F.when(F.col("v") == 3, F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("v")))


def test_failed_write_leaves_the_old_output(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_features(orders(spark, (1, "2025-01")), path)
    new = orders(spark, (2, "2025-01"), (3, "2025-02")).repartition(2)
    with pytest.raises(Exception, match="killed"):
        sinks.write_features(broken(new), path)
    assert values(spark, path) == [1] and os.listdir(tmp_path) == ["out"]
    sinks.write_features(new, path)
    assert values(spark, path) == [2, 3] and os.listdir(tmp_path) == ["out"]


def test_swap_that_was_cut_short_is_settled(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_features(orders(spark, (1, "2025-01")), path)
    os.rename(path, path + sinks.REPLACED)  # killed between the two renames
    sinks.settle(spark, path)
    assert values(spark, path) == [1]
    os.rename(path, path + sinks.REPLACED)
    sinks.write_features(orders(spark, (2, "2025-01")), path)  # the next run settles by itself
    assert values(spark, path) == [2] and os.listdir(tmp_path) == ["out"]


def test_only_the_months_at_hand_are_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_features(orders(spark, (1, "2025-01"), (2, "2025-02")), path, by_month=True)
    sinks.write_features(orders(spark, (4, "2025-02"), (5, "2025-03")), path, by_month=True, only_months=True)
    assert values(spark, path) == [1, 4, 5]
    sinks.write_features(orders(spark, (6, "2025-04")), path, by_month=True)
    assert values(spark, path) == [6]


def test_unwanted_lines_go_before_the_shuffle(spark):
    """With Spark's threshold lowered to these sizes, the semi-join filters the line scan by a Bloom filter."""
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").withColumnRenamed("l_orderkey", "InvoiceNo")
    kept = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").where("o_custkey % 50 = 1").withColumnRenamed("o_orderkey", "InvoiceNo")
    want = items_of_orders(lines, kept).count()
    with settings(spark, spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="1b", spark__sql__autoBroadcastJoinThreshold="-1"):
        found = items_of_orders(lines, kept)
        assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.count() == want > 0


@pytest.mark.parametrize("by_month", [False, True])
def test_rows_are_counted_while_they_are_written(spark, tmp_path, by_month):
    df = orders(spark, *[(i, f"2025-0{1 + i % 5}") for i in range(100)]).repartition(4)
    counted = {"rows": F.count(F.lit(1)), "most": F.max("v"), "none": F.max(F.lit(None).cast("string"))}
    found, jobs = jobs_of(spark, f"counted {by_month}", lambda: sinks.write_features(df, str(tmp_path / "a"), by_month, counted=counted))
    _, plain = jobs_of(spark, f"plain {by_month}", lambda: sinks.write_features(df, str(tmp_path / "b"), by_month))
    assert found == {"rows": 100, "most": 99, "none": None} and jobs == plain
