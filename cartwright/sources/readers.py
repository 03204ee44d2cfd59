"""Readers of the input tables.

CSV columns are picked by the header name of each file and cast to declared
types, so no file is scanned for schema inference and the order of columns may
differ between files. A declared column that a header lacks is an error.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import chain, islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.scalars import long_key, null_if_nan, text_key
from cartwright.session import settings

# Declared columns of the CSV inputs: name -> kind.
CUSTOMER_MAP = {"invoice_no": "long", "customer_code_ty": "text", "invoice_date": "date", "store_code": "long"}
STORE_MAP = {"MDS ID": "long", "DSR Code": "text"}
STORE_MASTER = {
    "Store Code": "text", "Store Name": "raw", "Store Type": "raw",
    "Geographical City": "raw", "Key City": "raw", "Generator New": "raw",
}
CATEGORIES = {
    "item_id_id": "text", "ProductCode": "text",
    "Clubbed base product category": "raw", "Final Dri Category": "raw",
}
COMBO_MASTER = {
    "header_item_id_id": "text", "choice_item_id_id": "text",
    "HeaderItemId": "text", "ChoiceItemId": "text", "Qty": "long",
}
INSTORE_ORDERS = {
    "InvoiceNo": "long", "BussTime": "clock", "StoreCode": "long", "GrossAmount": "money",
    "Discount": "money", "BaseAmount": "money", "TransType": "raw", "SaleType": "raw",
}
INSTORE_ITEMS = {
    "InvoiceNo": "long", "OrderDatetime": "clock", "StoreCode": "long",
    "ProductCode": "text", "Qty": "long", "PriceNet": "money",
}


def _cast(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    out = {
        "raw": lambda: c,
        "text": lambda: text_key(c),
        "long": lambda: long_key(c),
        "money": lambda: null_if_nan(c.try_cast("double")),
        "date": lambda: c.try_cast("date"),
        "clock": lambda: c.try_cast("timestamp_ntz"),
    }[kind]()
    return out.alias(name)


def csv_headers(spark: SparkSession, path: str, multi_line: bool = False) -> dict[tuple[str, ...], list[str]]:
    """Header -> files under ``path``, from one job with a task per file that reads its first lines.

    A file is never split here and never shares a task, so a task ends after its first batch of lines. What
    reaches the driver is one header per file, next to the listing of the files that it holds anyway.
    """
    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a function of this call, so that executors need no module of this package
        def lines(first: pa.RecordBatch) -> Iterator[str]:
            for batch in chain([first], batches):
                yield from (f"{x.as_py()}\n" for x in batch.column("value"))

        for batch in batches:
            if not batch.num_rows:
                continue
            text = (x.removeprefix("\ufeff") for x in lines(batch))
            text = (x for x in text if x.strip())  # blank lines ahead of the header are passed over
            header = next(csv.reader(text if multi_line else islice(text, 1)), [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("file").slice(0, 1), pa.array([header], pa.list_(pa.string()))], names=["file", "header"])
            return

    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    whole = str(1 << 40)
    one_file_a_task = settings(
        spark, spark__sql__files__maxPartitionBytes=whole, spark__sql__files__openCostInBytes=whole,
        spark__sql__execution__arrow__maxRecordsPerBatch="16")
    with one_file_a_task:
        rows = lines.mapInArrow(first_lines, "file string, header array<string>").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(rows, key=lambda r: r["file"]):
        if r["header"]:  # a file of blank lines has neither header nor rows
            groups.setdefault(tuple(r["header"]), []).append(unquote(r["file"]))
    return groups


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    optional: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """Declared columns of all files under ``path``.

    Files are grouped by header, and each group is read with its own; Spark checks every
    file of a group against it. Columns in ``optional`` that no file has are left out, and are
    NULL where only some have them. ``multi_line`` allows line breaks in quotes, at the
    price of one task per file.
    """
    groups = csv_headers(spark, path, multi_line)
    if not groups:
        raise ValueError(f"no CSV header found in {path}")
    parts = []
    for header, group in groups.items():
        absent = [n for n in columns if n not in header and n not in optional]
        if absent:
            raise ValueError(f"{group[0]} has no column {absent}; its header is {list(header)}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
        text = spark.read.schema(schema).csv(group, enforceSchema=False, header=True, multiLine=multi_line)
        parts.append(text.select(*[_cast(n, k) for n, k in columns.items() if n in header]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Projected scan; NaN in floating columns is read as missing."""
    df = spark.read.parquet(path)
    return nan_as_missing(df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns]))


def nan_as_missing(df: DataFrame) -> DataFrame:
    floats = {
        f.name: null_if_nan(F.col(f"`{f.name}`").cast("double"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def read_orders(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return read_parquet(spark, path, columns).withColumn("id", F.col("id").cast("bigint"))


def read_order_items(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    items = read_parquet(spark, path, columns)
    return items.withColumn("item_id_id", text_key(F.col("item_id_id")))


def read_complaints(spark: SparkSession, path: str) -> DataFrame:
    ids = spark.read.parquet(path).select(long_key(F.col("order_id")).alias("order_id"))
    return ids.where(F.col("order_id").isNotNull())


def read_instore_orders(spark: SparkSession, pattern: str) -> DataFrame:
    return read_csv(spark, pattern, INSTORE_ORDERS)


def read_instore_items(spark: SparkSession, pattern: str) -> DataFrame:
    """In-store lines; the quantity gets the name the delivery feed uses."""
    return read_csv(spark, pattern, INSTORE_ITEMS).withColumnRenamed("Qty", "quantity")
