"""CSV ingest, lineage, sinks and catalog reports (S1-S11) in fresh temporary folders."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidemark.plans.incremental import in_window
from tidemark.sources import catalog, csv, schemas, sinks

ORDERS_HEADER = ("order_id,customer_id,order_date,promised_delivery_time,actual_delivery_time,delivery_status,"
                 "order_total,payment_method,delivery_partner_id,store_id")


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_csv_positional_load_with_malformed_short_and_long_rows(spark, tmpdir_path):
    _write(tmpdir_path, "orders.csv", [
        ORDERS_HEADER,
        "1,c1,2024-01-01 10:00:00,2024-01-01 10:30:00,2024-01-01 10:40:00,on time,12.5,cash,DP1,3",
        "2,c2,not-a-date,,,delayed,abc,upi,DP2,4",           # malformed cells -> null
        "3,c3",                                               # short row -> null padded
        "4,c4,2024-01-02 00:00:00,,,x,1.0,card,DP3,5,EXTRA",  # extra cell dropped
    ])
    df = csv.read_csv(spark, f"{tmpdir_path}/orders.csv", schemas.ORDERS)
    got = {r.order_id: r for r in df.collect()}
    assert len(got) == 4
    assert got["1"].order_total == 12.5 and str(got["1"].order_date) == "2024-01-01 10:00:00"
    assert got["2"].order_date is None and got["2"].order_total is None
    assert got["3"].order_date is None and got["3"].store_id is None
    assert got["4"].store_id == "5"


def test_csv_swapped_header_loads_by_position_unless_checked(spark, tmpdir_path):
    swapped = ORDERS_HEADER.replace("order_id,customer_id", "customer_id,order_id")
    _write(tmpdir_path, "orders.csv", [swapped, "1,c1,2024-01-01 10:00:00,,,on time,1.0,cash,DP,1"])
    positional = csv.read_csv(spark, f"{tmpdir_path}/orders.csv", schemas.ORDERS).first()
    assert positional.order_id == "1"
    checked = csv.read_csv(spark, f"{tmpdir_path}/orders.csv", schemas.ORDERS, enforce_schema=False,
                           keep_corrupt=True)
    assert checked.columns[-1] == csv.CORRUPT_COLUMN


def test_load_all_isolates_failures_and_adds_lineage(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    _write(src, "orders.csv", [ORDERS_HEADER, "1,c1,2024-01-01 10:00:00,,,on time,1.0,cash,DP,1",
                               "2,c2,2024-01-01 11:00:00,,,on time,2.0,cash,DP,1"])
    _write(src, "products.csv", ["product_id,product_name,category,subcategory,price,brand,description,is_available",
                                 "p1,Milk,Dairy,Milk,1.5,B,fresh,true"])
    status = csv.load_all(spark, src, f"{tmpdir_path}/raw", batch_id="20240101_000000")
    rows = {r.table_name.rsplit("/", 1)[-1]: r for r in status.collect()}
    assert len(rows) == 8
    assert rows["raw_orders"].loaded and rows["raw_orders"].row_count == 2
    assert rows["raw_products"].loaded and rows["raw_products"].row_count == 1
    assert not rows["raw_customers"].loaded and "customers.csv" in rows["raw_customers"].error
    raw = sinks.read_table(spark, f"{tmpdir_path}/raw/raw_orders")
    lineage = raw.select("_source_file", "_batch_id", "_load_timestamp").first()
    assert lineage._source_file == "orders.csv" and lineage._batch_id == "20240101_000000"
    assert lineage._load_timestamp is not None


def test_row_counts_report_keeps_going_on_missing_table(spark, tmpdir_path):
    df = spark.range(3)
    report = {r.table_name: (r.row_count, r.error) for r in catalog.table_row_counts(
        spark, {"present": df, "missing": f"{tmpdir_path}/nope"}).collect()}
    assert report["present"] == (3, None)
    assert report["missing"][0] is None and report["missing"][1]


def test_schema_doc_preview_and_metadata(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "k int, v string")
    doc = catalog.schema_doc(spark, {"t": df}).collect()
    assert [(r.column_name, r.data_type) for r in doc] == [("k", "int"), ("v", "string")]
    assert [r.k for r in catalog.preview(df, ["k"], ["k"], 2).collect()] == [1, 2]
    assert catalog.table_metadata(spark).count() == 7


def test_dynamic_partition_overwrite_touches_only_present_months(spark, tmpdir_path):
    target = f"{tmpdir_path}/facts"
    first = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "order_month string, v int")
    sinks.overwrite_partitions(first, target, ["order_month"])
    second = spark.createDataFrame([("2024-02", 20)], "order_month string, v int")
    sinks.overwrite_partitions(second, target, ["order_month"])
    got = sorted((r.order_month, r.v) for r in spark.read.parquet(target).collect())
    assert got == [("2024-01", 1), ("2024-02", 20)]


def test_run_window_is_closed_and_pushed_down(spark, tmpdir_path):
    path = f"{tmpdir_path}/o"
    spark.createDataFrame(
        [("a", "2024-01-01 00:00:00"), ("b", "2024-01-31 23:59:00"), ("c", "2024-02-01 00:00:00"), ("d", None)],
        "id string, t string").select("id", F.col("t").cast("timestamp_ntz").alias("order_date")) \
        .write.parquet(path)
    df = spark.read.parquet(path)
    sel = df.filter(in_window(F.col("order_date"), "2024-01-01", "2024-01-31"))
    assert sorted(r.id for r in sel.collect()) == ["a", "b"]
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "order_date" in plan.split("PushedFilters")[1][:300]
