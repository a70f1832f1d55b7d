"""Aggregates from Parquet footers, and the reports built on them."""

from __future__ import annotations

import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import transforms as T
from tidemark.sources import catalog, footers


@pytest.fixture()
def stored(spark, tmpdir_path):
    n = F.col("id")
    rows = spark.range(100).select(
        "id", F.when(n % 2 == 0, n).alias("even"), F.lit(None).cast("int").alias("none"), F.array("id").alias("list"),
        F.lit("x").alias("odd.name"), F.when(n % 3 != 1, (n % 3).cast("string")).alias("part"))
    path = f"{tmpdir_path}/stored"
    rows.write.partitionBy("part").parquet(path)
    return path


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_and_limits_read_no_column(spark, stored):
    df = footers.read(spark, stored).agg(F.count(F.lit(1)), F.count("even"), F.min("id"), F.max("even"))
    plan = _plan(df)
    assert "PushedAggregation: [COUNT(*), COUNT(even), MIN(id), MAX(even)]" in plan
    assert set(re.search(r"ReadSchema: struct<(.*?)>", plan)[1].split(",")) == {
        "count(*):bigint", "count(even):bigint", "min(id):bigint", "max(even):bigint"}
    assert tuple(df.first()) == (100, 50, 0, 98)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session stays as it is


def test_a_column_without_limits_is_scanned(spark, stored):
    row = footers.measured(spark, stored, [F.max("none").alias("none"), F.max("id").alias("id"), F.count("none").alias("n")])
    assert (row["none"], row["id"], row["n"]) == (None, 99, 0)


def test_other_errors_are_raised(spark, stored, tmpdir_path):
    with pytest.raises(PySparkException):
        footers.measured(spark, stored, [F.max("absent")])
    with pytest.raises(PySparkException):
        footers.row_count(spark, f"{tmpdir_path}/absent")


def test_column_counts_with_partitions(spark, stored):
    assert footers.column_counts(spark, stored, ["part"]) == (
        100, {"id": 100, "even": 50, "none": 0, "odd.name": 100, "part": 67})


def test_empty_tables(spark, tmpdir_path):
    path = f"{tmpdir_path}/empty"
    spark.range(0).write.parquet(path)
    assert footers.row_count(spark, path) == 0
    assert footers.column_counts(spark, path) == (0, {"id": 0})
    assert tuple(footers.measured(spark, path, [F.count("id"), F.max("id")]))[:2] == (0, None)
    assert [tuple(r) for r in catalog.table_row_counts(spark, {"t": path}).collect()] == [("t", 0, None)]


def test_column_report(spark, stored):
    rows = {r["column_name"]: (r["data_type"], r["row_count"], r["non_null_count"])
            for r in catalog.column_report(spark, {"t": stored}, {"t": ["part"]}).collect()}
    assert rows["even"] == ("bigint", 100, 50) and rows["list"] == ("array<bigint>", 100, None)
    assert rows["part"][2] == 67


def test_profile_measures_fit_the_schema(spark, tmpdir_path):
    """The profile of a stored table equals that of its rows."""
    columns = [c for _, c in T.PROFILE_COLUMNS["customers"]]
    rows = spark.createDataFrame([(1, "a", None, "b"), (None, None, None, "b")], ", ".join(f"{c} string" for c in columns))
    path = f"{tmpdir_path}/profiled"
    rows.write.parquet(path)
    measures = T.profile_measures("customers")
    row = footers.measured(spark, path, measures)
    assert tuple(row)[:len(measures)] == tuple(T.completeness_profile(rows, "customers").first()) == (2, 1, 1, 0, 2)
    assert spark.createDataFrame([row[:len(measures)]], T.profile_schema("customers")).count() == 1
