"""Counts, minima and maxima answered by the footers of Parquet files.

Spark answers such aggregates from the row-group statistics where its Parquet reader is told to; no column is read,
so a report over a stored table costs a listing and a footer a file. The setting is made in a session of its own:
it changes the reader, and the caller's plans stay as they are.

Rows are counted whatever the columns hold. Minima and maxima need statistics in every row group; a column that is null
throughout one has none, and ``measured`` then scans the table instead. An empty table counts 0 and has null limits.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"
_INHERITED = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions")


def read(spark: SparkSession, path: str) -> DataFrame:
    """A scan of Parquet files whose plain aggregates come from the footers: ``count(*)``, ``count(column)``, and
    ``min`` or ``max`` of numbers, dates and booleans, over all rows or by partition columns.

    Other aggregates over it are right too, but read columns."""
    own = spark.newSession()
    for name in _INHERITED:
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set(_PUSHDOWN, "true")
    return own.read.parquet(path)


def measured(spark: SparkSession, path: str, measures: Sequence[Column]) -> Row:
    """The one row of table-wide ``measures``: from the footers, or by a scan where their statistics don't do.

    Files without any row have no statistics, and their counts come out as null: an empty table is scanned."""
    rows = F.count(F.lit(1)).alias("__rows")
    try:
        row = read(spark, path).agg(*measures, rows).first()
        if row["__rows"]:
            return row
    except (PySparkException, Py4JJavaError) as exc:
        if _PUSHDOWN not in str(exc):
            raise
    return spark.read.parquet(path).agg(*measures, rows).first()


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a stored table."""
    return measured(spark, path, [])["__rows"]


def column_counts(spark: SparkSession, path: str, partitioned_by: Sequence[str] = ()) -> tuple[int, dict[str, int]]:
    """(rows, non-null values of each column) of a stored table, nested columns left out.

    Values of partition columns are in no file: rows are counted by them, and added up."""
    stored = read(spark, path)
    flat = [f.name for f in stored.schema.fields
            if f.name not in partitioned_by and f.dataType.simpleString().partition("<")[0] not in ("array", "map", "struct", "variant")]
    counts = [F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"__c{i}") for i, c in enumerate(flat)]]
    groups = stored.groupBy(*[F.col(f"`{c}`") for c in partitioned_by]).agg(*counts)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    of_partitions = [total(F.when(F.col(f"`{c}`").isNotNull(), F.col("__rows"))).alias(f"__p{i}") for i, c in enumerate(partitioned_by)]
    row = groups.agg(total("__rows").alias("__rows"), *[total(f"__c{i}").alias(f"__c{i}") for i in range(len(flat))], *of_partitions).first()
    found = {c: row[f"__c{i}"] for i, c in enumerate(flat)} | {c: row[f"__p{i}"] for i, c in enumerate(partitioned_by)}
    return row["__rows"], found
