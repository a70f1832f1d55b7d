"""Catalog-level reports as DataFrames: row counts (S6), previews (S7), schema docs (S8), metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.session import run_concurrently
from tidemark.sources import footers
from tidemark.sources.sinks import is_path, read_table

ROW_COUNT_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("row_count", LongType(), True),
    StructField("error", StringType(), True),
])


def table_row_counts(spark: SparkSession, tables: Mapping[str, str | DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count, error).

    Tables are counted by overlapping jobs, those on a path from their footers; a table that cannot be resolved or
    read yields a row with its whole error instead of failing the report.
    """

    def count(name: str, source: str | DataFrame) -> tuple[str, int | None, str | None]:
        try:
            if isinstance(source, str) and is_path(source):
                return name, footers.row_count(spark, source), None
            df = read_table(spark, source) if isinstance(source, str) else source
            return name, df.count(), None
        except Exception as exc:  # reported in the row
            return name, None, f"{type(exc).__name__}: {exc}"

    rows = run_concurrently([lambda n=n, s=s: count(n, s) for n, s in tables.items()])
    return spark.createDataFrame(rows, ROW_COUNT_SCHEMA)


def list_tables(spark: SparkSession, namespace: str) -> dict[str, str]:
    """Table name -> target of every table of a namespace: a catalog schema, or a folder of table folders."""
    if "/" not in namespace:
        return {t.name: f"{namespace}.{t.name}" for t in spark.catalog.listTables(namespace) if not t.isTemporary}
    base = spark._jvm.org.apache.hadoop.fs.Path(namespace)
    listed = base.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(base)
    names = sorted(s.getPath().getName() for s in listed if s.isDirectory())
    return {n: f"{namespace.rstrip('/')}/{n}" for n in names if n[0] not in "._"}


def namespace_row_counts(spark: SparkSession, namespace: str) -> DataFrame:
    """``table_row_counts`` of every table of a namespace."""
    return table_row_counts(spark, list_tables(spark, namespace))


def preview(df: DataFrame, columns: list[str], order_by: list[str], n: int = 5) -> DataFrame:
    """Ordered ``LIMIT n`` of the projected columns (S7); Spark plans it as a TakeOrdered (top-n per task)."""
    return df.select(*columns).orderBy(*order_by).limit(n)


SCHEMA_DOC_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("position", IntegerType(), False),
    StructField("column_name", StringType(), False),
    StructField("data_type", StringType(), False),
    StructField("nullable", BooleanType(), False),
])


def schema_doc(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nullable) from each table's schema (S8); reads no data."""
    rows = [(name, i, f.name, f.dataType.simpleString(), f.nullable)
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, SCHEMA_DOC_SCHEMA)


COLUMN_REPORT_SCHEMA = StructType([
    *SCHEMA_DOC_SCHEMA.fields,
    StructField("row_count", LongType(), False),
    StructField("non_null_count", LongType(), True),
])


def column_report(spark: SparkSession, tables: Mapping[str, str], partitioned_by: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Schema docs (S8) of tables on paths with the rows and non-null values of each column, counted from the footers
    (nested columns: null). ``partitioned_by`` names the partition columns of the tables that have some."""
    by = partitioned_by or {}

    def report(name: str, path: str) -> list[tuple]:
        rows, found = footers.column_counts(spark, path, by.get(name, ()))
        doc = schema_doc(spark, {name: spark.read.parquet(path)}).collect()
        return [(*r, rows, found.get(r["column_name"])) for r in doc]

    done = run_concurrently([lambda n=n, p=p: report(n, p) for n, p in tables.items()])
    return spark.createDataFrame([r for rows in done for r in rows], COLUMN_REPORT_SCHEMA)


# --- fixed values: published tables, their descriptions and categories -----------------------------
TABLE_METADATA = [
    ("analytics_main", "Main analytical table with all order, customer, and delivery data joined", "Analytical"),
    ("customer_segment_analysis", "Aggregated metrics by customer segment", "Summary"),
    ("monthly_performance", "Monthly performance metrics and trends", "Time Series"),
    ("delivery_analysis", "Delivery performance analysis by delay categories", "Performance"),
    ("customer_ranking", "Customer ranking and performance within segments", "Ranking"),
    ("payment_analysis", "Payment method usage and performance analysis", "Payment"),
    ("kpi_summary", "Key performance indicators summary", "KPI"),
]

TABLE_METADATA_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("description", StringType(), False),
    StructField("category", StringType(), False),
])


def table_metadata(spark: SparkSession) -> DataFrame:
    """The static description of the published tables."""
    return spark.createDataFrame(TABLE_METADATA, TABLE_METADATA_SCHEMA)
