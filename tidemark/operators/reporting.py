"""Quality reporting over annotated tables (Q11-Q14), all as DataFrames.

Counts come from the annotated frame in one pass each: violations are exploded (at most one row per
violated rule per row) and counted by rule name with partial aggregation; the rule catalogue (one row
per rule) is a bounded broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.engine import ERRORS, WARNINGS, Checked
from tidemark.operators.rules import Rule

RULE_CATALOG_SCHEMA = StructType([
    StructField("rule_name", StringType(), False),
    StructField("criticality", StringType(), False),
    StructField("check_function", StringType(), False),
    StructField("test_definition", StringType(), False),
])


def rule_catalog(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: name, criticality, check function and JSON definition."""
    rows = [(r.name, r.criticality, r.check.function, r.definition()) for r in rules]
    return spark.createDataFrame(rows, RULE_CATALOG_SCHEMA)


def violation_counts(annotated: DataFrame) -> DataFrame:
    """(rule_name, failed_records_count) for every rule violated by at least one row."""
    return (annotated.select(F.explode(F.concat(F.col(ERRORS), F.col(WARNINGS))).alias("rule_name"))
            .groupBy("rule_name").agg(F.count(F.lit(1)).alias("failed_records_count")))


def rule_results(checked: Checked) -> DataFrame:
    """Per rule: failed_records_count (0 included), dataset-level outcome and check_status."""
    spark = checked.annotated.sparkSession
    catalog = rule_catalog(spark, checked.rules)
    counts = violation_counts(checked.annotated)
    outcomes = checked.outcomes
    failed = F.coalesce(F.col("failed_records_count"), F.lit(0)).cast("bigint")
    dataset_bad = F.coalesce(F.col("dataset_violated"), F.lit(False))
    return (catalog.join(counts, "rule_name", "left").join(F.broadcast(outcomes), "rule_name", "left")
            .select("rule_name", "criticality", "check_function",
                    failed.alias("failed_records_count"),
                    F.col("observed"),
                    F.when((failed > 0) | dataset_bad, "failed").otherwise("passed").alias("check_status"),
                    "test_definition"))


def rule_log(checked: Checked, run_id: str, valid_table: str | None = None,
             quarantine_table: str | None = None, run_timestamp: Column | None = None) -> DataFrame:
    """Q11: append-ready log rows: run_id, run_timestamp, valid_table, quarantine_table, rule_name,
    criticality, check_status, failed_records_count, observed (dataset-level outcome, if any),
    test_definition."""
    return rule_results(checked).select(
        F.lit(run_id).alias("run_id"),
        (run_timestamp if run_timestamp is not None else F.current_timestamp()).alias("run_timestamp"),
        F.lit(valid_table).cast("string").alias("valid_table"),
        F.lit(quarantine_table).cast("string").alias("quarantine_table"),
        "rule_name", "criticality", "check_status", "failed_records_count", "observed", "test_definition",
    )


def quality_score(annotated: DataFrame, table_name: str, quarantine_on: str = "error") -> DataFrame:
    """Q12: (table_name, total_records, valid_records, quarantined_records, quality_score) in one pass.

    Score = valid / total * 100, 0 for an empty table.
    """
    bad = F.size(ERRORS) > 0
    if quarantine_on == "any":
        bad = bad | (F.size(WARNINGS) > 0)
    return (annotated.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(bad).alias("quarantined_records"))
            .select(F.lit(table_name).alias("table_name"), "total_records",
                    (F.col("total_records") - F.col("quarantined_records")).alias("valid_records"),
                    "quarantined_records")
            .withColumn("quality_score",
                        F.coalesce(F.try_divide(F.col("valid_records"), F.col("total_records")) * 100,
                                   F.lit(0.0))))


def quality_summary(annotated: Mapping[str, DataFrame], quarantine_on: str = "error") -> DataFrame:
    """Q13: one score row per table (a union of one-pass aggregates)."""
    parts = [quality_score(df, name, quarantine_on) for name, df in annotated.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def overall_score(summary: DataFrame) -> DataFrame:
    """Q12: sum(valid) / sum(total) * 100 over the summary rows (0 if no rows)."""
    return summary.agg(
        F.sum("total_records").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
    ).select("total_records", "valid_records",
             F.coalesce(F.try_divide(F.col("valid_records"), F.col("total_records")) * 100, F.lit(0.0))
             .alias("quality_score"))


def quarantine_sample(quarantine: DataFrame, columns: Sequence[str], order_by: Sequence[str],
                      n: int = 3) -> DataFrame:
    """Q14: the first ``n`` quarantined rows by ``order_by`` with their violations (a top-n, not a scan
    of everything to the driver)."""
    return (quarantine.select(*columns, ERRORS, WARNINGS)
            .orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(n))


def quarantine_by_rule(quarantine: DataFrame) -> DataFrame:
    """Q14: quarantined rows per violated error rule."""
    return (quarantine.select(F.explode(ERRORS).alias("rule_name"))
            .groupBy("rule_name").agg(F.count(F.lit(1)).alias("quarantined_records")))
