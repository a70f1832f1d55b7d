"""Mergeable state of the marts: partial aggregates by month, from which every mart is finished (S11 with A1-A6).

Two tables hold all that the six marts need of the joined orders, each by month so that a run replaces the months it
touches and leaves the rest:

* the cube: counts and exact sums by segment, delay category, delivery status and payment method. Its size depends
  on these few values and the months, not on the orders;
* the customer groups: the same by customer too. Its rows are the key sets of the exact distinct counts (a customer
  is counted once over all months) and the customers of the ranking.

Sums are DECIMAL(38,2) and counts are long, so merged results equal those of one aggregation bit by bit. Averages are
finished from sums and counts. A mart reads the state alone, never the joined table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.marts import with_distinct

MONTH = "order_month"
GROUPS = ["order_year", "customer_segment", "delay_category", "delivery_status", "payment_method"]
CUSTOMER = ["customer_id", "customer_name", "is_premium"]
MEASURES = ("order_total", "delivery_time_minutes", "distance_km", "delivery_efficiency")
CUSTOMER_MEASURES = MEASURES[:2]


def _partials(measures: tuple[str, ...]) -> list[Column]:
    sums = [F.sum(F.col(m).cast("decimal(38,2)")).alias(f"{m}_sum") for m in measures]
    counts = [F.count(m).alias(f"{m}_count") for m in measures]
    return [F.count(F.lit(1)).alias("orders"), *sums, *counts,
            F.count_if(F.col("is_delayed")).alias("delayed"), F.count_if(~F.col("is_delayed")).alias("on_time")]


def cube(joined: DataFrame) -> DataFrame:
    """The cube of joined orders, by month."""
    return joined.groupBy(MONTH, *GROUPS).agg(*_partials(MEASURES))


def customer_groups(joined: DataFrame) -> DataFrame:
    """The customer groups of joined orders, by month."""
    return joined.groupBy(MONTH, *CUSTOMER, *GROUPS).agg(*_partials(CUSTOMER_MEASURES))


STATES: dict[str, Callable[[DataFrame], DataFrame]] = {"mart_cube": cube, "mart_customer_groups": customer_groups}


# --- merging ----------------------------------------------------------------------------------------------


def _total(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(38,2)")).cast("double")


def _count(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("long"))


def _avg(c: str) -> Column:
    return F.try_divide(_total(f"{c}_sum"), _count(f"{c}_count").cast("double"))


def _delayed() -> tuple[Column, Column]:
    return _count("delayed").alias("delayed_orders"), _count("on_time").alias("on_time_orders")


def segment_analysis(cube: DataFrame, groups: DataFrame) -> DataFrame:
    """A1 from state."""
    delayed, on_time = _delayed()
    key = ["customer_segment"]
    merged = cube.groupBy(*key).agg(
        _count("orders").alias("total_orders"), _avg("order_total").alias("avg_order_value"), _total("order_total_sum").alias("total_revenue"),
        _avg("delivery_time_minutes").alias("avg_delivery_time"), delayed, on_time, _avg("distance_km").alias("avg_delivery_distance"))
    merged = with_distinct(merged, groups, key, "customer_id", "unique_customers")
    merged = with_distinct(merged, cube, key, "payment_method", "payment_methods_used")
    return merged.select(
        "customer_segment", "total_orders", "unique_customers", "avg_order_value", "total_revenue", "avg_delivery_time",
        "delayed_orders", "on_time_orders", "avg_delivery_distance", "payment_methods_used",
        marts._pct("on_time_orders", "total_orders").alias("delivery_success_rate"),
        F.round(F.try_divide(F.col("total_orders"), F.col("unique_customers")), 2).alias("avg_orders_per_customer"))


def monthly_performance(cube: DataFrame, groups: DataFrame) -> DataFrame:
    """A2 from state."""
    delayed, on_time = _delayed()
    key = ["order_year", MONTH]
    merged = cube.groupBy(*key).agg(
        _count("orders").alias("total_orders"), _total("order_total_sum").alias("total_revenue"), _avg("order_total").alias("avg_order_value"),
        _avg("delivery_time_minutes").alias("avg_delivery_time"), delayed, on_time, _avg("distance_km").alias("avg_delivery_distance"))
    merged = with_distinct(merged, groups, key, "customer_id", "unique_customers")
    merged = with_distinct(merged, cube, key, "customer_segment", "segments_served")
    return merged.select(
        *key, "total_orders", "unique_customers", "total_revenue", "avg_order_value", "avg_delivery_time", "delayed_orders",
        "on_time_orders", "avg_delivery_distance", "segments_served",
        marts._pct("on_time_orders", "total_orders").alias("delivery_success_rate"),
        F.lit(None).cast("double").alias("monthly_growth_rate")).orderBy(*key)


def delivery_analysis(cube: DataFrame, groups: DataFrame) -> DataFrame:
    """A3 from state."""
    key = ["delay_category", "delivery_status"]
    merged = cube.groupBy(*key).agg(
        _count("orders").alias("order_count"), _avg("delivery_time_minutes").alias("avg_delivery_time"),
        _avg("distance_km").alias("avg_distance"), _avg("delivery_efficiency").alias("avg_efficiency"),
        _total("order_total_sum").alias("total_revenue"))
    merged = with_distinct(merged, groups, key, "customer_id", "affected_customers")
    return marts._share_of_total(merged, "order_count").withColumn(
        "avg_order_value", F.round(F.try_divide(F.col("total_revenue"), F.col("order_count")), 2))


def customer_ranking(cube: DataFrame, groups: DataFrame) -> DataFrame:
    """A4 from state."""
    delayed, on_time = _delayed()
    merged = groups.groupBy("customer_id", "customer_name", "customer_segment", "is_premium").agg(
        _count("orders").alias("order_count"), _total("order_total_sum").alias("total_revenue"), _avg("order_total").alias("avg_order_value"),
        _avg("delivery_time_minutes").alias("avg_delivery_time"), delayed, on_time)
    return marts.ranked_customers(merged.withColumn("delivery_success_rate", marts._pct("on_time_orders", "order_count")))


def payment_analysis(cube: DataFrame, groups: DataFrame) -> DataFrame:
    """A5 from state."""
    delayed, on_time = _delayed()
    merged = cube.groupBy("payment_method").agg(
        _count("orders").alias("order_count"), _total("order_total_sum").alias("total_revenue"), _avg("order_total").alias("avg_order_value"),
        _avg("delivery_time_minutes").alias("avg_delivery_time"), delayed, on_time)
    merged = with_distinct(merged, groups, ["payment_method"], "customer_id", "unique_customers").withColumn(
        "delivery_success_rate", marts._pct("on_time_orders", "order_count"))
    return marts._share_of_total(merged, "order_count")


def kpi_summary(cube: DataFrame, groups: DataFrame) -> DataFrame:
    """A6 from state: totals, customers (a missing id counts as one) and segments, three 1-row aggregates."""
    totals = cube.agg(
        _count("orders").alias("m0"), _total("order_total_sum").alias("m1"), _avg("order_total").alias("m3"),
        _avg("delivery_time_minutes").alias("m4"), (F.try_divide(_count("on_time"), _count("orders")) * 100).alias("m5"))
    customers = groups.groupBy("customer_id").agg(F.coalesce(F.bool_or("is_premium"), F.lit(False)).alias("premium")).agg(
        F.count(F.lit(1)).alias("m2"), F.count_if("premium").alias("m6"))
    segments = cube.select("customer_segment").distinct().agg(F.count(F.lit(1)).alias("m7"))
    return marts.kpi_rows(totals.crossJoin(F.broadcast(customers)).crossJoin(F.broadcast(segments)))


MARTS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "customer_segment_analysis": segment_analysis,
    "monthly_performance": monthly_performance,
    "delivery_analysis": delivery_analysis,
    "customer_ranking": customer_ranking,
    "payment_analysis": payment_analysis,
    "kpi_summary": kpi_summary,
}


def all_marts(cube: DataFrame, groups: DataFrame) -> dict[str, DataFrame]:
    """The six marts over the state of the joined orders."""
    return {name: fn(cube, groups) for name, fn in MARTS.items()}
