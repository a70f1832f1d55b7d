"""The joined order table (J1) and the analytic marts over it.

Every mart is one ``groupBy().agg()`` (partial aggregation before the shuffle) over the joined table,
which the pipeline materialises once. Shares of the grand total join a 1-row aggregate (a bounded
broadcast) instead of an unpartitioned window. The in-segment customer rank is computed without ever
gathering a segment into one task: see ``rank_within``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import (
    estimated_row_bytes,
    fits_broadcast,
    materialize,
    materialize_observed,
)

# --- fixed values: the joined table's columns (source alias, column, output name) -------------------
JOINED_COLUMNS = (
    ("c", "customer_segment", "customer_segment"),
    ("o", "customer_id", "customer_id"),
    ("d", "delivery_time_minutes", "delivery_time_minutes"),
    ("o", "order_id", "order_id"),
    ("o", "order_total", "order_total"),
    ("o", "order_date", "order_date"),
    ("o", "delivery_status", "delivery_status"),
    ("o", "payment_method", "payment_method"),
    ("c", "customer_name", "customer_name"),
    ("c", "total_orders", "customer_total_orders"),
    ("c", "avg_order_value", "customer_avg_order_value"),
    ("c", "is_premium", "is_premium"),
    ("d", "distance_km", "distance_km"),
    ("d", "is_delayed", "is_delayed"),
    ("d", "delay_category", "delay_category"),
    ("d", "delivery_efficiency", "delivery_efficiency"),
    ("o", "order_month", "order_month"),
    ("o", "order_year", "order_year"),
)

# --- fixed values: KPI metric labels, in report order ----------------------------------------------
KPI_METRICS = (
    "Total Orders",
    "Total Revenue",
    "Unique Customers",
    "Avg Order Value",
    "Avg Delivery Time (minutes)",
    "On-time Delivery Rate (%)",
    "Premium Customers",
    "Total Segments",
)


def side_columns(side: str) -> list[str]:
    """Columns the join reads from one side ("o", "c" or "d")."""
    return sorted({col for s, col, _ in JOINED_COLUMNS if s == side})


def join_orders(orders: DataFrame, customers: DataFrame, delivery: DataFrame,
                broadcast_customers: bool | None = None) -> DataFrame:
    """Orders left-joined to customers (on customer_id) and delivery (on order_id), 18 columns.

    Both right sides are unique on their key after the error-level uniqueness rules, so the row count is
    the order count. The two large tables (orders, delivery) are joined first on order_id; the customer
    side is joined next, broadcast only when the caller has measured it (``broadcast_customers=True``),
    otherwise planned by AQE from runtime statistics.
    """
    wanted = {"o": set(), "c": set(), "d": set()}
    for side, col, _ in JOINED_COLUMNS:
        wanted[side].add(col)
    o = orders.select(*sorted(wanted["o"])).alias("o")
    d = delivery.select("order_id", *sorted(wanted["d"])).withColumnRenamed("order_id", "_d_order_id").alias("d")
    c = customers.select("customer_id", *sorted(wanted["c"])).withColumnRenamed("customer_id", "_c_customer_id")
    if broadcast_customers:
        c = F.broadcast(c)
    c = c.alias("c")
    joined = (o.join(d, F.col("o.order_id") == F.col("d._d_order_id"), "left")
              .join(c, F.col("o.customer_id") == F.col("c._c_customer_id"), "left"))
    return joined.select(*[F.col(f"{side}.{col}").alias(out) for side, col, out in JOINED_COLUMNS])


def money_sum(c: str) -> Column:
    """Exact sum of a 2-decimal measure, added as DECIMAL(38,2): the result does not depend on the order in
    which partial sums are combined, and does not overflow below 1e36. Every measure of the joined table is
    finite and rounded to 2 decimals by cleaning, so nothing is lost."""
    return F.sum(F.col(c).cast("decimal(38,2)")).cast("double")


def money_avg(c: str) -> Column:
    """Exact sum of a 2-decimal measure over its count; null when no value is present, like ``avg``."""
    return F.try_divide(money_sum(c), F.count(c).cast("double"))


def _delayed(flag: str = "is_delayed") -> tuple[Column, Column]:
    """(delayed, on_time) counts; a null flag counts in neither."""
    return (F.count_if(F.col(flag)).alias("delayed_orders"),
            F.count_if(~F.col(flag)).alias("on_time_orders"))


def _pct(num: str, den: str) -> Column:
    return F.round(F.try_divide(F.col(num), F.col(den)) * 100, 2)


def _share_of_total(grouped: DataFrame, count_col: str) -> DataFrame:
    """Count / grand total * 100 via a 1-row total joined to every group (bounded broadcast)."""
    total = grouped.agg(F.sum(count_col).alias("_grand_total"))
    return (grouped.crossJoin(F.broadcast(total))
            .withColumn("percentage_of_orders", _pct(count_col, "_grand_total"))
            .drop("_grand_total"))


def with_distinct(grouped: DataFrame, rows: DataFrame, keys: list[str], counted: str, name: str) -> DataFrame:
    """``grouped`` with the exact number of distinct values of a column in each group of ``rows``.

    Values are made distinct before they are counted, in an aggregation of their own over two or three columns.
    Several distinct counts in one aggregation would copy every row once for each of them.
    """
    values = rows.where(F.col(counted).isNotNull()).select(*keys, counted).distinct()
    counts = values.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.count(F.lit(1)).alias(name))
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        cond = c if cond is None else cond & c
    return (grouped.join(counts, cond, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
            .drop(*[f"_of_{k}" for k in keys]))


def segment_analysis(joined: DataFrame) -> DataFrame:
    """A1: by customer_segment."""
    delayed, on_time = _delayed()
    grouped = (joined.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_avg("order_total").alias("avg_order_value"),
        money_sum("order_total").alias("total_revenue"),
        money_avg("delivery_time_minutes").alias("avg_delivery_time"),
        delayed, on_time,
        money_avg("distance_km").alias("avg_delivery_distance"),
    ))
    grouped = with_distinct(grouped, joined, ["customer_segment"], "customer_id", "unique_customers")
    grouped = with_distinct(grouped, joined, ["customer_segment"], "payment_method", "payment_methods_used")
    return grouped.select(
        "customer_segment", "total_orders", "unique_customers", "avg_order_value", "total_revenue", "avg_delivery_time",
        "delayed_orders", "on_time_orders", "avg_delivery_distance", "payment_methods_used",
        _pct("on_time_orders", "total_orders").alias("delivery_success_rate"),
        F.round(F.try_divide(F.col("total_orders"), F.col("unique_customers")), 2).alias("avg_orders_per_customer"))


def monthly_performance(joined: DataFrame) -> DataFrame:
    """A2: by (order_year, order_month), sorted. ``monthly_growth_rate`` is kept as a typed null column;
    ``monthly_growth`` computes the real month-over-month figure."""
    delayed, on_time = _delayed()
    grouped = (joined.groupBy("order_year", "order_month").agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum("order_total").alias("total_revenue"),
        money_avg("order_total").alias("avg_order_value"),
        money_avg("delivery_time_minutes").alias("avg_delivery_time"),
        delayed, on_time,
        money_avg("distance_km").alias("avg_delivery_distance"),
    ))
    keys = ["order_year", "order_month"]
    grouped = with_distinct(grouped, joined, keys, "customer_id", "unique_customers")
    grouped = with_distinct(grouped, joined, keys, "customer_segment", "segments_served")
    return grouped.select(
        *keys, "total_orders", "unique_customers", "total_revenue", "avg_order_value", "avg_delivery_time", "delayed_orders",
        "on_time_orders", "avg_delivery_distance", "segments_served",
        _pct("on_time_orders", "total_orders").alias("delivery_success_rate"),
        F.lit(None).cast("double").alias("monthly_growth_rate")).orderBy(*keys)


def monthly_growth(monthly: DataFrame) -> DataFrame:
    """Revenue growth % against the previous month present in the data.

    The window has no partition key, but it runs over the monthly aggregate (one row per month), whose
    size is bounded by the calendar span, not by the data volume.
    """
    w = Window.orderBy(F.col("order_year").asc_nulls_first(), F.col("order_month").asc_nulls_first())
    prev = F.lag("total_revenue").over(w)
    return monthly.select(
        "order_year", "order_month", "total_revenue",
        prev.alias("previous_revenue"),
        F.round(F.try_divide(F.col("total_revenue") - prev, prev) * 100, 2).alias("monthly_growth_rate"),
    )


def delivery_analysis(joined: DataFrame) -> DataFrame:
    """A3: by (delay_category, delivery_status), with share of all orders."""
    grouped = joined.groupBy("delay_category", "delivery_status").agg(
        F.count(F.lit(1)).alias("order_count"),
        money_avg("delivery_time_minutes").alias("avg_delivery_time"),
        money_avg("distance_km").alias("avg_distance"),
        money_avg("delivery_efficiency").alias("avg_efficiency"),
        money_sum("order_total").alias("total_revenue"),
    )
    grouped = with_distinct(grouped, joined, ["delay_category", "delivery_status"], "customer_id", "affected_customers")
    return (_share_of_total(grouped, "order_count")
            .withColumn("avg_order_value", F.round(F.try_divide(F.col("total_revenue"), F.col("order_count")), 2)))


def rank_within(df: DataFrame, group: str, order_key: Column, rank_col: str, max_col: str,
                partitions: int | None = None, broadcast_rows: int = 2_000_000) -> DataFrame:
    """``rank()`` of ``order_key`` (descending, nulls last) within ``group``, and the group's
    largest rank.

    A plain ``Window.partitionBy(group)`` sends each group to one task, so a group holding a third of the
    rows would be sorted by a single task. Instead:

    1. range-partition on (group, key desc): sampled bounds balance the ranges even when one group
       dominates, and equal (group, key) pairs always land in the same range, so ties never straddle two;
    2. rank within (range, group) - a shuffle on (range id, group) that spreads a hot group over all
       ranges; the result is written once to the shared folder, which pins the range ids;
    3. per (range, group): row count and last local rank - at most ranges + groups rows, written and
       counted, then broadcast when within ``broadcast_rows``;
    4. offset = rows of the same group in earlier ranges; rank = offset + local rank; the group's largest
       rank is the maximum of (offset + last local rank) over its ranges.

    Ties of one key share a range: rows with equal keys, such as all null revenues, are ranked alike by a
    running count and need no order among themselves.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.withColumn("_rk_key", order_key)
              .repartitionByRange(n, F.col(group).asc_nulls_first(), F.col("_rk_key").desc_nulls_last())
              .withColumn("_rk_part", F.spark_partition_id()))
    local = materialize(ranged.withColumn(
        "_rk_local",
        F.rank().over(Window.partitionBy("_rk_part", group).orderBy(F.col("_rk_key").desc_nulls_last()))),
        "rank-local")
    stats = local.groupBy("_rk_part", group).agg(F.count(F.lit(1)).alias("_rk_n"),
                                                  F.max("_rk_local").alias("_rk_last"))
    before = Window.partitionBy(group).orderBy("_rk_part").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_rk_offset", F.coalesce(F.sum("_rk_n").over(before), F.lit(0)))
    stats = stats.withColumn(max_col, F.max(F.col("_rk_offset") + F.col("_rk_last")).over(Window.partitionBy(group)))
    stats = stats.select(F.col("_rk_part").alias("_rk_part_s"), F.col(group).alias("_rk_group_s"),
                         "_rk_offset", F.col(max_col).cast("int"))
    stats, m = materialize_observed(stats, "rank-stats", rows=F.count(F.lit(1)),
                                    bytes=F.coalesce(F.sum(estimated_row_bytes(stats)), F.lit(0)))
    if fits_broadcast(spark, m["rows"], m["bytes"], broadcast_rows):
        stats = F.broadcast(stats)
    joined = local.join(stats, (F.col("_rk_part") == F.col("_rk_part_s"))
                        & F.col(group).eqNullSafe(F.col("_rk_group_s")), "inner")
    return (joined.withColumn(rank_col, (F.col("_rk_offset") + F.col("_rk_local")).cast("int"))
            .drop("_rk_key", "_rk_part", "_rk_local", "_rk_part_s", "_rk_group_s", "_rk_offset"))


def customer_ranking(joined: DataFrame, partitions: int | None = None) -> DataFrame:
    """A4: per customer (id, name, segment, premium flag), ranked by revenue within the segment.

    Revenue is ranked at 2 decimals so that equal revenues tie regardless of floating-point summation
    order. ``customer_percentile`` = rank / last rank in segment * 100 (the best customer has the
    lowest value).
    """
    delayed, on_time = _delayed()
    per_customer = joined.groupBy("customer_id", "customer_name", "customer_segment", "is_premium").agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum("order_total").alias("total_revenue"),
        money_avg("order_total").alias("avg_order_value"),
        money_avg("delivery_time_minutes").alias("avg_delivery_time"),
        delayed, on_time,
    ).withColumn("delivery_success_rate", _pct("on_time_orders", "order_count"))
    return ranked_customers(per_customer, partitions)


def ranked_customers(per_customer: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rank and percentile of each customer's revenue within the segment."""
    ranked = rank_within(per_customer, "customer_segment", F.round("total_revenue", 2),
                         "customer_rank_in_segment", "_max_rank", partitions)
    return (ranked.withColumn("customer_percentile", _pct("customer_rank_in_segment", "_max_rank"))
            .drop("_max_rank"))


def payment_analysis(joined: DataFrame) -> DataFrame:
    """A5: by payment_method, with share of all orders."""
    delayed, on_time = _delayed()
    grouped = joined.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum("order_total").alias("total_revenue"),
        money_avg("order_total").alias("avg_order_value"),
        money_avg("delivery_time_minutes").alias("avg_delivery_time"),
        delayed, on_time,
    )
    grouped = with_distinct(grouped, joined, ["payment_method"], "customer_id", "unique_customers").select(
        "payment_method", "order_count", "unique_customers", "total_revenue", "avg_order_value", "avg_delivery_time",
        "delayed_orders", "on_time_orders", _pct("on_time_orders", "order_count").alias("delivery_success_rate"))
    return _share_of_total(grouped, "order_count")


def _distinct_with_null(c: Column) -> Column:
    """Distinct values of ``c`` counting null as one value (like ``select(c).distinct().count()``)."""
    return F.count_distinct(c) + F.coalesce(F.max(F.when(c.isNull(), 1)), F.lit(0))


def kpi_summary(joined: DataFrame) -> DataFrame:
    """Eight (metric, value) rows from a single aggregation pass; empty input gives nulls/zeros."""
    premium_customer = F.when(F.col("is_premium"), F.col("customer_id"))
    premium_null_id = F.when(F.col("is_premium") & F.col("customer_id").isNull(), 1)
    values = joined.agg(
        F.count(F.lit(1)).alias("m0"),
        money_sum("order_total").alias("m1"),
        _distinct_with_null(F.col("customer_id")).alias("m2"),
        money_avg("order_total").alias("m3"),
        money_avg("delivery_time_minutes").alias("m4"),
        (F.try_divide(F.count_if(~F.col("is_delayed")), F.count(F.lit(1))) * 100).alias("m5"),
        (F.count_distinct(premium_customer) + F.coalesce(F.max(premium_null_id), F.lit(0))).alias("m6"),
        _distinct_with_null(F.col("customer_segment")).alias("m7"),
    )
    return kpi_rows(values)


def kpi_rows(values: DataFrame) -> DataFrame:
    """The (metric, value) rows of one row of measures m0, m1, ..."""
    rows = F.array(*[F.struct(F.lit(label).alias("metric"),
                              F.col(f"m{i}").cast("double").alias("value"))
                     for i, label in enumerate(KPI_METRICS)])
    return values.select(F.inline(rows)).select("metric", "value")
