"""Dirty raw tables derived from the driver tables (see FIXTURES.md).

The driver tables have clean keys and no nulls, so quality rules would never fire on them. These views
map them onto the three raw schemas and inject nulls, duplicates, malformed strings and out-of-range values
at fixed key residues. Every view is a pure projection/union over a whole driver table (plus one small
per-customer aggregate), so it scales with the input like any other scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _minutes(ts: Column, n: Column | int) -> Column:
    return F.timestamp_add("minute", n if isinstance(n, Column) else F.lit(n), ts)


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, None).otherwise(value)


def _status(k: Column) -> Column:
    # --- fixed values: k % 7 -> raw delivery status (0 -> null) ---
    r = k % 7
    return (F.when(r == 1, "DELAYED").when(r == 2, "delayed").when(r == 3, "slightly delayed")
            .when(r >= 4, "on time"))


def _order_time(k: Column) -> Column:
    return _minutes(F.col("o_orderdate"), (k % 1440).cast("int"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under the raw orders schema, with 60 duplicate rows and injected defects (sf0.01)."""
    orders = _table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = orders.unionByName(orders.filter(k % 500 == 7))
    d = _order_time(k)
    promised = (F.when(k % 97 == 0, _null("timestamp_ntz"))
                .when(k % 89 == 0, _minutes(d, -15))
                .otherwise(_minutes(d, (10 + k % 30).cast("int"))))
    actual = _null_if((k % 53 == 0) | promised.isNull(), _minutes(promised, ((k * 7) % 41 - 10).cast("int")))
    prio = F.col("o_orderpriority")
    # --- fixed values: order priority -> raw payment method ('4-NOT SPECIFIED' -> null) ---
    payment = (F.when(prio == "1-URGENT", "cash").when(prio == "2-HIGH", "CARD")
               .when(prio == "3-MEDIUM", "upi").when(prio == "5-LOW", "wallet"))
    return rows.select(
        _null_if(k % 611 == 0, k.cast("string")).alias("order_id"),
        _null_if(k % 401 == 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        _null_if(k % 307 == 0, d).alias("order_date"),
        promised.alias("promised_delivery_time"),
        actual.alias("actual_delivery_time"),
        _status(k).alias("delivery_status"),
        F.when(k % 173 == 0, None).when(k % 73 == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice")).alias("order_total"),
        payment.alias("payment_method"),
        F.concat(F.lit("DP"), (k % 50).cast("string")).alias("delivery_partner_id"),
        F.when(k % 127 == 0, "S-X").otherwise((k % 20).cast("string")).alias("store_id"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with nation and order count, under the raw customers schema, with defects."""
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    order_counts = (_table(spark, sf_dir, "orders").groupBy("o_custkey")
                    .agg(F.count(F.lit(1)).alias("n_orders")))
    base = (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .join(order_counts, customer.c_custkey == order_counts.o_custkey, "left"))
    k = F.col("c_custkey")
    rows = base.unionByName(base.filter(k % 300 == 11))
    seg = F.col("c_mktsegment")
    # --- fixed values: market segment -> raw customer segment (MACHINERY -> null), 'vip' first ---
    segment = (F.when(k % 113 == 0, "vip").when(seg == "AUTOMOBILE", "premium")
               .when(seg == "BUILDING", "REGULAR").when(seg == "FURNITURE", "new")
               .when(seg == "HOUSEHOLD", "Inactive"))
    return rows.select(
        _null_if(k % 499 == 0, k.cast("string")).alias("customer_id"),
        _null_if(k % 211 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("customer_name"),
        F.when(k % 83 == 0, _null("string")).when(k % 61 == 0, "bad.email")
        .when(k % 59 == 0, "shared@example.com")
        .otherwise(F.concat(F.lit(" User"), k.cast("string"), F.lit("@Example.COM "))).alias("email"),
        F.when(k % 71 == 0, _null("string")).when(k % 67 == 0, "12-34")
        .otherwise(F.concat(F.lit("+91 98"), (k + 10000000).cast("string"))).alias("phone"),
        F.concat(F.lit(" "), k.cast("string"), F.lit(" Main St ")).alias("address"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("area"),
        F.when(k % 101 == 0, "99").when(k % 103 == 0, "N/A")
        .otherwise((100000 + (k * 37) % 900000).cast("string")).alias("pincode"),
        _null_if(k % 109 == 0, F.date_add(F.lit("2019-01-01").cast("date"), (k % 1500).cast("int")))
        .alias("registration_date"),
        segment.alias("customer_segment"),
        F.col("n_orders").cast("int").alias("total_orders"),
        _null_if(k % 79 == 0, F.col("c_acctbal")).alias("avg_order_value"),
    )


def raw_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery records for orders with k % 31 != 0 (so the order join has misses), with defects."""
    orders = _table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kept = orders.filter(k % 31 != 0)
    rows = kept.unionByName(kept.filter(k % 700 == 13))
    d = _order_time(k)
    offset = (k * 7) % 400 - 70
    return rows.select(
        _null_if(k % 613 == 0, k.cast("string")).alias("order_id"),
        F.concat(F.lit("DP"), (k % 50).cast("string")).alias("delivery_partner_id"),
        d.alias("promised_time"),
        _minutes(d, offset.cast("int")).alias("actual_time"),
        _null_if(k % 47 == 0, offset.cast("double")).alias("delivery_time_minutes"),
        _null_if(k % 43 == 0, ((k * 13) % 600).cast("double") / 10.0).alias("distance_km"),
        _status(k).alias("delivery_status"),
        _null_if(k % 3 == 0, F.lit(" Traffic ")).alias("reasons_if_delayed"),
    )


def freshness_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events stream table, used as is for the freshness rule."""
    return _table(spark, sf_dir, "events")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": raw_orders(spark, sf_dir),
        "customers": raw_customers(spark, sf_dir),
        "delivery_performance": raw_delivery(spark, sf_dir),
    }
