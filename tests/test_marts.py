"""Marts and windows: the skew-safe rank against a plain window, KPI edge cases, shares, A9."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import marts as M


def test_rank_within_matches_window_on_skewed_groups(spark):
    # one group holds most rows, ties on the ordering key, a null group and a null key
    data = [("hot", float(i % 37)) for i in range(3000)] + [("cold", float(i)) for i in range(5)]
    data += [(None, 5.0), (None, 5.0), (None, 1.0), ("cold", None)]
    df = spark.createDataFrame(data, "g string, v double").withColumn("id", F.monotonically_increasing_id())
    got = M.rank_within(df, "g", F.col("v"), "r", "rmax", partitions=7)
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    expected = (df.withColumn("r", F.rank().over(w))
                .withColumn("rmax", F.max("r").over(Window.partitionBy("g"))))
    a = sorted((r.id, r.r, r.rmax) for r in got.select("id", "r", "rmax").collect())
    b = sorted((r.id, r.r, r.rmax) for r in expected.select("id", "r", "rmax").collect())
    assert a == b


JOINED = ("customer_segment string, customer_id string, delivery_time_minutes double, order_id string, "
          "order_total double, is_delayed boolean, is_premium boolean, payment_method string, "
          "distance_km double, delay_category string, delivery_status string, delivery_efficiency double")


def _joined(spark, rows):
    return spark.createDataFrame(rows, JOINED)


def test_kpi_summary_counts_null_as_a_value_and_handles_empty(spark):
    rows = [("Premium", "c1", 10.0, "o1", 100.0, False, True, "Cash", 1.0, "On Time", "On Time", 1.0),
            ("Premium", "c1", 20.0, "o2", 50.0, True, True, "Cash", 2.0, "Slight Delay", "Delayed", 1.0),
            (None, "c2", None, "o3", 30.0, None, None, "Card", None, None, "Delayed", None),
            ("New", None, 5.0, "o4", None, False, False, "Card", 1.0, "On Time", "On Time", 5.0)]
    kpi = {r.metric: r.value for r in M.kpi_summary(_joined(spark, rows)).collect()}
    assert kpi["Total Orders"] == 4.0
    assert kpi["Total Revenue"] == 180.0
    assert kpi["Unique Customers"] == 3.0          # c1, c2 and null
    assert kpi["Total Segments"] == 3.0            # Premium, New and null
    assert kpi["Premium Customers"] == 1.0
    assert kpi["On-time Delivery Rate (%)"] == 50.0  # null flag is not on time; denominator is all rows
    empty = {r.metric: r.value for r in M.kpi_summary(_joined(spark, [])).collect()}
    assert empty["Total Orders"] == 0.0 and empty["Avg Order Value"] is None
    assert empty["On-time Delivery Rate (%)"] is None


def test_shares_sum_to_100_and_conditional_counts(spark):
    rows = [(None, f"c{i % 3}", 1.0, f"o{i}", 10.0, [True, False, None][i % 3], False,
             ["Cash", "Card", "Upi"][i % 3], 1.0, "On Time", "On Time", 1.0) for i in range(10)]
    pay = M.payment_analysis(_joined(spark, rows)).collect()
    assert abs(sum(r.percentage_of_orders for r in pay) - 100.0) < 0.05
    seg = M.segment_analysis(_joined(spark, rows)).first()
    assert seg.delayed_orders + seg.on_time_orders < seg.total_orders   # null flags counted in neither
    assert seg.total_orders == 10 and seg.unique_customers == 3


def test_monthly_growth(spark):
    monthly = spark.createDataFrame([(2020, "2020-01", 100.0), (2020, "2020-02", 150.0), (2020, "2020-03", 75.0)],
                                    "order_year int, order_month string, total_revenue double")
    got = [r.monthly_growth_rate for r in M.monthly_growth(monthly).orderBy("order_month").collect()]
    assert got == [None, 50.0, -50.0]


def test_join_keeps_every_order(spark):
    orders = spark.createDataFrame([("o1", "c1", 1.0), ("o2", "c9", 2.0), ("o3", None, 3.0)],
                                   "order_id string, customer_id string, order_total double")
    for c in ["order_date timestamp_ntz", "delivery_status string", "payment_method string",
              "order_month string", "order_year int"]:
        name, typ = c.split()
        orders = orders.withColumn(name, F.lit(None).cast(typ))
    customers = spark.createDataFrame([("c1", "Premium", "Ann", 3, 1.0, True)],
                                      "customer_id string, customer_segment string, customer_name string, "
                                      "total_orders int, avg_order_value double, is_premium boolean")
    delivery = spark.createDataFrame([("o1", 5.0, 1.0, True, "Slight Delay", 5.0)],
                                     "order_id string, delivery_time_minutes double, distance_km double, "
                                     "is_delayed boolean, delay_category string, delivery_efficiency double")
    joined = M.join_orders(orders, customers, delivery)
    assert joined.count() == 3 and len(joined.columns) == 18
    row = joined.filter("order_id = 'o1'").first()
    assert row.customer_segment == "Premium" and row.is_delayed is True


def test_marts_count_customers_beside_the_sums(spark):
    """Sums are grouped by the mart's key alone: a distinct count in the same aggregation would carry them by customer."""
    schema = JOINED + ", order_year int, order_month string"
    rows = [("New", [None, "c1", "c2"][i % 3], 1.0, f"o{i}", 10.0, False, False, "Cash", 1.0, "On Time", "On Time", 1.0, 2024, "2024-01")
            for i in range(9)]
    df = spark.createDataFrame(rows, schema)
    for fn, name in ((M.segment_analysis, "unique_customers"), (M.monthly_performance, "unique_customers"),
                     (M.delivery_analysis, "affected_customers"), (M.payment_analysis, "unique_customers")):
        mart = fn(df)
        assert mart.first()[name] == 2
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "partial_count(distinct" not in plan and "count(distinct" not in plan, plan
