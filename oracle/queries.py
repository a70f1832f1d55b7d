"""DuckDB oracle statements keyed like ``tidemark.plans.queries.queries()``."""

from __future__ import annotations

import re

from oracle.sql import AS_OF, CLEAN_COLUMNS, INCREMENTAL_WINDOW, RULES, build, rnd, srnd  # noqa: F401

DOUBLE_COLUMNS = {
    "orders": {"order_total", "delivery_time_minutes"},
    "customers": {"avg_order_value"},
    "delivery": {"delivery_time_minutes", "distance_km", "delivery_efficiency"},
}
RAW_DOUBLES = {"orders": {"order_total"}, "customers": {"avg_order_value"},
               "delivery": {"delivery_time_minutes", "distance_km"}}
RAW_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_date", "promised_delivery_time", "actual_delivery_time",
               "delivery_status", "order_total", "payment_method", "delivery_partner_id", "store_id"],
    "customers": ["customer_id", "customer_name", "email", "phone", "address", "area", "pincode",
                  "registration_date", "customer_segment", "total_orders", "avg_order_value"],
    "delivery": ["order_id", "delivery_partner_id", "promised_time", "actual_time", "delivery_time_minutes",
                 "distance_km", "delivery_status", "reasons_if_delayed"],
}
PROFILE = {
    "orders": (("non_null_order_ids", "order_id"), ("non_null_customer_ids", "customer_id"),
               ("non_null_order_totals", "order_total"), ("delivery_status_available", "is_on_time")),
    "customers": (("non_null_customer_ids", "customer_id"), ("valid_emails", "email"),
                  ("valid_phones", "phone"), ("segments_available", "customer_segment")),
    "delivery": (("non_null_order_ids", "order_id"), ("delivery_times_available", "delivery_time_minutes"),
                 ("distances_available", "distance_km"), ("delay_status_available", "is_delayed")),
}
TABLE_NAMES = {"orders": "orders", "customers": "customers", "delivery": "delivery_performance"}


def msum(c: str) -> str:
    """Plain decimal sum of a 2-decimal measure."""
    return f"CAST(sum(CAST({c} AS DECIMAL(18, 2))) AS DOUBLE)"


def mavg(c: str) -> str:
    return f"({msum(c)} / nullif(CAST(count({c}) AS DOUBLE), 0))"


def _money(sql: str) -> str:
    sql = re.sub(r"\bavg\(([a-z_]+)\)", lambda m: mavg(m.group(1)), sql)
    return re.sub(r"\bsum\(order_total\)", lambda m: msum("order_total"), sql)


def _select(cols: list[str], doubles: set[str], digits: int = 4) -> str:
    return ", ".join(f"{srnd(c, digits)} AS {c}" if c in doubles else c for c in cols)


def _count(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


def _rule_results(t: str) -> str:
    rows = []
    for name, crit in RULES[t]:
        failed = _count(f"f_{name}")
        dataset = "false"
        if name == "order_data_freshness":
            dataset = "(SELECT COUNT(*) FROM o_fresh_windows WHERE records < 1) > 0"
        if name.startswith("minimum_"):
            dataset = "COUNT(*) < 1"
        rows.append(f"SELECT '{name}' AS rule_name, '{crit}' AS criticality, {failed} AS failed_records_count, "
                    f"CASE WHEN {failed} > 0 OR {dataset} THEN 'failed' ELSE 'passed' END AS check_status "
                    f"FROM {t}_flags")
    deps = (f"{t}_flags",) + (("o_fresh_windows",) if t == "orders" else ())
    return build("\nUNION ALL\n".join(rows), deps)


def _quality(t: str) -> str:
    return (f"SELECT '{TABLE_NAMES[t]}' AS table_name, CAST(COUNT(*) AS BIGINT) AS total_records, "
            f"{_count('NOT is_error')} AS valid_records, {_count('is_error')} AS quarantined_records, "
            f"{srnd(f'coalesce(' + _count('NOT is_error') + ' / nullif(COUNT(*), 0) * 100, 0.0)', 6)} "
            f"AS quality_score FROM {t}_checked")


SEGMENT_AGG = """
SELECT customer_segment, CAST(COUNT(*) AS BIGINT) AS total_orders,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customers,
       avg(order_total) AS avg_order_value, sum(order_total) AS total_revenue,
       avg(delivery_time_minutes) AS avg_delivery_time,
       CAST(COUNT(*) FILTER (WHERE is_delayed) AS BIGINT) AS delayed_orders,
       CAST(COUNT(*) FILTER (WHERE NOT is_delayed) AS BIGINT) AS on_time_orders,
       avg(distance_km) AS avg_delivery_distance,
       CAST(COUNT(DISTINCT payment_method) AS BIGINT) AS payment_methods_used
FROM joined GROUP BY customer_segment"""
SEGMENT_AGG = _money(SEGMENT_AGG)

MONTHLY_AGG = """
SELECT order_year, order_month, CAST(COUNT(*) AS BIGINT) AS total_orders,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customers,
       sum(order_total) AS total_revenue, avg(order_total) AS avg_order_value,
       avg(delivery_time_minutes) AS avg_delivery_time,
       CAST(COUNT(*) FILTER (WHERE is_delayed) AS BIGINT) AS delayed_orders,
       CAST(COUNT(*) FILTER (WHERE NOT is_delayed) AS BIGINT) AS on_time_orders,
       avg(distance_km) AS avg_delivery_distance,
       CAST(COUNT(DISTINCT customer_segment) AS BIGINT) AS segments_served
FROM joined GROUP BY order_year, order_month"""
MONTHLY_AGG = _money(MONTHLY_AGG)


def _pct(num: str, den: str) -> str:
    return rnd(f"{num} / nullif({den}, 0) * 100", 2)


def _r4(c: str) -> str:
    return f"{srnd(c, 4)} AS {c}"


def _freshness(min_records: int) -> str:
    return f"""
WITH e AS (SELECT max(time_bucket(INTERVAL '60 minutes', ts)) + INTERVAL '60 minutes' AS e FROM events),
w AS (SELECT unnest(generate_series(e - INTERVAL '24 hours', e - INTERVAL '60 minutes', INTERVAL '60 minutes'))
             AS window_start FROM e),
c AS (SELECT time_bucket(INTERVAL '60 minutes', ts) AS window_start, COUNT(*) AS n FROM events GROUP BY 1)
SELECT w.window_start, w.window_start + INTERVAL '60 minutes' AS window_end,
       CAST(coalesce(c.n, 0) AS BIGINT) AS records, coalesce(c.n, 0) < {min_records} AS below_min
FROM w LEFT JOIN c ON w.window_start = c.window_start"""


LINEITEM_FLAGS = """
WITH f AS (
  SELECT *,
    l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
        AND COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS f_unique_order_line,
    l_orderkey IS NULL AS f_order_key_required,
    l_discount IS NOT NULL AND NOT (l_discount BETWEEN 0 AND 0.1) AS f_discount_range,
    l_quantity IS NOT NULL AND NOT (l_quantity BETWEEN 1 AND 50) AS f_quantity_range,
    COUNT(l_linenumber) OVER (PARTITION BY l_orderkey) > 7 AS f_max_lines_per_order,
    COUNT(DISTINCT l_partkey) OVER (PARTITION BY l_orderkey) > 6 AS f_max_parts_per_order,
    coalesce(bool_or(coalesce(l_tax > l_discount, false)) OVER (PARTITION BY l_orderkey), false)
        AS f_tax_not_above_discount,
    COUNT(*) OVER () < 1 AS f_minimum_line_count
  FROM lineitem)
"""
LINEITEM_RULES = [("unique_order_line", "error"), ("order_key_required", "error"), ("discount_range", "warn"),
                  ("quantity_range", "warn"), ("max_lines_per_order", "warn"), ("max_parts_per_order", "warn"),
                  ("tax_not_above_discount", "warn"), ("minimum_line_count", "error")]


def _lineitem_rule_results() -> str:
    rows = []
    for name, crit in LINEITEM_RULES:
        failed = _count(f"f_{name}")
        dataset = "COUNT(*) < 1" if name.startswith("minimum_") else "false"
        rows.append(f"SELECT '{name}' AS rule_name, '{crit}' AS criticality, {failed} AS failed_records_count, "
                    f"CASE WHEN {failed} > 0 OR {dataset} THEN 'failed' ELSE 'passed' END AS check_status FROM f")
    return LINEITEM_FLAGS + "\nUNION ALL\n".join(rows)


def _lineitem_quality() -> str:
    errors = " OR ".join(f"f_{n}" for n, c in LINEITEM_RULES if c == "error")
    ok = _count(f"NOT ({errors})")
    return (LINEITEM_FLAGS + f"SELECT 'lineitem' AS table_name, CAST(COUNT(*) AS BIGINT) AS total_records, "
            f"{ok} AS valid_records, {_count(errors)} AS quarantined_records, "
            f"{srnd(f'coalesce({ok} / nullif(COUNT(*), 0) * 100, 0.0)', 6)} AS quality_score FROM f")


# fixed values: types of the published columns that aren't text, and the published tables' descriptions
COLUMN_TYPES = {
    "timestamp_ntz": {"order_date", "promised_delivery_time", "actual_delivery_time", "promised_time", "actual_time"},
    "double": {"order_total", "delivery_time_minutes", "avg_order_value", "distance_km", "delivery_efficiency"},
    "boolean": {"is_on_time", "is_premium", "is_delayed"},
    "int": {"order_year", "total_orders", "customer_age_days", "registration_year"},
    "date": {"registration_date"},
}
DESCRIBED = [
    ("analytics_main", "Main analytical table with all order, customer, and delivery data joined", "Analytical", "analytics_main"),
    ("customer_segment_analysis", "Aggregated metrics by customer segment", "Summary", "segment_analysis"),
    ("monthly_performance", "Monthly performance metrics and trends", "Time Series", "monthly_performance"),
    ("delivery_analysis", "Delivery performance analysis by delay categories", "Performance", "delivery_analysis"),
    ("customer_ranking", "Customer ranking and performance within segments", "Ranking", "customer_ranking"),
    ("payment_analysis", "Payment method usage and performance analysis", "Payment", "payment_analysis"),
    ("kpi_summary", "Key performance indicators summary", "KPI", "kpi_summary"),
]

FIRED = [("large_orders", "warn"), ("large_customers", "warn"), ("minimum_row_count", "error"), ("max_orders_per_customer", "warn"),
         ("max_total_price", "error"), ("unique_customer", "warn"), ("orders_a_day", "error")]
FIRED_RULES = f"""
WITH days AS (
  SELECT d.day, (SELECT COUNT(*) FROM orders WHERE date_trunc('day', o_orderdate) = d.day) AS records
  FROM (SELECT unnest(generate_series(date_trunc('day', max(o_orderdate)) - INTERVAL '23 days', date_trunc('day', max(o_orderdate)),
                                      INTERVAL '1 day')) AS day FROM orders) d),
f AS (
  SELECT o_totalprice > 300000 AS large_orders,
         sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER (PARTITION BY o_custkey) > 2500000 AS large_customers,
         COUNT(*) OVER () < 1000000000000 AS minimum_row_count,
         COUNT(o_orderkey) OVER (PARTITION BY o_custkey) > 12 AS max_orders_per_customer,
         max(o_totalprice) OVER () > 1000 AS max_total_price,
         o_custkey IS NOT NULL AND COUNT(*) OVER (PARTITION BY o_custkey) > 1 AS unique_customer,
         coalesce(date_trunc('day', o_orderdate) IN (SELECT day FROM days WHERE records < 7), false) AS orders_a_day
  FROM orders),
n AS (
  SELECT unnest([{", ".join(f"'{n}'" for n, _ in FIRED)}]) AS rule_name, unnest([{", ".join(f"'{c}'" for _, c in FIRED)}]) AS criticality,
         unnest([{", ".join(f"COUNT(*) FILTER (WHERE {n})" for n, _ in FIRED)}]) AS failed
  FROM f)
SELECT rule_name, criticality, CAST(failed AS BIGINT) AS failed_records_count,
       CASE WHEN failed > 0 OR (rule_name = 'orders_a_day' AND (SELECT COUNT(*) FROM days WHERE records < 7) > 0)
            THEN 'failed' ELSE 'passed' END AS check_status
FROM n
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for t in ("orders", "customers", "delivery"):
        q[f"raw_{t}"] = build(f"SELECT {_select(RAW_COLUMNS[t], RAW_DOUBLES[t])} FROM raw_{t}", (f"raw_{t}",))
        q[f"clean_{t}"] = build(f"SELECT {_select(CLEAN_COLUMNS[t], DOUBLE_COLUMNS[t])} FROM clean_{t}",
                                (f"clean_{t}",))
        measures = ", ".join(f"CAST(COUNT({src}) AS BIGINT) AS {out}" for out, src in PROFILE[t])
        q[f"profile_{t}"] = build(f"SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, {measures} FROM clean_{t}",
                                  (f"clean_{t}",))
        q[f"rule_results_{t}"] = _rule_results(t)
        cols = _select(CLEAN_COLUMNS[t], DOUBLE_COLUMNS[t])
        q[f"valid_{t}"] = build(f"SELECT {cols}, warnings FROM valid_{t}", (f"valid_{t}",))
        q[f"quarantine_{t}"] = build(f"SELECT {cols}, errors, warnings FROM quarantine_{t}", (f"quarantine_{t}",))

    summary = "\nUNION ALL\n".join(_quality(t) for t in ("orders", "customers", "delivery"))
    q["quality_summary"] = build(summary, ("orders_checked", "customers_checked", "delivery_checked"))
    q["overall_quality_score"] = build(
        f"SELECT CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(valid_records) AS BIGINT) AS valid_records, "
        f"{srnd('coalesce(sum(valid_records) / nullif(sum(total_records), 0) * 100, 0.0)', 6)} AS quality_score "
        f"FROM ({summary})", ("orders_checked", "customers_checked", "delivery_checked"))

    parts = []
    for t in ("orders", "customers", "delivery"):
        for name, crit in RULES[t]:
            if crit == "error":
                parts.append(f"SELECT '{TABLE_NAMES[t]}' AS table_name, '{name}' AS rule_name, "
                             f"{_count(f'f_{name}')} AS quarantined_records FROM {t}_flags")
    q["quarantine_by_rule"] = build(
        "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE quarantined_records > 0",
        ("orders_flags", "customers_flags", "delivery_flags"))

    q["quarantine_sample_orders"] = build(
        f"SELECT order_id, customer_id, {_r4('order_total')}, delivery_status, errors FROM quarantine_orders "
        "ORDER BY order_id NULLS FIRST, customer_id NULLS FIRST, order_total NULLS FIRST, "
        "delivery_status NULLS FIRST LIMIT 3", ("quarantine_orders",))

    joined_doubles = {"delivery_time_minutes", "order_total", "customer_avg_order_value", "distance_km",
                      "delivery_efficiency"}
    joined_cols = ["customer_segment", "customer_id", "delivery_time_minutes", "order_id", "order_total",
                   "order_date", "delivery_status", "payment_method", "customer_name", "customer_total_orders",
                   "customer_avg_order_value", "is_premium", "distance_km", "is_delayed", "delay_category",
                   "delivery_efficiency", "order_month", "order_year"]
    q["analytics_main"] = build(f"SELECT {_select(joined_cols, joined_doubles)} FROM joined", ("joined",))

    q["segment_analysis"] = build(f"""
SELECT customer_segment, total_orders, unique_customers, {_r4('avg_order_value')}, {_r4('total_revenue')},
       {_r4('avg_delivery_time')}, delayed_orders, on_time_orders, {_r4('avg_delivery_distance')},
       payment_methods_used, {_pct('on_time_orders', 'total_orders')} AS delivery_success_rate,
       {rnd('total_orders / nullif(unique_customers, 0)', 2)} AS avg_orders_per_customer
FROM ({SEGMENT_AGG})""", ("joined",))

    q["monthly_performance"] = build(f"""
SELECT order_year, order_month, total_orders, unique_customers, {_r4('total_revenue')}, {_r4('avg_order_value')},
       {_r4('avg_delivery_time')}, delayed_orders, on_time_orders, {_r4('avg_delivery_distance')}, segments_served,
       {_pct('on_time_orders', 'total_orders')} AS delivery_success_rate,
       CAST(NULL AS DOUBLE) AS monthly_growth_rate
FROM ({MONTHLY_AGG}) ORDER BY order_year, order_month""", ("joined",))

    q["monthly_growth"] = build(f"""
SELECT order_year, order_month, {_r4('total_revenue')}, {_r4('previous_revenue')},
       {rnd('(total_revenue - previous_revenue) / nullif(previous_revenue, 0) * 100', 2)} AS monthly_growth_rate
FROM (SELECT order_year, order_month, total_revenue,
             lag(total_revenue) OVER (ORDER BY order_year NULLS FIRST, order_month NULLS FIRST) AS previous_revenue
      FROM ({MONTHLY_AGG}))""", ("joined",))

    q["delivery_analysis"] = build(f"""
SELECT delay_category, delivery_status, order_count, {_r4('avg_delivery_time')}, {_r4('avg_distance')},
       {_r4('avg_efficiency')}, {_r4('total_revenue')}, affected_customers,
       {_pct('order_count', 'sum(order_count) OVER ()')} AS percentage_of_orders,
       {rnd('total_revenue / nullif(order_count, 0)', 2)} AS avg_order_value
FROM (SELECT delay_category, delivery_status, CAST(COUNT(*) AS BIGINT) AS order_count,
             avg(delivery_time_minutes) AS avg_delivery_time, avg(distance_km) AS avg_distance,
             avg(delivery_efficiency) AS avg_efficiency, sum(order_total) AS total_revenue,
             CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS affected_customers
      FROM joined GROUP BY delay_category, delivery_status)""", ("joined",))

    q["customer_ranking"] = build(f"""
SELECT customer_id, customer_name, customer_segment, is_premium, order_count, {_r4('total_revenue')},
       {_r4('avg_order_value')}, {_r4('avg_delivery_time')}, delayed_orders, on_time_orders,
       delivery_success_rate, customer_rank_in_segment,
       {_pct('customer_rank_in_segment', 'max(customer_rank_in_segment) OVER (PARTITION BY customer_segment)')}
           AS customer_percentile
FROM (SELECT *, CAST(rank() OVER (PARTITION BY customer_segment
                                  ORDER BY {rnd('total_revenue', 2)} DESC NULLS LAST) AS INTEGER)
                    AS customer_rank_in_segment
      FROM (SELECT customer_id, customer_name, customer_segment, is_premium, CAST(COUNT(*) AS BIGINT) AS order_count,
                   sum(order_total) AS total_revenue, avg(order_total) AS avg_order_value,
                   avg(delivery_time_minutes) AS avg_delivery_time,
                   CAST(COUNT(*) FILTER (WHERE is_delayed) AS BIGINT) AS delayed_orders,
                   CAST(COUNT(*) FILTER (WHERE NOT is_delayed) AS BIGINT) AS on_time_orders,
                   {_pct('COUNT(*) FILTER (WHERE NOT is_delayed)', 'COUNT(*)')} AS delivery_success_rate
            FROM joined GROUP BY customer_id, customer_name, customer_segment, is_premium))""", ("joined",))

    q["payment_analysis"] = build(f"""
SELECT payment_method, order_count, unique_customers, {_r4('total_revenue')}, {_r4('avg_order_value')},
       {_r4('avg_delivery_time')}, delayed_orders, on_time_orders,
       {_pct('on_time_orders', 'order_count')} AS delivery_success_rate,
       {_pct('order_count', 'sum(order_count) OVER ()')} AS percentage_of_orders
FROM (SELECT payment_method, CAST(COUNT(*) AS BIGINT) AS order_count,
             CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customers,
             sum(order_total) AS total_revenue, avg(order_total) AS avg_order_value,
             avg(delivery_time_minutes) AS avg_delivery_time,
             CAST(COUNT(*) FILTER (WHERE is_delayed) AS BIGINT) AS delayed_orders,
             CAST(COUNT(*) FILTER (WHERE NOT is_delayed) AS BIGINT) AS on_time_orders
      FROM joined GROUP BY payment_method)""", ("joined",))

    kpis = [
        ("Total Orders", "CAST((SELECT COUNT(*) FROM joined) AS DOUBLE)"),
        ("Total Revenue", srnd("(SELECT sum(order_total) FROM joined)", 4)),
        ("Unique Customers", "CAST((SELECT COUNT(*) FROM (SELECT DISTINCT customer_id FROM joined)) AS DOUBLE)"),
        ("Avg Order Value", srnd("(SELECT avg(order_total) FROM joined)", 4)),
        ("Avg Delivery Time (minutes)", srnd("(SELECT avg(delivery_time_minutes) FROM joined)", 4)),
        ("On-time Delivery Rate (%)",
         srnd("(SELECT COUNT(*) FILTER (WHERE is_delayed = false) / nullif(COUNT(*), 0) * 100 FROM joined)", 4)),
        ("Premium Customers",
         "CAST((SELECT COUNT(*) FROM (SELECT DISTINCT customer_id FROM joined WHERE is_premium = true)) AS DOUBLE)"),
        ("Total Segments", "CAST((SELECT COUNT(*) FROM (SELECT DISTINCT customer_segment FROM joined)) AS DOUBLE)"),
    ]
    q["kpi_summary"] = build("\nUNION ALL\n".join(f"SELECT '{m}' AS metric, {v} AS value" for m, v in kpis),
                             ("joined",))

    counts = [("raw_orders", "raw_orders"), ("raw_customers", "raw_customers"),
              ("raw_delivery_performance", "raw_delivery"), ("final_orders", "valid_orders"),
              ("final_customers", "valid_customers"), ("final_delivery_performance", "valid_delivery"),
              ("quarantine_orders", "quarantine_orders"), ("quarantine_customers", "quarantine_customers"),
              ("quarantine_delivery_performance", "quarantine_delivery"), ("analytics_main", "joined")]
    q["table_row_counts"] = build(
        "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count, "
                             f"CAST(NULL AS VARCHAR) AS error FROM {src}" for n, src in counts),
        tuple(src for _, src in counts))

    q["preview_final_orders"] = build(
        f"SELECT order_id, customer_id, {_r4('order_total')}, delivery_status, order_month FROM valid_orders "
        "ORDER BY order_id NULLS FIRST, customer_id NULLS FIRST, order_total NULLS FIRST, "
        "delivery_status NULLS FIRST, order_month NULLS FIRST LIMIT 5", ("valid_orders",))

    q["freshness_events"] = _freshness(1)
    q["freshness_events_min12"] = _freshness(12)

    start, end = INCREMENTAL_WINDOW
    q["run_window_orders"] = build(
        f"SELECT {_select(CLEAN_COLUMNS['orders'], DOUBLE_COLUMNS['orders'])} FROM clean_orders "
        f"WHERE order_date >= TIMESTAMP '{start} 00:00:00' AND order_date < TIMESTAMP '{end} 00:00:00' + INTERVAL 1 DAY",
        ("clean_orders",))

    for name in ("delivery_analysis", "customer_ranking", "payment_analysis", "kpi_summary"):
        q[name] = _money(q[name])

    samples = {"customers": (["customer_id", "customer_name", "email", "customer_segment"], "customers"),
               "delivery": (["order_id", "delivery_partner_id", "delivery_time_minutes", "distance_km",
                             "delivery_status"], "delivery")}
    for t, (cols, _) in samples.items():
        order = ", ".join(f"{c} NULLS FIRST" for c in cols)
        picked = _select(cols, DOUBLE_COLUMNS[t])
        q[f"quarantine_sample_{t}"] = build(
            f"SELECT {picked}, errors FROM (SELECT * FROM quarantine_{t} ORDER BY {order} LIMIT 3)", (f"quarantine_{t}",))
        q[f"preview_final_{t}"] = build(
            f"SELECT {picked} FROM (SELECT * FROM valid_{t} ORDER BY {order} LIMIT 5)", (f"valid_{t}",))

    for name in ("segment_analysis", "monthly_performance", "delivery_analysis", "customer_ranking", "payment_analysis",
                 "kpi_summary"):
        q[f"incremental_{name}"] = q[name]
    q["incremental_final_orders"] = q["valid_orders"]
    q["stored_valid_orders"], q["stored_quarantine_orders"] = q["valid_orders"], q["quarantine_orders"]
    q["analytics_main_bucketed"] = q["analytics_main"]
    q["incremental_duplicates"] = build("""
SELECT order_id, customer_id, order_date, order_month, errors
FROM (SELECT *, concat_ws(',',
        CASE WHEN order_id IS NOT NULL AND customer_id IS NOT NULL AND same_pair > 1 THEN 'composite_key_order_customer_is_unique' END,
        CASE WHEN customer_id IS NULL THEN 'customer_id_not_null' END,
        CASE WHEN order_id IS NULL THEN 'order_id_not_null' END,
        CASE WHEN order_id IS NOT NULL AND same_order > 1 THEN 'unique_order_id' END) AS errors
      FROM (SELECT *, COUNT(*) OVER (PARTITION BY order_id) AS same_order, COUNT(*) OVER (PARTITION BY order_id, customer_id) AS same_pair
            FROM (SELECT order_id, customer_id, order_date, order_month FROM clean_orders
                  UNION ALL
                  SELECT order_id, customer_id, TIMESTAMP '1997-01-15 10:30:00', '1997-01' FROM clean_orders
                  WHERE CAST(order_id AS BIGINT) % 41 = 3 AND order_month <> '1997-01')))
WHERE order_month = '1997-01' AND errors <> ''""", ("clean_orders",))
    sums = ", ".join(f"{srnd(f'CAST(sum(CAST({m} AS DECIMAL(18, 2))) AS DOUBLE)', 4)} AS {m}_sum, CAST(COUNT({m}) AS BIGINT) AS {m}_count"
                     for m in ("order_total", "delivery_time_minutes", "distance_km", "delivery_efficiency"))
    groups = "order_month, order_year, customer_segment, delay_category, delivery_status, payment_method"
    q["mart_cube"] = build(f"SELECT {groups}, CAST(COUNT(*) AS BIGINT) AS orders, {sums}, {_count('is_delayed')} AS delayed, "
                           f"{_count('NOT is_delayed')} AS on_time FROM joined GROUP BY {groups}", ("joined",))
    fault = "coalesce(CAST(order_id AS BIGINT), 0) % 13"
    q["ingest_rejects"] = build(f"""
SELECT coalesce(order_id, '') AS order_id, CASE {fault} WHEN 1 THEN 'short' WHEN 2 THEN 'long' ELSE 'type' END AS reason,
       CASE {fault} WHEN 3 THEN 'order_total' END AS columns
FROM raw_orders WHERE {fault} IN (1, 2, 3)""", ("raw_orders",))
    q["ingest_reject_status"] = build(f"""
SELECT 'orders.csv' AS source_file, {_count(f'{fault} NOT IN (1, 2, 3)')} AS row_count, {_count(f'{fault} IN (1, 2, 3)')} AS rejected_count,
       {_count(f'{fault} NOT IN (1, 2, 3)')} AS loaded_rows, {_count(f'{fault} IN (1, 2, 3)')} AS reject_rows
FROM raw_orders""", ("raw_orders",))
    number = "coalesce(CAST(order_id AS BIGINT), 0) % 3"
    q["ledger_loads"] = build(f"""
SELECT order_id, customer_id, {_r4('order_total')}, 'orders_' || CAST({number} AS VARCHAR) || '.csv' AS source_file,
       CASE WHEN {number} = 1 THEN 'b3' ELSE 'b1' END AS _batch_id, '3,0,1' AS files_loaded
FROM raw_orders WHERE {number} <> 1 OR CAST(order_id AS BIGINT) % 2 = 0""", ("raw_orders",))
    q["ingested_orders"] = build(
        f"SELECT {_select(RAW_COLUMNS['orders'], RAW_DOUBLES['orders'])}, 'b1' AS _batch_id, true AS from_csv, "
        "true AS has_load_time FROM raw_orders", ("raw_orders",))
    loads = [("orders", "raw_orders"), ("customers", "raw_customers"), ("delivery_performance", "raw_delivery")]
    q["ingest_status"] = build("\nUNION ALL\n".join(
        f"SELECT '{t}.csv' AS source_file, 'raw_{t}' AS table_name, true AS loaded, CAST(COUNT(*) AS BIGINT) AS row_count "
        f"FROM {src}" for t, src in loads), tuple(src for _, src in loads))
    q["logged_rule_results"] = (
        f"SELECT run_id, rule_name, criticality, failed_records_count, check_status FROM ({q['rule_results_orders']}) "
        "CROSS JOIN (VALUES ('first'), ('second')) AS runs(run_id)")
    q["fired_rule_results"] = FIRED_RULES

    columns = []
    for t in ("orders", "customers", "delivery"):
        q[f"footer_profile_{t}"] = q[f"profile_{t}"]
        for c in CLEAN_COLUMNS[t]:
            kind = next((k for k, names in COLUMN_TYPES.items() if c in names), "string")
            columns.append((t, c, kind, f"COUNT({c})"))
        columns += [(t, "_processed_timestamp", "timestamp", "COUNT(*)"), (t, "_data_quality_score", "double", "COUNT(*)")]
    q["column_report"] = build("\nUNION ALL\n".join(
        f"SELECT 'processed_{TABLE_NAMES[t]}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, "
        f"CAST(COUNT(*) AS BIGINT) AS row_count, CAST({n} AS BIGINT) AS non_null_count FROM clean_{t}" for t, c, kind, n in columns),
        ("clean_orders", "clean_customers", "clean_delivery"))
    q["table_metadata"] = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, '{text}' AS description, '{category}' AS category, "
        f"CAST(COUNT(*) AS BIGINT) AS row_count FROM ({q[source]})" for name, text, category, source in DESCRIBED)
    warned = "CASE WHEN warnings = '' THEN 0 ELSE len(string_split(warnings, ',')) END"
    q["stamped_final_orders"] = build(
        f"SELECT order_id, customer_id, true AS has_processing_time, {srnd(f'1.0 - {warned} / {len(RULES['orders'])}.0', 4)} "
        "AS data_quality_score FROM valid_orders", ("valid_orders",))
    q["stamped_analytics_main"] = build(
        "SELECT order_id, order_month, true AS has_creation_time, CASE WHEN coalesce(order_month = '1997-01', true) THEN 'batch_part' "
        "ELSE 'batch_full' END AS batch_id FROM joined", ("joined",))

    q["lineitem_rule_results"] = _lineitem_rule_results()
    q["lineitem_quality"] = _lineitem_quality()
    return q
