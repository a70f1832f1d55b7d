"""Independent DuckDB SQL for every registered query.

The statements restate the same semantics in plain SQL over the driver tables (views ``orders``,
``customer``, ``nation``, ``events``, ``lineitem``): fixture views, cleaning, rule flags (with window
functions, not the engine's pre-aggregate-and-join plan), splits, the join and the marts. Each query is
one ``WITH`` statement assembled from named CTEs with their dependencies.

Parity helpers: ``rnd`` reproduces Spark's ``round`` on doubles (half-up on the shortest decimal form),
``initcap`` reproduces Spark's title-casing (DuckDB has none).
"""

from __future__ import annotations

AS_OF = "2025-01-01"
INCREMENTAL_WINDOW = ("1997-01-01", "1997-12-31")


def rnd(x: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def srnd(x: str, digits: int) -> str:
    """Presentation rounding matching ``stable``: to digits + 3 places, then to ``digits``."""
    return (f"CAST(round(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,10)), {digits + 3}), {digits}) "
            f"AS DOUBLE)")


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def minutes(ts: str, n: str) -> str:
    return f"({ts} + INTERVAL '1' MINUTE * CAST(({n}) AS INTEGER))"


def status(k: str = "k") -> str:
    return (f"CASE {k} % 7 WHEN 0 THEN NULL WHEN 1 THEN 'DELAYED' WHEN 2 THEN 'delayed' "
            f"WHEN 3 THEN 'slightly delayed' ELSE 'on time' END")


EMAIL_PATTERN = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


# ---------------------------------------------------------------------------------------------- fixtures
cte("o_base", (), f"""
SELECT o.*, o_orderkey AS k, {minutes('o_orderdate', 'o_orderkey % 1440')} AS d
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 500 = 7) o""")

cte("o_times", ("o_base",), f"""
SELECT *, CASE WHEN k % 97 = 0 THEN NULL
               WHEN k % 89 = 0 THEN d - INTERVAL '15' MINUTE
               ELSE {minutes('d', '10 + k % 30')} END AS p
FROM o_base""")

cte("raw_orders", ("o_times",), f"""
SELECT CASE WHEN k % 611 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS order_id,
       CASE WHEN k % 401 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN k % 307 = 0 THEN NULL ELSE d END AS order_date,
       p AS promised_delivery_time,
       CASE WHEN k % 53 = 0 OR p IS NULL THEN NULL ELSE {minutes('p', '(k * 7) % 41 - 10')} END AS actual_delivery_time,
       {status()} AS delivery_status,
       CASE WHEN k % 173 = 0 THEN NULL WHEN k % 73 = 0 THEN -o_totalprice ELSE o_totalprice END AS order_total,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'cash' WHEN '2-HIGH' THEN 'CARD'
            WHEN '3-MEDIUM' THEN 'upi' WHEN '5-LOW' THEN 'wallet' END AS payment_method,
       'DP' || CAST(k % 50 AS VARCHAR) AS delivery_partner_id,
       CASE WHEN k % 127 = 0 THEN 'S-X' ELSE CAST(k % 20 AS VARCHAR) END AS store_id
FROM o_times""")

cte("c_base", (), """
SELECT c.*, c.c_custkey AS k, n.n_name, oc.n_orders
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey) oc ON c.c_custkey = oc.o_custkey""")

cte("raw_customers", ("c_base",), """
SELECT CASE WHEN k % 499 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS customer_id,
       CASE WHEN k % 211 = 0 THEN NULL ELSE '  ' || c_name || ' ' END AS customer_name,
       CASE WHEN k % 83 = 0 THEN NULL WHEN k % 61 = 0 THEN 'bad.email' WHEN k % 59 = 0 THEN 'shared@example.com'
            ELSE ' User' || CAST(k AS VARCHAR) || '@Example.COM ' END AS email,
       CASE WHEN k % 71 = 0 THEN NULL WHEN k % 67 = 0 THEN '12-34'
            ELSE '+91 98' || CAST(k + 10000000 AS VARCHAR) END AS phone,
       ' ' || CAST(k AS VARCHAR) || ' Main St ' AS address,
       n_name || ' ' AS area,
       CASE WHEN k % 101 = 0 THEN '99' WHEN k % 103 = 0 THEN 'N/A'
            ELSE CAST(100000 + (k * 37) % 900000 AS VARCHAR) END AS pincode,
       CASE WHEN k % 109 = 0 THEN NULL ELSE CAST(DATE '2019-01-01' + CAST(k % 1500 AS INTEGER) AS DATE) END
           AS registration_date,
       CASE WHEN k % 113 = 0 THEN 'vip' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'premium'
            WHEN c_mktsegment = 'BUILDING' THEN 'REGULAR' WHEN c_mktsegment = 'FURNITURE' THEN 'new'
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Inactive' END AS customer_segment,
       CAST(n_orders AS INTEGER) AS total_orders,
       CASE WHEN k % 79 = 0 THEN NULL ELSE c_acctbal END AS avg_order_value
FROM (SELECT * FROM c_base UNION ALL SELECT * FROM c_base WHERE k % 300 = 11) b""")

cte("d_base", (), f"""
SELECT o_orderkey AS k, {minutes('o_orderdate', 'o_orderkey % 1440')} AS d
FROM (SELECT * FROM orders WHERE o_orderkey % 31 <> 0
      UNION ALL SELECT * FROM orders WHERE o_orderkey % 31 <> 0 AND o_orderkey % 700 = 13) o""")

cte("raw_delivery", ("d_base",), f"""
SELECT CASE WHEN k % 613 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS order_id,
       'DP' || CAST(k % 50 AS VARCHAR) AS delivery_partner_id,
       d AS promised_time,
       {minutes('d', '(k * 7) % 400 - 70')} AS actual_time,
       CASE WHEN k % 47 = 0 THEN NULL ELSE CAST((k * 7) % 400 - 70 AS DOUBLE) END AS delivery_time_minutes,
       CASE WHEN k % 43 = 0 THEN NULL ELSE CAST((k * 13) % 600 AS DOUBLE) / 10.0 END AS distance_km,
       {status()} AS delivery_status,
       CASE WHEN k % 3 = 0 THEN NULL ELSE ' Traffic ' END AS reasons_if_delayed
FROM d_base""")

# ---------------------------------------------------------------------------------------------- cleaning
cte("o_step1", ("raw_orders",), f"""
SELECT order_id, customer_id, order_date, promised_delivery_time, actual_delivery_time,
       coalesce({initcap('delivery_status')}, 'Unknown') AS delivery_status,
       {rnd('order_total', 2)} AS order_total,
       coalesce({initcap('payment_method')}, 'Unknown') AS payment_method,
       delivery_partner_id, store_id
FROM raw_orders""")

cte("clean_orders", ("o_step1",), f"""
SELECT order_id, customer_id, order_date, promised_delivery_time, actual_delivery_time, delivery_status,
       CASE WHEN order_total >= 0 THEN order_total END AS order_total,
       payment_method, delivery_partner_id,
       CASE WHEN TRY_CAST(store_id AS BIGINT) >= 1 THEN store_id END AS store_id,
       {rnd('(floor(epoch(actual_delivery_time)) - floor(epoch(promised_delivery_time))) / 60', 2)}
           AS delivery_time_minutes,
       coalesce(delivery_status = 'On Time', false) AS is_on_time,
       strftime(order_date, '%Y-%m') AS order_month,
       CAST(year(order_date) AS INTEGER) AS order_year
FROM o_step1""")

cte("c_step1", ("raw_customers",), f"""
SELECT customer_id, trim(customer_name) AS customer_name, lower(trim(email)) AS email,
       regexp_replace(phone, '[^0-9+]', '', 'g') AS phone,
       trim(address) AS address, trim(area) AS area, pincode, registration_date,
       coalesce({initcap('customer_segment')}, 'Unknown') AS customer_segment,
       coalesce(total_orders, 0) AS total_orders,
       coalesce({rnd('avg_order_value', 2)}, 0.0) AS avg_order_value
FROM raw_customers""")

cte("clean_customers", ("c_step1",), f"""
SELECT customer_id, customer_name, email, phone, address, area,
       CASE WHEN TRY_CAST(pincode AS BIGINT) BETWEEN 100000 AND 999999 THEN pincode END AS pincode,
       registration_date, customer_segment,
       CASE WHEN total_orders >= 0 THEN total_orders END AS total_orders,
       CASE WHEN avg_order_value >= 0 THEN avg_order_value END AS avg_order_value,
       CAST(DATE '{AS_OF}' - registration_date AS INTEGER) AS customer_age_days,
       coalesce(customer_segment = 'Premium', false) AS is_premium,
       CAST(year(registration_date) AS INTEGER) AS registration_year
FROM c_step1""")

cte("d_step1", ("raw_delivery",), f"""
SELECT order_id, delivery_partner_id, promised_time, actual_time,
       {rnd('delivery_time_minutes', 2)} AS m, {rnd('distance_km', 2)} AS km,
       coalesce({initcap('delivery_status')}, 'Unknown') AS delivery_status,
       coalesce(trim(reasons_if_delayed), 'None') AS reasons_if_delayed
FROM raw_delivery""")

cte("d_step2", ("d_step1",), """
SELECT order_id, delivery_partner_id, promised_time, actual_time,
       CASE WHEN m BETWEEN -60 AND 300 THEN m END AS delivery_time_minutes,
       CASE WHEN km BETWEEN 0 AND 50 THEN km END AS distance_km,
       delivery_status, reasons_if_delayed
FROM d_step1""")

cte("clean_delivery", ("d_step2",), f"""
SELECT *,
       coalesce(delivery_time_minutes > 0, false) AS is_delayed,
       CASE WHEN delivery_time_minutes <= 0 THEN 'On Time' WHEN delivery_time_minutes <= 5 THEN 'Slight Delay'
            WHEN delivery_time_minutes <= 15 THEN 'Moderate Delay' ELSE 'Significant Delay' END AS delay_category,
       CASE WHEN distance_km > 0 THEN {rnd('delivery_time_minutes / distance_km', 2)} END AS delivery_efficiency
FROM d_step2""")

# ---------------------------------------------------------------------------------------------- rule flags
# Freshness on orders.order_date: 60-minute windows, the 24 ending with the last window holding data.
cte("o_fresh_end", ("clean_orders",), """
SELECT max(time_bucket(INTERVAL '60 minutes', order_date)) + INTERVAL '60 minutes' AS e FROM clean_orders""")

cte("o_fresh_windows", ("o_fresh_end", "clean_orders"), """
SELECT w.ws, (SELECT COUNT(*) FROM clean_orders o
              WHERE time_bucket(INTERVAL '60 minutes', o.order_date) = w.ws) AS records
FROM (SELECT unnest(generate_series(e - INTERVAL '24 hours', e - INTERVAL '60 minutes', INTERVAL '60 minutes')) AS ws
      FROM o_fresh_end) w""")

cte("orders_flags", ("clean_orders", "o_fresh_windows"), """
SELECT o.*,
  order_id IS NOT NULL AND COUNT(*) OVER (PARTITION BY order_id) > 1 AS f_unique_order_id,
  order_id IS NOT NULL AND customer_id IS NOT NULL
      AND COUNT(*) OVER (PARTITION BY order_id, customer_id) > 1 AS f_composite_key_order_customer_is_unique,
  order_id IS NULL AS f_order_id_not_null,
  customer_id IS NULL AS f_customer_id_not_null,
  order_date IS NULL AS f_order_date_not_null,
  order_total IS NOT NULL AND NOT (order_total BETWEEN 0 AND 100000) AS f_order_total_range,
  COUNT(*) OVER () < 1 AS f_minimum_order_count,
  coalesce(COUNT(order_id) OVER (PARTITION BY customer_id) > 100, false) AS f_max_orders_per_customer,
  coalesce(bool_or(coalesce(promised_delivery_time IS NOT NULL AND order_date IS NOT NULL
                            AND promised_delivery_time < order_date, false))
           OVER (PARTITION BY order_id), false) AS f_delivery_time_after_order,
  coalesce(time_bucket(INTERVAL '60 minutes', order_date) IN
           (SELECT ws FROM o_fresh_windows WHERE records < 1), false) AS f_order_data_freshness
FROM clean_orders o""")

cte("customers_flags", ("clean_customers",), f"""
SELECT c.*,
  customer_id IS NOT NULL AND COUNT(*) OVER (PARTITION BY customer_id) > 1 AS f_unique_customer_id,
  email IS NOT NULL AND COUNT(*) OVER (PARTITION BY email) > 1 AS f_unique_email_addresses,
  customer_id IS NULL AS f_customer_id_required,
  customer_name IS NULL AS f_customer_name_required,
  coalesce(bool_or(coalesce(email IS NOT NULL AND NOT regexp_matches(email, '{EMAIL_PATTERN}'), false))
           OVER (PARTITION BY customer_id), false) AS f_valid_email_format,
  coalesce(bool_or(coalesce(phone IS NOT NULL AND length(phone) < 10, false))
           OVER (PARTITION BY customer_id), false) AS f_phone_number_length,
  coalesce(bool_or(coalesce(customer_segment NOT IN ('Premium', 'Regular', 'New', 'Inactive', 'Unknown'), false))
           OVER (PARTITION BY customer_id), false) AS f_valid_customer_segment,
  COUNT(*) OVER () < 1 AS f_minimum_customer_count,
  COUNT(*) OVER (PARTITION BY customer_segment) < 1 AS f_customer_segment_distribution
FROM clean_customers c""")

cte("delivery_flags", ("clean_delivery",), """
SELECT d.*,
  order_id IS NOT NULL AND COUNT(*) OVER (PARTITION BY order_id) > 1 AS f_unique_delivery_order_id,
  order_id IS NULL AS f_order_id_required,
  delivery_status IS NULL AS f_delivery_status_required,
  delivery_time_minutes IS NOT NULL AND NOT (delivery_time_minutes BETWEEN 60 AND 300) AS f_delivery_time_range,
  distance_km IS NOT NULL AND NOT (distance_km BETWEEN 0 AND 50) AS f_distance_range,
  coalesce(bool_or(coalesce(delivery_status NOT IN ('On Time', 'Delayed', 'Unknown'), false))
           OVER (PARTITION BY order_id), false) AS f_delivery_status_validation
FROM clean_delivery d""")

RULES = {
    "orders": [
        ("unique_order_id", "error"), ("composite_key_order_customer_is_unique", "error"),
        ("order_id_not_null", "error"), ("customer_id_not_null", "error"), ("order_date_not_null", "error"),
        ("order_total_range", "warn"), ("minimum_order_count", "error"), ("max_orders_per_customer", "warn"),
        ("delivery_time_after_order", "warn"), ("order_data_freshness", "warn"),
    ],
    "customers": [
        ("unique_customer_id", "error"), ("unique_email_addresses", "warn"), ("customer_id_required", "error"),
        ("customer_name_required", "error"), ("valid_email_format", "warn"), ("phone_number_length", "warn"),
        ("valid_customer_segment", "warn"), ("minimum_customer_count", "error"),
        ("customer_segment_distribution", "warn"),
    ],
    "delivery": [
        ("unique_delivery_order_id", "error"), ("order_id_required", "error"),
        ("delivery_status_required", "error"), ("delivery_time_range", "warn"), ("distance_range", "warn"),
        ("delivery_status_validation", "warn"),
    ],
}
CLEAN_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_date", "promised_delivery_time", "actual_delivery_time",
               "delivery_status", "order_total", "payment_method", "delivery_partner_id", "store_id",
               "delivery_time_minutes", "is_on_time", "order_month", "order_year"],
    "customers": ["customer_id", "customer_name", "email", "phone", "address", "area", "pincode",
                  "registration_date", "customer_segment", "total_orders", "avg_order_value",
                  "customer_age_days", "is_premium", "registration_year"],
    "delivery": ["order_id", "delivery_partner_id", "promised_time", "actual_time", "delivery_time_minutes",
                 "distance_km", "delivery_status", "reasons_if_delayed", "is_delayed", "delay_category",
                 "delivery_efficiency"],
}


def _names(table: str, level: str | None) -> str:
    """Sorted comma-joined names of violated rules (of one criticality, or all)."""
    picks = sorted(n for n, c in RULES[table] if level is None or c == level)
    parts = ", ".join(f"CASE WHEN f_{n} THEN '{n}' END" for n in picks)
    return f"coalesce(concat_ws(',', {parts}), '')"


def _any(table: str, level: str) -> str:
    picks = [n for n, c in RULES[table] if c == level]
    return "(" + " OR ".join(f"f_{n}" for n in picks) + ")"


for _t in ("orders", "customers", "delivery"):
    _cols = ", ".join(CLEAN_COLUMNS[_t])
    cte(f"{_t}_checked", (f"{_t}_flags",), f"""
SELECT {_cols}, {_any(_t, 'error')} AS is_error, {_names(_t, 'error')} AS errors,
       {_names(_t, 'warn')} AS warnings
FROM {_t}_flags""")
    cte(f"valid_{_t}", (f"{_t}_checked",), f"SELECT * FROM {_t}_checked WHERE NOT is_error")
    cte(f"quarantine_{_t}", (f"{_t}_checked",), f"SELECT * FROM {_t}_checked WHERE is_error")

# ---------------------------------------------------------------------------------------------- join
cte("joined", ("valid_orders", "valid_customers", "valid_delivery"), """
SELECT c.customer_segment, o.customer_id, dp.delivery_time_minutes, o.order_id, o.order_total, o.order_date,
       o.delivery_status, o.payment_method, c.customer_name, c.total_orders AS customer_total_orders,
       c.avg_order_value AS customer_avg_order_value, c.is_premium, dp.distance_km, dp.is_delayed,
       dp.delay_category, dp.delivery_efficiency, o.order_month, o.order_year
FROM valid_orders o
LEFT JOIN valid_customers c ON o.customer_id = c.customer_id
LEFT JOIN valid_delivery dp ON o.order_id = dp.order_id""")


def build(final_select: str, deps: tuple[str, ...]) -> str:
    """``WITH`` the transitive dependencies of ``deps`` (in dependency order), then ``final_select``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in CTES[name][0]:
            visit(d)
        order.append(name)

    for d in deps:
        visit(d)
    if not order:
        return final_select
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{final_select}"
