"""The rule sets for the three checked tables (25 rules).

Row-shaped SQL checks are written as ``sql_condition`` with the same condition text, merge key and filter
as a ``SELECT key, CASE WHEN ... END AS condition FROM input WHERE ...`` query; this lets the engine fuse
them into the aggregation of other checks on the same key. The aggregate-shaped check stays a
``sql_query``. Two delivery range rules that shared one name get distinct names, and the duplicated
delivery-time rule on orders appears once (rule names must be unique).
"""

from __future__ import annotations

from tidemark.operators.rules import (
    Rule,
    is_aggr_not_greater_than,
    is_aggr_not_less_than,
    is_data_fresh_per_time_window,
    is_in_range,
    is_not_null,
    is_unique,
    rule,
    sql_condition,
    sql_query,
)

# --- fixed values: rule limits, allowed values and patterns ----------------------------------------
ORDER_TOTAL_LIMITS = (0, 100000)
MAX_ORDERS_PER_CUSTOMER = 100
FRESHNESS = {"window_minutes": 60, "min_records_per_window": 1, "lookback_windows": 24}
EMAIL_PATTERN = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$"
MIN_PHONE_LENGTH = 10
ALLOWED_SEGMENTS = ("Premium", "Regular", "New", "Inactive", "Unknown")
MIN_ORDERS_A_DAY = 7
DELIVERY_MINUTES_LIMITS = (60, 300)
DISTANCE_KM_LIMITS = (0, 50)
ALLOWED_DELIVERY_STATUSES = ("On Time", "Delayed", "Unknown")


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def orders_rules(freshness_column: str = "order_date", curr_timestamp: str | None = None) -> list[Rule]:
    return [
        rule("unique_order_id", "error", is_unique(["order_id"])),
        rule("composite_key_order_customer_is_unique", "error", is_unique(["order_id", "customer_id"])),
        rule("order_id_not_null", "error", is_not_null("order_id")),
        rule("customer_id_not_null", "error", is_not_null("customer_id")),
        rule("order_date_not_null", "error", is_not_null("order_date")),
        rule("order_total_range", "warn", is_in_range("order_total", *ORDER_TOTAL_LIMITS)),
        rule("minimum_order_count", "error", is_aggr_not_less_than("*", "count", 1)),
        rule("max_orders_per_customer", "warn",
             is_aggr_not_greater_than("order_id", "count", MAX_ORDERS_PER_CUSTOMER, group_by=["customer_id"])),
        rule("delivery_time_after_order", "warn",
             sql_condition("promised_delivery_time < order_date", merge_columns=["order_id"],
                           where="promised_delivery_time IS NOT NULL AND order_date IS NOT NULL")),
        rule("order_data_freshness", "warn",
             is_data_fresh_per_time_window(freshness_column, curr_timestamp=curr_timestamp, **FRESHNESS)),
    ]


def customers_rules() -> list[Rule]:
    return [
        rule("unique_customer_id", "error", is_unique(["customer_id"])),
        rule("unique_email_addresses", "warn", is_unique(["email"])),
        rule("customer_id_required", "error", is_not_null("customer_id")),
        rule("customer_name_required", "error", is_not_null("customer_name")),
        rule("valid_email_format", "warn",
             sql_condition(f"email IS NOT NULL AND email NOT REGEXP '{EMAIL_PATTERN}'",
                           merge_columns=["customer_id"])),
        rule("phone_number_length", "warn",
             sql_condition(f"phone IS NOT NULL AND length(phone) < {MIN_PHONE_LENGTH}",
                           merge_columns=["customer_id"])),
        rule("valid_customer_segment", "warn",
             sql_condition(f"customer_segment NOT IN ({_sql_list(ALLOWED_SEGMENTS)})",
                           merge_columns=["customer_id"])),
        rule("minimum_customer_count", "error", is_aggr_not_less_than("*", "count", 1)),
        rule("customer_segment_distribution", "warn",
             is_aggr_not_less_than("*", "count", 1, group_by=["customer_segment"])),
    ]


def delivery_rules(minutes_limits: tuple = DELIVERY_MINUTES_LIMITS,
                   distance_limits: tuple = DISTANCE_KM_LIMITS) -> list[Rule]:
    return [
        rule("unique_delivery_order_id", "error", is_unique(["order_id"])),
        rule("order_id_required", "error", is_not_null("order_id")),
        rule("delivery_status_required", "error", is_not_null("delivery_status")),
        rule("delivery_time_range", "warn", is_in_range("delivery_time_minutes", *minutes_limits)),
        rule("distance_range", "warn", is_in_range("distance_km", *distance_limits)),
        rule("delivery_status_validation", "warn",
             sql_condition(f"delivery_status NOT IN ({_sql_list(ALLOWED_DELIVERY_STATUSES)})",
                           merge_columns=["order_id"])),
    ]


def rule_sets() -> dict[str, list[Rule]]:
    return {
        "orders": orders_rules(),
        "customers": customers_rules(),
        "delivery_performance": delivery_rules(),
    }


def firing_rules() -> list[Rule]:
    """Dataset-level rules that the base orders table violates: SQL queries of both shapes (one row a key,
    one row a group), a table-wide minimum, a limit per customer, a key that is not unique and days with few orders."""
    return [
        rule("large_orders", "warn", sql_query(
            "SELECT o_orderkey, o_totalprice > 300000 AS condition FROM {{ input_view }}", ["o_orderkey"])),
        rule("large_customers", "warn", sql_query(
            "SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) > 2500000 AS condition "
            "FROM {{ input_view }} GROUP BY o_custkey", ["o_custkey"])),
        rule("minimum_row_count", "error", is_aggr_not_less_than("*", "count", 1_000_000_000_000)),
        rule("max_orders_per_customer", "warn",
             is_aggr_not_greater_than("o_orderkey", "count", 12, group_by=["o_custkey"])),
        rule("max_total_price", "error", is_aggr_not_greater_than("o_totalprice", "max", 1_000)),
        rule("unique_customer", "warn", is_unique(["o_custkey"])),
        rule("orders_a_day", "error", is_data_fresh_per_time_window("o_orderdate", 24 * 60, MIN_ORDERS_A_DAY, 24)),
    ]


def lineitem_rules() -> list[Rule]:
    """The same rule library on the line-item table: a composite key that is not unique in the data,
    per-order aggregate limits and row ranges."""
    return [
        rule("unique_order_line", "error", is_unique(["l_orderkey", "l_linenumber"])),
        rule("order_key_required", "error", is_not_null("l_orderkey")),
        rule("discount_range", "warn", is_in_range("l_discount", 0, 0.1)),
        rule("quantity_range", "warn", is_in_range("l_quantity", 1, 50)),
        rule("max_lines_per_order", "warn", is_aggr_not_greater_than("l_linenumber", "count", 7,
                                                                       group_by=["l_orderkey"])),
        rule("max_parts_per_order", "warn", is_aggr_not_greater_than("l_partkey", "count_distinct", 6,
                                                                       group_by=["l_orderkey"])),
        rule("tax_not_above_discount", "warn", sql_condition("l_tax > l_discount", merge_columns=["l_orderkey"])),
        rule("minimum_line_count", "error", is_aggr_not_less_than("*", "count", 1)),
    ]
