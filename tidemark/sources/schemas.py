"""Declared input schemas for the eight source tables (all columns nullable).

Loads always pass an explicit schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, TIMESTAMP, DATE, DOUBLE, INT, BOOL = (
    StringType(), TimestampType(), DateType(), DoubleType(), IntegerType(), BooleanType())


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# --- fixed values: table schemas, field names and types in source order -------------------------------
ORDERS = _struct(
    ("order_id", STRING), ("customer_id", STRING), ("order_date", TIMESTAMP),
    ("promised_delivery_time", TIMESTAMP), ("actual_delivery_time", TIMESTAMP),
    ("delivery_status", STRING), ("order_total", DOUBLE), ("payment_method", STRING),
    ("delivery_partner_id", STRING), ("store_id", STRING),
)
CUSTOMERS = _struct(
    ("customer_id", STRING), ("customer_name", STRING), ("email", STRING), ("phone", STRING),
    ("address", STRING), ("area", STRING), ("pincode", STRING), ("registration_date", DATE),
    ("customer_segment", STRING), ("total_orders", INT), ("avg_order_value", DOUBLE),
)
DELIVERY_PERFORMANCE = _struct(
    ("order_id", STRING), ("delivery_partner_id", STRING), ("promised_time", TIMESTAMP),
    ("actual_time", TIMESTAMP), ("delivery_time_minutes", DOUBLE), ("distance_km", DOUBLE),
    ("delivery_status", STRING), ("reasons_if_delayed", STRING),
)
PRODUCTS = _struct(
    ("product_id", STRING), ("product_name", STRING), ("category", STRING), ("subcategory", STRING),
    ("price", DOUBLE), ("brand", STRING), ("description", STRING), ("is_available", BOOL),
)
ORDER_ITEMS = _struct(
    ("order_item_id", STRING), ("order_id", STRING), ("product_id", STRING), ("quantity", INT),
    ("unit_price", DOUBLE), ("total_price", DOUBLE),
)
INVENTORY = _struct(
    ("product_id", STRING), ("store_id", STRING), ("quantity_available", INT), ("reorder_level", INT),
    ("last_updated", TIMESTAMP),
)
MARKETING_PERFORMANCE = _struct(
    ("campaign_id", STRING), ("campaign_name", STRING), ("start_date", DATE), ("end_date", DATE),
    ("budget", DOUBLE), ("spent", DOUBLE), ("impressions", INT), ("clicks", INT), ("conversions", INT),
)
CUSTOMER_FEEDBACK = _struct(
    ("feedback_id", STRING), ("order_id", STRING), ("customer_id", STRING), ("rating", INT),
    ("feedback_text", STRING), ("feedback_date", TIMESTAMP), ("category", STRING),
)

# --- fixed values: logical table -> schema ----------------------------------------------------------
TABLE_SCHEMAS: dict[str, StructType] = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "delivery_performance": DELIVERY_PERFORMANCE,
    "products": PRODUCTS,
    "order_items": ORDER_ITEMS,
    "inventory": INVENTORY,
    "marketing_performance": MARKETING_PERFORMANCE,
    "customer_feedback": CUSTOMER_FEEDBACK,
}

# Tables that continue past the raw layer.
CLEANED_TABLES = ("orders", "customers", "delivery_performance")
