"""Raw -> processed table transforms (T1-T3) and the completeness profile (T4).

Each transform is a handful of ``withColumns`` stages that Catalyst collapses into one projection, so a
table is cleaned in a single map-only pass (no shuffle), and columns the caller does not use are pruned
back to the scan. Stage order matters and is kept: cast -> round -> defaults -> range-null -> derive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleaners as C
from tidemark.functions import derived as D

# --- fixed values: cleaning range limits (closed intervals; None = open side) -----------------------
ORDER_TOTAL_RANGE = (0, None)
STORE_ID_RANGE = (1, None)
TOTAL_ORDERS_RANGE = (0, None)
AVG_ORDER_VALUE_RANGE = (0, None)
PINCODE_RANGE = (100000, 999999)
DELIVERY_MINUTES_RANGE = (-60, 300)
DISTANCE_KM_RANGE = (0, 50)
ON_TIME_STATUS = "On Time"
PREMIUM_SEGMENT = "Premium"


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def _ranged(df: DataFrame, name: str, bounds: tuple) -> Column:
    return C.in_range_or_null(name, bounds[0], bounds[1], dtype=_dtype(df, name))


def clean_orders(df: DataFrame) -> DataFrame:
    """Processed orders (+ delivery_time_minutes, is_on_time, order_month, order_year)."""
    df = df.withColumns({
        "order_date": C.as_timestamp("order_date", _dtype(df, "order_date")),
        "promised_delivery_time": C.as_timestamp("promised_delivery_time", _dtype(df, "promised_delivery_time")),
        "actual_delivery_time": C.as_timestamp("actual_delivery_time", _dtype(df, "actual_delivery_time")),
        "order_total": C.round2("order_total"),
        "delivery_status": C.title_or_default("delivery_status"),
        "payment_method": C.title_or_default("payment_method"),
    })
    df = df.withColumns({
        "order_total": _ranged(df, "order_total", ORDER_TOTAL_RANGE),
        "store_id": _ranged(df, "store_id", STORE_ID_RANGE),
    })
    return df.withColumns({
        "delivery_time_minutes": D.minutes_between("promised_delivery_time", "actual_delivery_time"),
        "is_on_time": D.flag_equals("delivery_status", ON_TIME_STATUS),
        "order_month": D.year_month("order_date"),
        "order_year": D.year_of("order_date"),
    })


def clean_customers(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Processed customers (+ customer_age_days, is_premium, registration_year).

    Null defaults run before the range check, so a negative average becomes null, not 0.
    ``as_of`` fixes the reference date of the age (default: today).
    """
    df = df.withColumns({
        "customer_name": C.trimmed("customer_name"),
        "address": C.trimmed("address"),
        "area": C.trimmed("area"),
        "email": C.standard_email("email"),
        "phone": C.phone_digits("phone"),
        "registration_date": C.as_date("registration_date", _dtype(df, "registration_date")),
        "customer_segment": C.title_or_default("customer_segment"),
        "total_orders": C.default_if_null("total_orders", 0),
        "avg_order_value": C.default_if_null(C.round2("avg_order_value"), 0.0),
    })
    df = df.withColumns({
        "total_orders": _ranged(df, "total_orders", TOTAL_ORDERS_RANGE),
        "avg_order_value": _ranged(df, "avg_order_value", AVG_ORDER_VALUE_RANGE),
        "pincode": _ranged(df, "pincode", PINCODE_RANGE),
    })
    return df.withColumns({
        "customer_age_days": D.age_days("registration_date", as_of),
        "is_premium": D.flag_equals("customer_segment", PREMIUM_SEGMENT),
        "registration_year": D.year_of("registration_date"),
    })


def clean_delivery(df: DataFrame, minutes_range: tuple = DELIVERY_MINUTES_RANGE,
                   distance_range: tuple = DISTANCE_KM_RANGE) -> DataFrame:
    """Processed delivery (+ is_delayed, delay_category, delivery_efficiency).

    The range check runs before the derivations: an out-of-range time becomes null, hence
    'Significant Delay' and not delayed.
    """
    df = df.withColumns({
        "promised_time": C.as_timestamp("promised_time", _dtype(df, "promised_time")),
        "actual_time": C.as_timestamp("actual_time", _dtype(df, "actual_time")),
        "delivery_time_minutes": C.round2("delivery_time_minutes"),
        "distance_km": C.round2("distance_km"),
        "delivery_status": C.title_or_default("delivery_status"),
        "reasons_if_delayed": C.trimmed_or_default("reasons_if_delayed", "None"),
    })
    df = df.withColumns({
        "delivery_time_minutes": _ranged(df, "delivery_time_minutes", minutes_range),
        "distance_km": _ranged(df, "distance_km", distance_range),
    })
    return df.withColumns({
        "is_delayed": D.is_delayed("delivery_time_minutes"),
        "delay_category": D.delay_category("delivery_time_minutes"),
        "delivery_efficiency": D.efficiency("delivery_time_minutes", "distance_km"),
    })


def stamp_processed(df: DataFrame, processed_at: Column | None = None, score: Column | float = 1.0) -> DataFrame:
    """P10: processing time and a quality score column (1.0 until rules have run)."""
    return df.withColumns({
        "_processed_timestamp": processed_at if processed_at is not None else F.current_timestamp(),
        "_data_quality_score": score if isinstance(score, Column) else F.lit(float(score)),
    })


# --- fixed values: columns profiled per table (output name, source column) --------------------------
PROFILE_COLUMNS = {
    "orders": (("non_null_order_ids", "order_id"), ("non_null_customer_ids", "customer_id"),
               ("non_null_order_totals", "order_total"), ("delivery_status_available", "is_on_time")),
    "customers": (("non_null_customer_ids", "customer_id"), ("valid_emails", "email"),
                  ("valid_phones", "phone"), ("segments_available", "customer_segment")),
    "delivery_performance": (("non_null_order_ids", "order_id"), ("delivery_times_available", "delivery_time_minutes"),
                             ("distances_available", "distance_km"), ("delay_status_available", "is_delayed")),
}


def profile_measures(table: str) -> list[Column]:
    """total_rows and the non-null count of each profiled column."""
    return [F.count(F.lit(1)).alias("total_rows"), *[F.count(src).alias(out) for out, src in PROFILE_COLUMNS[table]]]


def profile_schema(table: str) -> str:
    """The columns of the profile, as a schema text."""
    return ", ".join(f"{c} bigint" for c in ("total_rows", *[out for out, _ in PROFILE_COLUMNS[table]]))


def completeness_profile(df: DataFrame, table: str) -> DataFrame:
    """T4: one row: total_rows and the non-null count of each profiled column, in one aggregation pass."""
    return df.agg(*profile_measures(table))
