"""J1 staging: rename, cast, normalise and derive, one row per raw row.

Besides the reference columns, ``stg_orders`` carries ``total_units``: the
order total as an integer number of 1e-5 dollars, so every later money sum is
exact and independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisle.functions.dates import trunc_date
from aisle.functions.exact import money_to_units
from aisle.functions.rules import flag


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.col("signup_date").cast("date").alias("signed_up_at"),
        F.lower(F.trim("acquisition_channel")).alias("acquisition_channel"),
        F.lower(F.trim("country")).alias("country"),
        "email_subscriber",
        F.col("persona_actual").alias("persona_hidden"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    ts = F.col("order_date").cast("timestamp_ntz")
    return orders.select(
        "order_id", "customer_id", "session_id",
        F.col("order_date").cast("date").alias("ordered_at"),
        "num_items", "subtotal", "discount", "total", "returned",
        trunc_date(ts, "day").alias("order_date_only"),
        trunc_date(ts, "week").alias("order_week"),
        trunc_date(ts, "month").alias("order_month"),
        flag(F.col("discount") > 0).alias("used_discount"),
        F.when(F.col("subtotal") > 0, F.col("discount") / F.col("subtotal") * 100)
        .otherwise(F.lit(0.0)).alias("discount_pct"),
        money_to_units(F.col("total")).alias("total_units"),
    )


def stg_sessions(sessions: DataFrame) -> DataFrame:
    ts = F.col("session_start").cast("timestamp_ntz")
    return sessions.select(
        "session_id", "customer_id",
        ts.alias("session_started_at"),
        "num_products_viewed", "num_cart_adds", "purchased",
        trunc_date(ts, "day").alias("session_date"),
        trunc_date(ts, "week").alias("session_week"),
        trunc_date(ts, "month").alias("session_month"),
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name",
        F.lower(F.trim("category")).alias("category"),
        F.lower(F.trim("brand")).alias("brand"),
        "base_price", "avg_rating", "num_reviews",
    )
