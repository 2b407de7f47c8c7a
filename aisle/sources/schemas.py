"""Explicit schemas of the four raw retail tables (products, customers,
sessions, orders) and of the request-style records used by the scorers."""

from pyspark.sql import types as T

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("base_price", T.DoubleType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("num_reviews", T.IntegerType()),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("acquisition_channel", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("email_subscriber", T.BooleanType()),
    T.StructField("persona_actual", T.StringType()),
])

SESSIONS = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("session_start", T.TimestampNTZType()),
    T.StructField("num_products_viewed", T.IntegerType()),
    T.StructField("num_cart_adds", T.IntegerType()),
    T.StructField("purchased", T.BooleanType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("num_items", T.IntegerType()),
    T.StructField("subtotal", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("returned", T.BooleanType()),
])

RAW = {"products": PRODUCTS, "customers": CUSTOMERS, "sessions": SESSIONS, "orders": ORDERS}

# early-signal record accepted by the rule scorer
EARLY_RECORD = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("sessions_first_7d", T.LongType()),
    T.StructField("avg_products_viewed", T.DoubleType()),
    T.StructField("purchases_first_7d", T.LongType()),
    T.StructField("first_order_value", T.DoubleType()),
    T.StructField("days_to_first_purchase", T.LongType()),
    T.StructField("used_discount", T.BooleanType()),
])
