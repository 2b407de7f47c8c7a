"""Adapter from the driver's TPC-H-style tables to the four raw retail tables
(customers, sessions, orders, products) plus real order lines.

Every order, line, event and part is used. Signups are spread over the whole
range of order dates; a customer's sessions begin at the signup (a few stand
some hours before it, as early visits do). All mappings are plain column
expressions and joins, so the same rows come out of the oracle SQL.
Identifiers stay BIGINT (c_custkey, o_orderkey, p_partkey, event_id).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisle.functions.rules import ladder

# ---- fixed values of the adapter -------------------------------------------
SIGNUP_ORIGIN = dt.date(1995, 1, 1)       # signup = origin + (custkey * 37) % SIGNUP_DAYS days
SIGNUP_DAYS = 2400                        # 1995-01-01 to 2001-07-28; orders end 2001-08-01
EVENT_ORIGIN = "2024-01-01 00:00:00"      # events start (January 2024)
TIME_SQUEEZE = 2                          # session time passes at half the events' pace
EARLY_VISIT_HOURS = 6                     # sessions start this long before the signup day
CUSTOMERS_PER_USER = 10                   # see session_customer
DISCOUNT_SHARE_PCT = 5                    # discount kept when > 5 % of subtotal
# part type -> retail category (six types, six categories)
TYPE_TO_CATEGORY = [
    ("ECONOMY", "Tops"),
    ("LARGE", "Outerwear"),
    ("MEDIUM", "Bottoms"),
    ("PROMO", "Accessories"),
    ("SMALL", "Shoes"),
    ("STANDARD", "Dresses"),
]
# columns that the adapter reads; a declared schema saves a job per table
DRIVER_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


class Tables:
    """Lazy parquet readers for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir.rstrip('/')}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            reader = self.spark.read
            if name in DRIVER_SCHEMAS:
                reader = reader.schema(DRIVER_SCHEMAS[name])
            self._cache[name] = reader.parquet(self.path(name))
        return self._cache[name]


def _category_of_type(p_type: Column) -> Column:
    return ladder([(p_type == t, c) for t, c in TYPE_TO_CATEGORY], F.lit(None).cast("string"))


def signup_date(customer_id: Column) -> Column:
    return F.date_add(F.lit(SIGNUP_ORIGIN), F.pmod(customer_id * 37, F.lit(SIGNUP_DAYS)).cast("int"))


def session_customer(user_id: Column, event_id: Column) -> Column:
    """A user's events are dealt to ten customers: every other block of ten
    events goes to the first one (a frequent visitor), the rest one each."""
    slot = F.when(F.pmod(F.floor(event_id / CUSTOMERS_PER_USER), F.lit(2)) == 0,
                  F.pmod(event_id, F.lit(CUSTOMERS_PER_USER))).otherwise(F.lit(0))
    return user_id * CUSTOMERS_PER_USER + slot


def raw_customers(t: Tables) -> DataFrame:
    c = t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    # nation is the fixed 25-row TPC-H dimension: a broadcast with a known bound
    n = F.broadcast(t["nation"].select("n_nationkey", "n_name"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                signup_date(F.col("c_custkey")).alias("signup_date"),
                F.col("c_mktsegment").alias("acquisition_channel"),
                F.col("n_name").alias("country"),
                (F.col("c_acctbal") > 0).alias("email_subscriber"),
                F.concat(F.lit("P"), F.pmod(F.col("c_custkey"), F.lit(6)).cast("string")).alias("persona_actual"),
            ))


def order_lines(t: Tables) -> DataFrame:
    """Per-order line aggregates with exact integer money."""
    li = t["lineitem"].select("l_orderkey", "l_extendedprice", "l_discount", "l_returnflag")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    disc_pct = F.round(F.col("l_discount") * 100).cast("long")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(cents).alias("price_cents"),
        F.sum(cents * disc_pct).alias("discount_e4"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_returned"),
    )


def raw_orders(t: Tables) -> DataFrame:
    o = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    lines = order_lines(t)
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    price = F.coalesce(F.col("price_cents"), F.lit(0))
    disc = F.coalesce(F.col("discount_e4"), F.lit(0))
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.lit(None).cast("long").alias("session_id"),
        F.col("o_orderdate").alias("order_date"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("int").alias("num_items"),
        (price.cast("double") / F.lit(100000.0)).alias("subtotal"),
        F.when(disc > price * DISCOUNT_SHARE_PCT, disc.cast("double") / F.lit(10000000.0))
        .otherwise(F.lit(0.0)).alias("discount"),
        (F.col("o_totalprice") / F.lit(1000.0)).alias("total"),
        (F.coalesce(F.col("n_returned"), F.lit(0)) * 2 > F.coalesce(F.col("n_lines"), F.lit(0))).alias("returned"),
    )


def raw_sessions(t: Tables) -> DataFrame:
    return sessions_from_events(t["events"])


def sessions_from_events(events: DataFrame, clock: bool = False) -> DataFrame:
    """Events as sessions; works on a batch or a streaming DataFrame. ``clock``
    adds ``event_time``, when the event itself was made."""
    e = events.select("event_id", "user_id", "ts", "event_type")
    e = e.withColumn("customer_id", session_customer(F.col("user_id"), F.col("event_id")))
    e = e.withColumn("signup", signup_date(F.col("customer_id")).cast("timestamp_ntz"))
    start = F.expr(
        f"timestampadd(MICROSECOND, timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EVENT_ORIGIN}', ts) div {TIME_SQUEEZE}"
        f" - {EARLY_VISIT_HOURS * 3_600_000_000}, signup)")
    return e.select(
        F.col("event_id").alias("session_id"),
        "customer_id",
        start.alias("session_start"),
        (F.pmod(F.col("event_id"), F.lit(12)) + 1).cast("int").alias("num_products_viewed"),
        F.pmod(F.col("event_id"), F.lit(4)).cast("int").alias("num_cart_adds"),
        (F.col("event_type") == "purchase").alias("purchased"),
        *([F.col("ts").cast("timestamp").alias("event_time")] if clock else []),
    )


def raw_products(t: Tables) -> DataFrame:
    p = t["part"].select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        _category_of_type(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("brand"),
        (F.col("p_retailprice") / F.lit(10.0)).alias("base_price"),
        (F.lit(3.0) + F.pmod(F.col("p_partkey"), F.lit(21)).cast("double") / F.lit(10.0)).alias("avg_rating"),
        (F.col("p_size") * 7).cast("int").alias("num_reviews"),
    )


def raw_order_lines(t: Tables) -> DataFrame:
    """Real order lines with their part as the product, for basket analysis on
    actual baskets. Lines without an order or a part do not count. They meet the orders
    last, so that they stay dealt out by order for what follows."""
    o = t["orders"].select("o_orderkey")
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    p = t["part"].select("p_partkey", "p_type", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner").join(o, li.l_orderkey == o.o_orderkey, "inner")
    cat = F.lower(_category_of_type(F.col("p_type")))
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_partkey").alias("product_id"),
        cat.alias("category"),
        F.col("p_brand").alias("brand"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("line_value"),
    )
