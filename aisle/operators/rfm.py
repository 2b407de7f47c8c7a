"""Customer RFM scores, segments and behavioural flags.

J3 (the product) aggregates orders and sessions per customer *before* joining
them to customers, so each side shuffles once on customer_id and the joins
are 1:1. J2 reproduces the reference's naive version, whose sessions x orders
fan-out multiplies order sums by the session count; it never materialises
that product: the multiplication is applied to the pre-aggregated sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisle.functions import rules
from aisle.functions.dates import lit_date
from aisle.functions.exact import MONEY_SCALE
from aisle.params import DEFAULT, Params


def order_metrics(orders: DataFrame) -> DataFrame:
    """Per-customer order aggregates (exact money in ``monetary_units``)."""
    return orders.groupBy("customer_id").agg(
        F.max("ordered_at").alias("last_order_date"),
        F.count(F.lit(1)).alias("frequency_orders"),
        F.sum("total_units").alias("monetary_units"),
        F.sum("num_items").alias("total_items_purchased"),
        F.sum(F.when(F.col("returned"), 1).otherwise(0)).cast("long").alias("returned_orders"),
        F.sum(F.when(F.col("used_discount"), 1).otherwise(0)).cast("long").alias("orders_with_discount"),
    )


def session_counts(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_sessions"))


def _scored(df: DataFrame, p: Params, returner_col: str) -> DataFrame:
    r = rules.r_score(F.col("recency_days"))
    f = rules.f_score(F.col("frequency_orders"))
    m = rules.m_score(F.col("monetary_total"))
    df = df.withColumn("r_score", r).withColumn("f_score", f).withColumn("m_score", m)
    freq = F.when(F.col("frequency_orders") != 0, F.col("frequency_orders").cast("double"))
    return (df
            .withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
            .withColumn("rfm_segment", rules.rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score")))
            .withColumn("is_browser_only", rules.flag((F.col("total_sessions") > 0) & (F.col("frequency_orders") == 0)))
            .withColumn(returner_col, rules.flag(F.col("returned_orders") / freq > p.high_returner_rate))
            .withColumn("discount_seeker", rules.flag(F.col("orders_with_discount") / freq > p.discount_seeker_rate)))


def rfm_v2(customers: DataFrame, orders: DataFrame, sessions: DataFrame, p: Params = DEFAULT) -> DataFrame:
    co = order_metrics(orders)
    cs = session_counts(sessions)
    c = customers.select("customer_id", "signed_up_at", "acquisition_channel", "country", "persona_hidden")
    j = c.join(co, "customer_id", "left").join(cs, "customer_id", "left")
    units = F.coalesce(F.col("monetary_units"), F.lit(0))
    freq = F.coalesce(F.col("frequency_orders"), F.lit(0))
    metrics = j.select(
        "customer_id", "signed_up_at", "acquisition_channel", "country", "persona_hidden",
        "last_order_date",
        F.datediff(lit_date(p.as_of), F.col("last_order_date")).alias("recency_days"),
        freq.alias("frequency_orders"),
        (units.cast("double") / F.lit(MONEY_SCALE)).alias("monetary_total"),
        F.coalesce(F.col("total_items_purchased"), F.lit(0)).cast("long").alias("total_items_purchased"),
        F.when(freq > 0, units.cast("double") / (freq * MONEY_SCALE).cast("double"))
        .otherwise(F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(F.col("returned_orders"), F.lit(0)).alias("returned_orders"),
        F.coalesce(F.col("orders_with_discount"), F.lit(0)).alias("orders_with_discount"),
        F.coalesce(F.col("total_sessions"), F.lit(0)).alias("total_sessions"),
        units.alias("monetary_units"),
    )
    return _scored(metrics, p, "high_returner")


def rfm_naive_fanout(customers: DataFrame, orders: DataFrame, sessions: DataFrame,
                     p: Params = DEFAULT) -> DataFrame:
    """Reference v1: customers LEFT JOIN sessions LEFT JOIN orders, then
    aggregate. Sums over orders repeat once per session (greatest(s, 1));
    distinct counts, max and avg are unaffected."""
    co = order_metrics(orders)
    cs = session_counts(sessions)
    c = customers.select("customer_id", "signed_up_at", "acquisition_channel", "country", "persona_hidden")
    j = c.join(co, "customer_id", "left").join(cs, "customer_id", "left")
    fan = F.greatest(F.coalesce(F.col("total_sessions"), F.lit(0)), F.lit(1))
    units = F.coalesce(F.col("monetary_units"), F.lit(0))
    freq = F.coalesce(F.col("frequency_orders"), F.lit(0))
    metrics = j.select(
        "customer_id", "signed_up_at", "acquisition_channel", "country", "persona_hidden",
        "last_order_date",
        F.datediff(lit_date(p.as_of), F.col("last_order_date")).alias("recency_days"),
        freq.alias("frequency_orders"),
        ((units * fan).cast("double") / F.lit(MONEY_SCALE)).alias("monetary_total"),
        F.coalesce(F.col("total_sessions"), F.lit(0)).alias("total_sessions"),
        (F.coalesce(F.col("total_items_purchased"), F.lit(0)) * fan).cast("long").alias("total_items_purchased"),
        F.when(freq > 0, units.cast("double") / (freq * MONEY_SCALE).cast("double"))
        .otherwise(F.lit(0.0)).alias("avg_order_value"),
        (F.coalesce(F.col("returned_orders"), F.lit(0)) * fan).alias("returned_orders"),
        (F.coalesce(F.col("orders_with_discount"), F.lit(0)) * fan).alias("orders_with_discount"),
    )
    return _scored(metrics, p, "higher_returner")


def segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("monetary_units").alias("monetary_units"),
        F.sum("frequency_orders").alias("orders"),
    )
