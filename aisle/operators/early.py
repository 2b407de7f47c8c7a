"""J6 early signals, J11 early persona scoring, J23 prediction validation.

J6 counts sessions in the first ``early_days`` days after signup (and any
before it) with a filtered join, and takes "first order" figures. J11 turns
those signals into a persona with a first-match rule ladder and a broadcast
join to the five-row scorer dimension: no Python per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisle.functions.dates import day_boundaries
from aisle.functions.exact import pct2
from aisle.functions.rules import ladder
from aisle.operators import personas
from aisle.params import DEFAULT, Params


def first_orders(orders: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Value, items and discount of each customer's "first order": the earliest one
    ("true"), or the minima and any discount over all orders ("reference")."""
    disc = F.when(F.col("used_discount"), 1).otherwise(0)
    if p.first_order == "true":
        earliest = F.min_by(F.struct("total", "num_items", disc.alias("disc")), F.struct("ordered_at", "order_id"))
        return orders.groupBy("customer_id").agg(earliest.alias("_f")).select(
            "customer_id", F.col("_f.total").alias("first_order_value"), F.col("_f.num_items").alias("first_order_items"),
            F.col("_f.disc").alias("used_discount_first"))
    return orders.groupBy("customer_id").agg(F.min("total").alias("first_order_value"), F.min("num_items").alias("first_order_items"),
                                             F.max(disc).alias("used_discount_first"))


def early_signals(customers: DataFrame, sessions: DataFrame, orders: DataFrame,
                  clusters: DataFrame, p: Params = DEFAULT) -> DataFrame:
    c = customers.select("customer_id", "signed_up_at", "acquisition_channel")
    # one row per customer and day before the join: a hot customer's sessions
    # are combined map-side and never meet in one task
    daily = sessions.groupBy("customer_id", F.to_date("session_started_at").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("num_cart_adds").alias("_adds"), F.count("num_cart_adds").alias("_n_adds"),
        F.sum("num_products_viewed").alias("_views"), F.count("num_products_viewed").alias("_n_views"),
        F.sum(F.when(F.col("purchased"), 1).otherwise(0)).cast("long").alias("_bought"))
    days = day_boundaries(F.col("signed_up_at"), F.col("_day"))
    mean = lambda total, n: F.try_divide(F.sum(total).cast("double"), F.sum(n).cast("double"))
    es = (daily.join(c.select("customer_id", "signed_up_at"), "customer_id", "inner")
          .filter(days <= p.early_days)
          .groupBy("customer_id").agg(
              F.sum("_n").alias("sessions_first_7d"),
              mean("_adds", "_n_adds").alias("avg_cart_adds"),
              mean("_views", "_n_views").alias("avg_products_viewed"),
              F.sum("_bought").alias("purchases_first_7d"),
              F.min(F.when(F.col("_bought") > 0, days)).alias("days_to_first_purchase")))
    fo = first_orders(orders, p)
    cl = clusters.select("customer_id", "cluster_name", F.col("persona_hidden").alias("actual_persona"))
    j = c.join(es, "customer_id", "left").join(fo, "customer_id", "left").join(cl, "customer_id", "left")
    return j.select(
        "customer_id", "acquisition_channel",
        F.coalesce("sessions_first_7d", F.lit(0)).alias("sessions_first_7d"),
        F.coalesce("avg_products_viewed", F.lit(0.0)).alias("avg_products_viewed"),
        F.coalesce("avg_cart_adds", F.lit(0.0)).alias("avg_cart_adds"),
        F.coalesce("purchases_first_7d", F.lit(0)).alias("purchases_first_7d"),
        "days_to_first_purchase", "first_order_value", "first_order_items", "used_discount_first",
        "cluster_name", "actual_persona",
    )


def as_records(signals: DataFrame) -> DataFrame:
    """J6 rows in the scorer's record shape."""
    return signals.select(
        "customer_id",
        F.col("sessions_first_7d").cast("long").alias("sessions_first_7d"),
        F.col("avg_products_viewed").cast("double").alias("avg_products_viewed"),
        F.col("purchases_first_7d").cast("long").alias("purchases_first_7d"),
        F.col("first_order_value").cast("double").alias("first_order_value"),
        F.col("days_to_first_purchase").cast("long").alias("days_to_first_purchase"),
        (F.col("used_discount_first") == 1).alias("used_discount"),
    )


def predicted_persona(p: Params = DEFAULT) -> F.Column:
    s, n = F.col("sessions_first_7d"), F.coalesce(F.col("purchases_first_7d"), F.lit(0))
    d, v, u = F.col("days_to_first_purchase"), F.col("first_order_value"), F.col("used_discount")
    # Python truthiness of the reference: 0 / None / False are false
    quick = d.isNotNull() & ((d != 0) | F.lit(p.include_day_zero)) & (d <= 2)
    return ladder([
        ((s >= 15) & (n == 0), "Window Browser"),
        ((n >= 2) & quick, "VIP Loyalist"),
        (v.isNotNull() & (v != 0) & (v >= 300), "Big Ticket Buyer"),
        (F.coalesce(u, F.lit(False)), "Deal Hunter"),
    ], "Casual Shopper")


def reject_reason(rec: DataFrame) -> F.Column:
    """Input bounds of the scorer: counts and amounts must be >= 0."""
    checks = [("sessions_first_7d", "sessions_first_7d < 0"), ("avg_products_viewed", "avg_products_viewed < 0"),
              ("purchases_first_7d", "purchases_first_7d < 0"), ("first_order_value", "first_order_value < 0"),
              ("days_to_first_purchase", "days_to_first_purchase < 0")]
    reasons = [F.when(F.col(c) < 0, F.lit(msg)) for c, msg in checks]
    missing = F.when(F.col("sessions_first_7d").isNull(), F.lit("sessions_first_7d is required"))
    return F.concat_ws("; ", missing, *reasons)


def score_early(records: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """J11 for valid records: persona, confidence, ltv forecast, traits, actions."""
    rec = records.withColumn("_reject", reject_reason(records)).filter(F.col("_reject") == "")
    scored = rec.withColumn("predicted_persona", predicted_persona(p))
    dim = F.broadcast(personas.scorer_dim(records.sparkSession))
    return scored.join(dim, "predicted_persona", "left").select(
        "customer_id", "predicted_persona", "confidence", "ltv_forecast", "typical_ltv",
        "typical_sessions", "typical_orders", "monthly_velocity", "traits", "recommended_actions")


def rejected_inputs(records: DataFrame) -> DataFrame:
    return (records.withColumn("reject_reason", reject_reason(records))
            .filter(F.col("reject_reason") != "").select("customer_id", "reject_reason"))


def prediction_confusion(scored: DataFrame, clusters: DataFrame) -> DataFrame:
    """J23 (derived): predicted early persona against the assigned cluster."""
    dim = F.broadcast(personas.persona_dim(scored.sparkSession)
                      .select(F.col("persona").alias("predicted_persona"),
                              F.col("cluster_name").alias("predicted_cluster")))
    j = (scored.select("customer_id", "predicted_persona")
         .join(clusters.select("customer_id", F.col("cluster_name").alias("actual_cluster")), "customer_id", "inner")
         .join(dim, "predicted_persona", "left"))
    return j.groupBy("actual_cluster", "predicted_persona", "predicted_cluster").agg(
        F.count(F.lit(1)).alias("customers")).withColumn(
        "is_match", F.coalesce(F.col("actual_cluster") == F.col("predicted_cluster"), F.lit(False)))


def prediction_precision(confusion: DataFrame) -> DataFrame:
    return confusion.groupBy("predicted_persona").agg(
        F.sum("customers").alias("predicted"),
        F.sum(F.when(F.col("is_match"), F.col("customers")).otherwise(0)).alias("correct"),
    ).withColumn("precision_pct", pct2(F.col("correct"), F.col("predicted")))
