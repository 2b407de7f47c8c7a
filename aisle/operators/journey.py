"""J5 customer journey: event timeline, milestones and first-30-day paths.

Sessions, purchases and returns (purchase date + 7 days) form one event
relation (G1 union with type coercion). Milestones need only counts and the
first time of each (customer, type, day), so the events are reduced to that
before any join; a hot customer is combined map-side. Paths are built in two
levels: the events of a customer's day are concatenated first, the days after
the join with the signup date. The event sequence number uses the skew-safe row
number. Order is total: (ts, type, id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisle.functions.dates import date_plus_days_ts, day_boundaries, week_bucket
from aisle.operators.relational import row_number_by
from aisle.params import DEFAULT, Params

PATH_SEPARATOR = " → "
DAY_MARK = "\x01"            # stands for the day since signup until the join
WEEKS = range(5)


def all_events(sessions: DataFrame, orders: DataFrame, p: Params = DEFAULT) -> DataFrame:
    s = sessions.select(
        "customer_id",
        F.col("session_started_at").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit("Session").alias("event_type"),
        F.col("num_products_viewed").cast("double").alias("event_value"),
        F.col("purchased").alias("led_to_purchase"),
        F.col("session_id").alias("source_id"),
    )
    o = orders.select("customer_id", "ordered_at", "total", "returned", "order_id")
    purchases = o.select(
        "customer_id", F.col("ordered_at").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit("Purchase").alias("event_type"), F.col("total").alias("event_value"),
        F.lit(True).alias("led_to_purchase"), F.col("order_id").alias("source_id"))
    returns = o.filter(F.col("returned") == F.lit(True)).select(
        "customer_id", date_plus_days_ts(F.col("ordered_at"), p.return_lag_days).alias("event_timestamp"),
        F.lit("Return").alias("event_type"), F.col("total").alias("event_value"),
        F.lit(False).alias("led_to_purchase"), F.col("order_id").alias("source_id"))
    return s.unionByName(purchases).unionByName(returns)


def events_with_context(customers: DataFrame, sessions: DataFrame, orders: DataFrame,
                        clusters: DataFrame, p: Params = DEFAULT) -> DataFrame:
    ev = all_events(sessions, orders, p)
    c = customers.select("customer_id", "signed_up_at")
    cl = clusters.select("customer_id", "cluster_name", "persona_hidden")
    days = day_boundaries(F.col("signed_up_at"), F.col("event_timestamp"))
    return (ev.join(c, "customer_id", "inner").join(cl, "customer_id", "left")
            .withColumn("days_since_signup", days)
            .withColumn("week_since_signup", week_bucket(days)))


def event_timeline(events: DataFrame) -> DataFrame:
    """Events with their per-customer sequence number."""
    return row_number_by(events, "customer_id", ["event_timestamp", "event_type", "source_id"],
                         out="event_sequence")


def daily_events(events: DataFrame) -> DataFrame:
    """(customer_id, event_type, event_date, events, first_at)."""
    return (events.groupBy("customer_id", "event_type", F.to_date("event_timestamp").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("events"), F.min("event_timestamp").alias("first_at")))


def milestones(daily: DataFrame, customers: DataFrame, clusters: DataFrame) -> DataFrame:
    day = day_boundaries(F.col("signed_up_at"), F.col("event_date"))
    known = (daily.join(customers.select("customer_id", "signed_up_at"), "customer_id", "inner")
             .withColumn("_day", day).withColumn("_week", week_bucket(day)))
    is_a = lambda kind: F.col("event_type") == kind
    n_in = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("events"))), F.lit(0)).cast("long")
    kinds = ["Session", "Purchase", "Return"]
    aggs = [F.min(F.when(is_a(k), F.col("first_at"))).alias(f"first_{k.lower()}") for k in kinds]
    aggs += [F.min(F.when(is_a(k), F.col("_day"))).alias(f"days_to_first_{k.lower()}") for k in kinds]
    aggs += [n_in(F.col("_week") == w).alias(f"week_{w}_events") for w in WEEKS]
    aggs += [n_in((F.col("_week") == w) & is_a("Purchase")).alias(f"week_{w}_purchases") for w in WEEKS]
    per = known.groupBy("customer_id", "signed_up_at").agg(*aggs)
    cl = clusters.select("customer_id", "cluster_name", "persona_hidden")
    return per.join(cl, "customer_id", "left").select(
        "customer_id", "cluster_name", "persona_hidden", *[c for c in per.columns if c != "customer_id"])


def path_element() -> F.Column:
    ty, v = F.col("event_type"), F.col("event_value")
    detail = (F.when(ty == "Purchase", F.concat(F.lit(" ($"), F.round(v, 0).cast("string"), F.lit(")")))
              .when(ty == "Session", F.concat(F.lit(" ("), F.round(v, 0).cast("string"), F.lit(" views)")))
              .otherwise(F.lit("")))
    return F.concat(ty, detail, F.lit(DAY_MARK))


def journey_paths(events: DataFrame, customers: DataFrame, p: Params = DEFAULT) -> DataFrame:
    def joined(column: str, order: str) -> F.Column:
        return F.expr(f"listagg({column}, '{PATH_SEPARATOR}') WITHIN GROUP (ORDER BY {order})")

    daily = (events.withColumn("_element", path_element()).withColumn("event_date", F.to_date("event_timestamp"))
             .groupBy("customer_id", "event_date")
             .agg(joined("_element", "event_timestamp, event_type, source_id").alias("_part")))
    day = day_boundaries(F.col("signed_up_at"), F.col("event_date"))
    shown = F.replace(F.col("_part"), F.lit(DAY_MARK), F.concat(F.lit(" [Day "), day.cast("string"), F.lit("]")))
    return (daily.join(customers.select("customer_id", "signed_up_at"), "customer_id", "inner")
            .filter(day <= p.journey_days).withColumn("_shown", shown)
            .groupBy("customer_id").agg(joined("_shown", "event_date").alias("journey_path")))


def customer_journey(events: DataFrame, customers: DataFrame, clusters: DataFrame, p: Params = DEFAULT) -> DataFrame:
    m = milestones(daily_events(events), customers, clusters)
    return m.join(journey_paths(events, customers, p), "customer_id", "left")
