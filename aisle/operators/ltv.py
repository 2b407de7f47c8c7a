"""J7a LTV forecast v2, J7b LTV forecast v1 (cohort revenue curve), J19.

v2: per clustered customer, months active and days since last order; churn by
a rule ladder; the cluster's average monthly spend (a <= 6-row table, joined
by broadcast) times the remaining months times retention.

v1: cohort-month x cluster x months-since-signup revenue, averaged per
cluster and month into a curve, joined to each customer's future months with a
range residual (C6), grouped with the curve value in the key, and summed per
customer over those grouped rows (E3). The curve also holds months before
signup (orders may come first) and so grows with the calendar; the join needs
months 1 to 12 only (no signup lies after ``as_of``), 6 x 12 rows, broadcast.
Money per month is carried as integer nano-dollars so equal curve values
group together exactly and sums do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisle.functions import rules
from aisle.functions.dates import lit_date, month_boundaries, trunc_date
from aisle.functions.exact import MONEY_SCALE, RATE_SCALE, cents_of, big_half_up_div, mean_to, money_to_units
from aisle.params import DEFAULT, Params

UNITS_TO_NANO = RATE_SCALE // MONEY_SCALE     # 1e-5 dollar units -> 1e-9 dollars


def _current_state(customers: DataFrame, orders: DataFrame, clusters: DataFrame, p: Params) -> DataFrame:
    last = orders.groupBy("customer_id").agg(F.max("ordered_at").alias("last_order_date"))
    cl = clusters.select("customer_id", "cluster_name",
                         F.col("monetary_total").alias("actual_ltv_to_date"),
                         F.col("monetary_units").alias("actual_ltv_units"),
                         F.col("frequency_orders").alias("orders_to_date"), "total_sessions")
    asof = lit_date(p.as_of)
    return (cl.join(customers.select("customer_id", "signed_up_at"), "customer_id", "inner")
            .join(last, "customer_id", "left")
            .withColumn("months_active", month_boundaries(F.col("signed_up_at"), asof))
            .withColumn("days_since_last_order", F.datediff(asof, F.col("last_order_date"))))


def cluster_velocity(state: DataFrame) -> DataFrame:
    """Average of (ltv / months active) per cluster, months active > 0."""
    m = F.col("months_active")
    per = big_half_up_div(F.col("actual_ltv_units").cast("decimal(38,0)") * UNITS_TO_NANO, m.cast("decimal(38,0)"))
    return (state.filter(m > 0).groupBy("cluster_name")
            .agg(F.sum(per).alias("_v"), F.count(F.lit(1)).alias("_n"))
            .select("cluster_name",
                    (F.col("_v").cast("double") / (F.col("_n") * RATE_SCALE).cast("double")).alias("avg_monthly_spend")))


def ltv_forecast_v2(customers: DataFrame, orders: DataFrame, clusters: DataFrame,
                    p: Params = DEFAULT) -> DataFrame:
    state = _current_state(customers, orders, clusters, p)
    velocity = cluster_velocity(state)       # one row per cluster: <= 6 rows
    churn = rules.churn_probability(F.col("days_since_last_order"), null_is_never=True)
    f = (state.join(F.broadcast(velocity), "cluster_name", "left")
         .withColumn("churn_probability", churn))
    future = (F.col("avg_monthly_spend") * F.greatest(F.lit(0), F.lit(p.horizon_months) - F.col("months_active"))
              * (F.lit(1.0) - F.col("churn_probability")))
    f = f.withColumn("predicted_future_revenue", future)
    total = F.col("actual_ltv_to_date") + F.coalesce(F.col("predicted_future_revenue"), F.lit(0.0))
    f = f.withColumn("predicted_12m_ltv", total)
    return f.select(
        "customer_id", "signed_up_at", "cluster_name", "actual_ltv_to_date", "orders_to_date",
        "total_sessions", "months_active", "days_since_last_order", "churn_probability",
        "predicted_future_revenue", "avg_monthly_spend", "predicted_12m_ltv",
        rules.value_tier(F.col("predicted_12m_ltv")).alias("value_tier"),
        rules.risk_status(F.col("churn_probability"), F.col("actual_ltv_to_date"), p.strict_half).alias("risk_status"),
        "actual_ltv_units",
    )


def cluster_revenue_curve(customers: DataFrame, orders: DataFrame, clusters: DataFrame,
                          p: Params = DEFAULT) -> DataFrame:
    c = customers.select("customer_id", "signed_up_at")
    cl = clusters.select("customer_id", "cluster_name")
    o = orders.select("customer_id", "ordered_at", "total_units")
    msince = month_boundaries(F.col("signed_up_at"), F.col("ordered_at"))
    cohort = (c.join(cl, "customer_id", "inner").join(o, "customer_id", "inner")
              .withColumn("months_since_signup", msince)
              .filter(F.col("months_since_signup") <= p.horizon_months)
              .groupBy(trunc_date(F.col("signed_up_at"), "month").alias("cohort_month"),
                       "cluster_name", "months_since_signup")
              .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_units").alias("revenue_units")))
    nano = F.lit(UNITS_TO_NANO).cast("decimal(38,0)")
    aov = big_half_up_div(F.col("revenue_units").cast("decimal(38,0)") * nano, F.col("orders").cast("decimal(38,0)"))
    curve = cohort.groupBy("cluster_name", "months_since_signup").agg(
        F.count(F.lit(1)).alias("cohorts"),
        F.sum(aov).alias("_aov"),
        F.sum("orders").alias("_orders"),
        F.sum("revenue_units").alias("_rev"))
    rev_nano = big_half_up_div(F.col("_rev").cast("decimal(38,0)") * nano, F.col("cohorts").cast("decimal(38,0)"))
    return curve.select(
        "cluster_name", "months_since_signup",
        (F.col("_aov").cast("double") / (F.col("cohorts") * RATE_SCALE).cast("double")).alias("typical_order_value"),
        (F.col("_orders").cast("double") / F.col("cohorts").cast("double")).alias("typical_order_count"),
        (rev_nano.cast("double") / F.lit(float(RATE_SCALE))).alias("typical_monthly_revenue"),
        rev_nano.cast("long").alias("monthly_revenue_nano"),
    )


def future_curve(curve: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The curve's months 1 to the horizon: at most 12 rows per cluster."""
    return curve.filter(F.col("months_since_signup").between(1, p.horizon_months)).select(
        "cluster_name", "months_since_signup", "monthly_revenue_nano")


def ltv_forecast_v1(customers: DataFrame, orders: DataFrame, clusters: DataFrame, curve: DataFrame,
                    p: Params = DEFAULT) -> DataFrame:
    state = _current_state(customers, orders, clusters, p).withColumn(
        "months_remaining", F.lit(p.horizon_months) - F.col("months_active"))
    churn = rules.churn_probability(F.col("days_since_last_order"), null_is_never=False)
    crv = F.broadcast(future_curve(curve, p))
    s, c = state.alias("s"), crv.alias("c")
    cond = ((F.col("s.cluster_name") == F.col("c.cluster_name"))
            & (F.col("c.months_since_signup") > F.col("s.months_active")))
    keys = ["customer_id", "signed_up_at", "cluster_name", "actual_ltv_to_date", "orders_to_date",
            "months_active", "months_remaining", "days_since_last_order"]
    j = s.join(c, cond, "left").select(*[F.col(f"s.{k}") for k in keys],
                                       F.col("c.months_since_signup"), F.col("c.monthly_revenue_nano"))
    rev = F.col("monthly_revenue_nano")
    month_k = [F.max(F.when(F.col("months_since_signup") == F.col("months_active") + k, rev).otherwise(0))
               .alias(f"_m{k}") for k in (1, 2, 3)]
    g = j.groupBy(*keys, "monthly_revenue_nano").agg(*month_k)
    # rows per customer <= distinct curve values (<= 12): a bounded window
    w = Window.partitionBy("customer_id")
    g = (g.withColumn("churn_probability", churn)
         .withColumn("_sum", F.sum("monthly_revenue_nano").over(w)))
    future = F.col("_sum").cast("double") / F.lit(float(RATE_SCALE)) * (F.lit(1.0) - F.col("churn_probability"))
    g = g.withColumn("predicted_future_revenue", future)
    total = F.col("actual_ltv_to_date") + F.coalesce(F.col("predicted_future_revenue"), F.lit(0.0))
    return g.select(
        *keys, "churn_probability", "predicted_future_revenue",
        *[(F.col(f"_m{k}").cast("double") / F.lit(float(RATE_SCALE))).alias(f"forecast_month_{k}") for k in (1, 2, 3)],
        total.alias("predicted_12m_ltv"),
        rules.value_tier(total).alias("value_tier"),
        rules.risk_status(F.col("churn_probability"), F.col("actual_ltv_to_date"), strict_half=False).alias("risk_status"),
    ).filter(F.col("cluster_name").isNotNull())


def ltv_by_persona(ltv: DataFrame) -> DataFrame:
    """Per cluster totals and averages of the v2 forecast."""
    d = ltv.filter(F.col("cluster_name").isNotNull()).withColumns({
        "_pred": money_to_units(F.col("predicted_12m_ltv")),
        "_future": money_to_units(F.col("predicted_future_revenue")),
        "_churn": F.round(F.col("churn_probability") * 100).cast("long")})
    n = F.count(F.lit(1))
    return d.groupBy("cluster_name").agg(
        n.alias("customers"),
        cents_of(F.sum("actual_ltv_units")).alias("total_current_ltv"),
        cents_of(F.sum("_pred")).alias("total_predicted_ltv"),
        cents_of(F.sum("_future")).alias("total_future_revenue"),
        mean_to(F.sum("actual_ltv_units"), n, MONEY_SCALE, 2).alias("avg_current_ltv"),
        mean_to(F.sum("_pred"), n, MONEY_SCALE, 2).alias("avg_predicted_ltv"),
        mean_to(F.sum("_future"), F.count("_future"), MONEY_SCALE, 2).alias("avg_future_revenue"),
        mean_to(F.sum("_churn"), n, 1, 1).alias("avg_churn_pct"),
    )
