"""Elementary-operator queries, each on the staged relations.

Every entry pairs a Spark plan with its DuckDB twin. Names carry the
operator family: ``join_`` (2C), ``agg_`` (2D), ``win_`` (2E), ``sort_``
(2F), ``set_`` (2G), ``row_`` (2B, 2H, 2I).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisle.functions import rules
from aisle.functions.dates import date_plus_days_ts, day_boundaries, month_boundaries, week_bucket
from aisle.functions.exact import MONEY_SCALE, half_up_div, mean_to, moments, pct2, round_to, with_sample_std
from aisle.operators.relational import basket_lines, distinct_counts, ordered_concat, pair_counts, row_number_by
from aisle.plans import oracle
from aisle.plans.marts import Marts
from aisle.plans.registry import query
from aisle.session import shared_dir
from aisle.sources.files import query_views, scan_csv
from aisle.sources.tables import TableStore, lookup, store_by_key

r1, r2 = oracle.r1, oracle.r2


def both(name: str, sql: str):
    """Register a Spark query and its oracle SQL under one name."""
    def deco(fn):
        oracle.register(name, sql)
        return query(name)(fn)
    return deco


# ---- 2C joins ------------------------------------------------------------------
@both("join_left_zero_fill", """
SELECT c.customer_id, coalesce(co.frequency_orders, 0) AS frequency_orders,
       CAST(coalesce(co.monetary_units, 0) AS BIGINT) AS monetary_units, coalesce(cs.total_sessions, 0) AS total_sessions
FROM stg_customers c LEFT JOIN rfm_co co ON c.customer_id = co.customer_id
LEFT JOIN rfm_cs cs ON c.customer_id = cs.customer_id""")
def _(m: Marts) -> DataFrame:
    from aisle.operators.rfm import order_metrics, session_counts
    co, cs = order_metrics(m.orders), session_counts(m.sessions)
    return (m.customers.select("customer_id").join(co, "customer_id", "left").join(cs, "customer_id", "left")
            .select("customer_id", F.coalesce("frequency_orders", F.lit(0)).alias("frequency_orders"),
                    F.coalesce("monetary_units", F.lit(0)).alias("monetary_units"),
                    F.coalesce("total_sessions", F.lit(0)).alias("total_sessions")))


@both("join_inner", """
SELECT o.order_id, o.customer_id, c.signed_up_at, o.ordered_at
FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id""")
def _(m: Marts) -> DataFrame:
    return (m.orders.select("order_id", "customer_id", "ordered_at")
            .join(m.customers.select("customer_id", "signed_up_at"), "customer_id", "inner")
            .select("order_id", "customer_id", "signed_up_at", "ordered_at"))


@both("join_pair_lt", """
SELECT i1.product_id AS item_a, i2.product_id AS item_b, count(*) AS times, count(DISTINCT i1.order_id) AS baskets
FROM line_items i1 JOIN line_items i2 ON i1.order_id = i2.order_id AND i1.product_id < i2.product_id
GROUP BY 1, 2""")
def _(m: Marts) -> DataFrame:
    lines = m.stored(basket_lines(m.line_items, [], "order_id", "product_id"))
    return m.stored(pair_counts(lines, [], "order_id", "product_id", deduped=True))


@both("join_pair_ne", """
SELECT i1.category AS item_a, i2.category AS item_b, count(*) AS times, count(DISTINCT i1.order_id) AS baskets
FROM line_items i1 JOIN line_items i2 ON i1.order_id = i2.order_id AND i1.category <> i2.category
GROUP BY 1, 2""")
def _(m: Marts) -> DataFrame:
    lines = m.stored(basket_lines(m.line_items, [], "order_id", "category"))
    return m.stored(pair_counts(lines, [], "order_id", "category", ordered=True, deduped=True))


@both("join_range_residual", """
SELECT customer_id, months_active, months_since_signup, monthly_revenue_nano FROM ltv1_joined""")
def _(m: Marts) -> DataFrame:
    from aisle.operators.ltv import _current_state, future_curve
    st = _current_state(m.customers, m.orders, m.clusters, m.p).alias("s")
    c = F.broadcast(future_curve(m.cohort_curve, m.p)).alias("c")
    cond = ((F.col("s.cluster_name") == F.col("c.cluster_name"))
            & (F.col("c.months_since_signup") > F.col("s.months_active")))
    return st.join(c, cond, "left").select("s.customer_id", "s.months_active", "c.months_since_signup",
                                           "c.monthly_revenue_nano")


@both("join_scalar_stats", """
SELECT order_id, total_units,
       total - (SELECT CAST(sum(total_units) AS DOUBLE) / CAST(count(*) * 100000 AS DOUBLE) FROM stg_orders) AS total_vs_mean
FROM stg_orders""")
def _(m: Marts) -> DataFrame:
    mean = m.orders.agg((F.sum("total_units").cast("double")
                         / (F.count(F.lit(1)) * MONEY_SCALE).cast("double")).alias("mean")).scalar()
    return m.orders.select("order_id", "total_units", (F.col("total") - mean).alias("total_vs_mean"))


@both("join_multikey_left", """
SELECT b.cluster_name, b.order_id, b.product_id, t.total_orders
FROM (SELECT DISTINCT cluster_name, order_id, product_id FROM pa_items) b
LEFT JOIN pa_totals t ON b.cluster_name = t.cluster_name AND b.product_id = t.product_id""")
def _(m: Marts) -> DataFrame:
    it = m.affinity_items
    b = it.select("cluster_name", "order_id", "product_id").distinct()
    t = it.groupBy("cluster_name", "product_id").agg(F.countDistinct("order_id").alias("total_orders"))
    return b.join(t, ["cluster_name", "product_id"], "left").select("cluster_name", "order_id", "product_id",
                                                                   "total_orders")


@both("join_dim_lookup", """
SELECT l.order_id, l.line_number, l.part_id, p.product_name, p.category
FROM order_lines l LEFT JOIN stg_products p ON l.part_id = p.product_id""")
def _(m: Marts) -> DataFrame:
    # no hint: the catalogue grows with the data, so AQE picks broadcast
    # only when the measured side is under the broadcast threshold
    p = m.products.select(F.col("product_id").alias("part_id"), "product_name", "category")
    return m.order_lines.select("order_id", "line_number", "part_id").join(p, "part_id", "left").select(
        "order_id", "line_number", "part_id", "product_name", "category")


@both("join_left_filtered", """
SELECT c.customer_id, c.signed_up_at, cl.cluster_name
FROM stg_customers c LEFT JOIN clusters cl ON c.customer_id = cl.customer_id WHERE cl.cluster_name IS NOT NULL""")
def _(m: Marts) -> DataFrame:
    # a WHERE on the right side makes the left join an inner join
    return (m.customers.select("customer_id", "signed_up_at")
            .join(m.clusters.select("customer_id", "cluster_name"), "customer_id", "inner"))


@both("join_sample_k_per_key", """
SELECT category, CAST(slot - 1 AS INTEGER) AS slot, product_id
FROM (SELECT category, product_id, row_number() OVER (PARTITION BY category ORDER BY
             md5('-' || category || '-' || CAST(product_id AS VARCHAR)), product_id) AS slot
      FROM stg_products)
WHERE slot <= 3""")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import sample_per_key
    return sample_per_key(m.products, "category", "product_id", 3).select("category", "slot", "product_id")


# ---- 2D aggregates ---------------------------------------------------------------
@both("agg_count_sum_avg_min_max", """
SELECT customer_id, count(*) AS orders, CAST(sum(total_units) AS BIGINT) AS total_units,
       CAST(sum(total_units) AS DOUBLE) / CAST(count(*) * 100000 AS DOUBLE) AS avg_total,
       min(ordered_at) AS first_order, max(ordered_at) AS last_order, min(total) AS min_total, max(total) AS max_total
FROM stg_orders GROUP BY customer_id""")
def _(m: Marts) -> DataFrame:
    return m.orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_units").alias("total_units"),
        (F.sum("total_units").cast("double") / (F.count(F.lit(1)) * MONEY_SCALE).cast("double")).alias("avg_total"),
        F.min("ordered_at").alias("first_order"), F.max("ordered_at").alias("last_order"),
        F.min("total").alias("min_total"), F.max("total").alias("max_total"))


@both("agg_multi_count_distinct", """
SELECT cluster_name, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products, count(*) AS lines
FROM line_items GROUP BY cluster_name""")
def _(m: Marts) -> DataFrame:
    per = distinct_counts(m.line_items, "cluster_name", {"orders": "order_id", "products": "product_id"})
    lines = m.line_items.groupBy(F.col("cluster_name").alias("_c")).agg(F.count(F.lit(1)).alias("lines"))
    return per.join(lines, per.cluster_name.eqNullSafe(lines["_c"])).drop("_c")


@both("agg_conditional", """
SELECT customer_id,
       CAST(sum(CASE WHEN returned THEN 1 ELSE 0 END) AS BIGINT) AS returned_orders,
       CAST(sum(CASE WHEN used_discount THEN total_units ELSE 0 END) AS BIGINT) AS discounted_units,
       count(CASE WHEN num_items >= 4 THEN 1 END) AS large_orders,
       min(CASE WHEN returned THEN ordered_at END) AS first_return_order,
       max(CASE WHEN used_discount THEN ordered_at END) AS last_discounted_order
FROM stg_orders GROUP BY customer_id""")
def _(m: Marts) -> DataFrame:
    o = m.orders
    return o.groupBy("customer_id").agg(
        F.sum(F.when(F.col("returned"), 1).otherwise(0)).cast("long").alias("returned_orders"),
        F.sum(F.when(F.col("used_discount"), F.col("total_units")).otherwise(0)).alias("discounted_units"),
        F.count(F.when(F.col("num_items") >= 4, 1)).alias("large_orders"),
        F.min(F.when(F.col("returned"), F.col("ordered_at"))).alias("first_return_order"),
        F.max(F.when(F.col("used_discount"), F.col("ordered_at"))).alias("last_discounted_order"))


def _exact_std(q: str, s: str, n: str) -> str:
    """Sample standard deviation of integer 1e-5 units from exact sums."""
    return f"sqrt(CAST(CAST({n} AS HUGEINT) * {q} - {s} * {s} AS DOUBLE) / (CAST({n} AS DOUBLE) * ({n} - 1))) / 100000.0"


@both("agg_global_stats", """
SELECT n AS buyers, """ + oracle.exact_mean("s2", "n", 100000, 2) + """ AS avg_monetary,
       """ + r2(_exact_std("q2", "s2", "n")) + """ AS std_monetary, """ + r2(_exact_std("q1", "s1", "n")) + """ AS std_frequency,
       max_frequency
FROM cl_sums CROSS JOIN (SELECT max(frequency_orders) AS max_frequency FROM cl_buyers)""")
def _(m: Marts) -> DataFrame:
    b = m.rfm.filter(F.col("frequency_orders") > 0).select(
        "frequency_orders", F.col("monetary_units").alias("_m"), (F.col("frequency_orders") * MONEY_SCALE).alias("_f"))
    a = b.agg(F.count(F.lit(1)).alias("buyers"), F.max("frequency_orders").alias("max_frequency"), *moments("_m"), *moments("_f"))
    return with_sample_std(a, "_m", "_f").select("buyers", mean_to(F.col("_m_sum"), F.col("buyers"), MONEY_SCALE, 2).alias("avg_monetary"),
                    round_to(F.col("_m_std") / MONEY_SCALE, 2).alias("std_monetary"),
                    round_to(F.col("_f_std") / MONEY_SCALE, 2).alias("std_frequency"), "max_frequency")


@both("agg_string_ordered", """
SELECT order_id, string_agg(category, ' → ' ORDER BY line_number, product_id) AS categories
FROM order_lines GROUP BY order_id""")
def _(m: Marts) -> DataFrame:
    return ordered_concat(m.order_lines, "order_id", "category", ["line_number", "product_id"],
                          F.shiftright("line_number", 6), " → ", "categories")


@both("agg_string_sorted", """
SELECT order_id, string_agg(DISTINCT CAST(product_id AS VARCHAR), ', ' ORDER BY CAST(product_id AS VARCHAR)) AS products
FROM order_lines GROUP BY order_id""")
def _(m: Marts) -> DataFrame:
    once = m.order_lines.select("order_id", F.col("product_id").cast("string").alias("product_id")).distinct()
    return m.stored(ordered_concat(once, "order_id", "product_id", ["product_id"], F.substring("product_id", 1, 2), ", ", "products"))


@both("agg_group_by_expr", """
SELECT order_month, count(*) AS orders, CAST(sum(total_units) AS BIGINT) AS total_units
FROM stg_orders GROUP BY order_month""")
def _(m: Marts) -> DataFrame:
    return m.orders.groupBy(F.trunc("ordered_at", "month").alias("order_month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_units").alias("total_units"))


@both("agg_two_level", """
SELECT cluster_name, CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_orders_per_customer, count(*) AS customers
FROM (SELECT cl.cluster_name, o.customer_id, count(*) AS n
      FROM stg_orders o JOIN clusters cl ON o.customer_id = cl.customer_id GROUP BY 1, 2)
GROUP BY cluster_name""")
def _(m: Marts) -> DataFrame:
    per = (m.orders.join(m.clusters.select("customer_id", "cluster_name"), "customer_id", "inner")
           .groupBy("cluster_name", "customer_id").agg(F.count(F.lit(1)).alias("n")))
    return per.groupBy("cluster_name").agg(
        (F.sum("n").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_orders_per_customer"),
        F.count(F.lit(1)).alias("customers"))


@both("agg_avg_ratio", """
SELECT country, """ + r2("avg(o.discount / nullif(o.subtotal, 0))") + """ AS avg_discount_share, count(*) AS orders
FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id GROUP BY country""")
def _(m: Marts) -> DataFrame:
    o = m.orders.join(m.customers.select("customer_id", "country"), "customer_id", "inner")
    ratio = F.col("discount") / F.when(F.col("subtotal") != 0, F.col("subtotal"))
    return o.groupBy("country").agg(round_to(F.avg(ratio), 2).alias("avg_discount_share"),
                                    F.count(F.lit(1)).alias("orders"))


@both("agg_rollup_of_topk", """
SELECT value_tier, count(*) AS customers, CAST(sum(CAST(round(predicted_12m_ltv * 100.0) AS BIGINT)) AS DOUBLE) / 100.0 AS value
FROM (SELECT * FROM ltv_v2 ORDER BY predicted_12m_ltv DESC, customer_id LIMIT 50) GROUP BY value_tier""")
def _(m: Marts) -> DataFrame:
    top = m.ltv_v2.orderBy(F.col("predicted_12m_ltv").desc(), F.col("customer_id")).limit(50)
    return top.groupBy("value_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        (F.sum(F.round(F.col("predicted_12m_ltv") * 100.0).cast("long")).cast("double") / 100.0).alias("value"))


# ---- 2E windows ----------------------------------------------------------------
@both("win_row_number", """
SELECT order_id, customer_id, ordered_at,
       row_number() OVER (PARTITION BY customer_id ORDER BY ordered_at, order_id) AS order_sequence
FROM stg_orders""")
def _(m: Marts) -> DataFrame:
    return row_number_by(m.orders.select("order_id", "customer_id", "ordered_at"), "customer_id",
                         ["ordered_at", "order_id"], out="order_sequence")


@both("win_share_of_partition", """
SELECT cluster_name, primary_category, order_count,
       """ + oracle.pct2("order_count", "sum(order_count) OVER (PARTITION BY cluster_name)") + """ AS share_pct
FROM (SELECT cluster_name, primary_category, count(*) AS order_count FROM ca_pp GROUP BY 1, 2)""")
def _(m: Marts) -> DataFrame:
    from aisle.operators.basket import category_preferences
    from aisle.operators.relational import with_group_total
    prefs = category_preferences(m.orders, m.clusters).select("cluster_name", "primary_category", "order_count")
    s = with_group_total(prefs, "cluster_name", "order_count", "_total")
    return s.select("cluster_name", "primary_category", "order_count",
                    pct2(F.col("order_count"), F.col("_total")).alias("share_pct"))


@both("win_over_group", """
SELECT cluster_name, months_since_signup, count(*) AS cohorts,
       CAST(sum(sum(revenue_units)) OVER (PARTITION BY cluster_name) AS BIGINT) AS cluster_units
FROM ltv_cohort GROUP BY cluster_name, months_since_signup""")
def _(m: Marts) -> DataFrame:
    from aisle.functions.dates import trunc_date
    c = m.customers.select("customer_id", "signed_up_at")
    cl = m.clusters.select("customer_id", "cluster_name")
    o = m.orders.select("customer_id", "ordered_at", "total_units")
    cohort = (c.join(cl, "customer_id").join(o, "customer_id")
              .withColumn("months_since_signup", month_boundaries(F.col("signed_up_at"), F.col("ordered_at")))
              .filter(F.col("months_since_signup") <= m.p.horizon_months)
              .groupBy(trunc_date(F.col("signed_up_at"), "month").alias("cohort_month"), "cluster_name",
                       "months_since_signup")
              .agg(F.sum("total_units").alias("revenue_units")))
    g = cohort.groupBy("cluster_name", "months_since_signup").agg(
        F.count(F.lit(1)).alias("cohorts"), F.sum("revenue_units").alias("_u"))
    # a grouped row per cluster and month since signup: months, not customers
    return g.select("cluster_name", "months_since_signup", "cohorts",
                    F.sum("_u").over(Window.partitionBy("cluster_name")).alias("cluster_units"))


# ---- 2F sort / top-k, 2G set ----------------------------------------------------
@both("sort_multi", """
SELECT * FROM product_affinity ORDER BY cluster_name, times_bought_together DESC, product_a, product_b""")
def _(m: Marts) -> DataFrame:
    return m.product_affinity.orderBy("cluster_name", F.col("times_bought_together").desc(), "product_a", "product_b")


@both("sort_top_k", """
SELECT customer_id, cluster_name, predicted_12m_ltv FROM ltv_v2 ORDER BY predicted_12m_ltv DESC, customer_id LIMIT 50""")
def _(m: Marts) -> DataFrame:
    return (m.ltv_v2.select("customer_id", "cluster_name", "predicted_12m_ltv")
            .orderBy(F.col("predicted_12m_ltv").desc(), "customer_id").limit(50))


@both("sort_distinct_ordered", """
SELECT category_a AS category, max(times_bought_together) AS best_times FROM product_affinity
GROUP BY category_a ORDER BY best_times DESC, category LIMIT 5""")
def _(m: Marts) -> DataFrame:
    return (m.product_affinity.groupBy(F.col("category_a").alias("category"))
            .agg(F.max("times_bought_together").alias("best_times"))
            .orderBy(F.col("best_times").desc(), "category").limit(5))


@both("sort_arg_max", """
SELECT cluster_name, best_pair, best_lift FROM (
  SELECT cluster_name, product_a || ' + ' || product_b AS best_pair, lift AS best_lift,
         row_number() OVER (PARTITION BY cluster_name ORDER BY lift DESC, product_a, product_b) AS r
  FROM product_affinity) WHERE r = 1""")
def _(m: Marts) -> DataFrame:
    # arg-max with a total order: highest lift, then the smallest pair
    a = m.product_affinity
    key = F.struct((-F.col("lift")).alias("neg_lift"), F.col("product_a"), F.col("product_b"))
    return a.groupBy("cluster_name").agg(
        F.min_by(F.concat("product_a", F.lit(" + "), "product_b"), key).alias("best_pair"),
        F.max("lift").alias("best_lift"))


@both("set_union_all", "SELECT * FROM all_events")
def _(m: Marts) -> DataFrame:
    return m.events


# ---- 2B / 2H / 2I row-level -----------------------------------------------------
@both("row_filters", """
SELECT order_id, customer_id, total, num_items FROM stg_orders
WHERE returned = false AND total >= 40 AND total < 300 AND num_items IN (2, 3, 4) AND ordered_at IS NOT NULL""")
def _(m: Marts) -> DataFrame:
    o = m.orders
    return o.filter((F.col("returned") == F.lit(False)) & (F.col("total") >= 40) & (F.col("total") < 300)
                    & F.col("num_items").isin(2, 3, 4) & F.col("ordered_at").isNotNull()).select(
        "order_id", "customer_id", "total", "num_items")


@both("row_case_ladder", """
SELECT *, CASE WHEN total >= 300 THEN 'outerwear' WHEN total >= 150 THEN 'dresses' WHEN total >= 80 THEN 'shoes'
               WHEN total >= 40 THEN 'bottoms' ELSE 'tops' END AS primary_category,
       coalesce(discount_pct > 10, false) AS deep_discount, 'order' AS record_type
FROM (SELECT order_id, total, discount_pct FROM stg_orders)""")
def _(m: Marts) -> DataFrame:
    o = m.orders.select("order_id", "total", "discount_pct")
    return o.select("*", rules.primary_category(F.col("total")).alias("primary_category"),
                    rules.flag(F.col("discount_pct") > 10).alias("deep_discount"),
                    F.lit("order").alias("record_type"))


@both("row_explode_series", """
SELECT order_id, num_items, item_number,
       CASE WHEN item_number = 1 THEN primary_category
            WHEN item_number = 2 AND secondary_category IS NOT NULL THEN secondary_category
            ELSE primary_category END AS assigned_category
FROM bx_items""")
def _(m: Marts) -> DataFrame:
    from aisle.operators.relational import explode_count
    o = (m.orders.select("order_id", "total", "num_items")
         .withColumn("primary_category", rules.primary_category(F.col("total")))
         .withColumn("secondary_category", rules.secondary_category(F.col("num_items"))))
    it = explode_count(o, "num_items", "item_number")
    i = F.col("item_number")
    return it.select("order_id", "num_items", "item_number",
                     F.when(i == 1, F.col("primary_category"))
                     .when((i == 2) & F.col("secondary_category").isNotNull(), F.col("secondary_category"))
                     .otherwise(F.col("primary_category")).alias("assigned_category"))


@both("row_text_normalise", """
SELECT customer_id, acquisition_channel, country,
       upper(substr(country, 1, 1)) || substr(country, 2) AS country_title,
       split_part(acquisition_channel, 'e', 1) AS channel_head
FROM stg_customers""")
def _(m: Marts) -> DataFrame:
    c = m.customers
    return c.select("customer_id", "acquisition_channel", "country",
                    F.concat(F.upper(F.substring("country", 1, 1)), F.expr("substr(country, 2)")).alias("country_title"),
                    F.split_part(F.col("acquisition_channel"), F.lit("e"), F.lit(1)).alias("channel_head"))


@both("row_date_trunc", """
SELECT session_week, session_month, count(*) AS sessions FROM stg_sessions GROUP BY 1, 2""")
def _(m: Marts) -> DataFrame:
    return m.sessions.groupBy("session_week", "session_month").agg(F.count(F.lit(1)).alias("sessions"))


@both("row_day_month_diff", """
SELECT o.order_id, CAST(date_diff('day', c.signed_up_at, o.ordered_at) AS INTEGER) AS days_since_signup,
       CAST((year(o.ordered_at) * 12 + month(o.ordered_at)) - (year(c.signed_up_at) * 12 + month(c.signed_up_at)) AS INTEGER) AS months_since_signup,
       CAST(floor(date_diff('day', c.signed_up_at, o.ordered_at) / 7) AS BIGINT) AS week_since_signup
FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id""")
def _(m: Marts) -> DataFrame:
    o = m.orders.join(m.customers.select("customer_id", "signed_up_at"), "customer_id")
    d = day_boundaries(F.col("signed_up_at"), F.col("ordered_at"))
    return o.select("order_id", d.alias("days_since_signup"),
                    month_boundaries(F.col("signed_up_at"), F.col("ordered_at")).alias("months_since_signup"),
                    week_bucket(d).alias("week_since_signup"))


@both("row_date_interval", """
SELECT order_id, CAST(ordered_at + INTERVAL 7 DAY AS TIMESTAMP) AS return_at FROM stg_orders WHERE returned""")
def _(m: Marts) -> DataFrame:
    return m.orders.filter(F.col("returned")).select("order_id", date_plus_days_ts(F.col("ordered_at"), 7).alias("return_at"))


@both("row_null_functions", """
SELECT customer_id, coalesce(recency_days, -1) AS recency_or_minus_one,
       CAST(total_sessions AS DOUBLE) / nullif(frequency_orders, 0) AS sessions_per_order,
       greatest(recency_days, total_sessions) AS greatest_of
FROM rfm""")
def _(m: Marts) -> DataFrame:
    r = m.rfm
    return r.select("customer_id", F.coalesce("recency_days", F.lit(-1)).alias("recency_or_minus_one"),
                    (F.col("total_sessions").cast("double")
                     / F.when(F.col("frequency_orders") != 0, F.col("frequency_orders"))).alias("sessions_per_order"),
                    F.greatest(F.col("recency_days"), F.col("total_sessions")).alias("greatest_of"))


@both("row_round_concat_arith", """
SELECT order_id, 'Order ' || CAST(order_id AS VARCHAR) || ': $' || CAST(round(total, 0) AS VARCHAR) AS label,
       CAST((total_units * 2 + 1000) // 2000 AS DOUBLE) / 100.0 AS total_cents_rounded,
       total - subtotal AS total_minus_subtotal
FROM stg_orders""")
def _(m: Marts) -> DataFrame:
    o = m.orders
    return o.select("order_id",
                    F.concat(F.lit("Order "), F.col("order_id").cast("string"), F.lit(": $"),
                             F.round("total", 0).cast("string")).alias("label"),
                    (half_up_div(F.col("total_units"), F.lit(1000)).cast("double") / 100.0).alias("total_cents_rounded"),
                    (F.col("total") - F.col("subtotal")).alias("total_minus_subtotal"))


# ---- 2A lookups -----------------------------------------------------------------
@both("customer_lookup", """
SELECT l.customer_id, l.cluster_name, l.risk_status, l.churn_probability
FROM ltv_v2 l WHERE l.customer_id IN (SELECT customer_id FROM at_risk_api)""")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import at_risk_list
    keys = at_risk_list(m.ltv_v2, m.p).select("customer_id")
    return m.ltv_v2.join(keys, "customer_id", "left_semi").select("customer_id", "cluster_name", "risk_status",
                                                                   "churn_probability")


# ---- 2K streaming extension -------------------------------------------------------
@both("stream_first_week", """
SELECT customer_id, sessions_first_7d, avg_cart_adds, avg_products_viewed, purchases_first_7d, days_to_first_purchase
FROM early_sessions""")
def _(m: Marts) -> DataFrame:
    from aisle.streaming.first_week import run_first_week
    return run_first_week(m.spark, m.sf_dir, m.p)


@both("stream_early_scores", """
SELECT s.* FROM early_scored s WHERE s.customer_id IN (SELECT customer_id FROM early_sessions)""")
def _(m: Marts) -> DataFrame:
    """K1 with J11: customers are scored in the stream when their first week closes."""
    from aisle.streaming.first_week import replay
    return replay(m.spark, m.sf_dir, m.p, scored=True).table.withColumns(
        {c: F.array_join(c, " | ") for c in ("traits", "recommended_actions")})


# ---- 2I names and lists ------------------------------------------------------------
REQUESTS = ["VIP Loyalist", "vip_loyalists", "serial_returner", "Serial Returners", "Window Browers",
            "BIG TICKET BUYER", " deal hunters", "casual shopper", "nobody"]


@both("persona_name_lookup", """
SELECT customer_id, requested, coalesce(a.cluster_name, upper(plain[1]) || substr(plain, 2)) AS cluster_name
FROM (SELECT c.customer_id, n.requested, trim(lower(replace(n.requested, '_', ' '))) AS plain
      FROM stg_customers c JOIN """ + oracle.values_sql(list(enumerate(REQUESTS)), ["slot", "requested"]) + f""" n
        ON c.customer_id % {len(REQUESTS)} = n.slot) r
LEFT JOIN aliases a ON a.alias = r.plain""")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import resolve_personas
    names = F.array(*[F.lit(n) for n in REQUESTS])
    asked = m.customers.select("customer_id", F.element_at(
        names, (F.pmod(F.col("customer_id"), F.lit(len(REQUESTS))) + 1).cast("int")).alias("requested"))
    return resolve_personas(asked, "requested")


@both("cart_strings", "SELECT cart_id, persona, category FROM carts")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import carts_from_strings
    written = F.concat(F.lit(" "), F.array_join(F.collect_list(F.upper("category")), " , "), F.lit(",,"))
    carts = (m.line_items.filter(F.col("cluster_name").isNotNull())
             .groupBy(F.col("order_id").alias("cart_id"), F.col("cluster_name").alias("persona")).agg(written.alias("cart")))
    return m.stored(carts_from_strings(carts))


# ---- 2A loads, stored tables, SQL with parameters -----------------------------------
LOOKUP_IDS = [7, 42, 404, 1001, 999_999_999]


@both("table_refresh", "SELECT * FROM stg_customers")
def _(m: Marts) -> DataFrame:
    """Load, swap in, refresh, and read what the pointer names."""
    store = TableStore(m.spark, shared_dir(m.spark, f"store-{uuid.uuid4().hex}"))
    store.refresh("customers", m.customers.limit(0))
    return store.refresh("customers", m.customers)


@both("stored_lookup", "SELECT * FROM (" + oracle.QUERIES["customer_profile"] + ") WHERE customer_id IN (7, 42, 404, 1001, 999999999)")
def _(m: Marts) -> DataFrame:
    """Keyed lookup on a bucketed, sorted mart with bloom filters."""
    from aisle.operators.serving import customer_profile
    name = f"profiles_{uuid.uuid4().hex}"
    stored = store_by_key(customer_profile(m.ltv_v2).withColumn("recommended_actions", F.array_join("recommended_actions", " | ")),
                          "customer_id", shared_dir(m.spark, name), name)
    return lookup(stored, "customer_id", LOOKUP_IDS)


# one product in 50 has a price that is no number, another one a count that is none
_CSV_BAD = "product_id % 50 = 7", "product_id % 50 = 9"


def _csv_scan(m: Marts) -> tuple[DataFrame, DataFrame]:
    path = shared_dir(m.spark, f"products-{uuid.uuid4().hex}")
    (m.products.select("product_id", "product_name", "category", "brand",
                       F.expr(f"CASE WHEN {_CSV_BAD[0]} THEN 'n/a' ELSE cast(base_price AS string) END").alias("base_price"),
                       F.expr(f"CASE WHEN {_CSV_BAD[1]} THEN 'many, say 7' ELSE cast(num_reviews AS string) END").alias("num_reviews"))
     .write.option("header", True).csv(path))
    return scan_csv(m.spark, path)


@both("csv_scan", f"""
SELECT product_id, product_name, category, brand, base_price, CAST(num_reviews AS BIGINT) AS num_reviews
FROM stg_products WHERE NOT ({_CSV_BAD[0]} OR {_CSV_BAD[1]})""")
def _(m: Marts) -> DataFrame:
    """A1: types inferred from all rows of a CSV written from a table."""
    return _csv_scan(m)[0]


@both("csv_rejects", f"""
SELECT CAST(product_id AS VARCHAR) AS product_id,
       CASE WHEN {_CSV_BAD[0]} THEN 'base_price: ''n/a'' is no double' ELSE 'num_reviews: ''many, say 7'' is no bigint' END AS reason
FROM stg_products WHERE {_CSV_BAD[0]} OR {_CSV_BAD[1]}""")
def _(m: Marts) -> DataFrame:
    return _csv_scan(m)[1].select("product_id", "reason")


@both("sql_at_risk", """
SELECT customer_id, cluster_name, risk_status, predicted_12m_ltv FROM ltv_v2
WHERE risk_status IN ('High Value At Risk', 'Likely Churned') AND predicted_12m_ltv >= 1000""")
def _(m: Marts) -> DataFrame:
    """A view, a bound number and a bound IN list, one of whose values would
    end a pasted string."""
    return query_views(m.spark, """
        SELECT customer_id, cluster_name, risk_status, predicted_12m_ltv FROM {ltv}
        WHERE array_contains(:statuses, risk_status) AND predicted_12m_ltv >= :least""",
                       {"ltv": m.ltv_v2}, statuses=["High Value At Risk", "Likely Churned", "x') OR ('1'='1"], least=1000.0)


@both("sql_profile", """
SELECT r.customer_id, r.rfm_segment, c.cluster_name FROM rfm r LEFT JOIN clusters c ON c.customer_id = r.customer_id
WHERE r.customer_id IN (7, 42, 404, 1001, 999999999)""")
def _(m: Marts) -> DataFrame:
    return query_views(m.spark, """
        SELECT r.customer_id, r.rfm_segment, c.cluster_name FROM {rfm} r LEFT JOIN {clusters} c ON c.customer_id = r.customer_id
        WHERE array_contains(:ids, r.customer_id)""", {"rfm": m.rfm, "clusters": m.clusters}, ids=LOOKUP_IDS)
