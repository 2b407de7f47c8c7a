"""J4 behavioural clusters and J16 cluster statistics.

Buyers only. Each feature is standardised with the global mean and sample
standard deviation of the buyers. The moments are sums of integers (features in
units of 1e-5) in limbs that cannot overflow, so they are the same bits for every
partitioning and right for heavy tails; they are one row, joined once by broadcast. A first-match ladder over the unrounded z-scores
assigns one of six clusters; only the reported scores are rounded to 2 decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisle.functions.exact import MONEY_SCALE, half_up_div, mean_to, moments, round_to, with_sample_std
from aisle.functions.rules import ladder
from aisle.params import DEFAULT, Params

# (feature column, z-score column, reported score column)
FEATURES = [
    ("total_sessions", "sessions_z", "session_score"),
    ("frequency_orders", "frequency_z", "frequency_score"),
    ("monetary_total", "monetary_z", "monetary_score"),
    ("avg_order_value", "aov_z", "aov_score"),
    ("returned_orders", "returns_z", "returns_score"),
]

# ---- fixed values: cluster ids and names ------------------------------------
CLUSTERS = [
    (1, "VIP Loyalists"),
    (2, "Serial Returns"),
    (3, "Big Ticket Buyers"),
    (4, "Window Browsers"),
    (5, "Deal Hunters"),
    (6, "Casual Shoppers"),
]
CLUSTER_NAMES = [n for _, n in CLUSTERS]


def _cluster_rules(p: Params) -> list[Column]:
    z = {name: F.col(name) for _, name, _ in FEATURES}
    hi, lo = p.z_high, p.z_low
    return [
        (z["frequency_z"] > hi) & (z["monetary_z"] > hi) & (z["returns_z"] < hi),
        (z["frequency_z"] > hi) & (z["returns_z"] > hi),
        (z["frequency_z"] < lo) & (z["aov_z"] > hi) & (z["returns_z"] < hi),
        (z["sessions_z"] > hi) & (z["frequency_z"] < lo),
        F.col("discount_seeker") == F.lit(True),
    ]


def _scaled(feature: str) -> Column:
    """A feature as an exact integer number of 1e-5 units."""
    if feature == "monetary_total":
        return F.col("monetary_units")
    if feature == "avg_order_value":
        return half_up_div(F.col("monetary_units"), F.col("frequency_orders"))
    return F.col(feature).cast("long") * MONEY_SCALE


def behavioral_clusters(rfm: DataFrame, p: Params = DEFAULT) -> DataFrame:
    buyers = rfm.filter(F.col("frequency_orders") > 0)
    buyers = buyers.select("*", *[_scaled(c).alias(f"_x{i}") for i, (c, _, _) in enumerate(FEATURES)])
    xs = [f"_x{i}" for i in range(len(FEATURES))]
    # one aggregate for all features: a feature is a row, so its code is made once
    tall = buyers.select(F.posexplode(F.array(*xs)).alias("_i", "_x"))
    found = with_sample_std(tall.groupBy("_i").agg(*moments("_x")), "_x")
    of = lambda i, c: F.max(F.when(F.col("_i") == i, F.col(c)))
    stats = found.agg(F.max("_x_n").alias("_n"), *[of(i, f"_x_{k}").alias(f"{x}_{k}") for i, x in enumerate(xs) for k in ("sum", "std")])
    # one row by construction: the broadcast is bounded
    scored = buyers.join(F.broadcast(stats))
    for x, (_, z, _) in zip(xs, FEATURES):
        std = F.col(f"{x}_std")
        away = (F.col(x).cast("decimal(19,0)") * F.col("_n").cast("decimal(18,0)") - F.col(f"{x}_sum")).cast("double")
        scored = scored.withColumn(z, F.when(std > 0, away / (F.col("_n").cast("double") * std)))
    conds = _cluster_rules(p)
    scored = scored.withColumn("cluster_id", ladder(list(zip(conds, [i for i, _ in CLUSTERS[:5]])), CLUSTERS[5][0]))
    names = F.array(*[F.lit(name) for name in CLUSTER_NAMES])
    return scored.select(
        "customer_id", "persona_hidden", "cluster_id", F.element_at(names, F.col("cluster_id")).alias("cluster_name"),
        "total_sessions", "frequency_orders", "monetary_total", "avg_order_value", "returned_orders",
        "is_browser_only", "high_returner", "discount_seeker",
        *[round_to(F.col(z), 2).alias(s) for _, z, s in FEATURES],
        "monetary_units",
    )


def cluster_stats(clusters: DataFrame) -> DataFrame:
    """Per cluster: size, average LTV, sessions, orders and order value."""
    aov = half_up_div(F.col("monetary_units"), F.col("frequency_orders"))
    n = F.count(F.lit(1))
    return clusters.groupBy("cluster_name").agg(
        n.alias("customers"),
        mean_to(F.sum("monetary_units"), n, MONEY_SCALE, 2).alias("avg_ltv"),
        mean_to(F.sum("total_sessions"), n, 1, 1).alias("avg_sessions"),
        mean_to(F.sum("frequency_orders"), n, 1, 1).alias("avg_orders"),
        mean_to(F.sum(aov), n, MONEY_SCALE, 2).alias("avg_order_value"),
    )
