"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query builds the mart DAG over the driver's tables at ``sf_dir`` and
returns its result as a lazy DataFrame (no action is run here, but for the
streaming query, which drains its source). Names follow
(``join_``, ``agg_``, ``win_``, ``sort_``, ``set_``, ``row_``) instead of a
generic one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisle.params import DEFAULT
from aisle.plans.marts import Marts
from aisle.sources.files import table_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Marts], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Marts(spark, sf_dir, DEFAULT))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# ---- staging / load (J1, A3) --------------------------------------------------
@query("stg_customers")
def _(m: Marts) -> DataFrame:
    return m.customers


@query("stg_orders")
def _(m: Marts) -> DataFrame:
    return m.orders


@query("stg_sessions")
def _(m: Marts) -> DataFrame:
    return m.sessions


@query("stg_products")
def _(m: Marts) -> DataFrame:
    return m.products


@query("table_counts")
def _(m: Marts) -> DataFrame:
    return table_counts({"customers": m.customers, "sessions": m.sessions,
                         "orders": m.orders, "products": m.products})


# ---- RFM (J2, J3) ---------------------------------------------------------------
@query("rfm_scores")
def _(m: Marts) -> DataFrame:
    return m.rfm.select("customer_id", "recency_days", "frequency_orders", "monetary_total",
                        "r_score", "f_score", "m_score", "rfm_score")


@query("rfm_segments")
def _(m: Marts) -> DataFrame:
    return m.rfm


@query("rfm_segment_counts")
def _(m: Marts) -> DataFrame:
    from aisle.operators.rfm import segment_counts
    return segment_counts(m.rfm)


@query("rfm_naive_fanout")
def _(m: Marts) -> DataFrame:
    return m.rfm_v1


# ---- clusters (J4, J16) ---------------------------------------------------------
@query("cluster_assignment")
def _(m: Marts) -> DataFrame:
    return m.clusters


@query("cluster_zscores")
def _(m: Marts) -> DataFrame:
    return m.clusters.select("customer_id", "cluster_id", "session_score", "frequency_score",
                             "monetary_score", "aov_score", "returns_score")


@query("cluster_stats")
def _(m: Marts) -> DataFrame:
    from aisle.operators.clusters import cluster_stats
    return cluster_stats(m.clusters)


# ---- journey (J5) ---------------------------------------------------------------
@query("event_timeline")
def _(m: Marts) -> DataFrame:
    from aisle.operators.journey import event_timeline
    return event_timeline(m.journey_events)


@query("journey_milestones")
def _(m: Marts) -> DataFrame:
    from aisle.operators.journey import daily_events, milestones
    return milestones(daily_events(m.events), m.customers, m.clusters)


@query("journey_paths")
def _(m: Marts) -> DataFrame:
    return m.journey


# ---- early signals and scoring (J6, J11, J23) -----------------------------------
@query("early_signals")
def _(m: Marts) -> DataFrame:
    return m.early_signals


def _scored(m: Marts) -> DataFrame:
    from aisle.operators.early import as_records, score_early
    return score_early(as_records(m.early_signals), m.p)


@query("early_persona_score")
def _(m: Marts) -> DataFrame:
    return _scored(m).withColumns({c: F.array_join(c, " | ") for c in ("traits", "recommended_actions")})


@query("rejected_inputs")
def _(m: Marts) -> DataFrame:
    from aisle.operators.early import as_records, rejected_inputs
    return rejected_inputs(as_records(m.early_signals))


@query("early_persona_confusion")
def _(m: Marts) -> DataFrame:
    from aisle.operators.early import prediction_confusion
    return prediction_confusion(_scored(m), m.clusters)


@query("early_persona_precision")
def _(m: Marts) -> DataFrame:
    from aisle.operators.early import prediction_confusion, prediction_precision
    return prediction_precision(prediction_confusion(_scored(m), m.clusters))


# ---- LTV (J7a, J7b, J19) --------------------------------------------------------
@query("ltv_forecast_v2")
def _(m: Marts) -> DataFrame:
    return m.ltv_v2


@query("ltv_cohort_curve")
def _(m: Marts) -> DataFrame:
    return m.cohort_curve.drop("monthly_revenue_nano")


@query("ltv_forecast_v1")
def _(m: Marts) -> DataFrame:
    return m.ltv_v1


@query("ltv_by_persona")
def _(m: Marts) -> DataFrame:
    from aisle.operators.ltv import ltv_by_persona
    return ltv_by_persona(m.ltv_v2)


# ---- baskets (J8, J9, J10, J20) -------------------------------------------------
@query("basket_expansion")
def _(m: Marts) -> DataFrame:
    return m.basket_items


@query("lineitem_enriched")
def _(m: Marts) -> DataFrame:
    return m.line_items


@query("product_affinity")
def _(m: Marts) -> DataFrame:
    return m.product_affinity


@query("catalogue_affinity")
def _(m: Marts) -> DataFrame:
    return m.product_affinity


@query("family_affinity")
def _(m: Marts) -> DataFrame:
    return m.family_affinity


@query("affinity_rollup")
def _(m: Marts) -> DataFrame:
    return (m.affinity_rollup.withColumn("pair", F.explode_outer("top_pairs"))
            .select("cluster_name", "category_a", "category_b", "strong_pairs", "confidence_hundredths", "lift_hundredths",
                    "very_strong_times", "pair.pair_rank", "pair.product_a", "pair.product_b", "pair.times_bought_together"))


@query("category_affinity")
def _(m: Marts) -> DataFrame:
    from aisle.operators.basket import category_affinity
    return category_affinity(m.orders, m.clusters, m.p)


@query("category_preferences")
def _(m: Marts) -> DataFrame:
    from aisle.operators.basket import category_preferences
    return category_preferences(m.orders, m.clusters)


@query("affinity_matrix")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import affinity_matrix
    return affinity_matrix(m.affinity_rollup, m.p)


# ---- serving (J12-J22) -----------------------------------------------------------
@query("customer_profile")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import customer_profile
    return customer_profile(m.ltv_v2).withColumn(
        "recommended_actions", F.array_join("recommended_actions", " | "))


@query("persona_dimension")
def _(m: Marts) -> DataFrame:
    from aisle.operators.clusters import cluster_stats
    from aisle.operators.serving import persona_dimension
    return persona_dimension(cluster_stats(m.clusters))


@query("at_risk_list")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import at_risk_list
    return at_risk_list(m.ltv_v2, m.p)


@query("at_risk_summary")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import at_risk_list, at_risk_summary
    return at_risk_summary(at_risk_list(m.ltv_v2, m.p))


@query("portfolio_metrics")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import portfolio_metrics
    return portfolio_metrics(m.ltv_v2)


@query("risk_distribution")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import risk_distribution
    return risk_distribution(m.ltv_v2)


@query("risk_by_persona")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import at_risk_list, risk_by_persona
    return risk_by_persona(at_risk_list(m.ltv_v2, m.p, apply_min_ltv=False))


@query("campaign_tiers")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import campaign_targets, campaign_tiers
    return campaign_tiers(campaign_targets(m.ltv_v2, m.clusters, m.p))


@query("campaign_roi")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import campaign_roi, campaign_targets, campaign_tiers
    return campaign_roi(campaign_tiers(campaign_targets(m.ltv_v2, m.clusters, m.p)), m.p)


@query("persona_recommendations")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import persona_recommendations
    return persona_recommendations(m.affinity_rollup, m.p)


@query("persona_strategy")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import persona_strategy
    return persona_strategy(m.affinity_rollup, m.p)


@query("cart_recommendations")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import cart_recommendations, carts_from_lines
    return cart_recommendations(carts_from_lines(m.line_items), m.affinity_rollup, m.products, m.p, keep=m.stored)


@query("default_recommendations")
def _(m: Marts) -> DataFrame:
    from aisle.operators.serving import default_recommendations
    return default_recommendations(m.affinity_rollup, m.products, m.p)
