"""Serving queries over the marts.

Everything the reference computes in a request handler or in pandas after a
fetch is a DataFrame here: lookups are joins, per-category loops are one join
plus a per-group top-k, Python summaries are a second aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisle.functions.exact import cents_of, money_to_units, round_to
from aisle.operators import personas
from aisle.operators.basket import STRONG, placed_catalogue
from aisle.operators.relational import row_number_by, top_k_per_group
from aisle.params import DEFAULT, Params

AT_RISK = ["High Value At Risk", "At Risk"]


def cents(x: Column) -> Column:
    """Round a double amount to whole cents (as an integer)."""
    return F.round(x * F.lit(100.0)).cast("long")


# ---- J12 customer profile -----------------------------------------------------
def customer_profile(ltv: DataFrame, keys: DataFrame | Sequence | None = None) -> DataFrame:
    d = ltv
    if keys is not None:
        if isinstance(keys, DataFrame):
            d = d.join(keys.select("customer_id").distinct(), "customer_id", "left_semi")
        else:
            d = d.filter(F.col("customer_id").isin(list(keys)))
    acts = F.broadcast(personas.risk_actions_dim(ltv.sparkSession))
    return d.join(acts, "risk_status", "left").select(
        "customer_id", "cluster_name",
        round_to(F.col("actual_ltv_to_date"), 2).alias("actual_ltv"),
        round_to(F.col("predicted_12m_ltv"), 2).alias("predicted_12m_ltv"),
        "total_sessions", F.col("orders_to_date").alias("total_orders"), "risk_status",
        "days_since_last_order", "churn_probability",
        F.coalesce(F.col("recommended_actions"), F.array().cast("array<string>")).alias("recommended_actions"))


# ---- J15 at-risk list and summary --------------------------------------------
def at_risk_list(ltv: DataFrame, p: Params = DEFAULT, apply_min_ltv: bool = True,
                 limit: int | None = None) -> DataFrame:
    """Top-``limit`` at-risk customers by predicted LTV (the API list; the
    dashboard variant passes ``apply_min_ltv=False``). The limit is the
    feature; Spark plans it as a per-partition top-k merged once."""
    limit = p.at_risk_limit if limit is None else limit
    d = ltv.filter(F.col("risk_status").isin(AT_RISK))
    if apply_min_ltv:
        d = d.filter(F.col("actual_ltv_to_date") >= p.at_risk_min_ltv)
    d = d.orderBy(F.col("predicted_12m_ltv").desc(), F.col("customer_id")).limit(limit)
    return d.select(
        "customer_id", "cluster_name",
        round_to(F.col("actual_ltv_to_date"), 2).alias("actual_ltv"),
        round_to(F.col("predicted_12m_ltv"), 2).alias("predicted_ltv"),
        "days_since_last_order", "churn_probability",
        round_to(F.col("churn_probability") * 100, 1).alias("churn_pct"),
        "risk_status")


def at_risk_summary(at_risk: DataFrame) -> DataFrame:
    c = cents(F.col("predicted_ltv"))
    total = F.sum(c)
    return at_risk.agg(
        F.count(F.lit(1)).alias("count"),
        (F.coalesce(total, F.lit(0)).cast("double") / F.lit(100.0)).alias("total_value_at_risk"),
        F.count(F.when(c >= 300000, 1)).alias("tier_1_count"),
        F.count(F.when((c >= 200000) & (c < 300000), 1)).alias("tier_2_count"),
        F.count(F.when(c < 200000, 1)).alias("tier_3_count"),
        (F.coalesce(total, F.lit(0)).cast("double") / F.lit(100.0) * F.lit(0.20)).alias("estimated_recovery_20pct"),
        (F.coalesce(total, F.lit(0)).cast("double") / F.lit(100.0) * F.lit(0.30)).alias("estimated_recovery_30pct"),
    )


# ---- J17 portfolio, J18 risk distribution -------------------------------------
def portfolio_metrics(ltv: DataFrame) -> DataFrame:
    at_risk = F.col("risk_status").isin(AT_RISK)
    pred = money_to_units(F.col("predicted_12m_ltv"))
    m = ltv.agg(
        F.count(F.lit(1)).alias("total_customers"),
        cents_of(F.sum("actual_ltv_units")).alias("current_value"),
        cents_of(F.sum(pred)).alias("predicted_value"),
        cents_of(F.sum(money_to_units(F.col("predicted_future_revenue")))).alias("future_opportunity"),
        F.count(F.when(at_risk, 1)).alias("at_risk_count"),
        cents_of(F.sum(F.when(at_risk, pred).otherwise(0))).alias("at_risk_value"))
    return m.withColumn("growth_potential_pct", F.when(
        F.col("current_value") > 0,
        round_to(F.col("future_opportunity") / F.col("current_value") * 100, 1)).otherwise(F.lit(0.0)))


def risk_distribution(ltv: DataFrame) -> DataFrame:
    return ltv.groupBy("risk_status").agg(
        F.count(F.lit(1)).alias("customers"),
        cents_of(F.sum(money_to_units(F.col("predicted_12m_ltv")))).alias("value"))


def risk_by_persona(at_risk: DataFrame) -> DataFrame:
    return at_risk.groupBy("cluster_name").agg(
        F.count(F.lit(1)).alias("customers"),
        (F.sum(cents(F.col("predicted_ltv"))).cast("double") / F.lit(100.0)).alias("total_value"))


# ---- J21 campaign tiers, J22 ROI ----------------------------------------------
def campaign_targets(ltv: DataFrame, clusters: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """At-risk customers that the campaign may target, with their tier."""
    rr = clusters.select("customer_id", (F.col("returned_orders") / F.when(
        F.col("frequency_orders") != 0, F.col("frequency_orders").cast("double"))).alias("return_rate"))
    d = (ltv.filter(F.col("risk_status").isin(AT_RISK))
         .filter(F.col("churn_probability") < p.exclude_churn_at_least)
         .join(rr, "customer_id", "left")
         .filter(~F.coalesce(F.col("return_rate") > p.exclude_return_rate_above, F.lit(False))))
    c = cents(F.col("predicted_12m_ltv"))
    tier = F.when(c >= 300000, "Tier 1").when(c >= 200000, "Tier 2").otherwise("Tier 3")
    return d.select("customer_id", "cluster_name", (c.cast("double") / 100).alias("predicted_ltv"),
                    "churn_probability", "return_rate", tier.alias("tier"))


def campaign_tiers(targets: DataFrame) -> DataFrame:
    dim = F.broadcast(personas.tier_dim(targets.sparkSession).drop("min_ltv"))
    t = targets.groupBy("tier").agg(
        F.count(F.lit(1)).alias("customers"),
        (F.sum(cents(F.col("predicted_ltv"))).cast("double") / F.lit(100.0)).alias("total_value"))
    return t.join(dim, "tier", "left")


def campaign_roi(tiers: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Scenario table: the overall campaign at 20 % / 30 % reactivation and
    each tier at its own low/high rate. Scenarios are a generator over a
    literal array (no join)."""
    scen = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(r).alias("rate"),
                                        F.lit(i).alias("level"))
                               for i, (n, r) in enumerate(personas.ROI_SCENARIOS)]))
    overall = (tiers.agg(F.sum("customers").alias("customers"), F.sum(cents(F.col("total_value"))).alias("_c"))
               .select(F.lit("All").alias("tier"), "customers", "_c", scen.alias("s"))
               .select("tier", "customers", "_c", F.col("s.scenario").alias("scenario"),
                       F.col("s.rate").alias("reactivation_rate"),
                       F.lit(p.campaign_cost).alias("campaign_cost")))
    per_tier = (tiers.select("tier", "customers", cents(F.col("total_value")).alias("_c"), scen.alias("s"),
                             "reactivation_low", "reactivation_high")
                .select("tier", "customers", "_c", F.col("s.scenario").alias("scenario"),
                        F.when(F.col("s.level") == 0, F.col("reactivation_low"))
                        .otherwise(F.col("reactivation_high")).alias("reactivation_rate"),
                        F.lit(None).cast("double").alias("campaign_cost")))
    d = overall.unionByName(per_tier)
    value = F.col("_c").cast("double") / F.lit(100.0)
    rec = value * F.col("reactivation_rate")
    return d.select(
        "scenario", "tier", "customers", value.alias("value_at_risk"), "reactivation_rate",
        F.floor(F.col("customers") * F.col("reactivation_rate")).alias("customers_reactivated"),
        rec.alias("revenue_recovered"), "campaign_cost",
        (rec - F.col("campaign_cost")).alias("net_benefit"),
        ((rec - F.col("campaign_cost")) / F.col("campaign_cost") * 100).alias("roi_pct"))


# ---- J14 persona recommendations and strategy, J20 matrix ---------------------
def strong_pairs(rollup: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Top ``top_pairs`` Strong / Very Strong pairs per cluster by times, from the
    first pairs of every pair of categories."""
    pairs = (rollup.select("cluster_name", "category_a", "category_b", F.explode("top_pairs").alias("pair"))
             .select("cluster_name", "category_a", "category_b", "pair.*").drop("pair_rank"))
    return top_k_per_group(pairs, "cluster_name",
                           [F.col("times_bought_together").desc(), F.col("product_a"), F.col("product_b")],
                           p.top_pairs, rank_col="pair_rank")


def persona_recommendations(rollup: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return strong_pairs(rollup, p).select(
        "cluster_name", "pair_rank", "category_a", "category_b", "times_bought_together", "confidence_pct",
        "lift", "recommendation_strength", "recommendation_text")


def persona_strategy(rollup: DataFrame, p: Params = DEFAULT) -> DataFrame:
    top = strong_pairs(rollup, p)
    combo = F.concat(F.col("category_a"), F.lit(" + "), F.col("category_b"))
    summary = top.groupBy("cluster_name").agg(
        F.min_by(combo, "pair_rank").alias("top_combo"),
        F.min_by("times_bought_together", "pair_rank").alias("top_times"),
        F.min_by("confidence_pct", "pair_rank").alias("top_confidence"),
        F.min_by("recommendation_strength", "pair_rank").alias("top_strength"),
        F.max_by(combo, F.struct(F.col("lift"), -F.col("pair_rank"))).alias("highest_lift_combo"),
        F.max("lift").alias("highest_lift"))
    comp = (top.groupBy("cluster_name", "category_b").agg(F.sum("times_bought_together").alias("_t"))
            .groupBy("cluster_name").agg(F.max_by("category_b", F.struct(F.col("_t"), F.col("category_b")))
                                         .alias("top_companion")))
    dims = personas.persona_dim(rollup.sparkSession).select("persona", "cluster_name").join(
        personas.strategy_dim(rollup.sparkSession), "persona", "inner")
    s = summary.join(comp, "cluster_name", "left").join(F.broadcast(dims), "cluster_name", "left")
    companion = F.coalesce(F.col("top_companion"), F.lit(personas.DEFAULT_COMPANION))
    return s.select(
        "cluster_name", "persona", "top_combo", "top_times", "top_confidence", "top_strength",
        "highest_lift_combo", "highest_lift", companion.alias("top_companion"), "primary_tactic",
        "discount_strategy", F.replace(F.col("messaging_template"), F.lit("{companion}"), companion).alias("messaging"),
        "email_frequency", "upsell_timing")


def affinity_matrix(rollup: DataFrame, p: Params = DEFAULT, categories: Sequence[str] | None = None) -> DataFrame:
    """Symmetric category x category confidence per cluster over the top
    strong pairs; a cell written by several pairs keeps the value of the
    lowest-ranked one (the last one a descending-times loop would write)."""
    from aisle.operators.basket import CATEGORIES
    cats = list(categories or CATEGORIES)
    top = strong_pairs(rollup, p)
    both = (top.select("cluster_name", F.col("category_a").alias("row_category"),
                       F.col("category_b").alias("col_category"), "confidence_pct", "pair_rank")
            .unionByName(top.select("cluster_name", F.col("category_b").alias("row_category"),
                                    F.col("category_a").alias("col_category"), "confidence_pct", "pair_rank")))
    cell = both.groupBy("cluster_name", "row_category", "col_category").agg(
        F.max_by("confidence_pct", "pair_rank").alias("v"))
    wide = cell.groupBy("cluster_name", "row_category").pivot("col_category", cats).agg(F.first("v"))
    return wide.select("cluster_name", F.col("row_category").alias("category"),
                       *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cats])


# ---- J13 cart-aware recommendations ----------------------------------------
def carts_from_lines(line_items: DataFrame) -> DataFrame:
    """Each order's distinct categories as a cart, owned by the customer's
    cluster: (cart_id, persona, category)."""
    return (line_items.filter(F.col("cluster_name").isNotNull())
            .select(F.col("order_id").alias("cart_id"), F.col("cluster_name").alias("persona"), "category")
            .distinct())


def carts_from_strings(carts: DataFrame) -> DataFrame:
    """(cart_id, persona, category) from rows whose ``cart`` is a comma-separated
    list of categories: split, stripped, lower-cased, without blanks or repeats."""
    part = F.explode(F.split(F.col("cart"), ","))
    return (carts.select("cart_id", "persona", part.alias("category"))
            .select("cart_id", "persona", F.lower(F.trim("category")).alias("category"))
            .filter(F.col("category") != "").distinct())


def resolve_personas(requests: DataFrame, name: str = "persona") -> DataFrame:
    """``requests`` with ``cluster_name``: the cluster that a persona name in any
    known spelling means, else the name in title case with blanks."""
    plain = F.trim(F.lower(F.replace(F.col(name), F.lit("_"), F.lit(" "))))
    dim = F.broadcast(personas.alias_dim(requests.sparkSession))
    return (requests.withColumn("_alias", plain).join(dim, F.col("_alias") == dim["alias"], "left")
            .withColumn("cluster_name", F.coalesce(F.col("alias_cluster"), F.initcap(F.col("_alias"))))
            .drop("_alias", "alias", "alias_cluster"))


def persona_dimension(cluster_stats: DataFrame) -> DataFrame:
    """The published persona figures next to the measured clusters."""
    dim = personas.persona_dim(cluster_stats.sparkSession).withColumn("key_traits", F.array_join("key_traits", " | "))
    measured = cluster_stats.select("cluster_name", *[F.col(c).alias(f"measured_{c}") for c in
                                                      ["customers", "avg_ltv", "avg_sessions", "avg_orders", "avg_order_value"]])
    return dim.join(measured, "cluster_name", "left")


def draw_ranks(rows: DataFrame, key: Sequence[str], size: str, k: int) -> DataFrame:
    """``rows``, each ``least(k, size)`` times, with ``slot`` (from 0) and ``rank``: a
    random subset of 1..size without repeats, every one about equally likely, that the
    columns ``key`` determine. Draw i of a subset is uniform over the first
    size - k + i + 1 numbers; one that was drawn before stands for the last of them."""
    out = rows.withColumn("_k", F.least(F.lit(k), F.col(size)))
    for i in range(k):
        last = F.col(size) - F.col("_k") + i
        drawn = F.pmod(keyed_hash(*[F.col(c) for c in key], F.lit(i)), last + 1)
        again = F.lit(False)
        for j in range(i):
            again = again | (drawn == F.col(f"_p{j}"))
        out = out.withColumn(f"_p{i}", F.when(F.col("_k") > i, F.when(again, last).otherwise(drawn)))
    ranks = F.slice(F.array(*[f"_p{i}" for i in range(k)]), 1, F.col("_k").cast("int"))
    out = out.select(*[F.col(f"`{c}`") for c in rows.columns], F.posexplode(ranks).alias("slot", "rank"))
    return out.withColumn("rank", F.col("rank") + 1)


def keyed_hash(*parts: Column) -> Column:
    """32 bits of the MD5 of the parts, joined by "-"."""
    text = F.concat_ws("-", *[c.cast("string") for c in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def sample_per_key(rows: DataFrame, key: str, item: str, k: int, seed: str = "") -> DataFrame:
    """k random rows of each key (F4), with ``slot``: those of the least keyed hash.
    Mergeable: a task ships at most k rows of a key."""
    order = F.md5(F.concat_ws("-", F.lit(seed), F.col(key).cast("string"), F.col(item).cast("string")).cast("binary"))
    return top_k_per_group(rows.withColumn("_order", order), key, [F.col("_order"), F.col(item)], k, rank_col="slot").withColumn(
        "slot", F.col("slot") - 1).drop("_order")


def _sample_products(recs: DataFrame, products: DataFrame, key: str, k: int) -> DataFrame:
    """k distinct products of each recommended category, drawn for the integer
    request key (``draw_ranks``) and looked up by their place in the catalogue, one
    integer: no request is joined with a whole category. ``recs`` is shuffled with a row
    per product, so many requests should come narrow."""
    placed, sizes = placed_catalogue(products)
    placed = placed.select("_place", "product_id", "product_name", "brand", "base_price")
    r = recs.join(F.broadcast(sizes.withColumnRenamed("category", "recommended_category")),
                  "recommended_category", "inner")
    r = draw_ranks(r, [key, "recommended_category"], "category_size", k)
    r = r.withColumn("_of", F.col("_before") + F.col("rank")).drop("rank", "category_size", "_before")
    j = r.join(placed, r["_of"] == placed["_place"], "inner")
    return j.drop("_of", "_place").withColumnRenamed("slot", "product_slot")


def cart_kinds(carts: DataFrame) -> DataFrame:
    """One row per cart with its ``kind``, the sorted list of its (persona, category):
    all that the categories recommended to it depend on."""
    known = carts.filter(F.col("persona").isNotNull() & F.col("category").isNotNull())
    return known.groupBy("cart_id").agg(F.array_sort(F.collect_list(F.struct("persona", "category"))).alias("kind"))


def kind_recommendations(kinds: DataFrame, rollup: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The best companion categories of each kind of ``cart_kinds``, numbered by
    ``rec_id``. Carts of one persona have at most 2^6 - 1 kinds a cluster, however many
    there are. ``pairs_with`` lists the kind's categories behind a recommendation with
    their numbers of strong pairs, run by run."""
    a = rollup.filter("strong_pairs > 0").select(F.col("cluster_name").alias("persona"), F.col("category_a").alias("category"),
                                                 F.col("category_b").alias("recommended_category"),
                                                 "strong_pairs", "confidence_hundredths", "lift_hundredths")
    lines = kinds.select("kind").distinct().select("kind", F.inline("kind"))
    pairs = (F.sum("strong_pairs") * 100).cast("double")
    run = F.concat("category", F.lit(" x"), F.col("strong_pairs").cast("string"))
    g = lines.join(a, ["persona", "category"], "inner").groupBy("kind", "persona", "recommended_category").agg(
        (F.sum("confidence_hundredths").cast("double") / pairs).alias("avg_confidence"),
        (F.sum("lift_hundredths").cast("double") / pairs).alias("avg_lift"),
        F.array_join(F.array_sort(F.collect_list(run)), ", ").alias("pairs_with"))
    top = top_k_per_group(g, "kind", [F.col("avg_confidence").desc(), F.col("recommended_category"), F.col("persona")],
                          p.cart_limit, rank_col="rec_rank")
    hashed = top.withColumn("_hash", F.xxhash64("kind"))
    return row_number_by(hashed, [], ["_hash", "kind", "rec_rank"], out="rec_id",
                         bucket=F.shiftright("_hash", 52)).drop("_hash")


def cart_recommendations(carts: DataFrame, rollup: DataFrame, products: DataFrame, p: Params = DEFAULT,
                         keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Per cart the best companion categories, with products. They are worked out per
    kind of cart. A request for a product is the cart and the number of the
    recommendation, whose columns are added to the product found, so no wide row is
    shuffled. ``keep`` stores a relation that is read twice."""
    kinds = keep(cart_kinds(carts))
    top = keep(kind_recommendations(kinds, rollup, p))
    asked = kinds.join(top.select("kind", "rec_id", "recommended_category"), "kind", "inner").drop("kind")
    found = _sample_products(asked, products, "cart_id", p.products_per_category).drop("recommended_category")
    return found.join(top.drop("kind"), "rec_id", "inner").select(
        "recommended_category", "cart_id", "persona", "avg_confidence", "avg_lift", "pairs_with", "rec_rank",
        "product_slot", "product_id", "product_name", "brand", "base_price")


def default_recommendations(rollup: DataFrame, products: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """No cart: the persona's Very Strong categories by their best pair count."""
    from aisle.operators.clusters import CLUSTERS
    cid = F.lit(None).cast("int")
    for i, name in CLUSTERS:
        cid = F.when(F.col("cluster_name") == name, F.lit(i)).otherwise(cid)
    cats = (rollup.filter("very_strong_times IS NOT NULL").withColumn("cluster_id", cid)
            .groupBy("cluster_name", "cluster_id", F.col("category_a").alias("recommended_category"))
            .agg(F.max("very_strong_times").alias("best_times")))
    top = top_k_per_group(cats, "cluster_name", [F.col("best_times").desc(), F.col("recommended_category")],
                          p.cart_limit, rank_col="rec_rank")
    return _sample_products(top, products, "cluster_id", p.products_per_category)
