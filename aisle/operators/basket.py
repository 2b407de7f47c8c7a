"""J8 order items, J9 product affinity, J10 category affinity, J20 matrix.

J8 has two sources of items:
* ``expand_baskets``: one item per unit of num_items, categorised from the
  order value/size and assigned a catalogue product by keyed sampling
  (``keyed_rank``), a deterministic, distributed stand-in for a random pick;
* ``enrich_lines``: real order lines with customer and cluster context.

J9 counts pairs of products over the expanded items with ``pair_counts`` and derives
support, confidence and lift from exact integer counts; per-cluster totals come from
a <= 6-row grouped table. Readers of single pairs or categories use
``affinity_rollup``, whose size does not grow with the catalogue. ``family_items``
rolls products up to families (category and ``product_id % 4``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisle.functions import rules
from aisle.functions.exact import pct2, ratio2
from aisle.operators.relational import (basket_lines, basket_sizes, distinct_counts, explode_count, pair_counts,
                                       row_number_by, top_k_per_group, with_group_total)
from aisle.params import DEFAULT, Params

CATEGORIES = ["accessories", "bottoms", "dresses", "outerwear", "shoes", "tops"]
STRONG = ["Very Strong", "Strong"]


def ranked_catalogue(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products with their 1-based rank inside the category, category sizes
    for the six order categories: <= 6 rows)."""
    ranked = row_number_by(products, "category", "product_id", out="category_rank")
    sizes = (products.filter(F.col("category").isin(CATEGORIES))
             .groupBy("category").agg(F.count(F.lit(1)).alias("category_size")))
    return ranked, sizes


def placed_catalogue(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products of the order categories with their ``_place``, category sizes with
    ``_before``: <= 6 rows). The categories stand one after the other: a product's place
    is the number of products before its category plus its rank in it, so one integer
    looks it up."""
    ranked, sizes = ranked_catalogue(products)
    before = Window.orderBy("category").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("category_size").over(before), F.lit(0)))
    placed = ranked.join(F.broadcast(sizes), "category", "inner").withColumn("_place", F.col("_before") + F.col("category_rank"))
    return placed.drop("_before", "category_size", "category_rank"), sizes


PICK_MODULUS = 1_000_003
POPULARITY = 3          # a third power: the first tenth of a category has 46 % of its sales


def keyed_rank(key: Column, item: Column, size: Column) -> Column:
    """A rank in 1..size drawn by the integer key of (order, item): u, uniform in
    [0, 1), to the power ``POPULARITY``, times the size. Sales concentrate on the
    first ranks, as demand does, so pairs of products recur in a catalogue of any size."""
    x = F.pmod(key * 7919 + item * 104729, F.lit(PICK_MODULUS))
    u = F.pmod(x * x + x * 31, F.lit(PICK_MODULUS)).cast("double") / F.lit(float(PICK_MODULUS))
    power = u
    for _ in range(POPULARITY - 1):
        power = power * u
    return F.floor(power * size).cast("long") + 1


def expand_baskets(orders: DataFrame, products: DataFrame, clusters: DataFrame,
                   p: Params = DEFAULT) -> DataFrame:
    cl = clusters.select("customer_id", "cluster_name", "persona_hidden")
    oc = (orders.select("order_id", "customer_id", "ordered_at", "total", "num_items", "returned")
          .join(cl, "customer_id", "left")
          .withColumn("primary_category", rules.primary_category(F.col("total")))
          .withColumn("secondary_category", rules.secondary_category(F.col("num_items"))))
    items = explode_count(oc, "num_items", "item_number")
    item = F.col("item_number")
    assigned = (F.when(item == 1, F.col("primary_category"))
                .when((item == 2) & F.col("secondary_category").isNotNull(), F.col("secondary_category"))
                .otherwise(F.col("primary_category")))
    placed, sizes = placed_catalogue(products)
    items = (items.withColumn("assigned_category", assigned)
             .join(F.broadcast(sizes), F.col("assigned_category") == sizes.category, "left")
             .drop("category")
             .withColumn("pick", F.col("_before") + keyed_rank(F.col("order_id"), item, F.col("category_size"))))
    cat = placed.select("_place", "product_id", "product_name", "category", "brand", "base_price")
    j = items.join(cat, items.pick == cat._place, "left")
    return j.select(
        "order_id", "customer_id", "ordered_at", "product_id", "product_name", "category", "brand",
        "base_price", F.col("total").alias("order_total"), F.col("num_items").alias("items_in_order"),
        F.col("returned").alias("order_returned"), "cluster_name", "persona_hidden")


def enrich_lines(lines: DataFrame, orders: DataFrame, clusters: DataFrame) -> DataFrame:
    """Lines with their order and its customer's cluster, which the orders meet first:
    lines are dealt out by order alone."""
    o = orders.select("order_id", "customer_id", "ordered_at", F.col("total").alias("order_total"),
                      F.col("num_items").alias("items_in_order"), F.col("returned").alias("order_returned"))
    cl = clusters.select("customer_id", "cluster_name", "persona_hidden")
    return (lines.join(o.join(cl, "customer_id", "left"), "order_id", "inner")
            .select("order_id", "line_number", "customer_id", "ordered_at", "product_id", "category", "brand",
                    "line_value", "order_total", "items_in_order", "order_returned", "cluster_name",
                    "persona_hidden"))


FAMILIES = 4            # product families per category


def affinity_items(items: DataFrame) -> DataFrame:
    """Expanded items as (cluster_name, order_id, product_id, category, brand);
    items of unclustered customers or of a category without products belong to no
    pair."""
    return (items.filter(F.col("cluster_name").isNotNull() & F.col("product_id").isNotNull())
            .select("cluster_name", "order_id", "product_id", "category", "brand"))


def family_items(items: DataFrame) -> DataFrame:
    """``affinity_items`` rolled up to product families."""
    family = F.pmod(F.col("product_id"), F.lit(FAMILIES)).cast("string")
    return affinity_items(items).withColumns({"product_id": F.concat("category", F.lit("-"), family),
                                              "brand": F.concat(F.lit("b"), family)})


def affinity_lines(items: DataFrame) -> DataFrame:
    """One row per (cluster, order, product): what every branch of
    ``product_affinity`` reads, so it is worth keeping."""
    it = items.filter(F.col("cluster_name").isNotNull())
    return basket_lines(it, "cluster_name", "order_id", "product_id", carry=["category", "brand"])


def affinity_baskets(lines: DataFrame) -> DataFrame:
    """One row per (cluster, order) with its number of products, narrow; the pairs and
    ``product_affinity`` read it, so it is worth keeping."""
    return basket_sizes(lines, "cluster_name", "order_id")


def affinity_pairs(lines: DataFrame, large: DataFrame | None = None) -> DataFrame:
    """One row per (cluster, item_a < item_b), narrow; read twice by
    ``product_affinity``, so it is worth keeping. ``large``: the ``large_baskets`` of
    ``affinity_baskets``, where stored."""
    return pair_counts(lines, "cluster_name", "order_id", "product_id", deduped=True, large=large)


def affinity_totals(lines: DataFrame) -> DataFrame:
    """One row per (cluster, product) with its number of baskets and its attributes;
    read three times by ``product_affinity``. The lines are counted by hash; only the
    grouped rows meet the first values of strings, which Spark sorts."""
    counted = lines.groupBy("cluster_name", "product_id", "category", "brand").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy("cluster_name", "product_id").agg(
        F.sum("_n").alias("total"), F.first("category").alias("category"), F.first("brand").alias("brand"))


def product_affinity(pairs: DataFrame, totals: DataFrame, lines: DataFrame, p: Params = DEFAULT,
                     baskets: DataFrame | None = None) -> DataFrame:
    """Support, confidence and lift from ``affinity_pairs``, ``affinity_totals`` and
    ``affinity_lines``, or ``affinity_baskets`` of them where stored. The sums over all
    pair rows of a cluster come from one row per (cluster, item_b), so only pairs bought
    often enough meet the totals."""
    baskets = affinity_baskets(lines) if baskets is None else baskets
    orders_in_cluster = baskets.groupBy("cluster_name").agg(F.count("order_id").alias("cluster_orders"))
    partners = pairs.groupBy("cluster_name", F.col("item_b").alias("product_id")).agg(
        F.sum("baskets").alias("_both"), F.count(F.lit(1)).alias("_pairs"))
    # both per-cluster sums in one aggregate: <= 6 rows, broadcast back
    sums = (partners.join(totals.select("cluster_name", "product_id", "total"), ["cluster_name", "product_id"])
            .groupBy("cluster_name").agg(F.sum("_both").alias("_sum_both"),
                                         F.sum(F.col("_pairs") * F.col("total")).alias("_sum_b")))
    side = lambda x: totals.select("cluster_name", F.col("product_id").alias(f"item_{x}"), F.col("total").alias(f"total_{x}"),
                                   F.col("category").alias(f"category_{x}"), F.col("brand").alias(f"brand_{x}"))
    m = (pairs.filter(F.col("times") >= p.min_pair_times)
         .join(side("a"), ["cluster_name", "item_a"]).join(side("b"), ["cluster_name", "item_b"])
         .join(F.broadcast(sums), "cluster_name", "left")
         .join(F.broadcast(orders_in_cluster), "cluster_name", "left"))
    both = F.col("baskets")
    m = m.select(
        "cluster_name", F.col("item_a").alias("product_a"), "category_a", "brand_a",
        F.col("item_b").alias("product_b"), "category_b", "brand_b",
        F.col("times").alias("times_bought_together"),
        F.col("baskets").alias("orders_with_both"),
        pct2(both, F.col("_sum_both")).alias("support_pct"),
        pct2(both, F.col("total_a")).alias("confidence_pct"),
        ratio2(both * F.col("_sum_b").cast("decimal(38,0)"),
               F.col("total_a").cast("decimal(38,0)") * F.col("total_b")).alias("lift"),
        ratio2(both * F.col("cluster_orders").cast("decimal(38,0)"),
               F.col("total_a").cast("decimal(38,0)") * F.col("total_b")).alias("lift_standard"),
    )
    m = m.filter(F.col("lift") >= p.min_lift)
    text = F.concat(F.lit("Customers who bought "), F.col("category_a"), F.lit(" ("), F.col("brand_a"),
                    F.lit(") also bought "), F.col("category_b"), F.lit(" ("), F.col("brand_b"), F.lit(") "),
                    F.col("confidence_pct").cast("string"), F.lit("% of the time"))
    return m.select(
        "cluster_name", "product_a", "category_a", "brand_a", "product_b", "category_b", "brand_b",
        "times_bought_together", "orders_with_both", "support_pct", "confidence_pct", "lift", "lift_standard",
        rules.pair_strength(F.col("times_bought_together"), F.col("lift")).alias("recommendation_strength"),
        text.alias("recommendation_text"))


def affinity_rollup(affinity: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Pairs of products per (cluster, category_a, category_b): exact totals over the
    strong pairs and the first ``top_pairs`` of them. At most 6 x 6 rows per cluster of
    at most ``top_pairs`` pairs, whatever the catalogue; totals are partial aggregates
    and a group ships at most ``top_pairs`` rows per task."""
    keys = ["cluster_name", "category_a", "category_b"]
    strong = F.col("recommendation_strength").isin(STRONG)
    hundredths = lambda c: F.round(F.col(c) * 100).cast("long")
    totals = affinity.groupBy(*keys).agg(
        F.count(F.when(strong, 1)).alias("strong_pairs"),
        F.sum(F.when(strong, hundredths("confidence_pct"))).alias("confidence_hundredths"),
        F.sum(F.when(strong, hundredths("lift"))).alias("lift_hundredths"),
        F.max(F.when(F.col("recommendation_strength") == STRONG[0], F.col("times_bought_together"))).alias("very_strong_times"))
    first = top_k_per_group(affinity.filter(strong), keys,
                            [F.col("times_bought_together").desc(), F.col("product_a"), F.col("product_b")],
                            p.top_pairs, rank_col="pair_rank")
    pair = F.struct("pair_rank", "product_a", "brand_a", "product_b", "brand_b", "times_bought_together",
                    "confidence_pct", "lift", "recommendation_strength", "recommendation_text")
    lists = first.groupBy(*keys).agg(F.sort_array(F.collect_list(pair)).alias("top_pairs"))
    return totals.join(lists, keys, "left")


def _category_purchases(orders: DataFrame, clusters: DataFrame) -> DataFrame:
    cl = clusters.select("customer_id", "cluster_name")
    return (orders.select("order_id", "customer_id", "total", "num_items").join(cl, "customer_id", "inner")
            .withColumn("primary_category", rules.primary_category(F.col("total"), capitalise=True))
            .withColumn("secondary_category", rules.secondary_category(F.col("num_items"), capitalise=True)))


def category_affinity(orders: DataFrame, clusters: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """J10 (intent of the v1 model): each order pairs its value category with
    its size category; the self-join on order is 1:1, so it is a filter."""
    pp = _category_purchases(orders, clusters)
    both = (pp.filter(F.col("secondary_category").isNotNull() & (F.col("primary_category") != F.col("secondary_category")))
            .withColumns({"category_a": F.col("primary_category"), "category_b": F.col("secondary_category")}))
    pairs = distinct_counts(both, ["cluster_name", "category_a", "category_b"],
                            {"co_occurrence_count": "order_id", "customers": "customer_id"})
    totals = pp.groupBy("cluster_name", F.col("primary_category").alias("category_a")).agg(
        F.count(F.lit(1)).alias("total_purchases"))
    m = with_group_total(pairs, "cluster_name", "co_occurrence_count", "_sum")
    m = m.join(totals, ["cluster_name", "category_a"], "left")
    conf = pct2(F.col("co_occurrence_count"), F.col("total_purchases"))
    text = F.concat(F.lit("Customers who bought "), F.col("category_a"), F.lit(" also bought "),
                    F.col("category_b"), F.lit(" ("), conf.cast("string"), F.lit("% of the time)"))
    return (m.filter(F.col("co_occurrence_count") >= p.min_category_pairs)
            .select("cluster_name", "category_a", "category_b", "co_occurrence_count", "customers",
                    pct2(F.col("co_occurrence_count"), F.col("_sum")).alias("support_pct"),
                    conf.alias("confidence_pct"),
                    rules.category_strength(F.col("co_occurrence_count")).alias("recommendation_strength"),
                    text.alias("recommendation_text")))


def category_preferences(orders: DataFrame, clusters: DataFrame) -> DataFrame:
    pp = _category_purchases(orders, clusters)
    return pp.groupBy("cluster_name", "primary_category").agg(
        F.count(F.lit(1)).alias("order_count"), F.countDistinct("customer_id").alias("unique_customers"))
