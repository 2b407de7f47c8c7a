"""CSV round trip (A1/A2), mart invariants and partition-count metamorphism."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from aisle.plans.marts import Marts
from aisle.sources import files, tpch_adapter


def test_csv_round_trip(spark, small_dir):
    t = tpch_adapter.Tables(spark, small_dir)
    raw = tpch_adapter.raw_orders(t).drop("session_id")
    out = os.path.join(tempfile.mkdtemp(prefix="aisle-csv-"), "orders")
    raw.write.mode("overwrite").option("header", True).csv(out)
    back = files.read_csv(spark, out, raw.schema)
    assert sorted(back.collect()) == sorted(raw.collect())


def test_csv_with_the_raw_schemas(spark, tmp_path):
    from aisle.sources.schemas import RAW
    (tmp_path / "products.csv").write_text("product_id,product_name,category,brand,base_price,avg_rating,num_reviews\n"
                                           "P1,Top One,Tops,PlainWear,67.12,4.34,102\nP2,,Shoes,,1,,\n")
    got = files.read_csv(spark, str(tmp_path / "products.csv"), RAW["products"]).collect()
    assert [tuple(r) for r in got] == [("P1", "Top One", "Tops", "PlainWear", 67.12, 4.34, 102),
                                       ("P2", None, "Shoes", None, 1.0, None, None)]
    assert files.read_csv(spark, str(tmp_path / "products.csv")).count() == 2
    for name, schema in RAW.items():
        assert spark.createDataFrame([], schema).columns == schema.names, name


def test_overwrite_load_views_and_listing(spark, small_dir, tmp_path):
    out = str(tmp_path / "t")
    files.write_table(spark.range(5), out)
    files.write_table(spark.range(3).withColumn("k", F.col("id") % 2), out, ["k"])
    assert files.read_table(spark, out).count() == 3
    m = Marts(spark, small_dir)
    files.register_views({"v_customers": m.customers, "v_orders": m.orders})
    assert spark.sql("SELECT count(*) FROM v_customers").first()[0] == m.customers.count()
    assert {"v_customers", "v_orders"} <= {r.table_name for r in files.list_tables(spark).collect()}


def test_marts_are_written_and_released(spark, small_dir, tmp_path):
    m = Marts(spark, small_dir)
    store = m.materialise(str(tmp_path))
    again = m.materialise(str(tmp_path))
    assert {(r.name, r.version) for r in again.current().collect()} == {
        (n, 2) for n in ("rfm", "clusters", "ltv_v2", "product_affinity", "affinity_rollup")}
    assert store.read("clusters").count() == m.clusters.count()
    kept = m.clusters.inputFiles()
    m.release()
    assert kept and not any(os.path.exists(f.replace("file://", "")) for f in kept)


def test_checkpoint_folder_is_never_private_on_a_cluster():
    from types import SimpleNamespace

    from aisle.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda k, d=None: d)
    for master in ("yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))


def test_every_order_is_read(spark, small_dir):
    m = Marts(spark, small_dir)
    assert m.orders.count() == m.t["orders"].count()
    assert m.order_lines.count() == m.t["lineitem"].join(m.t["orders"], F.expr("l_orderkey = o_orderkey"), "left_semi").count()
    assert m.orders.agg(F.max("ordered_at")).first()[0] < m.p.as_of


def test_clusters_independent_of_partitioning(spark, small_dir):
    old, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("3", "8", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(sorted(Marts(spark, small_dir, keep=False).clusters.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] == seen[2]


def test_facts_are_reduced_before_the_customer_exchange(spark, small_dir):
    """With broadcast off, a partial aggregate stands below each shuffle of
    sessions or events by customer."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        m = Marts(spark, small_dir, keep=False)
        for df in (m.early_signals, m.journey):
            plan = df._jdf.queryExecution().executedPlan().toString()
            lines = plan.split("\n")
            scans = [i for i, line in enumerate(lines) if "events.parquet" in line]
            assert scans
            for i in scans:
                below = next(j for j in range(i, 0, -1) if "Exchange" in lines[j]) + 1
                assert any("partial_" in x for x in lines[below:below + 2]), lines[below - 1:i]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_one_stats_join_no_subquery(spark, small_dir):
    import __spark_entry__ as E
    plan = E.queries()["cart_recommendations"](spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan


def test_table_counts(spark, small_dir):
    m = Marts(spark, small_dir)
    got = {r.table_name: r.row_count for r in files.table_counts(
        {"customers": m.customers, "orders": m.orders}).collect()}
    assert got == {"customers": m.customers.count(), "orders": m.orders.count()}


def test_one_row_per_customer(spark, small_dir):
    m = Marts(spark, small_dir)
    n = m.customers.count()
    assert m.rfm.count() == n and m.rfm.select("customer_id").distinct().count() == n
    assert m.early_signals.count() == n
    assert m.ltv_v2.count() == m.clusters.count()


def test_naive_fanout_is_v2_times_sessions(spark, small_dir):
    m = Marts(spark, small_dir)
    j = m.rfm.select("customer_id", "monetary_units", "total_sessions").join(
        m.rfm_v1.select("customer_id", F.col("monetary_total").alias("v1")), "customer_id")
    bad = j.filter(F.abs(F.col("v1") - F.col("monetary_units") * F.greatest("total_sessions", F.lit(1)) / 100000.0) > 1e-6)
    assert bad.count() == 0


def test_clusters_only_buyers_and_six_names(spark, small_dir):
    from aisle.operators.clusters import CLUSTER_NAMES
    m = Marts(spark, small_dir)
    assert m.clusters.filter("frequency_orders <= 0").count() == 0
    assert {r[0] for r in m.clusters.select("cluster_name").distinct().collect()} <= set(CLUSTER_NAMES)


def test_campaign_tiers_partition_targets(spark, small_dir):
    from aisle.operators.serving import campaign_targets, campaign_tiers
    m = Marts(spark, small_dir)
    targets = campaign_targets(m.ltv_v2, m.clusters)
    tiers = campaign_tiers(targets)
    assert tiers.agg(F.sum("customers")).collect()[0][0] == targets.count()


def test_affinity_independent_of_partitioning(spark, small_dir):
    import __spark_entry__ as E
    q = E.queries()["product_affinity"]
    a = sorted(q(spark, small_dir).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.catalog.clearCache()
        b = sorted(q(spark, small_dir).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.catalog.clearCache()
    assert a == b


def test_profiles_by_key_list_and_by_key_table(spark, small_dir):
    from aisle.operators.serving import customer_profile
    m = Marts(spark, small_dir)
    keys = [r[0] for r in m.ltv_v2.select("customer_id").orderBy("customer_id").limit(3).collect()]
    by_list = customer_profile(m.ltv_v2, keys).collect()
    by_table = customer_profile(m.ltv_v2, spark.createDataFrame([(k,) for k in keys + keys + [-1]], "customer_id long")).collect()
    assert sorted(r.customer_id for r in by_list) == keys and sorted(by_list) == sorted(by_table)


def test_affinity_pairs_are_of_real_products(spark, small_dir):
    import __spark_entry__ as E
    from compare import compare, duck
    from aisle.operators.basket import affinity_items, affinity_lines, affinity_pairs
    m = Marts(spark, small_dir)
    items = m.basket_items.filter("cluster_name IS NOT NULL AND product_id IS NOT NULL")
    a, b = (items.select("cluster_name", "order_id", F.col("product_id").alias(x)) for x in "ab")
    want = a.join(b, ["cluster_name", "order_id"]).filter("a < b").groupBy("cluster_name", "a", "b").agg(
        F.count("*").alias("times"), F.countDistinct("order_id").alias("baskets"))
    got = affinity_pairs(affinity_lines(affinity_items(m.basket_items)))
    keys = sorted(tuple(r) for r in got.select("cluster_name", "item_a", "item_b", "times", "baskets").collect())
    assert keys == sorted(tuple(r) for r in want.collect()) and len({(x[0], x[1], x[2]) for x in keys}) > 1000
    name = "catalogue_affinity"
    assert compare(name, E.queries()[name](spark, small_dir).toPandas(), duck(small_dir).execute(E.oracle_sql()[name]).df()) == "OK"
