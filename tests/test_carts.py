"""Cart recommendations: worked out per kind of cart, with narrow shuffles that do not outlive their mart."""

import itertools
import re
import time

from pyspark.sql import functions as F

from aisle.operators.serving import cart_kinds, cart_recommendations
from aisle.params import DEFAULT
from aisle.plans import marts
from aisle.plans.marts import Marts

ROLLUP = [("A", "tops", "shoes", 2, 9000, 400), ("A", "tops", "dresses", 3, 3000, 900), ("A", "tops", "bottoms", 1, 1000, 150),
          ("A", "shoes", "dresses", 1, 8000, 200), ("A", "shoes", "tops", 4, 2000, 800), ("A", "shoes", "outerwear", 0, None, None),
          ("B", "tops", "tops", 5, 9900, 700), ("B", "dresses", "hats", 2, 5000, 300)]
CARTS = [(1, "A", "tops"), (2, "A", "tops"), (2, "A", "shoes"), (3, "A", "shoes"), (3, "A", "tops"), (4, "A", "tops"), (4, "B", "tops"),
         (5, "B", "dresses"), (6, None, "tops"), (7, "A", None), (8, "A", "hats"), (9, "C", "tops"), (None, "A", "tops")]
PRODUCTS = [(i, f"p{i}", c, f"brand{i}", i / 4) for i, c in enumerate(
    ["tops"] * 9 + ["shoes"] * 2 + ["dresses"] * 5 + ["bottoms"] + ["hats"] * 3 + [None])]


def _frames(spark):
    return (spark.createDataFrame(CARTS, "cart_id long, persona string, category string"),
            spark.createDataFrame(ROLLUP, "cluster_name string, category_a string, category_b string, strong_pairs long, "
                                          "confidence_hundredths long, lift_hundredths long"),
            spark.createDataFrame(PRODUCTS, "product_id long, product_name string, category string, brand string, base_price double"))


def _expected():
    """(cart, persona, category): (confidence, lift, pairs_with, rank), by a loop over carts."""
    out = {}
    for cart in {c for c, _, _ in CARTS}:
        found = {}
        for _, persona, category in (x for x in CARTS if x[0] == cart):
            for a in ROLLUP:
                if a[:2] == (persona, category) and a[3] > 0:
                    found.setdefault((persona, a[2]), []).append(a)
        best = [(sum(a[4] for a in v) / (100.0 * sum(a[3] for a in v)), sum(a[5] for a in v) / (100.0 * sum(a[3] for a in v)),
                 ", ".join(sorted(f"{a[1]} x{a[3]}" for a in v)), persona, c) for (persona, c), v in found.items()]
        for rank, b in enumerate(sorted(best, key=lambda b: (-b[0], b[4]))[:DEFAULT.cart_limit], 1):
            out[cart, b[3], b[4]] = (b[0], b[1], b[2], rank)
    return out


def test_recommendations_of_own_carts(spark, tmp_path):
    """Several personas in a cart, null keys, ranks that go to categories without products."""
    number = itertools.count()

    def keep(df):
        df.write.parquet(path := f"{tmp_path}/{next(number)}")
        return spark.read.schema(df.schema).parquet(path)

    expected = {k: v for k, v in _expected().items() if k[2] != "hats"}
    assert (4, "B", "tops") in expected and (None, "A", "shoes") in expected and (5, "B", "hats") in _expected()
    seen = []
    for how in (lambda df: df, keep):
        rows = cart_recommendations(*_frames(spark), keep=how).collect()
        assert {(r.cart_id, r.persona, r.recommended_category): (r.avg_confidence, r.avg_lift, r.pairs_with, r.rec_rank)
                for r in rows} == expected
        by = {}
        for r in rows:
            assert PRODUCTS[r.product_id] == (r.product_id, r.product_name, r.recommended_category, r.brand, r.base_price)
            by.setdefault((r.cart_id, r.persona, r.recommended_category), {})[r.product_slot] = r.product_id
        for key, picks in by.items():
            n = min(DEFAULT.products_per_category, sum(x[2] == key[2] for x in PRODUCTS))
            assert sorted(picks) == list(range(n)) and len(set(picks.values())) == n
        assert len(rows) == sum(map(len, by.values()))
        seen.append(sorted(map(str, rows)))
    assert seen[0] == seen[1]


def test_a_cart_has_one_kind(spark):
    kinds = {r.cart_id: [tuple(x) for x in r.kind] for r in cart_kinds(_frames(spark)[0]).collect()}
    assert kinds[2] == kinds[3] == [("A", "shoes"), ("A", "tops")] and kinds[4] == [("A", "tops"), ("B", "tops")]
    assert set(kinds) == {1, 2, 3, 4, 5, 8, 9, None}


def test_no_wide_row_of_a_cart_is_shuffled(spark, small_dir):
    import __spark_entry__ as E
    df = E.queries()["cart_recommendations"](spark, small_dir)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    shuffled = [set(re.findall(r"(\w+)#", x)) for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)]
    assert shuffled
    for columns in shuffled:
        assert not ("cart_id" in columns and columns & {"pairs_with", "avg_confidence", "persona", "product_name"}), columns


def test_shuffle_files_go_when_a_mart_is_stored(spark, small_dir):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles().iterator()
        names = []
        while files.hasNext():
            names.append(files.next().getName())
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    m = Marts(spark, small_dir)
    assert m._fact_rows                     # counted beforehand, in shuffles of its own
    before = shuffles()
    rows = spark.range(20_000).repartition(7).groupBy((F.col("id") % 999).alias("k")).count()
    got = m.stored(rows)
    until = time.time() + 30
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert got.count() == 999 and got.agg(F.sum("count")).first()[0] == 20_000
    m.release()


def test_pairs_of_many_facts_are_counted_cluster_by_cluster(spark, small_dir, monkeypatch):
    """One action at a time and the same rows, each once."""
    from aisle.operators import basket
    asked, count = [], basket.affinity_pairs
    monkeypatch.setattr(basket, "affinity_pairs", lambda lines, large: asked.append(lines) or count(lines, large))
    whole = sorted(Marts(spark, small_dir).affinity_pairs.collect())
    assert len(asked) == 1
    monkeypatch.setattr(marts, "SLICED_ROWS", 1)
    m = Marts(spark, small_dir)
    assert sorted(m.affinity_pairs.collect()) == whole
    parts = [{r[0] for r in lines.select("cluster_name").distinct().collect()} for lines in asked[1:]]
    assert len(parts) > 1 and all(len(p) == 1 for p in parts)
    assert set().union(*parts) == {r[0] for r in m.affinity_lines.select("cluster_name").distinct().collect()}
    m.release()
