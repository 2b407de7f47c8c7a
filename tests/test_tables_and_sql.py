"""Stored tables (A2, A6, A8), CSV inference and quarantine (A1), SQL with
parameters (A5, A9), distinct counts by bitmaps (D5), random samples (F4)."""

import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from aisle.operators.relational import distinct_counts
from aisle.operators.serving import draw_ranks, sample_per_key
from aisle.sources.files import query_views, scan_csv
from aisle.sources.tables import TableStore, lookup, store_by_key


def test_a_failed_refresh_leaves_the_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(KeyError):
        store.read("t")
    before = store.refresh("t", spark.range(1000).withColumn("v", F.col("id") * 2))
    broken = spark.range(0, 1000, 1, 8).withColumn("v", F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("half-way"))))
    with pytest.raises(Exception, match="half-way"):
        store.refresh("t", broken)
    assert before.agg(F.sum("v")).first()[0] == 999 * 1000 == store.read("t").agg(F.sum("v")).first()[0]
    after = store.refresh("t", spark.range(10).withColumn("v", F.lit(1).cast("long")))
    assert after.count() == 10 == store.read("t").count()
    assert before.count() == 1000                      # an earlier reader keeps its version
    assert [(r.name, r.version, r.row_count) for r in store.current().collect()] == [("t", 2, 10)]


def test_a_short_write_is_not_swapped_in(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    store.refresh("t", spark.range(5))
    from pyspark.sql import Observation
    monkeypatch.setattr(Observation, "get", property(lambda self: {"n": 8}))
    with pytest.raises(IOError):
        store.refresh("t", spark.range(7))
    monkeypatch.undo()
    assert store.read("t").count() == 5


def test_empty_and_partitioned_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.refresh("e", spark.range(0)).count() == 0
    t = store.refresh("p", spark.range(10).withColumn("k", F.col("id") % 3), partition_by=["k"])
    assert sorted(t.columns) == ["id", "k"] and t.filter("k = 1").count() == 3


def test_lookup_prunes_buckets(spark, tmp_path):
    df = spark.range(20000).withColumn("v", F.col("id").cast("string"))
    stored = store_by_key(df, "id", str(tmp_path / "t"), "lookup_test", buckets=16)
    found = lookup(stored, "id", [17, 4711, 10**9])
    assert sorted(r.id for r in found.collect()) == [17, 4711]
    # two of the keys exist, in at most two buckets; the third key's row groups are ruled out by statistics
    leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() < 3 * 20000 / 16
    # the plan says how many buckets only where buckets are also kept apart as partitions
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")
    plan = lookup(stored, "id", [17, 4711, 10**9])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset(auto)
    buckets = re.search(r"SelectedBucketsCount: (\d+) out of 16", plan)
    assert buckets and int(buckets[1]) <= 3
    assert "In(id, [" in plan                            # the pushed filter
    spark.sql("DROP TABLE lookup_test")


def test_csv_types_and_quarantine(spark, tmp_path):
    rows = [f"{i},{i / 4},2024-01-{i % 28 + 1:02d},{'true' if i % 2 else 'false'},name {i}" for i in range(100)]
    rows += ["x1,1.0,2024-01-01,true,bad id", "200,1.0,2024-01-01,true", "201,oops,2024-01-01,true,bad number", "202,,,,",
             "203,1,2024-13-77,false,bad day", '204,2.5,2024-02-02,true,"a, quoted ""one"""', "205,1,2024-01-01,true,a,b"]
    (tmp_path / "t.csv").write_text("id,x,day,flag,name\n" + "\n".join(rows) + "\n")
    good, bad = scan_csv(spark, str(tmp_path / "t.csv"))
    assert dict(good.dtypes) == {"id": "bigint", "x": "double", "day": "date", "flag": "boolean", "name": "string"}
    got = {r["id"]: r for r in good.collect()}
    assert set(got) == {*range(100), 202, 204}
    assert got[204]["name"] == 'a, quoted "one"' and got[202]["x"] is None and got[7]["x"] == 1.75
    assert sorted(r["reason"] for r in bad.collect()) == sorted([
        "id: 'x1' is no bigint", "wrong number of fields", "wrong number of fields", "x: 'oops' is no double",
        "day: '2024-13-77' is no date"])


def test_csv_folder_without_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    good, bad = scan_csv(spark, str(tmp_path))
    assert good.count() == bad.count() == 0 and dict(good.dtypes) == {"a": "string", "b": "string"}


def test_sql_values_are_never_text(spark):
    people = spark.createDataFrame([(1, "O'Hare"), (2, "x') OR ('1'='1"), (3, None)], "id int, name string")
    run = lambda names, least: sorted(r.id for r in query_views(
        spark, "SELECT id FROM {p} WHERE array_contains(:names, name) AND id >= :least", {"p": people}, names=names, least=least).collect())
    assert run(["O'Hare"], 0) == [1]
    assert run(["x') OR ('1'='1"], 0) == [2]
    assert run(["nobody"], 0) == []
    assert run(["O'Hare", "x') OR ('1'='1"], 2) == [2]


def test_distinct_counts_of_any_ids(spark):
    ids = [0, 1, 1, -1, -40000, 32767, 32768, 32769, 2**31, 2**31 + 1, 2**62, 2**62, None]
    rows = [("a", i, n % 3) for n, i in enumerate(ids)] + [(None, 5, None), (None, 5, 7), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, x long, y int").repartition(4)
    got = {r["k"]: (r["nx"], r["ny"]) for r in distinct_counts(df, "k", {"nx": "x", "ny": "y"}).collect()}
    want = {r["k"]: (r["nx"], r["ny"]) for r in df.groupBy("k").agg(F.countDistinct("x").alias("nx"), F.countDistinct("y").alias("ny")).collect()}
    assert got == want
    plan = distinct_counts(df, "k", {"nx": "x", "ny": "y"})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_drawn_subsets_are_about_equally_likely(spark):
    keys = spark.range(6000).withColumns({"key": F.col("id"), "size": F.lit(5).cast("long")})
    rows = draw_ranks(keys, ["key"], "size", 3).collect()
    drawn = {}
    for r in rows:
        drawn.setdefault(r["key"], []).append((r["slot"], r["rank"]))
    subsets = Counter(frozenset(x for _, x in d) for d in drawn.values())
    assert all(len(d) == 3 and len({x for _, x in d}) == 3 and all(1 <= x <= 5 for _, x in d) for d in drawn.values())
    assert set(subsets) == {frozenset(c) for c in combinations(range(1, 6), 3)}
    assert all(abs(n - 600) < 5 * 600**0.5 for n in subsets.values())
    again = {(r["key"], r["slot"], r["rank"]) for r in draw_ranks(keys.repartition(7), ["key"], "size", 3).collect()}
    assert again == {(r["key"], r["slot"], r["rank"]) for r in rows}


def test_draws_from_small_groups_take_all(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "key long, size long")
    got = {}
    for r in draw_ranks(rows, ["key"], "size", 3).collect():
        got.setdefault(r["key"], set()).add(r["rank"])
    assert got == {1: {1}, 2: {1, 2}, 3: {1, 2, 3}}


def test_samples_per_key_differ_by_seed_and_cover(spark):
    rows = spark.range(60).select((F.col("id") % 3).alias("k"), F.col("id").alias("item"))
    seen = Counter()
    for seed in range(40):
        got = sample_per_key(rows, "k", "item", 3, str(seed)).filter("k = 0").collect()
        assert sorted(r["slot"] for r in got) == [0, 1, 2]
        seen.update(r["item"] for r in got)
    assert len(seen) >= 19 and max(seen.values()) <= 18     # 120 draws of 20 items
