"""Skew-safe operators against brute force, with one hot key holding a
third of the rows."""

import datetime as dt
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aisle.operators.relational import (basket_sizes, explode_count, large_baskets, ordered_concat, pair_counts,
                                       row_number_by)


def test_row_number_by_matches_window_on_hot_key(spark):
    rnd = random.Random(7)
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 40), rnd.randint(-9000, 90000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, t long, id long").repartition(7)
    got = row_number_by(df, "g", ["t", "id"], out="rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_row_number_by_day_and_own_bucket(spark):
    rnd = random.Random(9)
    start = dt.datetime(2020, 1, 1)
    rows = [(rnd.choice([None, 1, 2]), None if i % 50 == 0 else start + dt.timedelta(hours=rnd.randint(0, 900)), i) for i in range(800)]
    df = spark.createDataFrame(rows, "g int, t timestamp_ntz, id long")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("t", "id"))).collect()
    key = lambda r: (str(r), )
    assert sorted(row_number_by(df, "g", ["t", "id"], out="rn").collect(), key=key) == sorted(want, key=key)
    named = df.select("g", F.col("id").cast("string").alias("id"))
    with pytest.raises(ValueError):
        row_number_by(named, "g", "id")
    got = row_number_by(named, "g", "id", out="rn", bucket=F.substring("id", 1, 1)).collect()
    want = named.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("id"))).collect()
    assert sorted(got, key=key) == sorted(want, key=key)


def test_row_number_by_large_ids_and_nulls(spark):
    big = 2 ** 53
    rows = [(big + 1, 1), (big + 3, 2), (big + 3, 1), (None, 5), (None, None), (big + 1, None)]
    got = {(r.g, r.t, r.rn) for r in row_number_by(spark.createDataFrame(rows, "g long, t long"), "g", "t", out="rn").collect()}
    assert got == {(big + 1, None, 1), (big + 1, 1, 2), (big + 3, 1, 1), (big + 3, 2, 2), (None, None, 1), (None, 5, 2)}


def test_row_number_by_needs_no_job_and_no_python(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("g"), "id")
    plan = row_number_by(df, "g", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Checkpoint" not in plan


def test_explode_count_splits_large_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 5), (4, 23), (5, None), (6, -2)], "k long, n int")
    got = explode_count(df, "n", "i", chunk=4)
    counts = Counter(r.k for r in got.collect())
    assert counts == {2: 1, 3: 5, 4: 23}
    assert sorted(r.i for r in got.filter("k = 4").collect()) == list(range(1, 24))
    dealt = explode_count(df, "n", "i", chunk=4, spread=["k"])
    assert sorted(dealt.collect()) == sorted(got.collect())
    assert explode_count(spark.createDataFrame([(1, 100_000)], "k long, n int"), "n", "i").count() == 100_000


def _brute_pairs(baskets, ordered):
    times, both = Counter(), Counter()
    for items in baskets.values():
        seen = set()
        for a, b in itertools.product(items, items):
            if (a != b) if ordered else (a < b):
                times[(a, b)] += 1
                seen.add((a, b))
        for p in seen:
            both[p] += 1
    return times, both


def test_pair_counts_match_self_join(spark):
    rnd = random.Random(3)
    baskets = {o: [f"p{rnd.randint(0, 9)}" for _ in range(rnd.randint(1, 6))] for o in range(400)}
    baskets[999] = [f"p{i % 10}" for i in range(300)]          # one hot basket with repeats
    rows = [(o, p) for o, items in baskets.items() for p in items]
    df = spark.createDataFrame(rows, "o long, p string").withColumn("g", F.lit(1)).repartition(5)
    for ordered in (False, True):
        got = pair_counts(df, "g", "o", "p", ordered=ordered).collect()
        times, both = _brute_pairs(baskets, ordered)
        assert {(r.item_a, r.item_b): r.times for r in got} == dict(times)
        assert {(r.item_a, r.item_b): r.baskets for r in got} == dict(both)


def test_pair_counts_without_basket_or_item(spark):
    rows = [(None, "a"), (None, "b"), (1, "a"), (1, "b"), (1, None), (2, None), (2, "c")]
    df = spark.createDataFrame(rows, "o long, p string").withColumn("g", F.lit(1))
    assert [tuple(r) for r in pair_counts(df, "g", "o", "p").collect()] == [(1, "a", "b", 1, 1)]


def test_pair_counts_of_a_huge_basket(spark):
    """A basket of 20,000 items is many block pairs; only a sum is read back."""
    n = 20_000
    df = spark.range(n).select(F.lit(1).alias("g"), F.lit(7).alias("o"), F.col("id").alias("p"))
    few = df.filter("p < 500")
    got = pair_counts(few, "g", "o", "p", block=64)
    assert got.count() == 500 * 499 // 2 and got.filter("times <> 1 OR baskets <> 1").count() == 0
    lines = df.withColumn("_cnt", F.lit(1).cast("long"))
    pairs = pair_counts(lines, "g", "o", "p", deduped=True)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_pair_counts_join_on_one_integer(spark, tmp_path):
    """The self-join sorts by one integer, and lines whose large baskets are stored are shuffled once."""
    rows = [(g, o, p, 1 + p % 2) for g in ("x", "y", None) for o in range(40) for p in range(30 if o == 7 else o % 5)]
    spark.createDataFrame(rows, "g string, o long, p long, _cnt long").write.parquet(f"{tmp_path}/lines")
    lines = spark.read.parquet(f"{tmp_path}/lines")
    large_baskets(basket_sizes(lines, "g", "o"), 8).write.parquet(f"{tmp_path}/large")
    large = spark.read.parquet(f"{tmp_path}/large")
    assert {(r.g, r.o, r._n) for r in large.collect()} == {(g, 7, 30) for g in ("x", "y", None)}
    for ordered in (False, True):
        pairs = pair_counts(lines, "g", "o", "p", ordered=ordered, deduped=True, block=8, large=large)
        got = {(r.g, r.item_a, r.item_b): (r.times, r.baskets) for r in pairs.collect()}
        want = defaultdict(lambda: (0, 0))
        for g, o, a, m in rows:
            for h, q, b, n in rows:
                if (g, o) == (h, q) and ((a != b) if ordered else (a < b)):
                    want[(g, a, b)] = (want[(g, a, b)][0] + m * n, want[(g, a, b)][1] + 1)
        assert got == dict(want)
        assert got == {(r.g, r.item_a, r.item_b): (r.times, r.baskets)
                       for r in pair_counts(lines, "g", "o", "p", ordered=ordered, deduped=True, block=8).collect()}
    plan = pair_counts(lines, "g", "o", "p", deduped=True, large=large)._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"Join \[_key#\d+L\], \[_key#\d+L\]", plan), plan


def test_ordered_concat_in_two_levels(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 1, 2]), i, None if i % 7 == 0 else f"e{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, i int, e string").repartition(5)
    got = {r.k: r.s for r in ordered_concat(df, "k", "e", ["i"], F.shiftright("i", 4), ", ", "s").collect()}
    want = {k: ", ".join(e for kk, _, e in rows if kk == k and e) for k in (None, 1, 2)}
    assert got == want
