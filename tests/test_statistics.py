"""Moments that no heavy tail can overflow."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisle.functions.exact import MONEY_SCALE, big_div, half_up_div, moments, with_sample_std
from aisle.operators.clusters import behavioral_clusters


def exact_std(xs):
    n, s = len(xs), sum(xs)
    var = Fraction(n * sum(x * x for x in xs) - s * s, n * (n - 1))
    return math.sqrt(var)


def std_of(spark, xs, parts=4):
    df = spark.createDataFrame([(x,) for x in xs], "x long").repartition(parts)
    return with_sample_std(df.agg(*moments("x")), "x").first()["x_std"]


@pytest.mark.parametrize("xs", [
    [1, 2], [5, 5, 5], [0, 10**9 - 1, 10**9, 10**9 + 1], [-7, 3, 10**12], [2**63 - 1, -(2**63) + 1, 0],
    [2**63 - 1] * 20 + [2**63 - 2], [10**18 + i for i in range(50)], [100 * MONEY_SCALE] * 999 + [10**9 * MONEY_SCALE],
    list(range(-500, 500))])
def test_standard_deviation_is_that_of_fractions(spark, xs):
    want = exact_std(xs)
    assert std_of(spark, xs) == pytest.approx(want, rel=1e-12, abs=0)


def test_fewer_than_two_rows_and_nulls(spark):
    assert std_of(spark, [7]) is None
    assert std_of(spark, []) is None
    assert std_of(spark, [None, 3, None, 5]) == pytest.approx(math.sqrt(2))


def test_sums_of_a_billion_rows(spark):
    """The sums of 10^9 buyers, one of them of $1B, as aggregates would give them."""
    n, v, top = 10**9 - 1, 100 * MONEY_SCALE, 10**9 * MONEY_SCALE
    limb = 10**9
    parts = {"n": n + 1, "sum": n * v + top}
    for k, (a, b) in {"hh": (0, 0), "hl": (0, 1), "ll": (1, 1)}.items():
        parts[k] = n * divmod(v, limb)[a] * divmod(v, limb)[b] + divmod(top, limb)[a] * divmod(top, limb)[b]
    row = spark.createDataFrame([tuple(str(x) for x in parts.values())], [f"x_{k}" for k in parts])
    row = row.select(*[F.col(c).cast("decimal(38,0)").alias(c) for c in row.columns])
    s, q = parts["sum"], n * v * v + top * top
    want = math.sqrt(Fraction((n + 1) * q - s * s, (n + 1) * n))
    assert with_sample_std(row, "x").first()["x_std"] == pytest.approx(want, rel=1e-12)


def test_quotients_beyond_bigint(spark):
    row = spark.range(1).select(F.lit("170000000000000000000000000").cast("decimal(38,0)").alias("a"), F.lit(7).cast("long").alias("b"))
    assert int(row.select(big_div(F.col("a"), F.col("b"))).first()[0]) == 170000000000000000000000000 // 7
    near = spark.createDataFrame([(2**62 + 1, 2), (2**63 - 1, 3), (5, 2), (4, 3), (0, 9)], "a long, b long")
    got = [r[0] for r in near.select(half_up_div(F.col("a"), F.col("b"))).collect()]
    assert got == [2**61 + 1, (2**63 - 1) // 3 + 0, 3, 1, 0]


RFM = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("persona_hidden", T.StringType()),
    T.StructField("total_sessions", T.LongType()), T.StructField("frequency_orders", T.LongType()),
    T.StructField("monetary_total", T.DoubleType()), T.StructField("avg_order_value", T.DoubleType()),
    T.StructField("returned_orders", T.LongType()), T.StructField("is_browser_only", T.BooleanType()),
    T.StructField("high_returner", T.BooleanType()), T.StructField("discount_seeker", T.BooleanType()),
    T.StructField("monetary_units", T.LongType())])


def buyers(top):
    spent = [100 + i % 7 for i in range(999)] + [top]
    return [(i, "P0", 3, 1, float(d), float(d), 0, False, False, False, d * MONEY_SCALE) for i, d in enumerate(spent)], spent


@pytest.mark.parametrize("top", [10**6, 10**7, 10**9])
def test_scores_with_one_heavy_buyer(spark, top):
    rows, spent = buyers(top)
    std, mean = exact_std(spent), Fraction(sum(spent), len(spent))
    got = {}
    for parts in (3, 8, 64):
        out = behavioral_clusters(spark.createDataFrame(rows, RFM).repartition(parts)).collect()
        got[parts] = {r["customer_id"]: (r["monetary_score"], r["aov_score"], r["cluster_id"], r["session_score"]) for r in out}
    assert got[3] == got[8] == got[64]
    for i, d in enumerate(spent):
        monetary, aov, _, sessions = got[8][i]
        assert monetary == aov == pytest.approx(float(d - mean) / std, abs=0.005001)
        assert sessions is None          # no variance, no score
    assert got[8][999][0] == 31.59
