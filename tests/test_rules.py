"""Rule ladders at every threshold +- epsilon, NULL, 0 and negative values."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisle.functions import rules


def _one(spark, schema, rows, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_recency_score(spark):
    s = T.StructType([T.StructField("d", T.IntegerType())])
    days = [-5, 0, 30, 31, 60, 61, 90, 91, 180, 181, None]
    got = _one(spark, s, [(d,) for d in days], rules.r_score(F.col("d")))
    assert got == [5, 5, 5, 4, 4, 3, 3, 2, 2, 1, 0]


def test_frequency_and_monetary_scores(spark):
    s = T.StructType([T.StructField("f", T.LongType()), T.StructField("m", T.DoubleType())])
    rows = [(0, 0.0), (1, 0.01), (2, 49.99), (3, 50.0), (5, 100.0), (10, 250.0), (11, 500.0)]
    df = spark.createDataFrame(rows, s)
    got = [(r[0], r[1]) for r in df.select(rules.f_score(F.col("f")), rules.m_score(F.col("m"))).collect()]
    assert got == [(0, 0), (1, 1), (2, 1), (3, 2), (4, 3), (5, 4), (5, 5)]


def test_segment_order(spark):
    s = T.StructType([T.StructField(n, T.IntegerType()) for n in "rfm"])
    rows = [(5, 5, 5), (3, 3, 3), (5, 1, 1), (1, 3, 3), (1, 1, 1), (3, 1, 3), (3, 3, 1), (0, 0, 0), (3, 1, 1)]
    got = _one(spark, s, rows, rules.rfm_segment(F.col("r"), F.col("f"), F.col("m")))
    # a never-buyer (0,0,0) matches 'Lost' first: 'Never Purchased' is unreachable
    assert got == ["Champions", "Loyal Customers", "New Customers", "At Risk", "Lost", "Big Spenders",
                   "Frequent Shoppers", "Lost", "Potential"]


def test_churn_and_risk(spark):
    s = T.StructType([T.StructField("d", T.IntegerType()), T.StructField("ltv", T.DoubleType())])
    rows = [(None, 10.0), (30, 10.0), (31, 10.0), (61, 999.0), (61, 1000.0), (91, 10.0), (181, 10.0)]
    df = spark.createDataFrame(rows, s).withColumn("c", rules.churn_probability(F.col("d")))
    strict = df.select("c", rules.risk_status(F.col("c"), F.col("ltv"), True)).collect()
    assert [r[0] for r in strict] == [1.0, 0.10, 0.25, 0.50, 0.50, 0.75, 0.90]
    # the reference's `>+ 0.50` sends churn 0.5 with low LTV to Healthy
    assert [r[1] for r in strict] == ["Likely Churned", "Healthy", "Healthy", "Healthy", "High Value At Risk",
                                      "Likely Churned", "Likely Churned"]
    intended = df.select(rules.risk_status(F.col("c"), F.col("ltv"), False)).collect()
    assert intended[3][0] == "At Risk"
    # v1 has no NULL branch: NULL recency churns at 0.90
    v1 = df.select(rules.churn_probability(F.col("d"), null_is_never=False)).collect()
    assert v1[0][0] == 0.90


def test_value_tier_and_categories(spark):
    s = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("n", T.IntegerType())])
    rows = [(99.99, 0), (100.0, 1), (500.0, 2), (1000.0, 3), (2000.0, 4), (40.0, None), (300.0, 5)]
    df = spark.createDataFrame(rows, s)
    got = df.select(rules.value_tier(F.col("x")), rules.primary_category(F.col("x")),
                    rules.secondary_category(F.col("n"))).collect()
    assert [r[0] for r in got] == ["Basic", "Bronze", "Silver", "Gold", "Platinum", "Basic", "Bronze"]
    assert [r[1] for r in got] == ["shoes", "shoes", "outerwear", "outerwear", "outerwear", "bottoms", "outerwear"]
    assert [r[2] for r in got] == [None, None, "tops", "tops", "accessories", None, "accessories"]


def test_month_boundaries(spark):
    from aisle.functions.dates import month_boundaries
    s = T.StructType([T.StructField("a", T.DateType()), T.StructField("b", T.DateType())])
    rows = [(dt.date(1995, 1, 31), dt.date(1995, 2, 1)), (dt.date(1995, 1, 1), dt.date(1995, 12, 31)),
            (dt.date(1995, 12, 31), dt.date(1995, 12, 31))]
    got = _one(spark, s, rows, month_boundaries(F.col("a"), F.col("b")))
    assert got == [1, 11, 0]


def test_exact_percentages(spark):
    from aisle.functions.exact import pct2, ratio2
    s = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.LongType())])
    rows = [(1, 3), (2, 3), (1, 32), (201, 200), (0, 5), (5, 0)]
    got = spark.createDataFrame(rows, s).select(pct2(F.col("n"), F.col("d")), ratio2(F.col("n"), F.col("d"))).collect()
    assert [r[0] for r in got] == [33.33, 66.67, 3.13, 100.5, 0.0, None]
    # 201/200 = 1.005 rounds half-up on the exact ratio
    assert [r[1] for r in got] == [0.33, 0.67, 0.03, 1.01, 0.0, None]
