"""Prefix sums and row numbers over a total order, in native expressions.

A single window over a hot group (or over the whole table) would run in one
task. Here the order key is cut into buckets, a partially aggregated groupBy
gives each bucket's totals, the few totals are summed up per group, and a
window inside (group, bucket) adds the rest. No job but the one that finds the
cut points runs, and nothing is checkpointed: the cut points are literals, so
every reader and every retry sees the same buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut_points(df: DataFrame, key: str, buckets: int) -> list:
    """At most ``buckets - 1`` ascending values of the numeric column ``key``
    that cut its rows into about equal parts (one aggregate; mergeable)."""
    if buckets < 2:
        return []
    at = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(key, at, F.lit(max(10000, 10 * buckets))).alias("q")).first()
    return sorted(set(row["q"] or []))


def bucket_by(col: Column, cuts: Sequence) -> Column:
    """Number of cut points at or below the value (0 for null), as a balanced
    tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(col.isNull(), F.lit(0)).otherwise(tree(0, len(cuts)))


def running_totals(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column],
                   totals: dict[str, str | Column]) -> DataFrame:
    """``df`` with two columns per entry of ``totals``: the sum of the value over
    all earlier rows of the group (rows before this one in (bucket, order)), and
    as ``<name>_total`` the sum over the whole group.

    ``bucket`` must not contradict ``order``. The relation of bucket totals has
    one row per (group, bucket); its window reads those rows only.
    """
    group = list(group)
    names = list(totals)
    value = {n: v if isinstance(v, Column) else F.col(v) for n, v in totals.items()}
    # one key for the join and the window, never null as a whole, so that both
    # read the same exchange of the rows
    key = lambda cols, b: F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)], b.alias("b"))
    per = df.groupBy(*group, bucket).agg(*[F.sum(v).alias(n) for n, v in value.items()])
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    base = per.select(
        key([F.col(g) for g in group], F.col(bucket)).alias("_key_of"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_base_{n}") for n in names],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in names])
    rows = df.withColumn("_key_of_row", key([F.col(g) for g in group], F.col(bucket)))
    local = rows.join(base, rows["_key_of_row"] == base["_key_of"], "left")
    inside = Window.partitionBy("_key_of_row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return local.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.col(f"_base_{n}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(n) for n, v in value.items()],
        *[F.col(f"{n}_total") for n in names])
