"""Tasks in proportion to the input: settings around stored marts, pairs and the stream's processor."""

from types import SimpleNamespace

import pytest
from pyspark.sql import Row

from aisle import session
from aisle.operators.basket import affinity_pairs, affinity_totals, product_affinity
from aisle.params import DEFAULT
from aisle.plans.marts import Marts
from aisle.streaming import first_week


def test_settings_rise_with_the_rows_and_come_back(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(k, None) for k in keys]
    with pytest.raises(ZeroDivisionError):
        with session.sized_tasks(spark, 40 * session.ROWS_PER_TASK + 1):
            assert [spark.conf.get(k) for k in keys] == ["41", session.BYTES_PER_TASK, session.BYTES_PER_TASK]
            1 / 0
    assert [spark.conf.get(k, None) for k in keys] == before
    with session.sized_tasks(spark, 1):
        assert spark.conf.get(keys[0]) == before[0]


@pytest.mark.parametrize("name", ["join_pair_lt", "join_pair_ne", "cart_strings", "agg_string_sorted", "family_affinity"])
def test_stored_results_are_made_by_more_tasks(spark, small_dir, monkeypatch, name):
    import __spark_entry__ as E
    monkeypatch.setattr(session, "ROWS_PER_TASK", 400)
    seen, write = [], Marts._kept
    def kept(m, df):
        out = write(m, df)
        seen.append((m._fact_rows, len(out.inputFiles())))
        return out
    monkeypatch.setattr(Marts, "_kept", kept)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    old, parts = spark.conf.get(coalesce), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(coalesce, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        E.queries()[name](spark, small_dir)
    finally:
        spark.conf.set(coalesce, old)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert seen and seen[0][0] == sum(Marts(spark, small_dir).t[n].count() for n in ("orders", "lineitem", "events"))
    assert max(files for _, files in seen) > 1


def test_affinity_from_own_rows(spark):
    """Sums run over all pairs, also those that are too rare to be returned."""
    baskets = {o: "abc" if o % 2 else "ab" for o in range(12)} | {50: "cd", 51: "a"}
    rows = [("X", o, p, f"cat-{p}", f"brand-{p}", 1) for o, items in baskets.items() for p in items]
    lines = spark.createDataFrame(rows, "cluster_name string, order_id long, product_id string, category string, brand string, _cnt long")
    pairs = affinity_pairs(lines)
    assert pairs.columns == ["cluster_name", "item_a", "item_b", "times", "baskets"]
    total = {p: sum(p in items for items in baskets.values()) for p in "abcd"}
    both = {(a, b): n for a in "abcd" for b in "abcd" if a < b
            and (n := sum(a in items and b in items for items in baskets.values()))}
    sum_both, sum_b = sum(both.values()), sum(total[b] for _, b in both)
    got = product_affinity(pairs, affinity_totals(lines), lines, DEFAULT.with_(min_lift=0.0)).collect()
    half_up = lambda n, d: (2 * 100 * n + d) // (2 * d) / 100
    assert {(r.product_a, r.product_b): (r.orders_with_both, r.category_a, r.brand_b, r.support_pct, r.confidence_pct, r.lift, r.lift_standard)
            for r in got} == {
        (a, b): (n, f"cat-{a}", f"brand-{b}", half_up(100 * n, sum_both), half_up(100 * n, total[a]),
                 half_up(n * sum_b, total[a] * total[b]), half_up(n * len(baskets), total[a] * total[b]))
        for (a, b), n in both.items() if n >= DEFAULT.min_pair_times}
    assert ("c", "d") in both and len(got) < len(both)


def test_first_week_reads_plain_rows():
    """No frame is made per customer: rows go in and rows come out."""
    state, timers = [], []
    handle = SimpleNamespace(
        getValueState=lambda *_: SimpleNamespace(get=lambda: state[-1] if state else None, update=state.append, clear=state.clear),
        registerTimer=timers.append, deleteTimer=timers.remove)
    week = first_week._processor()
    week.init(handle)
    row = Row("num_cart_adds", "num_products_viewed", "purchased", "day", "at_us", "closes")
    at = lambda mark: SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
    late = list(week.handleInputRows((7,), iter([row(1, 2, False, 0, 5, 100), row(3, None, True, 4, 6, 900), row(2, 1, None, 1, 7, 901)]), at(100)))
    assert [(r.customer_id, r.late_at, r.sessions_first_7d) for r in late] == [(7, 5, None)]
    assert list(week.handleInputRows((7,), iter([row(0, 2, True, 2, 8, 950)]), at(200))) == [] and timers == [950]
    out = [r.asDict() for r in week.handleExpiredTimer((7,), at(960), None)]
    assert out == [{"customer_id": 7, "sessions_first_7d": 3, "avg_cart_adds": 5 / 3, "avg_products_viewed": 1.0,
                    "purchases_first_7d": 2, "days_to_first_purchase": 2, "late_at": None}] and state == []
