"""Registered queries against their DuckDB SQL twins on the smallest tables."""

import pytest

from compare import compare, duck

QUERIES = ["stg_orders", "rfm_segments", "rfm_naive_fanout", "cluster_assignment", "journey_paths",
           "event_timeline", "early_signals", "early_persona_score", "ltv_forecast_v2", "ltv_forecast_v1",
           "basket_expansion", "product_affinity", "category_affinity", "at_risk_summary", "campaign_roi",
           "join_pair_lt", "join_pair_ne", "win_row_number", "join_sample_k_per_key", "agg_string_ordered",
           "journey_milestones", "cluster_stats", "ltv_by_persona", "portfolio_metrics", "persona_dimension",
           "persona_name_lookup", "cart_strings", "default_recommendations", "rejected_inputs", "stream_first_week"]


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__ as E
    return E.queries(), E.oracle_sql()


def test_every_query_has_oracle(entry):
    """All queries of the library itself; those of the optional training-data
    subpackage state beside each whether SQL can express it."""
    from aisle.plans.registry import QUERIES as own
    qs, sql = entry
    assert set(sql) <= set(qs) and set(own) <= set(sql)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, small_dir, entry, name):
    qs, sql = entry
    got = qs[name](spark, small_dir).toPandas()
    want = duck(small_dir).execute(sql[name]).df()
    assert compare(name, got, want) == "OK"


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "rfm_segment" in df.columns
