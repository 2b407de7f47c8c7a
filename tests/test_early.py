"""Early persona scorer: every rule and its traps."""

from pyspark.sql import functions as F

from aisle.operators.early import rejected_inputs, score_early
from aisle.params import DEFAULT
from aisle.sources.schemas import EARLY_RECORD

ROWS = [
    ("wb", 15, 3.0, 0, None, None, False),     # 15 sessions, no purchase
    ("vip", 2, 1.0, 2, 80.0, 1, False),        # 2 purchases by day 1
    ("day0", 2, 1.0, 2, 80.0, 0, False),       # day 0 is falsy: not VIP
    ("big", 1, 1.0, 1, 300.0, 3, False),       # first order 300
    ("deal", 1, 1.0, 1, 50.0, 3, True),        # used a discount
    ("casual", 1, 1.0, 0, None, None, None),
    ("unknown", 15, 3.0, None, None, None, None),   # no purchase count means none
    ("neg", 1, 1.0, 1, 50.0, -1, False),       # out of bounds
]


def test_scorer(spark):
    df = spark.createDataFrame(ROWS, EARLY_RECORD)
    got = {r.customer_id: (r.predicted_persona, r.confidence, r.ltv_forecast) for r in score_early(df).collect()}
    assert got["wb"] == ("Window Browser", 0.95, 173.0)
    assert got["vip"] == ("VIP Loyalist", 0.92, 3111.0)
    assert got["day0"][0] == "Casual Shopper"
    assert got["big"] == ("Big Ticket Buyer", 0.79, 891.0)
    assert got["deal"] == ("Deal Hunter", 0.65, 557.0)
    assert got["unknown"] == ("Window Browser", 0.95, 173.0)
    assert got["casual"] == ("Casual Shopper", 0.70, 682.0)
    assert "neg" not in got
    with_zero = {r.customer_id: r.predicted_persona
                 for r in score_early(df, DEFAULT.with_(include_day_zero=True)).collect()}
    assert with_zero["day0"] == "VIP Loyalist"
    rej = {r.customer_id: r.reject_reason for r in rejected_inputs(df).collect()}
    assert rej == {"neg": "days_to_first_purchase < 0"}


def test_traits_and_spellings(spark):
    from aisle.operators.serving import carts_from_strings, resolve_personas
    df = spark.createDataFrame(ROWS, EARLY_RECORD)
    traits = {r.customer_id: r.traits for r in score_early(df).collect()}
    assert traits["big"] == ["high_aov", "likely_gift_shopper"] and traits["wb"] == ["browse_heavy"]
    names = [("serial_returner",), ("Serial Returners",), ("window browers",), ("VIP LOYALISTS",), ("some_body",), (None,)]
    got = [r.cluster_name for r in resolve_personas(spark.createDataFrame(names, "persona string")).orderBy(F.monotonically_increasing_id()).collect()]
    assert sorted(map(str, got)) == sorted(["Serial Returns", "Serial Returns", "Window Browsers", "VIP Loyalists", "Some Body", "None"])
    carts = spark.createDataFrame([(1, "p", " Tops, shoes ,,tops"), (2, "p", None), (3, "p", " , ")], "cart_id int, persona string, cart string")
    assert sorted((r.cart_id, r.category) for r in carts_from_strings(carts).collect()) == [(1, "shoes"), (1, "tops")]
