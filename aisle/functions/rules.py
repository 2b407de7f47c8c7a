"""Threshold ladders as data.

A ladder is an ordered list of (condition, value); the first match wins, like
a searched CASE (B9). Each reference rule table lives here once and is turned
into a single ``F.when`` chain, so every mart and query shares the same rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false END: NULL becomes false."""
    return F.coalesce(cond, F.lit(False))


# ---- fixed values: RFM score ladders (upper bound in days -> score) --------
RECENCY_STEPS = [(30, 5), (60, 4), (90, 3), (180, 2)]
FREQUENCY_STEPS = [(10, 5), (5, 4), (3, 3), (2, 2), (1, 1)]
MONETARY_STEPS = [(500, 5), (250, 4), (100, 3), (50, 2)]

# ---- fixed values: churn probability by days since last order -------------
CHURN_STEPS = [(30, 0.10), (60, 0.25), (90, 0.50), (180, 0.75)]
CHURN_ELSE = 0.90
CHURN_NEVER = 1.0

# ---- fixed values: value tier by predicted 12-month LTV --------------------
VALUE_TIERS = [(2000, "Platinum"), (1000, "Gold"), (500, "Silver"), (100, "Bronze")]
VALUE_TIER_ELSE = "Basic"

# ---- fixed values: order-value categories (J8, J10) ------------------------
PRIMARY_CATEGORY_STEPS = [(300, "outerwear"), (150, "dresses"), (80, "shoes"), (40, "bottoms")]
PRIMARY_CATEGORY_ELSE = "tops"
SECONDARY_CATEGORY_STEPS = [(4, "accessories"), (2, "tops")]

# ---- fixed values: affinity strength (times, rounded lift) -----------------
PAIR_STRENGTH = [(50, 2.0, "Very Strong"), (30, 1.5, "Strong"), (15, 1.2, "Moderate")]
PAIR_STRENGTH_ELSE = "Weak"
CATEGORY_STRENGTH = [(50, "Strong"), (20, "Moderate")]
CATEGORY_STRENGTH_ELSE = "Weak"


def r_score(recency_days: Column) -> Column:
    rules = [(recency_days <= d, s) for d, s in RECENCY_STEPS]
    rules.append((recency_days.isNull(), 0))
    return ladder(rules, 1)


def f_score(frequency: Column) -> Column:
    return ladder([(frequency >= n, s) for n, s in FREQUENCY_STEPS], 0)


def m_score(monetary: Column) -> Column:
    rules = [(monetary >= m, s) for m, s in MONETARY_STEPS]
    rules.append((monetary > 0, 1))
    return ladder(rules, 0)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    # fixed order of the reference; 'Never Purchased' is unreachable because a
    # never-buyer (0,0,0) already matches 'Lost'
    return ladder([
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers"),
        ((r >= 4) & (f <= 2) & (m <= 2), "New Customers"),
        ((r <= 2) & (f >= 3) & (m >= 3), "At Risk"),
        ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
        ((r >= 3) & (f <= 2) & (m >= 3), "Big Spenders"),
        ((r >= 3) & (f >= 3) & (m <= 2), "Frequent Shoppers"),
        ((r == 0) & (f == 0) & (m == 0), "Never Purchased"),
    ], "Potential")


def churn_probability(days_since_last: Column, null_is_never: bool = True) -> Column:
    rules = []
    if null_is_never:
        rules.append((days_since_last.isNull(), CHURN_NEVER))
    rules += [(days_since_last <= d, p) for d, p in CHURN_STEPS]
    return ladder(rules, CHURN_ELSE).cast("double")


def value_tier(ltv: Column) -> Column:
    return ladder([(ltv >= t, name) for t, name in VALUE_TIERS], VALUE_TIER_ELSE)


def risk_status(churn: Column, actual_ltv: Column, strict_half: bool = True) -> Column:
    # strict_half reproduces the reference's `>+ 0.50` (a '>' comparison):
    # 'At Risk' then needs churn > 0.5 and churn 0.75 is caught one rule above.
    at_risk = churn > 0.5 if strict_half else churn >= 0.5
    return ladder([
        ((churn >= 0.5) & (actual_ltv >= 1000), "High Value At Risk"),
        (churn >= 0.75, "Likely Churned"),
        (at_risk, "At Risk"),
    ], "Healthy")


def primary_category(total: Column, capitalise: bool = False) -> Column:
    name = (lambda s: s.capitalize()) if capitalise else (lambda s: s)
    return ladder([(total >= t, name(c)) for t, c in PRIMARY_CATEGORY_STEPS],
                  name(PRIMARY_CATEGORY_ELSE))


def secondary_category(num_items: Column, capitalise: bool = False) -> Column:
    name = (lambda s: s.capitalize()) if capitalise else (lambda s: s)
    return ladder([(num_items >= n, name(c)) for n, c in SECONDARY_CATEGORY_STEPS],
                  F.lit(None).cast("string"))


def pair_strength(times: Column, lift: Column) -> Column:
    return ladder([((times >= n) & (lift >= l), s) for n, l, s in PAIR_STRENGTH],
                  PAIR_STRENGTH_ELSE)


def category_strength(count: Column) -> Column:
    return ladder([(count >= n, s) for n, s in CATEGORY_STRENGTH], CATEGORY_STRENGTH_ELSE)
