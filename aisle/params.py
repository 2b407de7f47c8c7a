"""Operator parameters. Defaults are the reference's values; every threshold
is a field so a caller can change it without touching operator code."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # "today" for recency, months active and churn: the day after the last order
    as_of: dt.date = dt.date(2001, 8, 2)

    # J2/J3 RFM flags
    high_returner_rate: float = 0.2
    discount_seeker_rate: float = 0.5

    # J4 behavioural clusters: z-score cut-offs
    z_high: float = 0.5
    z_low: float = 0.0

    # J5 journey: path window in days since signup, return lag in days
    journey_days: int = 30
    return_lag_days: int = 7

    # J6 early signals
    early_days: int = 7
    first_order: str = "reference"          # "reference" = min over all orders, "true" = earliest order

    # J7a LTV v2
    horizon_months: int = 12
    strict_half: bool = True                # reference's `>+ 0.50` typo (At Risk unreachable)

    # J9 product affinity
    min_pair_times: int = 5
    min_lift: float = 1.0

    # J10 category affinity v1
    min_category_pairs: int = 10

    # J11 early scoring
    include_day_zero: bool = False          # reference treats day 0 as falsy (not VIP)

    # J13-J15 serving
    cart_limit: int = 3
    products_per_category: int = 3
    top_pairs: int = 10
    at_risk_limit: int = 100
    at_risk_min_ltv: float = 1000.0

    # J21-J22 campaign
    campaign_cost: float = 26050.0
    exclude_churn_at_least: float = 0.90
    exclude_return_rate_above: float = 0.5

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
