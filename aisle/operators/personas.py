"""J24 persona dimension and the other small fixed dimensions.

These are literal relations of a handful of rows (six personas, four risk
states, three campaign tiers); joins to them are broadcast with that bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---- fixed values: personas -------------------------------------------------
# (persona, cluster name used by the behavioural clusters, description,
#  typical ltv, monthly velocity, sessions, orders, returns per customer,
#  average order value, detection accuracy,
#  key traits, marketing strategy)
PERSONAS = [
    ("VIP Loyalist", "VIP Loyalists", "Frequent buyers with high lifetime value",
     2356.0, 280.0, 52.0, 8.4, None, None, "92%", ["Fast conversion", "High Frequency", "Low Returns"],
     "Retain at all costs, VIP perks, early access"),
    ("Serial Returner", "Serial Returns", "High spenders but return frequently",
     2323.0, 267.0, 61.0, 8.4, 2.8, None, "Cannot predict early (need return data)",
     ["High spend", "High returns", "Same revenue as VIPs"],
     "Implement return fees, improve descriptions"),
    ("Big Ticket Buyer", "Big Ticket Buyers", "Infrequent but high-value purchases",
     674.0, 95.0, 20.0, 1.8, None, 379.0, "79%", ["High AOV", "Seasonal", "Gift shoppers"],
     "Holiday campaigns, gift guides, bundling"),
    ("Window Browser", "Window Browsers", "Browser heavily but rarely purchase",
     154.0, 17.0, 70.0, 1.5, None, None, "95%", ["High sessions", "Low conversion", "Research shoppers"],
     "Cart abandonment, browser retargeting, minimal investment"),
    ("Deal Hunter", "Deal Hunters", "Price-sensitive, waits for sales",
     312.0, 56.0, 34.0, 1.9, None, None, "65%", ["Discount seekers", "Flash sale buyers"],
     "Flash sales, loyalty rewards, clearance alerts"),
    ("Casual Shopper", "Casual Shoppers", "Standard customers, steady but unexciting",
     525.0, 73.0, 40.0, 2.6, None, None, "Default category", ["Average engagement", "Mixed Behavior"],
     "Standard nurture, occasional promotions"),
]

# ---- fixed values: early-signal scorer outputs per persona ------------------
# (persona, confidence, ltv forecast, typical ltv, typical sessions,
#  typical orders, monthly velocity, traits, recommended actions)
SCORER = [
    ("Window Browser", 0.95, 173.0, 154.0, 70.0, 1.5, 17.0, ["browse_heavy"], [
        "Trigger card abandonment email after 3 sessions",
        "Offer first-purchase discount (15% off)",
        "Send browser retargeting ads",
        "Add to 'High Intent Browser' nurture campaign",
        "Show social proof (reviews, bestsellers)"]),
    ("VIP Loyalist", 0.92, 3111.0, 2356.0, 52.0, 8.4, 280.0, ["high_value"], [
        "⭐️ IMMEDIATE: Invite to VIP loyalty program",
        "Offer early access to new products",
        "Assign dedicated account manager",
        "Send personalized thank-you with exclusive perks",
        "Free shipping on all future orders",
        "Birthday/anniversary recognition"]),
    ("Big Ticket Buyer", 0.79, 891.0, 674.0, 20.0, 1.8, 95.0, ["high_aov", "likely_gift_shopper"], [
        "Send gift guide recommendations",
        "Offer bundling discounts for multiple items",
        "Target with holiday/seasonal campaigns (Nov-Dec, Feb, May)",
        "Add to 'Gift Shopper' segment to Q4 marketing",
        "Show gift wrapping options prominently"]),
    ("Deal Hunter", 0.65, 557.0, 312.0, 34.0, 1.9, 56.0, ["price_sensitive"], [
        "Send flash sale notifications",
        "Offer loyalty rewards program",
        "Target with clearance/sale campaigns",
        "Limit full-price marketing",
        "Show 'Deal of the Day' prominently"]),
    ("Casual Shopper", 0.70, 682.0, 525.0, 40.0, 2.6, 73.0, ["standard_buyer"], [
        "Standard nurture email campaign (Weekly)",
        "Send new arrival notifications",
        "Offer occasional promotions (20% off)",
        "Monitor for upgrade to VIP status",
        "Cross-sell complementary products"]),
]

# ---- fixed values: spellings that callers use besides persona and cluster names
MISSPELT = [
    ("window browers", "Window Browsers"),
    ("serial returners", "Serial Returns"),
]

# ---- fixed values: next actions by LTV risk status --------------------------
RISK_ACTIONS = [
    ("High Value At Risk", [
        "🚨 URGENT: Launch win-back campaign immediately",
        "Personal outreach from CEO/founder",
        "Offer 30% discount + free shipping",
        "Phone call from account manager",
        "Investigate reason for inactivity"]),
    ("At Risk", [
        "Send re-engagement email series (3 emails)",
        "Offer 25% discount",
        "Show new products since last visit",
        "Enable retargeting ads"]),
    ("Healthy", [
        "Continue standard nurture campaign",
        "Recognize loyalty with thank-you",
        "Offer exclusive early access to sales",
        "Consider VIP program upgrade"]),
    ("Likely Churned", []),
]

# ---- fixed values: cross-sell strategy per persona ({companion} = top companion category)
STRATEGIES = [
    ("VIP Loyalist", "Bundle recommendations at checkout", "None needed - willing to pay full price",
     "Complete your look: Add {companion}", "Weekly with exclusive new arrivals", "Immediately at card add"),
    ("Big Ticket Buyer", "Bundle recommendations at checkout", "None needed - willing to pay full price",
     "Perfect gift combination: Outerwear + Accessories", "Monthly, seasonal focus (Nov-Dec, Feb, May)",
     "After first item added to cart"),
    ("Serial Returner", "Show complementary items with size guides", "None - control return rate",
     "Customers also bought {companion} in similar sizes", "Standard weekly", "On product page, not at checkout"),
    ("Window Browser", "Show social proof - 'Others bought together'", "15% off bundle to encourage first purchase",
     "Bestseller combo: Outerwear + {companion}", "After 3+ browsing sessions", "Persistent cart reminder"),
    ("Deal Hunter", "Flash sale bundles", "20% off when buying both categories",
     "Limited time: Dresses + {companion} bundle", "Flash sales only (2-3x per month)", "During sale events only"),
    ("Casual Shopper", "Standard cross-sell at cart", "15% off second time occasionally",
     "Complete your outfit with {companion}", "Weekly new arrivals", "At cart or after first purchase"),
]
DEFAULT_COMPANION = "tops"

# ---- fixed values: win-back campaign tiers -----------------------------------
# (tier, lower bound on predicted LTV, discount %, free shipping, personal touch,
#  expected reactivation low, high)
CAMPAIGN_TIERS = [
    ("Tier 1", 3000.0, "30%", "Yes", "CEO email + call", 0.30, 0.40),
    ("Tier 2", 2000.0, "25%", "Yes", "Personalized email", 0.20, 0.30),
    ("Tier 3", None, "15-20%", "On orders $50+", "Generic template", 0.15, 0.20),
]
# (scenario, reactivation rate)
ROI_SCENARIOS = [("Conservative", 0.20), ("Optimistic", 0.30)]


def persona_dim(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("persona", T.StringType()), T.StructField("cluster_name", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("ltv", T.DoubleType()),
        T.StructField("monthly_velocity", T.DoubleType()), T.StructField("sessions", T.DoubleType()),
        T.StructField("orders", T.DoubleType()), T.StructField("returns_per_customer", T.DoubleType()),
        T.StructField("avg_order_value", T.DoubleType()), T.StructField("detection_accuracy", T.StringType()),
        T.StructField("key_traits", T.ArrayType(T.StringType())),
        T.StructField("marketing_strategy", T.StringType()),
    ])
    return spark.createDataFrame(PERSONAS, schema)


def scorer_dim(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("predicted_persona", T.StringType()), T.StructField("confidence", T.DoubleType()),
        T.StructField("ltv_forecast", T.DoubleType()), T.StructField("typical_ltv", T.DoubleType()),
        T.StructField("typical_sessions", T.DoubleType()), T.StructField("typical_orders", T.DoubleType()),
        T.StructField("monthly_velocity", T.DoubleType()),
        T.StructField("traits", T.ArrayType(T.StringType())),
        T.StructField("recommended_actions", T.ArrayType(T.StringType())),
    ])
    return spark.createDataFrame(SCORER, schema)


def persona_aliases() -> list[tuple[str, str]]:
    """(spelling in lower case, cluster name): the persona and cluster names of
    the dimension, and the known misspellings."""
    return sorted({(n.lower(), c) for persona, c, *_ in PERSONAS for n in (persona, c)} | set(MISSPELT))


def alias_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(persona_aliases(), "alias string, alias_cluster string")


def risk_actions_dim(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("risk_status", T.StringType()),
                           T.StructField("recommended_actions", T.ArrayType(T.StringType()))])
    return spark.createDataFrame(RISK_ACTIONS, schema)


def strategy_dim(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ["persona", "primary_tactic", "discount_strategy", "messaging_template",
                            "email_frequency", "upsell_timing"]])
    return spark.createDataFrame(STRATEGIES, schema)


def tier_dim(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("tier", T.StringType()), T.StructField("min_ltv", T.DoubleType()),
        T.StructField("discount", T.StringType()), T.StructField("free_shipping", T.StringType()),
        T.StructField("personal_touch", T.StringType()),
        T.StructField("reactivation_low", T.DoubleType()), T.StructField("reactivation_high", T.DoubleType()),
    ])
    return spark.createDataFrame(CAMPAIGN_TIERS, schema)
