"""Rules of the per-customer and per-account roll-ups.

Fixed values: labels, cut points, weights and points below are given by the
business and must not be changed without it. A score is the sum of its parts,
held inside 0..100.
"""

from brightledger.rules.base import any_of, band, lookup, rules

# Label groups used in many rules.
DIGITAL_CHANNELS = any_of("channel_type", "ONLINE", "MOBILE")
PHYSICAL_CHANNELS = any_of("channel_type", "BRANCH", "ATM", "PHONE")
BANKING_PRODUCTS = any_of("product_type", "CHECKING", "SAVINGS", "MOBILE_BANKING")
LENDING_PRODUCTS = any_of("product_type", "MORTGAGE", "LOANS")
RETIREMENT_ACCOUNTS = any_of("account_type", "IRA", "ROTH_IRA", "401K")
TROUBLED_LOANS = any_of("loan_status", "DELINQUENT", "DEFAULT")
MONEY_ACTIVITIES = any_of("activity_type", "TRANSFER", "BILL_PAY", "MOBILE_DEPOSIT")
HIGH_RISK_LEVELS = any_of("overall_risk_level", "HIGH_RISK", "CRITICAL_RISK")
WEALTHY_TIERS = any_of("wealth_tier", "PRIVATE_BANKING", "WEALTH_MANAGEMENT")
AFFLUENT = any_of("current_segment", "PREMIUM", "MASS_AFFLUENT")
RISING_AFFLUENT = any_of("current_segment", "PREMIUM", "MASS_AFFLUENT", "EMERGING_AFFLUENT")

# --- customer profile --------------------------------------------------------
ENGAGEMENT = rules(
    "MINIMAL_ENGAGEMENT",
    ("total_digital_activities >= 50 AND avg_satisfaction_score >= 4", "HIGHLY_ENGAGED"),
    ("total_digital_activities >= 20 AND avg_satisfaction_score >= 3", "MODERATELY_ENGAGED"),
    ("total_digital_activities > 0 OR total_service_interactions > 0", "LIGHTLY_ENGAGED"),
)
AT_RISK = "escalated_interactions > 2 OR avg_satisfaction_score < 2"
DIGITAL_PREFERENCE = rules(
    "NON_DIGITAL",
    ("mobile_app_activities > web_portal_activities", "MOBILE_PREFERRED"),
    ("web_portal_activities > mobile_app_activities", "WEB_PREFERRED"),
    ("total_digital_activities > 0", "MULTI_CHANNEL"),
)

# --- financial summary -------------------------------------------------------
# Points for holding at least one product of a kind.
PENETRATION_PARTS = tuple(
    rules(0, (f"{count} > 0", points))
    for count, points in (
        ("total_deposit_accounts", 20),
        ("total_cards", 15),
        ("total_loans", 25),
        ("total_investments", 25),
        ("total_insurance_policies", 15),
    )
)
# Utilisation is a percentage, yet the limits are fractions; kept as given.
FINANCIAL_RISK = rules(
    "LOW_RISK",
    ("delinquent_loans > 0 OR max_credit_utilization > 0.9", "HIGH_RISK"),
    ("avg_credit_utilization > 0.7 OR at_risk_loan_balance > 0", "MEDIUM_RISK"),
)
WEALTH_TIER = band(
    "wealth",
    [(1000000, "PRIVATE_BANKING"), (250000, "WEALTH_MANAGEMENT"), (100000, "PREFERRED"), (25000, "SELECT")],
    "STANDARD",
)

# --- transaction analytics ---------------------------------------------------
SPENDING = band(
    "total_outflows", [(10000, "HIGH_SPENDER"), (5000, "MEDIUM_SPENDER"), (1000, "MODERATE_SPENDER")], "LOW_SPENDER"
)
ACTIVITY = band(
    "total_transactions", [(100, "VERY_ACTIVE"), (50, "ACTIVE"), (20, "MODERATE"), (5, "LIGHT")], "MINIMAL"
)

# --- channel effectiveness ---------------------------------------------------
CAMPAIGN_VALUE = lookup(
    "campaign_type",
    {
        "CREDIT_CARD_OFFER": 500,
        "SAVINGS_PROMOTION": 200,
        "LOAN_OFFER": 1000,
        "INVESTMENT_SEMINAR": 750,
        "INSURANCE_QUOTE": 300,
        "DIGITAL_BANKING": 100,
    },
    250,
)
# Points per channel counted, by score.
ADOPTION_WEIGHTS = {"digital_channels_used": 15, "digital_platforms_used": 20}
ADOPTION_SHARE_POINTS = 65
DIVERSITY_WEIGHTS = {
    "total_channels_used": 12,
    "marketing_channels_used": 8,
    "service_channels_used": 10,
    "digital_platforms_used": 15,
}
DIVERSITY_MIX = rules(
    0,
    ("digital_channels_used > 0 AND physical_channels_used > 0", 20),
    ("digital_channels_used > 0 OR physical_channels_used > 0", 10),
)
CHANNEL_PREFERENCE = rules(
    "MINIMAL_USAGE",
    ("digital_channel_usage > physical_channel_usage * 4", "DIGITAL_ONLY"),
    ("digital_channel_usage > physical_channel_usage * 2", "DIGITAL_FIRST"),
    ("digital_channel_usage > physical_channel_usage", "DIGITAL_PREFERRED"),
    ("physical_channel_usage > digital_channel_usage", "PHYSICAL_PREFERRED"),
    ("digital_channel_usage > 0 AND physical_channel_usage > 0", "OMNI_CHANNEL"),
    ("digital_channel_usage > 0", "DIGITAL_ONLY"),
    ("physical_channel_usage > 0", "PHYSICAL_ONLY"),
)
CHANNEL_ENGAGEMENT = rules(
    "NONE",
    ("total_channel_usage >= 100", "VERY_HIGH"),
    ("total_channel_usage >= 50", "HIGH"),
    ("total_channel_usage >= 20", "MEDIUM"),
    ("total_channel_usage >= 5", "LOW"),
    ("total_channel_usage > 0", "MINIMAL"),
)
SESSION_QUALITY = rules(
    "NO_SESSIONS",
    ("total_digital_activities >= 50", "HIGH_QUALITY"),
    ("total_digital_activities >= 20", "MEDIUM_QUALITY"),
    ("total_digital_activities >= 5", "LOW_QUALITY"),
    ("total_digital_activities > 0", "BRIEF_SESSIONS"),
)
CHANNEL_ACTION = rules(
    "MAINTAIN_CURRENT_STRATEGY",
    ("digital_channels_used = 0 AND physical_channels_used > 0", "DIGITAL_ONBOARDING"),
    ("total_digital_activities = 0 AND total_channels_used = 1", "CHANNEL_EXPANSION"),
    ("total_escalated_interactions > 2", "SERVICE_CHANNEL_OPTIMIZATION"),
    ("marketing_conversion_rate < 0.05 AND total_campaigns_received > 10", "MARKETING_CHANNEL_REVIEW"),
)
CHANNEL_OPPORTUNITY = rules(
    "STANDARD_OPTIMIZATION",
    ("digital_channels_used = 0 AND physical_channels_used > 0", "HIGH_DIGITAL_OPPORTUNITY"),
    ("marketing_conversion_rate = 0 AND total_campaigns_received > 5", "MARKETING_OPTIMIZATION"),
    ("service_channels_used > 3 AND service_satisfaction_score < 3", "SERVICE_CONSOLIDATION"),
    ("digital_platforms_used = 1 AND total_digital_activities > 20", "PLATFORM_EXPANSION"),
)

# --- product penetration -----------------------------------------------------
PRODUCT_WEIGHTS = {
    "digital_banking_products": 15,
    "lending_products": 25,
    "investment_products": 30,
    "insurance_products": 20,
}
PRODUCT_BREADTH = rules(0, ("total_products_used >= 5", 10))
DIGITAL_ADOPTION = band(
    "digital_banking_products", [(5, "DIGITAL_NATIVE"), (3, "DIGITAL_ADOPTER"), (1, "DIGITAL_BEGINNER")], "NON_DIGITAL"
)
# Share of campaigns answered that earns each label.
RESPONSIVENESS = rules(
    "UNRESPONSIVE",
    ("total_campaigns_targeted = 0", "UNTARGETED"),
    ("campaigns_converted > total_campaigns_targeted * 0.1", "HIGHLY_RESPONSIVE"),
    ("campaigns_clicked > total_campaigns_targeted * 0.05", "MODERATELY_RESPONSIVE"),
    ("campaigns_opened > total_campaigns_targeted * 0.02", "LIGHTLY_RESPONSIVE"),
)
PRODUCT_CHANNEL = rules(
    "MINIMAL_ENGAGEMENT",
    ("digital_channel_usage > physical_channel_usage * 3", "DIGITAL_FIRST"),
    ("digital_channel_usage > physical_channel_usage", "DIGITAL_PREFERRED"),
    ("physical_channel_usage > digital_channel_usage", "BRANCH_PREFERRED"),
    ("total_channels_used > 0", "OMNI_CHANNEL"),
)


def _outweighs(kind: str) -> str:
    others = [k for k in ("digital_banking", "lending", "investment", "insurance") if k != kind]
    return f"{kind}_usage > " + " + ".join(f"{other}_usage" for other in others)


SPECIALISATION = rules(
    "PRODUCT_EXPLORER",
    (_outweighs("investment"), "INVESTMENT_FOCUSED"),
    (_outweighs("lending"), "LENDING_FOCUSED"),
    (_outweighs("insurance"), "INSURANCE_FOCUSED"),
    ("digital_banking_usage > 0", "BANKING_FOCUSED"),
)
CROSS_SELL_PARTS = (
    rules(0, ("digital_banking_products = 0", 20)),
    rules(0, (f"lending_products = 0 AND {AFFLUENT}", 25)),
    rules(0, (f"investment_products = 0 AND {RISING_AFFLUENT}", 30)),
    rules(0, ("insurance_products = 0", 15)),
    rules(0, ("cross_sell_conversions > 0", 10)),
)
NEXT_PRODUCT = rules(
    "BASIC_PRODUCTS",
    (f"investment_products = 0 AND {AFFLUENT}", "INVESTMENT_ADVISORY"),
    ("lending_products = 0 AND digital_banking_products > 0", "PERSONAL_LOAN"),
    ("insurance_products = 0 AND total_products_used > 0", "INSURANCE_BUNDLE"),
    ("digital_banking_products = 0", "MOBILE_BANKING"),
    ("total_products_used >= 2", "PREMIUM_SERVICES"),
)

# --- risk profile ------------------------------------------------------------
# Score taken for a customer who was never assessed, and the weights.
UNKNOWN_SCORE = 500
TOP_CREDIT_SCORE = 850
RISK_WEIGHTS = {
    "current_credit_risk_score": 0.3,
    "current_fraud_risk_score": 0.3,
    "avg_credit_score": 0.2,
    "highest_fraud_risk_score": 0.2,
}
RISK_LEVEL = rules(
    "LOW_RISK",
    ("confirmed_fraud_incidents > 0 OR sanctions_flags > 0", "CRITICAL_RISK"),
    ("pending_fraud_investigations > 0 OR aml_flags > 0 OR failed_kyc_checks > 0", "HIGH_RISK"),
    ("current_credit_risk_score < 550 OR current_fraud_risk_score < 550", "ELEVATED_RISK"),
    ("avg_credit_score < 580 OR total_fraud_alerts > 2", "MODERATE_RISK"),
)
COMPLIANCE = rules(
    "PENDING_VERIFICATION",
    ("sanctions_flags > 0 OR aml_flags > 0", "NON_COMPLIANT"),
    ("failed_kyc_checks > 0 OR total_compliance_flags > 0", "REVIEW_REQUIRED"),
    ("passed_kyc_checks > 0 AND total_compliance_checks > 0", "COMPLIANT"),
)
MONITORING = (
    "confirmed_fraud_incidents > 0 OR sanctions_flags > 0 OR aml_flags > 0"
    " OR failed_kyc_checks > 0 OR unusual_activity_alerts > 5"
)
IMMEDIATE_REVIEW = (
    "pending_fraud_investigations > 0 OR total_compliance_flags > passed_kyc_checks"
    " OR assessments_requiring_review > 0 OR pending_account_alerts > 0"
)
RISK_TREND = rules(
    "STABLE",
    ("credit_score_volatility > 50", "VOLATILE"),
    ("total_fraud_alerts > total_credit_reports", "DETERIORATING"),
    ("highest_credit_score - lowest_credit_score > 100", "UNSTABLE"),
)

# --- retention ---------------------------------------------------------------
EVENT_CHURN_SCORE = rules(25, ("churn_events > 0", 90), ("churn_risk_events > 2", 75), ("churn_risk_events > 0", 50))
LOST_TOUCH = "digital_activities_last_30_days = 0 AND total_digital_activities > 0"
POINTS_PER_CHURN_EVENT = 30
CHURN_PARTS = (
    rules(0, ("at_risk_customer", 25)),
    rules(
        0,
        ("min_satisfaction_score <= 2", 20),
        ("avg_satisfaction_score <= 2.5", 15),
        ("avg_satisfaction_score <= 3", 10),
    ),
    rules(
        0,
        (LOST_TOUCH, 15),
        ("digital_activities_last_30_days < floor(digital_activities_last_90_days / 3)", 10),
    ),
    rules(0, ("complaint_interactions > support_interactions", 15), ("escalated_interactions > 2", 10)),
    rules(0, (HIGH_RISK_LEVELS, 10), ("requires_immediate_review", 5)),
)
# Segment labels here differ from the ones the cleaning layer gives; kept as given.
OPPORTUNITY_PARTS = (
    lookup("customer_value_segment", {"HIGH_VALUE": 30, "MEDIUM_VALUE": 20, "LOW_VALUE": 10}, 5),
    band("relationship_years", [(5, 25), (2, 20), (1, 15)], 10),
    rules(0, ("successful_retentions > 0", 20), ("retention_campaigns_sent > 0", 10)),
    lookup("engagement_level", {"HIGHLY_ENGAGED": 15, "MODERATELY_ENGAGED": 10, "LIGHTLY_ENGAGED": 5}, 0),
    lookup("digital_preference", {"DIGITAL_FIRST": 10, "DIGITAL_PREFERRED": 10, "MULTI_CHANNEL": 5}, 0),
)
RETENTION_STAGE = rules(
    "STABLE",
    ("churn_events > 0", "CHURNED"),
    ("churn_risk_events > 0 AND recent_churn_risk", "HIGH_CHURN_RISK"),
    ("avg_satisfaction_score <= 2 OR escalated_interactions > 2", "DISSATISFIED"),
    (LOST_TOUCH, "DISENGAGED"),
    ("interactions_last_30_days > 3 AND complaint_interactions > 0", "COMPLAINT_PATTERN"),
    ("successful_retentions > 0", "SUCCESSFULLY_RETAINED"),
    ("engagement_level = 'HIGHLY_ENGAGED'", "LOYAL"),
)
RETENTION_ACTION = rules(
    "STANDARD_RETENTION",
    ("churn_events > 0", "WIN_BACK_CAMPAIGN"),
    ("churn_risk_events > 0 AND recent_churn_risk", "IMMEDIATE_RETENTION_CALL"),
    ("min_satisfaction_score <= 2", "SATISFACTION_RECOVERY"),
    (LOST_TOUCH, "RE_ENGAGEMENT_CAMPAIGN"),
    ("complaint_interactions > support_interactions", "PROACTIVE_OUTREACH"),
    ("escalated_interactions > 1", "EXECUTIVE_ESCALATION"),
    ("engagement_level = 'MINIMAL_ENGAGED'", "ACTIVATION_CAMPAIGN"),
)
RETENTION_STRATEGY = rules(
    "STANDARD_RETENTION",
    ("customer_value_segment = 'HIGH_VALUE' AND churn_risk_events > 0", "CONCIERGE_RETENTION"),
    ("digital_preference = 'DIGITAL_FIRST'", "DIGITAL_RETENTION_CAMPAIGN"),
    ("complaint_interactions > 0", "SERVICE_RECOVERY"),
    ("digital_activities_last_30_days = 0", "PRODUCT_EDUCATION"),
    ("relationship_years >= 5", "LOYALTY_REWARDS"),
)
RETENTION_PRIORITY = rules(
    "MONITOR",
    ("churn_events > 0", "WIN_BACK"),
    ("churn_risk_events > 0 AND customer_value_segment = 'HIGH_VALUE'", "CRITICAL"),
    ("churn_risk_events > 0 OR avg_satisfaction_score <= 2", "HIGH"),
    ("escalated_interactions > 1 OR digital_activities_last_30_days = 0", "MEDIUM"),
    ("engagement_level = 'MINIMAL_ENGAGED'", "LOW"),
)

# --- account performance -----------------------------------------------------
# ``balance`` is the newest daily balance, or the account's own where there is none.
PROFITABILITY_PARTS = (
    rules(0, ("monthly_fee > 0", 20)),
    band("total_transaction_volume", [(50000, 25), (20000, 20), (10000, 15), (5000, 10)], 5),
    band("balance", [(100000, 25), (50000, 20), (25000, 15), (10000, 10)], 5),
    lookup("activity_level", {"VERY_ACTIVE": 15, "ACTIVE": 12, "MODERATE": 8, "LIGHT": 5}, 0),
    rules(0, ("digital_transaction_percentage > 70", 10)),
    rules(0, ("account_age_years >= 5", 5)),
)
HEALTH_PARTS = (
    band("balance", [(10000, 40), (5000, 30), (1000, 20), (0, 10)], 0),
    band("total_transactions", [(50, 20), (20, 15), (10, 10), (1, 5)], 0),
    lookup(
        "overall_risk_level", {"LOW_RISK": 20, "MODERATE_RISK": 15, "ELEVATED_RISK": 10, "HIGH_RISK": 5}, 0
    ),
    band("avg_satisfaction_score", [(4, 10), (3, 7), (2, 4)], 0),
    lookup("compliance_status", {"COMPLIANT": 10, "PENDING_VERIFICATION": 5}, 0),
)
DORMANT = "total_transactions = 0 AND account_age_years > 1"
YOUNG_OFFLINE = "digital_transaction_percentage < 30 AND age < 50"
ACCOUNT_RISK_FLAG = rules(
    "NORMAL",
    ("requires_immediate_review", "IMMEDIATE_REVIEW_REQUIRED"),
    ("requires_enhanced_monitoring", "ENHANCED_MONITORING"),
    ("at_risk_customer", "CUSTOMER_AT_RISK"),
    (DORMANT, "DORMANT_ACCOUNT"),
    ("balance <= 0", "NEGATIVE_BALANCE"),
)
ACCOUNT_OPPORTUNITY = rules(
    "MAINTAIN_RELATIONSHIP",
    ("cross_sell_opportunity_score >= 75", "HIGH_CROSS_SELL_OPPORTUNITY"),
    (WEALTHY_TIERS, "WEALTH_MANAGEMENT_OPPORTUNITY"),
    (YOUNG_OFFLINE, "DIGITAL_CONVERSION_OPPORTUNITY"),
    ("activity_level = 'MINIMAL' AND account_age_years < 2", "ACTIVATION_OPPORTUNITY"),
    ("product_penetration_score < 40", "PRODUCT_EXPANSION_OPPORTUNITY"),
)
ACCOUNT_ACTION = rules(
    "STANDARD_MAINTENANCE",
    ("requires_immediate_review", "RISK_REVIEW"),
    ("at_risk_customer AND avg_satisfaction_score < 3", "RETENTION_CALL"),
    (DORMANT, "DORMANT_REACTIVATION"),
    ("cross_sell_opportunity_score >= 75", "CROSS_SELL_CAMPAIGN"),
    (YOUNG_OFFLINE, "DIGITAL_ONBOARDING"),
    ("balance >= 50000 AND total_investments = 0", "INVESTMENT_CONSULTATION"),
)
ACCOUNT_SERVICE_TIER = rules(
    "STANDARD",
    ("wealth_tier = 'PRIVATE_BANKING'", "PRIVATE_BANKING"),
    ("wealth_tier = 'WEALTH_MANAGEMENT'", "WEALTH_MANAGEMENT"),
    ("balance >= 100000", "PREMIUM"),
    ("product_penetration_score >= 60", "PREFERRED"),
    (any_of("activity_level", "VERY_ACTIVE", "ACTIVE"), "ACTIVE"),
)

# --- master view -------------------------------------------------------------
PENETRATION_WEIGHT = 0.3
LIFETIME_PARTS = (
    band("total_relationship_value", [(1000000, 40), (250000, 30), (100000, 20), (25000, 10)], 5),
    band("relationship_years", [(10, 20), (5, 15), (2, 10)], 5),
    lookup("engagement_level", {"HIGHLY_ENGAGED": 10, "MODERATELY_ENGAGED": 7, "LIGHTLY_ENGAGED": 4}, 1),
)
MASTER_CHURN_PARTS = (
    rules(0, ("at_risk_customer", 40)),
    rules(0, ("avg_satisfaction_score < 3", 20)),
    rules(0, ("delinquent_loans > 0", 15)),
    rules(0, ("total_transactions = 0", 15)),
    rules(0, (HIGH_RISK_LEVELS, 10)),
)
MASTER_ACTION = rules(
    "MAINTAIN_RELATIONSHIP",
    ("requires_immediate_review", "IMMEDIATE_RISK_REVIEW"),
    ("at_risk_customer AND avg_satisfaction_score < 3", "RETENTION_OUTREACH"),
    (f"{WEALTHY_TIERS} AND total_investments = 0", "WEALTH_CONSULTATION"),
    ("product_penetration_score < 40 AND lending_eligible", "CROSS_SELL_LENDING"),
    ("digital_transaction_percentage < 50 AND age < 50", "DIGITAL_ADOPTION_CAMPAIGN"),
    ("avg_credit_utilization > 0.8", "CREDIT_LIMIT_INCREASE_OFFER"),
    ("engagement_level = 'MINIMAL_ENGAGEMENT'", "ENGAGEMENT_CAMPAIGN"),
)
MASTER_TIER = rules(
    "BRONZE_CUSTOMER",
    ("wealth_tier = 'PRIVATE_BANKING'", "ULTRA_HIGH_NET_WORTH"),
    ("wealth_tier = 'WEALTH_MANAGEMENT'", "HIGH_NET_WORTH"),
    ("product_penetration_score >= 80 AND relationship_years >= 5", "PLATINUM_CUSTOMER"),
    ("product_penetration_score >= 60 AND engagement_level = 'HIGHLY_ENGAGED'", "GOLD_CUSTOMER"),
    ("product_penetration_score >= 40", "SILVER_CUSTOMER"),
)
