"""Rules of the alternative profile where they differ from the main ones.

Fixed values: labels, cut points, rates and amounts below are given by the business
and must not be changed without it.
"""

from brightledger.rules.base import any_of, band, lookup, rules
from brightledger.rules.silver import HEALTH_PARTS, YOUNG_OFFLINE
from brightledger.rules.staging import LOAN_PERFORMANCE  # noqa: F401  (the same in both profiles)

# --- loans -------------------------------------------------------------------
LOAN_TENURE = rules(
    "LONG_TERM",
    ("loan_age_years = 0", "CURRENT"),
    ("loan_age_years <= 3", "NEW"),
    ("loan_age_years <= 6", "ESTABLISHED"),
    ("loan_age_years <= 9", "MATURE"),
)
LOAN_RISK = rules(
    40,
    ("loan_status = 'DEFAULTED'", 100),
    ("loan_status = 'DEFAULT'", 95),
    ("loan_age_years > 9", 85),
    ("loan_age_years > 6", 70),
    ("loan_age_years > 3", 55),
)
LOAN_SIZE = band("loan_amount", [(500000, "JUMBO"), (200000, "LARGE"), (50000, "MEDIUM"), (10000, "SMALL")], "MICRO")
# Upper amounts per loan type: (type, excellent below, good below).
LOAN_AMOUNT_LIMITS = (("MORTGAGE", 200000, 500000), ("PERSONAL", 100000, 150000), ("AUTO", 150000, 200000))
LOAN_RATE = rules(
    "MARKET_RATE",
    *[
        (f"loan_type = '{kind}' AND loan_amount < {limit}", label)
        for kind, excellent, good in LOAN_AMOUNT_LIMITS
        for limit, label in ((excellent, "EXCELLENT_RATE"), (good, "GOOD_RATE"))
    ],
)
LOAN_MONTHS_LEFT = band("loan_age_years", [(10, 120), (5, 60)], 12)
LOAN_INTEREST = lookup("loan_type", {"MORTGAGE": 4.5, "AUTO": 6.8}, 12.5)

# --- phones ------------------------------------------------------------------
PHONE_DIGITS = 10
PHONE_FLAGS = {
    "is_mobile": "phone_type = 'MOBILE'",
    "is_primary_contact": "phone_type = 'PRIMARY' OR is_primary",
    "communication_ready": "phone_status = 'VERIFIED' AND is_valid_format",
    "sms_ready": "sms_enabled AND phone_status = 'VERIFIED'",
    "marketing_ready": "marketing_consent AND phone_status = 'VERIFIED'",
}
PHONE_QUALITY = rules(
    25,
    ("phone_status = 'VERIFIED' AND is_valid_format AND sms_enabled", 95),
    ("phone_status = 'VERIFIED' AND is_valid_format", 85),
    ("phone_status = 'VERIFIED'", 70),
    ("phone_status = 'UNVERIFIED' AND is_valid_format", 50),
)

# --- financial summary -------------------------------------------------------
COVERAGE = lookup("policy_type", {"LIFE": 500000, "AUTO": 250000, "HOME": 400000}, 100000)
PREMIUM = lookup("policy_type", {"LIFE": 2400, "AUTO": 1800, "HOME": 2200}, 1200)
LONG_TERM_HOLDINGS = any_of("investment_type", "STOCKS", "BONDS")
RELATIONSHIP = rules(
    "MINIMAL_RELATIONSHIP",
    (
        "total_deposit_accounts > 0 AND total_cards > 0 AND total_loans > 0 AND total_investments > 0",
        "FULL_RELATIONSHIP",
    ),
    ("total_deposit_accounts > 0 AND total_cards > 0 AND total_loans > 0", "CORE_BANKING"),
    ("total_deposit_accounts > 0 AND total_cards > 0", "BASIC_BANKING"),
    ("total_deposit_accounts > 0", "DEPOSIT_ONLY"),
)
VALUE_SEGMENT = band(
    "business", [(1000000, "HIGH_VALUE"), (250000, "MEDIUM_VALUE"), (50000, "STANDARD_VALUE")], "LOW_VALUE"
)

# --- channels and products ---------------------------------------------------
CAMPAIGN_CHANNEL = lookup(
    "campaign_type",
    {"EMAIL_PROMOTION": "EMAIL", "DIRECT_MAIL": "MAIL", "DIGITAL_ADS": "DIGITAL", "SOCIAL_MEDIA": "SOCIAL"},
    "PHONE",
)
CAMPAIGN_VALUE = lookup(
    "campaign_type",
    {"EMAIL_PROMOTION": 200, "DIRECT_MAIL": 300, "DIGITAL_ADS": 150, "SOCIAL_MEDIA": 100, "PHONE_CALL": 500},
    250,
)
PRODUCT_KINDS = {
    "digital_banking": any_of("product_id", "CHCK001", "SAVE001"),
    "lending": "product_id = 'LOAN001'",
    "investment": "product_id = 'INVT001'",
    "insurance": "product_id = 'CD001'",
}

# --- risk profile ------------------------------------------------------------
NEEDS_REVIEW = any_of("risk_level", "HIGH", "MEDIUM")
FRAUD_SCORE = lookup("risk_level", {"HIGH": 850, "MEDIUM": 650}, 450)
RISK_RATING = band("composite", [(750, "LOW_RISK"), (600, "MEDIUM_RISK")], "HIGH_RISK")
COMPLIANCE = rules(
    "MAJOR_CONCERNS",
    ("coalesce(total_compliance_flags, 0) = 0", "COMPLIANT"),
    ("total_compliance_flags <= 2", "MINOR_CONCERNS"),
)
FRAUD_LEVEL = rules(
    "LOW_FRAUD_RISK",
    ("confirmed_fraud_incidents > 0", "HIGH_FRAUD_RISK"),
    ("pending_fraud_investigations > 2", "MEDIUM_FRAUD_RISK"),
)
KYC_STATUS = rules("KYC_PENDING", ("failed_kyc_checks > 0", "KYC_FAILED"), ("passed_kyc_checks > 0", "KYC_PASSED"))
REVIEW_NEED = rules(
    "STANDARD_MONITORING",
    (
        "total_compliance_flags > 2 OR confirmed_fraud_incidents > 0 OR failed_kyc_checks > 0",
        "REQUIRES_IMMEDIATE_REVIEW",
    ),
    ("total_compliance_flags > 0 OR pending_fraud_investigations > 1", "REQUIRES_MONITORING"),
)

# --- account performance -----------------------------------------------------
# Value segments stand for wealth tiers in this profile.
HEALTH_PARTS = (
    *HEALTH_PARTS[:2],
    lookup("overall_risk_level", {"LOW_RISK": 20, "MEDIUM_RISK": 10, "HIGH_RISK": 5}, 0),
    HEALTH_PARTS[3],
    lookup("compliance_status", {"COMPLIANT": 10, "MINOR_CONCERNS": 5}, 0),
)
ACCOUNT_OPPORTUNITY = rules(
    "MAINTAIN_RELATIONSHIP",
    ("cross_sell_opportunity_score >= 75", "HIGH_CROSS_SELL_OPPORTUNITY"),
    (any_of("wealth_tier", "HIGH_VALUE", "MEDIUM_VALUE"), "WEALTH_MANAGEMENT_OPPORTUNITY"),
    (YOUNG_OFFLINE, "DIGITAL_CONVERSION_OPPORTUNITY"),
    ("activity_level = 'MINIMAL' AND account_age_years < 2", "ACTIVATION_OPPORTUNITY"),
    ("product_penetration_score < 40", "PRODUCT_EXPANSION_OPPORTUNITY"),
)
ACCOUNT_SERVICE_TIER = rules(
    "STANDARD",
    ("wealth_tier = 'HIGH_VALUE'", "PRIVATE_BANKING"),
    ("wealth_tier = 'MEDIUM_VALUE'", "WEALTH_MANAGEMENT"),
    ("balance >= 100000", "PREMIUM"),
    ("product_penetration_score >= 60", "PREFERRED"),
    (any_of("activity_level", "VERY_ACTIVE", "ACTIVE"), "ACTIVE"),
)

# --- master view -------------------------------------------------------------
HIGH_RISK = "overall_risk_level = 'HIGH_RISK'"
MASTER_CHURN_PARTS = (
    rules(0, ("at_risk_customer", 40)),
    rules(0, ("avg_satisfaction_score < 3", 20)),
    rules(0, ("delinquent_loans > 0", 15)),
    rules(0, ("total_transactions = 0", 15)),
    rules(0, (HIGH_RISK, 10)),
)
MASTER_ACTION = rules(
    "MAINTAIN_RELATIONSHIP",
    ("requires_immediate_review", "IMMEDIATE_RISK_REVIEW"),
    ("at_risk_customer AND avg_satisfaction_score < 3", "RETENTION_OUTREACH"),
    (f"{any_of('wealth_tier', 'HIGH_VALUE', 'MEDIUM_VALUE')} AND total_investments = 0", "WEALTH_CONSULTATION"),
    ("product_penetration_score < 40 AND lending_eligible", "CROSS_SELL_LENDING"),
    ("digital_transaction_percentage < 50 AND age < 50", "DIGITAL_ADOPTION_CAMPAIGN"),
    ("avg_credit_utilization > 0.8", "CREDIT_LIMIT_INCREASE_OFFER"),
    ("engagement_level = 'MINIMAL_ENGAGEMENT'", "ENGAGEMENT_CAMPAIGN"),
)
MASTER_TIER = rules(
    "BRONZE_CUSTOMER",
    ("wealth_tier = 'HIGH_VALUE'", "ULTRA_HIGH_NET_WORTH"),
    ("wealth_tier = 'MEDIUM_VALUE'", "HIGH_NET_WORTH"),
    ("product_penetration_score >= 80 AND relationship_years >= 5", "PLATINUM_CUSTOMER"),
    ("product_penetration_score >= 60 AND engagement_level = 'HIGHLY_ENGAGED'", "GOLD_CUSTOMER"),
    ("product_penetration_score >= 40", "SILVER_CUSTOMER"),
)

# --- reports -----------------------------------------------------------------
RISK_FACTOR = lookup("overall_risk_level", {"LOW_RISK": 1.0, "MEDIUM_RISK": 0.8, "HIGH_RISK": 0.6}, 0.8)
RISK_TREND = rules(
    "STABLE",
    ("credit_score_volatility > 50", "VOLATILE"),
    ("composite_risk_score > 700", "DETERIORATING"),
    ("composite_risk_score > 600", "UNSTABLE"),
)
