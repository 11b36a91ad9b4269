"""Rules of the executive summaries.

Fixed values: labels, cut points and factors below are given by the business and
must not be changed without it.
"""

from brightledger.rules.base import any_of, band, lookup, rules
from brightledger.rules.silver import HIGH_RISK_LEVELS, WEALTHY_TIERS

DIGITAL_FIRST = any_of("digital_preference", "DIGITAL_FIRST", "DIGITAL_PREFERRED")
PRIORITY_RETENTION = any_of("retention_priority", "CRITICAL", "WIN_BACK")
RESPONSIVE = any_of("marketing_responsiveness", "HIGHLY_RESPONSIVE", "MODERATELY_RESPONSIVE")
DIGITAL_READY = any_of("digital_adoption_level", "DIGITAL_NATIVE", "DIGITAL_ADOPTER")
HIGH_RISK = HIGH_RISK_LEVELS
WEALTHY = WEALTHY_TIERS
NON_COMPLIANT = "compliance_status <> 'COMPLIANT'"

# --- executive dashboard -----------------------------------------------------
PORTFOLIO_HEALTH = rules(
    "GROWTH_OPPORTUNITY",
    ("total_customers = 0", "GROWTH_OPPORTUNITY"),
    ("high_value_customers >= total_customers * 0.2", "STRONG_VALUE_MIX"),
    ("high_value_customers >= total_customers * 0.1", "BALANCED_PORTFOLIO"),
)
SEGMENT_HEALTH = lookup(
    "customer_value_segment",
    {"High Value": "STRONG_VALUE_MIX", "Medium Value": "BALANCED_PORTFOLIO"},
    "GROWTH_OPPORTUNITY",
)
DIGITAL_MATURITY = band(
    "avg_digital_adoption", [(75, "DIGITAL_LEADER"), (50, "DIGITAL_PROGRESSIVE")], "DIGITAL_OPPORTUNITY"
)
RISK_STATUS = rules(
    "HIGH_RISK_ATTENTION_NEEDED",
    ("high_risk_customers <= total_customers * 0.05", "LOW_RISK_PORTFOLIO"),
    ("high_risk_customers <= total_customers * 0.15", "MANAGED_RISK"),
)

# --- financial summary -------------------------------------------------------
RISK_FACTOR = lookup(
    "overall_risk_level",
    {"LOW_RISK": 1.0, "MODERATE_RISK": 0.8, "ELEVATED_RISK": 0.6, "HIGH_RISK": 0.3},
    0.1,
)
YIELD = band(
    "net_revenue_yield", [(3, "HIGH_YIELD_PORTFOLIO"), (2, "STRONG_YIELD"), (1, "MODERATE_YIELD")], "YIELD_IMPROVEMENT_NEEDED"
)
ASSET_HEALTH = band(
    "healthy_assets",
    [(80, "EXCELLENT_PORTFOLIO_HEALTH"), (60, "GOOD_PORTFOLIO_HEALTH"), (40, "FAIR_PORTFOLIO_HEALTH")],
    "PORTFOLIO_HEALTH_ATTENTION_NEEDED",
)
CROSS_SELL = band(
    "avg_product_penetration",
    [(75, "EXCELLENT_CROSS_SELL"), (50, "GOOD_CROSS_SELL_PERFORMANCE"), (30, "MODERATE_CROSS_SELL")],
    "CROSS_SELL_OPPORTUNITY",
)
FINANCIAL_ACTION = rules(
    "MAINTAIN_CURRENT_STRATEGY",
    ("dormancy_rate > 15", "ACTIVATION_CAMPAIGN_NEEDED"),
    ("activation_rate < 85", "ENGAGEMENT_IMPROVEMENT_NEEDED"),
)

# --- segmentation ------------------------------------------------------------
SEGMENT_IMPORTANCE = band(
    "segment_value_share_pct",
    [(40, "PRIMARY_VALUE_DRIVER"), (20, "MAJOR_CONTRIBUTOR"), (10, "SIGNIFICANT_SEGMENT")],
    "NICHE_SEGMENT",
)
MARKETABILITY = band(
    "marketing_response_rate_pct",
    [(70, "HIGHLY_MARKETABLE"), (50, "MODERATELY_MARKETABLE"), (30, "SELECTIVE_MARKETING")],
    "MARKETING_CHALLENGE",
)
DIGITAL_STRATEGY = band(
    "digital_adoption_rate_pct",
    [(70, "DIGITAL_NATIVE"), (50, "DIGITAL_ADOPTER"), (30, "DIGITAL_OPPORTUNITY")],
    "TRADITIONAL_PREFERRED",
)
RETENTION_CLASS = rules(
    "STANDARD_RETENTION",
    ("avg_churn_risk <= 30 AND avg_retention_opportunity >= 70", "LOYALTY_CHAMPIONS"),
    ("avg_churn_risk <= 50 AND avg_retention_opportunity >= 50", "STABLE_RELATIONSHIPS"),
    ("avg_churn_risk >= 70", "RETENTION_CRITICAL"),
)
MARKETING_ACTION = rules(
    "MAINTAIN_CURRENT_STRATEGY",
    ("high_cross_sell_customers >= segment_customer_count * 0.5", "AGGRESSIVE_CROSS_SELL_CAMPAIGN"),
    ("digital_adoption_rate_pct < 40 AND customer_value_segment = 'High Value'", "DIGITAL_TRANSFORMATION_FOCUS"),
    ("marketing_response_rate_pct < 30", "MESSAGING_STRATEGY_REVIEW"),
    ("critical_retention_cases >= segment_customer_count * 0.1", "RETENTION_PROGRAM_PRIORITY"),
)

# --- product performance -----------------------------------------------------
CROSS_SELL_STATUS = rules(
    "CROSS_SELL_IMPROVEMENT_NEEDED",
    ("total_customers = 0", "CROSS_SELL_IMPROVEMENT_NEEDED"),
    ("multi_product_customers >= total_customers * 0.6", "EXCELLENT_CROSS_SELL_PERFORMANCE"),
    ("multi_product_customers >= total_customers * 0.4", "STRONG_CROSS_SELL_PERFORMANCE"),
    ("multi_product_customers >= total_customers * 0.25", "MODERATE_CROSS_SELL_PERFORMANCE"),
)
SEGMENT_CROSS_SELL = lookup(
    "customer_value_segment",
    {
        "High Value": "EXCELLENT_CROSS_SELL_PERFORMANCE",
        "Medium Value": "STRONG_CROSS_SELL_PERFORMANCE",
        "Standard Value": "MODERATE_CROSS_SELL_PERFORMANCE",
    },
    "CROSS_SELL_IMPROVEMENT_NEEDED",
)
PRODUCT_DIGITAL_MATURITY = rules(
    "DIGITAL_TRANSFORMATION_NEEDED",
    ("total_customers = 0", "DIGITAL_TRANSFORMATION_NEEDED"),
    ("digital_preferred_customers >= total_customers * 0.7", "DIGITAL_PRODUCT_LEADER"),
    ("digital_preferred_customers >= total_customers * 0.5", "DIGITAL_PROGRESSIVE"),
    ("digital_preferred_customers >= total_customers * 0.3", "DIGITAL_DEVELOPING"),
)
WEALTH_PRODUCTS = band(
    "investment_penetration_rate",
    [(25, "STRONG_WEALTH_PRODUCTS"), (15, "DEVELOPING_WEALTH_PRODUCTS"), (5, "EMERGING_WEALTH_PRODUCTS")],
    "WEALTH_PRODUCT_OPPORTUNITY",
)
PRODUCT_STRATEGY = rules(
    "OPTIMIZE_CURRENT_PORTFOLIO",
    ("total_customers = 0", "OPTIMIZE_CURRENT_PORTFOLIO"),
    ("high_cross_sell_opportunity >= total_customers * 0.3", "AGGRESSIVE_CROSS_SELL_CAMPAIGN"),
    ("investment_penetration_rate < 15 AND avg_value > 50000", "WEALTH_PRODUCT_FOCUS"),
    ("digital_first_rate < 50", "DIGITAL_PRODUCT_ENHANCEMENT"),
    ("multi_product_customers < total_customers * 0.4", "PRODUCT_BUNDLING_STRATEGY"),
)
PRODUCT_FOCUS = rules(
    "PRODUCT_OPTIMIZATION",
    ("loan_penetration_rate < deposit_penetration_rate * 0.3", "LENDING_PRODUCT_EXPANSION"),
    ("card_penetration_rate < 60", "PAYMENT_PRODUCT_GROWTH"),
    ("investment_penetration_rate < 20", "WEALTH_MANAGEMENT_DEVELOPMENT"),
)

# --- risk dashboard ----------------------------------------------------------
PORTFOLIO_RISK = rules(
    "MANAGED_RISK_PROFILE",
    ("critical_rate > 10", "CRITICAL_RISK_PORTFOLIO"),
    ("concentration > 25", "HIGH_RISK_CONCENTRATION"),
    ("non_compliance_rate > 5", "COMPLIANCE_ISSUES"),
    ("deteriorating_rate > 15", "RISK_DETERIORATION"),
)
TIER_RISK = rules(
    "MANAGED_RISK_PROFILE",
    ("total_customers = 0", "MANAGED_RISK_PROFILE"),
    ("at_high_risk > total_customers * 0.1", "HIGH_RISK_CONCENTRATION"),
    ("compliance_issues > total_customers * 0.05", "COMPLIANCE_ISSUES"),
    ("avg_composite > 70", "RISK_DETERIORATION"),
)
COMPLIANCE_HEALTH = band(
    "non_compliance_rate",
    [(10, "COMPLIANCE_CRISIS"), (5, "COMPLIANCE_ATTENTION_NEEDED"), (2, "COMPLIANCE_MONITORING_REQUIRED")],
    "COMPLIANCE_HEALTHY",
    op=">",
)
FRAUD_CLIMATE = band(
    "fraud_rate",
    [(20, "HIGH_FRAUD_ENVIRONMENT"), (10, "ELEVATED_FRAUD_RISK"), (5, "MODERATE_FRAUD_ACTIVITY")],
    "LOW_FRAUD_ENVIRONMENT",
    op=">",
)
RISK_ACTION = rules(
    "STANDARD_RISK_MONITORING",
    ("risk_actions > 100", "IMMEDIATE_RISK_COMMITTEE_MEETING"),
    ("compliance_actions > 50", "COMPLIANCE_REMEDIATION_PLAN"),
    ("high_fraud_alert_customers > 20", "FRAUD_INVESTIGATION_SURGE"),
    ("high_value_exposure > 15", "HIGH_VALUE_CUSTOMER_REVIEW"),
)
REGULATORY = rules(
    "NO_REGULATORY_ALERTS",
    ("non_compliance_rate > 5 OR compliance_actions > 25", "REGULATORY_REPORTING_REQUIRED"),
)
