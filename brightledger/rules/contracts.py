"""Declared checks per table.

Fixed values: which columns must be unique, present, or one of a list of labels.
"""

from collections.abc import Mapping, Sequence

from brightledger.operators.checks import Check


def _checks(unique: Sequence[str] = (), present: Sequence[str] = (), allowed: Mapping[str, Sequence[str]] = {}) -> list[Check]:
    return (
        [Check("unique", column) for column in unique]
        + [Check("not_null", column) for column in present]
        + [Check("accepted_values", column, tuple(values)) for column, values in allowed.items()]
    )


STAGING = {
    "customers_360": _checks(
        unique=("customer_id", "customer_number"),
        present=("customer_id", "customer_number", "first_name", "last_name", "email_address", "credit_score"),
    ),
    "customer_addresses": _checks(
        unique=("address_id",),
        present=("address_id", "customer_id"),
    ),
    "customer_phones": _checks(
        unique=("phone_id",),
        present=("phone_id", "customer_id"),
    ),
    "accounts": _checks(
        unique=("account_id",),
        present=("account_id", "customer_id", "product_type"),
        allowed={
            "account_status": ("ACTIVE", "CLOSED", "DORMANT", "RESTRICTED"),
        },
    ),
    "transactions": _checks(
        unique=("transaction_id",),
        present=("transaction_id", "account_id"),
    ),
    "deposits": _checks(
        unique=("deposit_id",),
        present=("deposit_id",),
    ),
    "withdrawals": _checks(
        unique=("withdrawal_id",),
        present=("withdrawal_id",),
    ),
    "transfers": _checks(
        unique=("transfer_id",),
        present=("transfer_id",),
    ),
    "payments": _checks(
        unique=("payment_id",),
        present=("payment_id",),
    ),
    "fees": _checks(
        unique=("fee_id",),
        present=("fee_id",),
    ),
    "interest_accruals": _checks(
        unique=("accrual_id",),
        present=("accrual_id",),
    ),
    "account_balances": _checks(
        unique=("balance_id",),
        present=("balance_id",),
    ),
    "cards": _checks(
        unique=("card_id",),
        present=("card_id",),
    ),
    "loans": _checks(
        unique=("loan_id",),
        present=("loan_id",),
    ),
    "credit_scores": _checks(
        unique=("score_id",),
        present=("score_id", "credit_score"),
    ),
    "investments": _checks(
        unique=("holding_id",),
        present=("holding_id",),
    ),
    "insurance_policies": _checks(
        unique=("policy_id",),
        present=("policy_id",),
    ),
    "customer_interactions": _checks(
        unique=("interaction_id",),
        present=("interaction_id",),
    ),
    "marketing_campaigns": _checks(
        unique=("campaign_response_id",),
        present=("campaign_response_id",),
    ),
    "digital_activity": _checks(
        unique=("activity_id",),
        present=("activity_id",),
    ),
    "channel_usage": _checks(
        unique=("usage_id",),
        present=("usage_id",),
    ),
    "product_usage": _checks(
        unique=("usage_id",),
        present=("usage_id",),
    ),
    "customer_segments": _checks(
        unique=("segment_id",),
        present=("segment_id",),
    ),
    "retention_events": _checks(
        unique=("event_id",),
        present=("event_id",),
    ),
    "risk_assessments": _checks(
        unique=("assessment_id",),
        present=("assessment_id",),
    ),
    "kyc_records": _checks(
        unique=("kyc_id",),
        present=("kyc_id",),
    ),
    "compliance_records": _checks(
        unique=("compliance_id",),
        present=("compliance_id",),
    ),
    "fraud_alerts": _checks(
        unique=("alert_id",),
        present=("alert_id",),
    ),
    "account_alerts": _checks(
        unique=("alert_id",),
        present=("alert_id",),
    ),
}

ROLL_UPS = {
    "customer_profile": _checks(
        unique=("customer_id",),
        present=("customer_id", "full_name", "at_risk_customer"),
        allowed={
            "engagement_level": ("HIGHLY_ENGAGED", "MODERATELY_ENGAGED", "LIGHTLY_ENGAGED", "MINIMAL_ENGAGEMENT"),
            "digital_preference": ("MOBILE_PREFERRED", "WEB_PREFERRED", "MULTI_CHANNEL", "NON_DIGITAL"),
        },
    ),
    "customer_360_master": _checks(
        unique=("customer_id",),
        present=("customer_id", "customer_lifetime_value_score", "churn_risk_score", "next_best_action"),
        allowed={
            "executive_customer_tier": (
                "ULTRA_HIGH_NET_WORTH",
                "HIGH_NET_WORTH",
                "PLATINUM_CUSTOMER",
                "GOLD_CUSTOMER",
                "SILVER_CUSTOMER",
                "BRONZE_CUSTOMER",
            ),
        },
    ),
    "customer_retention_analytics": _checks(
        unique=("customer_id",),
        present=("customer_id", "churn_risk_score", "retention_opportunity_score"),
        allowed={
            "retention_lifecycle_stage": (
                "CHURNED",
                "HIGH_CHURN_RISK",
                "DISSATISFIED",
                "DISENGAGED",
                "COMPLAINT_PATTERN",
                "SUCCESSFULLY_RETAINED",
                "LOYAL",
                "STABLE",
            ),
            "retention_priority": ("WIN_BACK", "CRITICAL", "HIGH", "MEDIUM", "LOW", "MONITOR"),
        },
    ),
    "customer_financial_summary": _checks(
        unique=("customer_id",),
        present=("customer_id", "total_relationship_value", "net_worth_with_bank", "product_penetration_score"),
        allowed={
            "wealth_tier": ("PRIVATE_BANKING", "WEALTH_MANAGEMENT", "PREFERRED", "SELECT", "STANDARD"),
            "financial_risk_level": ("HIGH_RISK", "MEDIUM_RISK", "LOW_RISK"),
        },
    ),
    "transaction_analytics": _checks(
        unique=("account_id",),
        present=("account_id", "total_transaction_volume", "net_cash_flow", "digital_transaction_percentage"),
        allowed={
            "activity_level": ("VERY_ACTIVE", "ACTIVE", "MODERATE", "LIGHT", "MINIMAL"),
            "spending_category": ("HIGH_SPENDER", "MEDIUM_SPENDER", "MODERATE_SPENDER", "LOW_SPENDER"),
        },
    ),
    "account_performance_dashboard": _checks(
        unique=("account_id",),
        present=("account_id", "customer_id", "account_profitability_score", "account_health_score"),
        allowed={
            "account_risk_flag": (
                "IMMEDIATE_REVIEW_REQUIRED",
                "ENHANCED_MONITORING",
                "CUSTOMER_AT_RISK",
                "DORMANT_ACCOUNT",
                "NEGATIVE_BALANCE",
                "NORMAL",
            ),
            "account_service_tier": ("PRIVATE_BANKING", "WEALTH_MANAGEMENT", "PREMIUM", "PREFERRED", "ACTIVE", "STANDARD"),
        },
    ),
    "comprehensive_risk_profile": _checks(
        unique=("customer_id",),
        present=("customer_id", "composite_risk_score", "requires_enhanced_monitoring", "requires_immediate_review"),
        allowed={
            "overall_risk_level": ("CRITICAL_RISK", "HIGH_RISK", "ELEVATED_RISK", "MODERATE_RISK", "LOW_RISK"),
            "compliance_status": ("NON_COMPLIANT", "REVIEW_REQUIRED", "COMPLIANT", "PENDING_VERIFICATION"),
            "risk_trend": ("VOLATILE", "DETERIORATING", "UNSTABLE", "STABLE"),
        },
    ),
    "product_penetration_analysis": _checks(
        unique=("customer_id",),
        present=("customer_id", "product_penetration_score", "cross_sell_opportunity_score", "product_stickiness_score"),
        allowed={
            "digital_adoption_level": ("DIGITAL_NATIVE", "DIGITAL_ADOPTER", "DIGITAL_BEGINNER", "NON_DIGITAL"),
            "marketing_responsiveness": ("UNTARGETED", "HIGHLY_RESPONSIVE", "MODERATELY_RESPONSIVE", "LIGHTLY_RESPONSIVE", "UNRESPONSIVE"),
        },
    ),
    "channel_effectiveness": _checks(
        unique=("customer_id",),
        present=("customer_id", "digital_adoption_score", "channel_diversity_score"),
        allowed={
            "channel_preference": (
                "DIGITAL_ONLY",
                "DIGITAL_FIRST",
                "DIGITAL_PREFERRED",
                "PHYSICAL_PREFERRED",
                "OMNI_CHANNEL",
                "PHYSICAL_ONLY",
                "MINIMAL_USAGE",
            ),
            "channel_engagement_level": ("VERY_HIGH", "HIGH", "MEDIUM", "LOW", "MINIMAL", "NONE"),
            "digital_session_quality": ("HIGH_QUALITY", "MEDIUM_QUALITY", "LOW_QUALITY", "BRIEF_SESSIONS", "NO_SESSIONS"),
        },
    ),
}

REPORTS = {
    "executive_customer_dashboard": _checks(
        present=("dashboard_section", "total_customers"),
        allowed={
            "dashboard_section": ("EXECUTIVE_SUMMARY", "SEGMENT_PERFORMANCE"),
            "portfolio_health": ("STRONG_VALUE_MIX", "BALANCED_PORTFOLIO", "GROWTH_OPPORTUNITY"),
            "digital_maturity": ("DIGITAL_LEADER", "DIGITAL_PROGRESSIVE", "DIGITAL_OPPORTUNITY"),
        },
    ),
    "financial_performance_summary": _checks(
        present=("total_customers", "total_aum"),
        allowed={
            "portfolio_yield_assessment": ("HIGH_YIELD_PORTFOLIO", "STRONG_YIELD", "MODERATE_YIELD", "YIELD_IMPROVEMENT_NEEDED"),
        },
    ),
    "risk_management_dashboard": _checks(
        present=("dashboard_section", "total_customers"),
        allowed={
            "dashboard_section": ("RISK_OVERVIEW", "WEALTH_TIER_RISK_BREAKDOWN"),
            "portfolio_risk_status": (
                "CRITICAL_RISK_PORTFOLIO",
                "HIGH_RISK_CONCENTRATION",
                "COMPLIANCE_ISSUES",
                "RISK_DETERIORATION",
                "MANAGED_RISK_PROFILE",
            ),
            "compliance_health_status": (
                "COMPLIANCE_CRISIS",
                "COMPLIANCE_ATTENTION_NEEDED",
                "COMPLIANCE_MONITORING_REQUIRED",
                "COMPLIANCE_HEALTHY",
            ),
            "recommended_action": (
                "IMMEDIATE_RISK_COMMITTEE_MEETING",
                "COMPLIANCE_REMEDIATION_PLAN",
                "FRAUD_INVESTIGATION_SURGE",
                "HIGH_VALUE_CUSTOMER_REVIEW",
                "STANDARD_RISK_MONITORING",
            ),
        },
    ),
    "customer_segmentation_analysis": _checks(
        present=("analysis_section",),
        allowed={
            "analysis_section": ("SEGMENT_OVERVIEW", "LIFECYCLE_ANALYSIS"),
            "segment_strategic_importance": (
                "PRIMARY_VALUE_DRIVER",
                "MAJOR_CONTRIBUTOR",
                "SIGNIFICANT_SEGMENT",
                "NICHE_SEGMENT",
                "LIFECYCLE_STAGE",
            ),
            "marketing_effectiveness": ("HIGHLY_MARKETABLE", "MODERATELY_MARKETABLE", "SELECTIVE_MARKETING", "MARKETING_CHALLENGE"),
            "digital_strategy_classification": ("DIGITAL_NATIVE", "DIGITAL_ADOPTER", "DIGITAL_OPPORTUNITY", "TRADITIONAL_PREFERRED"),
        },
    ),
    "product_performance_analytics": _checks(
        present=("analytics_section",),
        allowed={
            "analytics_section": ("PRODUCT_PORTFOLIO_OVERVIEW", "SEGMENT_PRODUCT_PERFORMANCE", "NEXT_BEST_PRODUCT_OPPORTUNITIES"),
            "cross_sell_performance_status": (
                "EXCELLENT_CROSS_SELL_PERFORMANCE",
                "STRONG_CROSS_SELL_PERFORMANCE",
                "MODERATE_CROSS_SELL_PERFORMANCE",
                "CROSS_SELL_IMPROVEMENT_NEEDED",
                "NEXT_BEST_PRODUCT",
            ),
            "digital_product_maturity": (
                "DIGITAL_PRODUCT_LEADER",
                "DIGITAL_PROGRESSIVE",
                "DIGITAL_DEVELOPING",
                "DIGITAL_TRANSFORMATION_NEEDED",
            ),
            "recommended_product_strategy": (
                "AGGRESSIVE_CROSS_SELL_CAMPAIGN",
                "WEALTH_PRODUCT_FOCUS",
                "DIGITAL_PRODUCT_ENHANCEMENT",
                "PRODUCT_BUNDLING_STRATEGY",
                "OPTIMIZE_CURRENT_PORTFOLIO",
            ),
        },
    ),
}

ORDER_DEMO = {
    "stg_customers": _checks(
        unique=("customer_id",),
        present=("customer_id",),
    ),
    "stg_orders": _checks(
        unique=("order_id",),
        present=("order_id",),
        allowed={
            "status": ("placed", "shipped", "completed", "return_pending", "returned"),
        },
    ),
    "stg_payments": _checks(
        unique=("payment_id",),
        present=("payment_id",),
        allowed={
            "payment_method": ("credit_card", "coupon", "bank_transfer", "gift_card"),
        },
    ),
    "customers": _checks(
        unique=("customer_id",),
        present=("customer_id",),
    ),
    "orders": _checks(
        unique=("order_id",),
        present=("order_id", "customer_id", "amount", "credit_card_amount", "coupon_amount", "bank_transfer_amount", "gift_card_amount"),
        allowed={
            "status": ("placed", "shipped", "completed", "return_pending", "returned"),
        },
    )
    + [Check("relationships", "customer_id", parent="customers", parent_column="customer_id")],
    "published_customers": _checks(
        unique=("customer_id",),
        present=("customer_id",),
    ),
    "published_orders": _checks(
        unique=("order_id",),
        present=("order_id",),
    ),
    "customer_orders": _checks(
        unique=("customer_id",),
        present=("customer_id",),
    ),
    "customer_summary": _checks(
        unique=("customer_id",),
        present=("customer_id",),
    ),
}

# The reference tables: the first column of each is its key.
REFERENCE_KEYS = {
    "product_catalog": "product_id",
    "risk_categories": "risk_category_id",
    "credit_score_ranges": "score_range_id",
    "transaction_types": "transaction_type_id",
    "channel_definitions": "channel_id",
    "geographic_regions": "region_id",
    "income_brackets": "bracket_id",
    "age_cohorts": "cohort_id",
    "occupation_categories": "occupation_id",
    "regulatory_requirements": "requirement_id",
    "compliance_rules": "rule_id",
    "currency_codes": "currency_code",
    "country_risk_ratings": "country_code",
    "fee_structures": "fee_id",
    "interest_rate_tiers": "tier_id",
    "marketing_segments": "segment_id",
    "lifecycle_stages": "stage_id",
    "service_level_agreements": "sla_id",
    "holiday_calendars": "holiday_id",
    "economic_indicators": "indicator_id",
}
REFERENCES = {table: _checks((key,), (key,)) for table, key in REFERENCE_KEYS.items()}

# Tables of the order demo that other readers may use by name.
PUBLIC = ("published_customers", "published_orders")
