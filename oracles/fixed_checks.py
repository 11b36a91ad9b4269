"""The data checks that the check queries count, by table."""

from collections import namedtuple

Check = namedtuple("Check", "kind column values parent parent_column", defaults=((), "", ""))

STAGING = {
    'customers_360': [
        Check('unique', 'customer_id'),
        Check('unique', 'customer_number'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'customer_number'),
        Check('not_null', 'first_name'),
        Check('not_null', 'last_name'),
        Check('not_null', 'email_address'),
        Check('not_null', 'credit_score'),
    ],
    'customer_addresses': [
        Check('unique', 'address_id'),
        Check('not_null', 'address_id'),
        Check('not_null', 'customer_id'),
    ],
    'customer_phones': [
        Check('unique', 'phone_id'),
        Check('not_null', 'phone_id'),
        Check('not_null', 'customer_id'),
    ],
    'accounts': [
        Check('unique', 'account_id'),
        Check('not_null', 'account_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'product_type'),
        Check('accepted_values', 'account_status', ('ACTIVE', 'CLOSED', 'DORMANT', 'RESTRICTED')),
    ],
    'transactions': [
        Check('unique', 'transaction_id'),
        Check('not_null', 'transaction_id'),
        Check('not_null', 'account_id'),
    ],
    'deposits': [
        Check('unique', 'deposit_id'),
        Check('not_null', 'deposit_id'),
    ],
    'withdrawals': [
        Check('unique', 'withdrawal_id'),
        Check('not_null', 'withdrawal_id'),
    ],
    'transfers': [
        Check('unique', 'transfer_id'),
        Check('not_null', 'transfer_id'),
    ],
    'payments': [
        Check('unique', 'payment_id'),
        Check('not_null', 'payment_id'),
    ],
    'fees': [
        Check('unique', 'fee_id'),
        Check('not_null', 'fee_id'),
    ],
    'interest_accruals': [
        Check('unique', 'accrual_id'),
        Check('not_null', 'accrual_id'),
    ],
    'account_balances': [
        Check('unique', 'balance_id'),
        Check('not_null', 'balance_id'),
    ],
    'cards': [
        Check('unique', 'card_id'),
        Check('not_null', 'card_id'),
    ],
    'loans': [
        Check('unique', 'loan_id'),
        Check('not_null', 'loan_id'),
    ],
    'credit_scores': [
        Check('unique', 'score_id'),
        Check('not_null', 'score_id'),
        Check('not_null', 'credit_score'),
    ],
    'investments': [
        Check('unique', 'holding_id'),
        Check('not_null', 'holding_id'),
    ],
    'insurance_policies': [
        Check('unique', 'policy_id'),
        Check('not_null', 'policy_id'),
    ],
    'customer_interactions': [
        Check('unique', 'interaction_id'),
        Check('not_null', 'interaction_id'),
    ],
    'marketing_campaigns': [
        Check('unique', 'campaign_response_id'),
        Check('not_null', 'campaign_response_id'),
    ],
    'digital_activity': [
        Check('unique', 'activity_id'),
        Check('not_null', 'activity_id'),
    ],
    'channel_usage': [
        Check('unique', 'usage_id'),
        Check('not_null', 'usage_id'),
    ],
    'product_usage': [
        Check('unique', 'usage_id'),
        Check('not_null', 'usage_id'),
    ],
    'customer_segments': [
        Check('unique', 'segment_id'),
        Check('not_null', 'segment_id'),
    ],
    'retention_events': [
        Check('unique', 'event_id'),
        Check('not_null', 'event_id'),
    ],
    'risk_assessments': [
        Check('unique', 'assessment_id'),
        Check('not_null', 'assessment_id'),
    ],
    'kyc_records': [
        Check('unique', 'kyc_id'),
        Check('not_null', 'kyc_id'),
    ],
    'compliance_records': [
        Check('unique', 'compliance_id'),
        Check('not_null', 'compliance_id'),
    ],
    'fraud_alerts': [
        Check('unique', 'alert_id'),
        Check('not_null', 'alert_id'),
    ],
    'account_alerts': [
        Check('unique', 'alert_id'),
        Check('not_null', 'alert_id'),
    ],
}

ROLL_UPS = {
    'customer_profile': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'full_name'),
        Check('not_null', 'at_risk_customer'),
        Check('accepted_values', 'engagement_level', ('HIGHLY_ENGAGED', 'MODERATELY_ENGAGED', 'LIGHTLY_ENGAGED', 'MINIMAL_ENGAGEMENT')),
        Check('accepted_values', 'digital_preference', ('MOBILE_PREFERRED', 'WEB_PREFERRED', 'MULTI_CHANNEL', 'NON_DIGITAL')),
    ],
    'customer_360_master': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'customer_lifetime_value_score'),
        Check('not_null', 'churn_risk_score'),
        Check('not_null', 'next_best_action'),
        Check('accepted_values', 'executive_customer_tier', ('ULTRA_HIGH_NET_WORTH', 'HIGH_NET_WORTH', 'PLATINUM_CUSTOMER', 'GOLD_CUSTOMER', 'SILVER_CUSTOMER', 'BRONZE_CUSTOMER')),
    ],
    'customer_retention_analytics': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'churn_risk_score'),
        Check('not_null', 'retention_opportunity_score'),
        Check('accepted_values', 'retention_lifecycle_stage', ('CHURNED', 'HIGH_CHURN_RISK', 'DISSATISFIED', 'DISENGAGED', 'COMPLAINT_PATTERN', 'SUCCESSFULLY_RETAINED', 'LOYAL', 'STABLE')),
        Check('accepted_values', 'retention_priority', ('WIN_BACK', 'CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'MONITOR')),
    ],
    'customer_financial_summary': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'total_relationship_value'),
        Check('not_null', 'net_worth_with_bank'),
        Check('not_null', 'product_penetration_score'),
        Check('accepted_values', 'wealth_tier', ('PRIVATE_BANKING', 'WEALTH_MANAGEMENT', 'PREFERRED', 'SELECT', 'STANDARD')),
        Check('accepted_values', 'financial_risk_level', ('HIGH_RISK', 'MEDIUM_RISK', 'LOW_RISK')),
    ],
    'transaction_analytics': [
        Check('unique', 'account_id'),
        Check('not_null', 'account_id'),
        Check('not_null', 'total_transaction_volume'),
        Check('not_null', 'net_cash_flow'),
        Check('not_null', 'digital_transaction_percentage'),
        Check('accepted_values', 'activity_level', ('VERY_ACTIVE', 'ACTIVE', 'MODERATE', 'LIGHT', 'MINIMAL')),
        Check('accepted_values', 'spending_category', ('HIGH_SPENDER', 'MEDIUM_SPENDER', 'MODERATE_SPENDER', 'LOW_SPENDER')),
    ],
    'account_performance_dashboard': [
        Check('unique', 'account_id'),
        Check('not_null', 'account_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'account_profitability_score'),
        Check('not_null', 'account_health_score'),
        Check('accepted_values', 'account_risk_flag', ('IMMEDIATE_REVIEW_REQUIRED', 'ENHANCED_MONITORING', 'CUSTOMER_AT_RISK', 'DORMANT_ACCOUNT', 'NEGATIVE_BALANCE', 'NORMAL')),
        Check('accepted_values', 'account_service_tier', ('PRIVATE_BANKING', 'WEALTH_MANAGEMENT', 'PREMIUM', 'PREFERRED', 'ACTIVE', 'STANDARD')),
    ],
    'comprehensive_risk_profile': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'composite_risk_score'),
        Check('not_null', 'requires_enhanced_monitoring'),
        Check('not_null', 'requires_immediate_review'),
        Check('accepted_values', 'overall_risk_level', ('CRITICAL_RISK', 'HIGH_RISK', 'ELEVATED_RISK', 'MODERATE_RISK', 'LOW_RISK')),
        Check('accepted_values', 'compliance_status', ('NON_COMPLIANT', 'REVIEW_REQUIRED', 'COMPLIANT', 'PENDING_VERIFICATION')),
        Check('accepted_values', 'risk_trend', ('VOLATILE', 'DETERIORATING', 'UNSTABLE', 'STABLE')),
    ],
    'product_penetration_analysis': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'product_penetration_score'),
        Check('not_null', 'cross_sell_opportunity_score'),
        Check('not_null', 'product_stickiness_score'),
        Check('accepted_values', 'digital_adoption_level', ('DIGITAL_NATIVE', 'DIGITAL_ADOPTER', 'DIGITAL_BEGINNER', 'NON_DIGITAL')),
        Check('accepted_values', 'marketing_responsiveness', ('UNTARGETED', 'HIGHLY_RESPONSIVE', 'MODERATELY_RESPONSIVE', 'LIGHTLY_RESPONSIVE', 'UNRESPONSIVE')),
    ],
    'channel_effectiveness': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'digital_adoption_score'),
        Check('not_null', 'channel_diversity_score'),
        Check('accepted_values', 'channel_preference', ('DIGITAL_ONLY', 'DIGITAL_FIRST', 'DIGITAL_PREFERRED', 'PHYSICAL_PREFERRED', 'OMNI_CHANNEL', 'PHYSICAL_ONLY', 'MINIMAL_USAGE')),
        Check('accepted_values', 'channel_engagement_level', ('VERY_HIGH', 'HIGH', 'MEDIUM', 'LOW', 'MINIMAL', 'NONE')),
        Check('accepted_values', 'digital_session_quality', ('HIGH_QUALITY', 'MEDIUM_QUALITY', 'LOW_QUALITY', 'BRIEF_SESSIONS', 'NO_SESSIONS')),
    ],
}

REPORTS = {
    'executive_customer_dashboard': [
        Check('not_null', 'dashboard_section'),
        Check('not_null', 'total_customers'),
        Check('accepted_values', 'dashboard_section', ('EXECUTIVE_SUMMARY', 'SEGMENT_PERFORMANCE')),
        Check('accepted_values', 'portfolio_health', ('STRONG_VALUE_MIX', 'BALANCED_PORTFOLIO', 'GROWTH_OPPORTUNITY')),
        Check('accepted_values', 'digital_maturity', ('DIGITAL_LEADER', 'DIGITAL_PROGRESSIVE', 'DIGITAL_OPPORTUNITY')),
    ],
    'financial_performance_summary': [
        Check('not_null', 'total_customers'),
        Check('not_null', 'total_aum'),
        Check('accepted_values', 'portfolio_yield_assessment', ('HIGH_YIELD_PORTFOLIO', 'STRONG_YIELD', 'MODERATE_YIELD', 'YIELD_IMPROVEMENT_NEEDED')),
    ],
    'risk_management_dashboard': [
        Check('not_null', 'dashboard_section'),
        Check('not_null', 'total_customers'),
        Check('accepted_values', 'dashboard_section', ('RISK_OVERVIEW', 'WEALTH_TIER_RISK_BREAKDOWN')),
        Check('accepted_values', 'portfolio_risk_status', ('CRITICAL_RISK_PORTFOLIO', 'HIGH_RISK_CONCENTRATION', 'COMPLIANCE_ISSUES', 'RISK_DETERIORATION', 'MANAGED_RISK_PROFILE')),
        Check('accepted_values', 'compliance_health_status', ('COMPLIANCE_CRISIS', 'COMPLIANCE_ATTENTION_NEEDED', 'COMPLIANCE_MONITORING_REQUIRED', 'COMPLIANCE_HEALTHY')),
        Check('accepted_values', 'recommended_action', ('IMMEDIATE_RISK_COMMITTEE_MEETING', 'COMPLIANCE_REMEDIATION_PLAN', 'FRAUD_INVESTIGATION_SURGE', 'HIGH_VALUE_CUSTOMER_REVIEW', 'STANDARD_RISK_MONITORING')),
    ],
    'customer_segmentation_analysis': [
        Check('not_null', 'analysis_section'),
        Check('accepted_values', 'analysis_section', ('SEGMENT_OVERVIEW', 'LIFECYCLE_ANALYSIS')),
        Check('accepted_values', 'segment_strategic_importance', ('PRIMARY_VALUE_DRIVER', 'MAJOR_CONTRIBUTOR', 'SIGNIFICANT_SEGMENT', 'NICHE_SEGMENT', 'LIFECYCLE_STAGE')),
        Check('accepted_values', 'marketing_effectiveness', ('HIGHLY_MARKETABLE', 'MODERATELY_MARKETABLE', 'SELECTIVE_MARKETING', 'MARKETING_CHALLENGE')),
        Check('accepted_values', 'digital_strategy_classification', ('DIGITAL_NATIVE', 'DIGITAL_ADOPTER', 'DIGITAL_OPPORTUNITY', 'TRADITIONAL_PREFERRED')),
    ],
    'product_performance_analytics': [
        Check('not_null', 'analytics_section'),
        Check('accepted_values', 'analytics_section', ('PRODUCT_PORTFOLIO_OVERVIEW', 'SEGMENT_PRODUCT_PERFORMANCE', 'NEXT_BEST_PRODUCT_OPPORTUNITIES')),
        Check('accepted_values', 'cross_sell_performance_status', ('EXCELLENT_CROSS_SELL_PERFORMANCE', 'STRONG_CROSS_SELL_PERFORMANCE', 'MODERATE_CROSS_SELL_PERFORMANCE', 'CROSS_SELL_IMPROVEMENT_NEEDED', 'NEXT_BEST_PRODUCT')),
        Check('accepted_values', 'digital_product_maturity', ('DIGITAL_PRODUCT_LEADER', 'DIGITAL_PROGRESSIVE', 'DIGITAL_DEVELOPING', 'DIGITAL_TRANSFORMATION_NEEDED')),
        Check('accepted_values', 'recommended_product_strategy', ('AGGRESSIVE_CROSS_SELL_CAMPAIGN', 'WEALTH_PRODUCT_FOCUS', 'DIGITAL_PRODUCT_ENHANCEMENT', 'PRODUCT_BUNDLING_STRATEGY', 'OPTIMIZE_CURRENT_PORTFOLIO')),
    ],
}

ORDER_DEMO = {
    'stg_customers': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
    ],
    'stg_orders': [
        Check('unique', 'order_id'),
        Check('not_null', 'order_id'),
        Check('accepted_values', 'status', ('placed', 'shipped', 'completed', 'return_pending', 'returned')),
    ],
    'stg_payments': [
        Check('unique', 'payment_id'),
        Check('not_null', 'payment_id'),
        Check('accepted_values', 'payment_method', ('credit_card', 'coupon', 'bank_transfer', 'gift_card')),
    ],
    'customers': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
    ],
    'orders': [
        Check('unique', 'order_id'),
        Check('not_null', 'order_id'),
        Check('not_null', 'customer_id'),
        Check('not_null', 'amount'),
        Check('not_null', 'credit_card_amount'),
        Check('not_null', 'coupon_amount'),
        Check('not_null', 'bank_transfer_amount'),
        Check('not_null', 'gift_card_amount'),
        Check('accepted_values', 'status', ('placed', 'shipped', 'completed', 'return_pending', 'returned')),
        Check('relationships', 'customer_id', parent='customers', parent_column='customer_id'),
    ],
    'published_customers': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
    ],
    'published_orders': [
        Check('unique', 'order_id'),
        Check('not_null', 'order_id'),
    ],
    'customer_orders': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
    ],
    'customer_summary': [
        Check('unique', 'customer_id'),
        Check('not_null', 'customer_id'),
    ],
}
