"""What the check queries expect of the rules: labels, cut points, weights and points.

Fixed values, stated here on their own, so that a change of a rule shows.
"""

from types import SimpleNamespace

staging = SimpleNamespace(
    AGE_COHORT="""CASE
        WHEN age < 25 THEN 'AC010'
        WHEN age < 35 THEN 'AC006'
        WHEN age < 50 THEN 'AC007'
        WHEN age < 65 THEN 'AC008'
        ELSE 'AC009' END""",
    INCOME_BRACKET="""CASE
        WHEN annual_income <= 25000 THEN 'IB001'
        WHEN annual_income <= 50000 THEN 'IB002'
        WHEN annual_income <= 75000 THEN 'IB003'
        WHEN annual_income <= 100000 THEN 'IB004'
        WHEN annual_income <= 150000 THEN 'IB005'
        WHEN annual_income <= 250000 THEN 'IB006'
        ELSE 'IB007' END""",
    CREDIT_RANGE="""CASE
        WHEN credit_score >= 800 THEN 'CSR001'
        WHEN credit_score >= 740 THEN 'CSR002'
        WHEN credit_score >= 670 THEN 'CSR003'
        WHEN credit_score >= 580 THEN 'CSR004'
        WHEN credit_score >= 500 THEN 'CSR005'
        ELSE 'CSR006' END""",
    RISK_CATEGORY="""CASE
        WHEN credit_score >= 740 AND annual_income >= 75000 THEN 'RC002'
        WHEN credit_score >= 670 AND annual_income >= 50000 THEN 'RC003'
        WHEN credit_score >= 580 THEN 'RC004'
        WHEN credit_score >= 500 THEN 'RC005'
        ELSE 'RC006' END""",
    LIFECYCLE_STAGE="""CASE
        WHEN relationship_month_part <= 2 THEN 'LS003'
        WHEN relationship_years < 1 THEN 'LS004'
        WHEN relationship_years < 3 THEN 'LS005'
        WHEN relationship_years < 5 THEN 'LS006'
        ELSE 'LS007' END""",
    VALUE_SEGMENT="""CASE
        WHEN annual_income >= 250000 AND credit_score >= 740 THEN 'High Value'
        WHEN annual_income >= 100000 AND credit_score >= 670 THEN 'Medium Value'
        ELSE 'Standard Value' END""",
    CUSTOMER_FLAGS={
        'marketing_eligible': "age >= 18 AND customer_status = 'ACTIVE'",
        'lending_eligible': "credit_score >= 580",
        'premium_product_eligible': "annual_income >= 50000",
    },
    BALANCE_TIER="""CASE
        WHEN current_balance >= 100000 THEN 'High Balance'
        WHEN current_balance >= 25000 THEN 'Medium Balance'
        WHEN current_balance >= 5000 THEN 'Standard Balance'
        ELSE 'Low Balance' END""",
    SERVICE_TIER="""CASE
        WHEN current_balance >= 250000 THEN 'Private Banking'
        WHEN current_balance >= 100000 THEN 'Premium'
        WHEN current_balance >= 25000 THEN 'Preferred'
        ELSE 'Standard' END""",
    ACCOUNT_TENURE="""CASE
        WHEN account_age_years >= 10 THEN 'Long Term'
        WHEN account_age_years >= 5 THEN 'Established'
        WHEN account_age_years >= 2 THEN 'Mature'
        ELSE 'New' END""",
    ACCOUNT_DIGITAL="""CASE
        WHEN online_banking_enabled AND mobile_banking_enabled THEN 'Full Digital'
        WHEN online_banking_enabled OR mobile_banking_enabled THEN 'Partial Digital'
        ELSE 'Traditional' END""",
    ACCOUNT_RISK="""CASE
        WHEN current_balance <= 0 THEN 'Negative Balance'
        WHEN current_balance < product_min_balance THEN 'Below Minimum'
        WHEN account_status = 'RESTRICTED' THEN 'Restricted'
        WHEN account_status = 'DORMANT' THEN 'Dormant'
        ELSE 'Normal' END""",
    ACCOUNT_CROSS_SELL="""CASE
        WHEN current_balance >= 50000 AND account_age_years >= 2 THEN 90
        WHEN current_balance >= 25000 AND account_age_years >= 1 THEN 75
        WHEN current_balance >= 10000 THEN 60
        WHEN account_status = 'ACTIVE' THEN 45
        ELSE 20 END""",
    ACCOUNT_FLAGS={
        'below_minimum_balance': "current_balance < product_min_balance",
        'fee_waiver_eligible': "current_balance >= product_min_balance AND monthly_fee > 0",
    },
    DAILY_BALANCE="""CASE
        WHEN balance_amount >= 50000 THEN 'HIGH_BALANCE'
        WHEN balance_amount >= 10000 THEN 'MEDIUM_BALANCE'
        ELSE 'LOW_BALANCE' END""",
    TRANSACTION_SIZE="""CASE
        WHEN transaction_amount >= 10000 THEN 'LARGE'
        WHEN transaction_amount >= 1000 THEN 'MEDIUM'
        WHEN transaction_amount >= 100 THEN 'SMALL'
        ELSE 'MICRO' END""",
    CHANNEL_GROUP="""CASE
        WHEN channel IN ('ONLINE', 'MOBILE') THEN 'DIGITAL'
        WHEN channel IN ('ATM', 'CARD') THEN 'SELF_SERVICE'
        WHEN channel IN ('BRANCH', 'PHONE') THEN 'ASSISTED'
        ELSE 'OTHER' END""",
    DAY_KIND="""CASE
        WHEN day_of_week IN (1, 7) THEN 'WEEKEND'
        ELSE 'WEEKDAY' END""",
    FLOW="""CASE
        WHEN transaction_type IN ('DEPOSIT', 'TRANSFER_IN', 'INTEREST', 'DIVIDEND', 'REFUND') THEN 'INFLOW'
        WHEN transaction_type IN ('WITHDRAWAL', 'TRANSFER_OUT', 'PAYMENT', 'PURCHASE', 'FEE') THEN 'OUTFLOW'
        ELSE 'NEUTRAL' END""",
    TRANSACTION_RISK="""CASE
        WHEN is_high_risk THEN 90
        WHEN amount_category = 'LARGE' AND time_category = 'OFF_HOURS' THEN 75
        WHEN amount_category = 'LARGE' THEN 60
        WHEN time_category = 'OFF_HOURS' THEN 45
        ELSE 20 END""",
    TRANSACTION_FLAGS={
        'is_digital_transaction': "channel IN ('ONLINE', 'MOBILE')",
    },
    DEPOSIT_SIZE="""CASE
        WHEN deposit_amount >= 10000 THEN 'LARGE'
        WHEN deposit_amount >= 1000 THEN 'MEDIUM'
        ELSE 'SMALL' END""",
    DEPOSIT_CHANNEL="""CASE
        WHEN deposit_type IN ('MOBILE_DEPOSIT', 'ACH') THEN 'DIGITAL'
        ELSE 'TRADITIONAL' END""",
    WITHDRAWAL_SIZE="""CASE
        WHEN withdrawal_amount >= 5000 THEN 'LARGE'
        WHEN withdrawal_amount >= 500 THEN 'MEDIUM'
        ELSE 'SMALL' END""",
    FEE_SIZE="""CASE
        WHEN fee_amount >= 25 THEN 'HIGH_FEE'
        WHEN fee_amount >= 10 THEN 'MEDIUM_FEE'
        ELSE 'LOW_FEE' END""",
    FEE_CLASS="""CASE
        WHEN fee_type IN ('OVERDRAFT', 'LATE_PAYMENT') THEN 'PENALTY'
        WHEN fee_type = 'MONTHLY_MAINTENANCE' THEN 'SERVICE'
        ELSE 'TRANSACTION' END""",
    CARD_UTILISATION="""CASE
        WHEN utilization_rate > 90 THEN 'HIGH_UTILIZATION'
        WHEN utilization_rate > 70 THEN 'MEDIUM_UTILIZATION'
        WHEN utilization_rate > 30 THEN 'LOW_UTILIZATION'
        ELSE 'MINIMAL_UTILIZATION' END""",
    CARD_RISK="""CASE
        WHEN utilization_rate > 85 THEN 90
        WHEN utilization_rate > 70 THEN 70
        WHEN utilization_rate > 50 THEN 50
        WHEN card_status = 'BLOCKED' THEN 95
        ELSE 20 END""",
    CARD_DIGITAL="""CASE
        WHEN contactless_enabled AND online_enabled THEN 'FULL_DIGITAL'
        WHEN contactless_enabled OR online_enabled THEN 'PARTIAL_DIGITAL'
        ELSE 'TRADITIONAL' END""",
    CARD_TIER="""CASE
        WHEN credit_limit >= 50000 THEN 'PREMIUM'
        WHEN credit_limit >= 25000 THEN 'GOLD'
        WHEN credit_limit >= 10000 THEN 'SILVER'
        WHEN credit_limit > 0 THEN 'STANDARD'
        ELSE 'N/A' END""",
    CARD_TENURE="""CASE
        WHEN card_age_years >= 5 THEN 'LONG_TERM'
        WHEN card_age_years >= 2 THEN 'ESTABLISHED'
        WHEN card_age_years >= 1 THEN 'MATURE'
        ELSE 'NEW' END""",
    CARD_FLAGS={
        'is_usable': "card_status = 'ACTIVE' AND NOT is_expired",
    },
    LOAN_DELINQUENCY="""CASE
        WHEN days_past_due = 0 THEN 'CURRENT'
        WHEN days_past_due <= 30 THEN 'LATE_1_30'
        WHEN days_past_due <= 60 THEN 'LATE_31_60'
        WHEN days_past_due <= 90 THEN 'LATE_61_90'
        ELSE 'LATE_90_PLUS' END""",
    LOAN_RISK="""CASE
        WHEN loan_status = 'CHARGED_OFF' THEN 100
        WHEN loan_status = 'DEFAULT' THEN 95
        WHEN days_past_due > 90 THEN 85
        WHEN days_past_due > 60 THEN 70
        WHEN days_past_due > 30 THEN 55
        WHEN days_past_due > 0 THEN 40
        ELSE 20 END""",
    LOAN_PERFORMANCE="""CASE
        WHEN percent_paid >= 80 THEN 'EXCELLENT'
        WHEN percent_paid >= 60 THEN 'GOOD'
        WHEN percent_paid >= 40 THEN 'FAIR'
        WHEN percent_paid >= 20 THEN 'POOR'
        ELSE 'NEW' END""",
    LOAN_SIZE="""CASE
        WHEN original_amount >= 500000 THEN 'JUMBO'
        WHEN original_amount >= 200000 THEN 'LARGE'
        WHEN original_amount >= 50000 THEN 'MEDIUM'
        WHEN original_amount >= 10000 THEN 'SMALL'
        ELSE 'MICRO' END""",
    LOAN_RATE="""CASE
        WHEN loan_type = 'MORTGAGE' AND interest_rate < 4 THEN 'EXCELLENT_RATE'
        WHEN loan_type = 'MORTGAGE' AND interest_rate < 5 THEN 'GOOD_RATE'
        WHEN loan_type = 'PERSONAL' AND interest_rate < 10 THEN 'EXCELLENT_RATE'
        WHEN loan_type = 'PERSONAL' AND interest_rate < 12 THEN 'GOOD_RATE'
        WHEN loan_type = 'AUTO' AND interest_rate < 5 THEN 'EXCELLENT_RATE'
        WHEN loan_type = 'AUTO' AND interest_rate < 7 THEN 'GOOD_RATE'
        ELSE 'MARKET_RATE' END""",
    LOAN_TENURE="""CASE
        WHEN loan_age_years >= 10 THEN 'LONG_TERM'
        WHEN loan_age_years >= 5 THEN 'ESTABLISHED'
        WHEN loan_age_years >= 2 THEN 'MATURE'
        ELSE 'NEW' END""",
    LOAN_FLAGS={
        'is_performing': "loan_status IN ('CURRENT', 'PAID_OFF') AND days_past_due = 0",
    },
    ASSET_CLASS="""CASE
        WHEN investment_type = 'STOCK' THEN 'EQUITY'
        WHEN investment_type = 'ETF' THEN 'EQUITY'
        WHEN investment_type = 'BOND' THEN 'FIXED_INCOME'
        WHEN investment_type = 'MUTUAL_FUND' THEN 'POOLED_INVESTMENT'
        WHEN investment_type = 'CD' THEN 'CASH_EQUIVALENT'
        WHEN investment_type = 'MONEY_MARKET' THEN 'CASH_EQUIVALENT'
        ELSE 'OTHER' END""",
    LIQUIDITY="""CASE
        WHEN investment_type = 'MUTUAL_FUND' THEN 'MEDIUM_LIQUIDITY'
        WHEN investment_type = 'BOND' THEN 'MEDIUM_LIQUIDITY'
        WHEN investment_type = 'CD' THEN 'LOW_LIQUIDITY'
        ELSE 'HIGH_LIQUIDITY' END""",
    PERFORMANCE="""CASE
        WHEN return_percent >= 20 THEN 'STRONG_PERFORMER'
        WHEN return_percent >= 10 THEN 'GOOD_PERFORMER'
        WHEN return_percent >= 0 THEN 'MODERATE_PERFORMER'
        WHEN return_percent >= -10 THEN 'POOR_PERFORMER'
        ELSE 'SIGNIFICANT_LOSS' END""",
    HOLDING_SIZE="""CASE
        WHEN current_value >= 100000 THEN 'LARGE_HOLDING'
        WHEN current_value >= 25000 THEN 'MEDIUM_HOLDING'
        WHEN current_value >= 5000 THEN 'SMALL_HOLDING'
        ELSE 'MINIMAL_HOLDING' END""",
    TAX_STATUS="""CASE
        WHEN account_type = 'TAXABLE' AND unrealized_gain_loss > 0 THEN 'TAXABLE_GAIN'
        WHEN account_type = 'TAXABLE' AND unrealized_gain_loss < 0 THEN 'TAX_LOSS_HARVEST'
        WHEN account_type IN ('IRA', 'ROTH_IRA', '401K') THEN 'TAX_DEFERRED'
        ELSE 'NO_TAX_IMPACT' END""",
    RISK_RETURN="""CASE
        WHEN risk_rating = 'HIGH' AND return_percent > 15 THEN 'HIGH_RISK_HIGH_RETURN'
        WHEN risk_rating = 'HIGH' AND return_percent < 0 THEN 'HIGH_RISK_POOR_RETURN'
        WHEN risk_rating = 'LOW' AND return_percent > 5 THEN 'LOW_RISK_GOOD_RETURN'
        WHEN risk_rating = 'LOW' AND return_percent < 0 THEN 'LOW_RISK_POOR_RETURN'
        ELSE 'MODERATE_RISK_RETURN' END""",
    HOLDING_TENURE="""CASE
        WHEN holding_years >= 5 THEN 'LONG_TERM'
        WHEN holding_years >= 2 THEN 'MEDIUM_TERM'
        WHEN holding_years >= 1 THEN 'SHORT_TERM'
        ELSE 'VERY_SHORT_TERM' END""",
    HOLDING_FLAGS={
        'is_major_holding': "current_value >= 50000",
        'requires_review': "return_percent < -20",
    },
    CLAIMS="""CASE
        WHEN claims_count = 0 THEN 'NO_CLAIMS'
        WHEN claims_count <= 2 THEN 'LOW_CLAIMS'
        WHEN claims_count <= 4 THEN 'MODERATE_CLAIMS'
        ELSE 'HIGH_CLAIMS' END""",
    BUREAU_SCORE="""CASE
        WHEN credit_score >= 800 THEN 'EXCEPTIONAL'
        WHEN credit_score >= 740 THEN 'VERY_GOOD'
        WHEN credit_score >= 670 THEN 'GOOD'
        WHEN credit_score >= 580 THEN 'FAIR'
        ELSE 'POOR' END""",
    ASSESSMENT_SCORE="""CASE
        WHEN risk_score >= 800 THEN 'EXCELLENT'
        WHEN risk_score >= 740 THEN 'VERY_GOOD'
        WHEN risk_score >= 670 THEN 'GOOD'
        WHEN risk_score >= 580 THEN 'FAIR'
        ELSE 'POOR' END""",
    LIVING_COST="""CASE
        WHEN cost_of_living_index > 130 THEN 'High Cost Area'
        WHEN cost_of_living_index > 110 THEN 'Medium Cost Area'
        ELSE 'Low Cost Area' END""",
    ADDRESS_STABILITY="""CASE
        WHEN years_at_address >= 5 THEN 'Stable'
        WHEN years_at_address >= 2 THEN 'Moderate'
        ELSE 'New' END""",
    ADDRESS_QUALITY="""CASE
        WHEN address_status = 'VERIFIED' AND years_at_address >= 2 THEN 90
        WHEN address_status = 'VERIFIED' AND years_at_address >= 1 THEN 75
        WHEN address_status = 'VERIFIED' THEN 60
        WHEN address_status = 'UNVERIFIED' THEN 40
        ELSE 20 END""",
    ADDRESS_FLAGS={
        'service_deliverable': "is_deliverable AND address_status = 'VERIFIED'",
        'urban_area': "population_density = 'High'",
    },
    PHONE_FORMAT="""CASE
        WHEN area_code IN ('000', '111', '999') THEN FALSE
        WHEN exchange IN ('000', '111', '999') THEN FALSE
        WHEN line_number IN ('0000', '1111', '9999') THEN FALSE
        ELSE TRUE END""",
    PHONE_FLAGS={
        'call_eligible': "is_verified AND phone_status = 'ACTIVE' AND NOT do_not_call",
        'sms_eligible': "sms_enabled AND phone_type = 'MOBILE' AND phone_status = 'ACTIVE'",
        'is_mobile': "phone_type = 'MOBILE'",
        'is_landline': "phone_type IN ('HOME', 'WORK')",
        'is_special_number': "area_code IN ('555', '800', '888', '877', '866')",
        'verification_required': "NOT is_verified AND phone_status = 'ACTIVE'",
    },
    PHONE_MARKETING_FLAGS={
        'marketing_call_eligible': "marketing_opt_in AND call_eligible",
        'marketing_sms_eligible': "marketing_opt_in AND sms_eligible",
    },
    PHONE_QUALITY="""CASE
        WHEN is_verified AND is_valid_format AND phone_status = 'ACTIVE' THEN 95
        WHEN is_valid_format AND phone_status = 'ACTIVE' THEN 80
        WHEN is_valid_format THEN 60
        ELSE 30 END""",
    CONTACT_METHOD="""CASE
        WHEN phone_type = 'MOBILE' AND sms_enabled THEN 'SMS_PREFERRED'
        WHEN phone_type = 'MOBILE' THEN 'MOBILE_CALL'
        WHEN phone_type = 'HOME' THEN 'HOME_CALL'
        WHEN phone_type = 'WORK' THEN 'WORK_CALL'
        ELSE 'NO_CONTACT' END""",
    DURATION="""CASE
        WHEN duration_minutes <= 15 THEN 'QUICK'
        WHEN duration_minutes <= 60 THEN 'STANDARD'
        WHEN duration_minutes <= 120 THEN 'EXTENDED'
        ELSE 'LENGTHY' END""",
    CONTACT_CHANNEL="""CASE
        WHEN interaction_type IN ('EMAIL', 'CHAT', 'SOCIAL_MEDIA') THEN 'DIGITAL'
        WHEN interaction_type = 'PHONE_CALL' THEN 'VOICE'
        WHEN interaction_type = 'BRANCH_VISIT' THEN 'IN_PERSON'
        ELSE 'OTHER' END""",
    EFFORT="""CASE
        WHEN contact_count > 3 THEN 'HIGH_EFFORT'
        WHEN contact_count > 1 THEN 'MEDIUM_EFFORT'
        ELSE 'LOW_EFFORT' END""",
    SATISFACTION="""CASE
        WHEN satisfaction_score >= 4 THEN 'SATISFIED'
        WHEN satisfaction_score >= 3 THEN 'NEUTRAL'
        WHEN satisfaction_score >= 1 THEN 'DISSATISFIED'
        ELSE 'NOT_RATED' END""",
    RESOLUTION="""CASE
        WHEN status = 'RESOLVED' AND contact_count = 1 AND NOT was_escalated THEN 'FIRST_CONTACT_RESOLUTION'
        WHEN status = 'RESOLVED' AND NOT was_escalated THEN 'RESOLVED_NO_ESCALATION'
        WHEN status = 'RESOLVED' AND was_escalated THEN 'RESOLVED_WITH_ESCALATION'
        WHEN status = 'ESCALATED' THEN 'UNRESOLVED_ESCALATED'
        ELSE 'UNRESOLVED_PENDING' END""",
    COMPLEXITY="""CASE
        WHEN reason_code IN ('TRANSACTION_DISPUTE', 'LOAN_QUESTION') AND was_escalated THEN 'COMPLEX'
        WHEN agent_tier IN ('SPECIALIST', 'SUPERVISOR') THEN 'MODERATE'
        ELSE 'SIMPLE' END""",
    INTERACTION_FLAGS={
        'is_digital_interaction': "interaction_type IN ('EMAIL', 'CHAT', 'SOCIAL_MEDIA')",
        'high_risk_interaction': "(reason_code = 'FEES_COMPLAINT' AND satisfaction_score <= 2) OR (priority = 'URGENT' AND status <> 'RESOLVED')",
    },
    CAMPAIGN_ENGAGEMENT="""CASE
        WHEN response_type = 'CONVERTED' THEN 'HIGH_ENGAGEMENT'
        WHEN response_type = 'CLICKED' THEN 'MEDIUM_ENGAGEMENT'
        WHEN response_type = 'OPENED' THEN 'LOW_ENGAGEMENT'
        ELSE 'NO_ENGAGEMENT' END""",
    CAMPAIGN_CHANNEL="""CASE
        WHEN channel IN ('EMAIL', 'DIGITAL_AD') THEN 'DIGITAL'
        ELSE 'TRADITIONAL' END""",
)

silver = SimpleNamespace(
    DIGITAL_CHANNELS="channel_type IN ('ONLINE', 'MOBILE')",
    PHYSICAL_CHANNELS="channel_type IN ('BRANCH', 'ATM', 'PHONE')",
    BANKING_PRODUCTS="product_type IN ('CHECKING', 'SAVINGS', 'MOBILE_BANKING')",
    LENDING_PRODUCTS="product_type IN ('MORTGAGE', 'LOANS')",
    RETIREMENT_ACCOUNTS="account_type IN ('IRA', 'ROTH_IRA', '401K')",
    TROUBLED_LOANS="loan_status IN ('DELINQUENT', 'DEFAULT')",
    MONEY_ACTIVITIES="activity_type IN ('TRANSFER', 'BILL_PAY', 'MOBILE_DEPOSIT')",
    ENGAGEMENT="""CASE
        WHEN total_digital_activities >= 50 AND avg_satisfaction_score >= 4 THEN 'HIGHLY_ENGAGED'
        WHEN total_digital_activities >= 20 AND avg_satisfaction_score >= 3 THEN 'MODERATELY_ENGAGED'
        WHEN total_digital_activities > 0 OR total_service_interactions > 0 THEN 'LIGHTLY_ENGAGED'
        ELSE 'MINIMAL_ENGAGEMENT' END""",
    AT_RISK="escalated_interactions > 2 OR avg_satisfaction_score < 2",
    DIGITAL_PREFERENCE="""CASE
        WHEN mobile_app_activities > web_portal_activities THEN 'MOBILE_PREFERRED'
        WHEN web_portal_activities > mobile_app_activities THEN 'WEB_PREFERRED'
        WHEN total_digital_activities > 0 THEN 'MULTI_CHANNEL'
        ELSE 'NON_DIGITAL' END""",
    PENETRATION_PARTS=(
        """CASE
        WHEN total_deposit_accounts > 0 THEN 20
        ELSE 0 END""",
        """CASE
        WHEN total_cards > 0 THEN 15
        ELSE 0 END""",
        """CASE
        WHEN total_loans > 0 THEN 25
        ELSE 0 END""",
        """CASE
        WHEN total_investments > 0 THEN 25
        ELSE 0 END""",
        """CASE
        WHEN total_insurance_policies > 0 THEN 15
        ELSE 0 END""",
    ),
    FINANCIAL_RISK="""CASE
        WHEN delinquent_loans > 0 OR max_credit_utilization > 0.9 THEN 'HIGH_RISK'
        WHEN avg_credit_utilization > 0.7 OR at_risk_loan_balance > 0 THEN 'MEDIUM_RISK'
        ELSE 'LOW_RISK' END""",
    WEALTH_TIER="""CASE
        WHEN wealth >= 1000000 THEN 'PRIVATE_BANKING'
        WHEN wealth >= 250000 THEN 'WEALTH_MANAGEMENT'
        WHEN wealth >= 100000 THEN 'PREFERRED'
        WHEN wealth >= 25000 THEN 'SELECT'
        ELSE 'STANDARD' END""",
    SPENDING="""CASE
        WHEN total_outflows >= 10000 THEN 'HIGH_SPENDER'
        WHEN total_outflows >= 5000 THEN 'MEDIUM_SPENDER'
        WHEN total_outflows >= 1000 THEN 'MODERATE_SPENDER'
        ELSE 'LOW_SPENDER' END""",
    ACTIVITY="""CASE
        WHEN total_transactions >= 100 THEN 'VERY_ACTIVE'
        WHEN total_transactions >= 50 THEN 'ACTIVE'
        WHEN total_transactions >= 20 THEN 'MODERATE'
        WHEN total_transactions >= 5 THEN 'LIGHT'
        ELSE 'MINIMAL' END""",
    CAMPAIGN_VALUE="""CASE
        WHEN campaign_type = 'CREDIT_CARD_OFFER' THEN 500
        WHEN campaign_type = 'SAVINGS_PROMOTION' THEN 200
        WHEN campaign_type = 'LOAN_OFFER' THEN 1000
        WHEN campaign_type = 'INVESTMENT_SEMINAR' THEN 750
        WHEN campaign_type = 'INSURANCE_QUOTE' THEN 300
        WHEN campaign_type = 'DIGITAL_BANKING' THEN 100
        ELSE 250 END""",
    ADOPTION_WEIGHTS={
        'digital_channels_used': 15,
        'digital_platforms_used': 20,
    },
    ADOPTION_SHARE_POINTS=65,
    DIVERSITY_WEIGHTS={
        'total_channels_used': 12,
        'marketing_channels_used': 8,
        'service_channels_used': 10,
        'digital_platforms_used': 15,
    },
    DIVERSITY_MIX="""CASE
        WHEN digital_channels_used > 0 AND physical_channels_used > 0 THEN 20
        WHEN digital_channels_used > 0 OR physical_channels_used > 0 THEN 10
        ELSE 0 END""",
    CHANNEL_PREFERENCE="""CASE
        WHEN digital_channel_usage > physical_channel_usage * 4 THEN 'DIGITAL_ONLY'
        WHEN digital_channel_usage > physical_channel_usage * 2 THEN 'DIGITAL_FIRST'
        WHEN digital_channel_usage > physical_channel_usage THEN 'DIGITAL_PREFERRED'
        WHEN physical_channel_usage > digital_channel_usage THEN 'PHYSICAL_PREFERRED'
        WHEN digital_channel_usage > 0 AND physical_channel_usage > 0 THEN 'OMNI_CHANNEL'
        WHEN digital_channel_usage > 0 THEN 'DIGITAL_ONLY'
        WHEN physical_channel_usage > 0 THEN 'PHYSICAL_ONLY'
        ELSE 'MINIMAL_USAGE' END""",
    CHANNEL_ENGAGEMENT="""CASE
        WHEN total_channel_usage >= 100 THEN 'VERY_HIGH'
        WHEN total_channel_usage >= 50 THEN 'HIGH'
        WHEN total_channel_usage >= 20 THEN 'MEDIUM'
        WHEN total_channel_usage >= 5 THEN 'LOW'
        WHEN total_channel_usage > 0 THEN 'MINIMAL'
        ELSE 'NONE' END""",
    SESSION_QUALITY="""CASE
        WHEN total_digital_activities >= 50 THEN 'HIGH_QUALITY'
        WHEN total_digital_activities >= 20 THEN 'MEDIUM_QUALITY'
        WHEN total_digital_activities >= 5 THEN 'LOW_QUALITY'
        WHEN total_digital_activities > 0 THEN 'BRIEF_SESSIONS'
        ELSE 'NO_SESSIONS' END""",
    CHANNEL_ACTION="""CASE
        WHEN digital_channels_used = 0 AND physical_channels_used > 0 THEN 'DIGITAL_ONBOARDING'
        WHEN total_digital_activities = 0 AND total_channels_used = 1 THEN 'CHANNEL_EXPANSION'
        WHEN total_escalated_interactions > 2 THEN 'SERVICE_CHANNEL_OPTIMIZATION'
        WHEN marketing_conversion_rate < 0.05 AND total_campaigns_received > 10 THEN 'MARKETING_CHANNEL_REVIEW'
        ELSE 'MAINTAIN_CURRENT_STRATEGY' END""",
    CHANNEL_OPPORTUNITY="""CASE
        WHEN digital_channels_used = 0 AND physical_channels_used > 0 THEN 'HIGH_DIGITAL_OPPORTUNITY'
        WHEN marketing_conversion_rate = 0 AND total_campaigns_received > 5 THEN 'MARKETING_OPTIMIZATION'
        WHEN service_channels_used > 3 AND service_satisfaction_score < 3 THEN 'SERVICE_CONSOLIDATION'
        WHEN digital_platforms_used = 1 AND total_digital_activities > 20 THEN 'PLATFORM_EXPANSION'
        ELSE 'STANDARD_OPTIMIZATION' END""",
    PRODUCT_WEIGHTS={
        'digital_banking_products': 15,
        'lending_products': 25,
        'investment_products': 30,
        'insurance_products': 20,
    },
    PRODUCT_BREADTH="""CASE
        WHEN total_products_used >= 5 THEN 10
        ELSE 0 END""",
    DIGITAL_ADOPTION="""CASE
        WHEN digital_banking_products >= 5 THEN 'DIGITAL_NATIVE'
        WHEN digital_banking_products >= 3 THEN 'DIGITAL_ADOPTER'
        WHEN digital_banking_products >= 1 THEN 'DIGITAL_BEGINNER'
        ELSE 'NON_DIGITAL' END""",
    RESPONSIVENESS="""CASE
        WHEN total_campaigns_targeted = 0 THEN 'UNTARGETED'
        WHEN campaigns_converted > total_campaigns_targeted * 0.1 THEN 'HIGHLY_RESPONSIVE'
        WHEN campaigns_clicked > total_campaigns_targeted * 0.05 THEN 'MODERATELY_RESPONSIVE'
        WHEN campaigns_opened > total_campaigns_targeted * 0.02 THEN 'LIGHTLY_RESPONSIVE'
        ELSE 'UNRESPONSIVE' END""",
    PRODUCT_CHANNEL="""CASE
        WHEN digital_channel_usage > physical_channel_usage * 3 THEN 'DIGITAL_FIRST'
        WHEN digital_channel_usage > physical_channel_usage THEN 'DIGITAL_PREFERRED'
        WHEN physical_channel_usage > digital_channel_usage THEN 'BRANCH_PREFERRED'
        WHEN total_channels_used > 0 THEN 'OMNI_CHANNEL'
        ELSE 'MINIMAL_ENGAGEMENT' END""",
    SPECIALISATION="""CASE
        WHEN investment_usage > digital_banking_usage + lending_usage + insurance_usage THEN 'INVESTMENT_FOCUSED'
        WHEN lending_usage > digital_banking_usage + investment_usage + insurance_usage THEN 'LENDING_FOCUSED'
        WHEN insurance_usage > digital_banking_usage + lending_usage + investment_usage THEN 'INSURANCE_FOCUSED'
        WHEN digital_banking_usage > 0 THEN 'BANKING_FOCUSED'
        ELSE 'PRODUCT_EXPLORER' END""",
    CROSS_SELL_PARTS=(
        """CASE
        WHEN digital_banking_products = 0 THEN 20
        ELSE 0 END""",
        """CASE
        WHEN lending_products = 0 AND current_segment IN ('PREMIUM', 'MASS_AFFLUENT') THEN 25
        ELSE 0 END""",
        """CASE
        WHEN investment_products = 0 AND current_segment IN ('PREMIUM', 'MASS_AFFLUENT', 'EMERGING_AFFLUENT') THEN 30
        ELSE 0 END""",
        """CASE
        WHEN insurance_products = 0 THEN 15
        ELSE 0 END""",
        """CASE
        WHEN cross_sell_conversions > 0 THEN 10
        ELSE 0 END""",
    ),
    NEXT_PRODUCT="""CASE
        WHEN investment_products = 0 AND current_segment IN ('PREMIUM', 'MASS_AFFLUENT') THEN 'INVESTMENT_ADVISORY'
        WHEN lending_products = 0 AND digital_banking_products > 0 THEN 'PERSONAL_LOAN'
        WHEN insurance_products = 0 AND total_products_used > 0 THEN 'INSURANCE_BUNDLE'
        WHEN digital_banking_products = 0 THEN 'MOBILE_BANKING'
        WHEN total_products_used >= 2 THEN 'PREMIUM_SERVICES'
        ELSE 'BASIC_PRODUCTS' END""",
    UNKNOWN_SCORE=500,
    TOP_CREDIT_SCORE=850,
    RISK_WEIGHTS={
        'current_credit_risk_score': 0.3,
        'current_fraud_risk_score': 0.3,
        'avg_credit_score': 0.2,
        'highest_fraud_risk_score': 0.2,
    },
    RISK_LEVEL="""CASE
        WHEN confirmed_fraud_incidents > 0 OR sanctions_flags > 0 THEN 'CRITICAL_RISK'
        WHEN pending_fraud_investigations > 0 OR aml_flags > 0 OR failed_kyc_checks > 0 THEN 'HIGH_RISK'
        WHEN current_credit_risk_score < 550 OR current_fraud_risk_score < 550 THEN 'ELEVATED_RISK'
        WHEN avg_credit_score < 580 OR total_fraud_alerts > 2 THEN 'MODERATE_RISK'
        ELSE 'LOW_RISK' END""",
    COMPLIANCE="""CASE
        WHEN sanctions_flags > 0 OR aml_flags > 0 THEN 'NON_COMPLIANT'
        WHEN failed_kyc_checks > 0 OR total_compliance_flags > 0 THEN 'REVIEW_REQUIRED'
        WHEN passed_kyc_checks > 0 AND total_compliance_checks > 0 THEN 'COMPLIANT'
        ELSE 'PENDING_VERIFICATION' END""",
    MONITORING="confirmed_fraud_incidents > 0 OR sanctions_flags > 0 OR aml_flags > 0 OR failed_kyc_checks > 0 OR unusual_activity_alerts > 5",
    IMMEDIATE_REVIEW="pending_fraud_investigations > 0 OR total_compliance_flags > passed_kyc_checks OR assessments_requiring_review > 0 OR pending_account_alerts > 0",
    RISK_TREND="""CASE
        WHEN credit_score_volatility > 50 THEN 'VOLATILE'
        WHEN total_fraud_alerts > total_credit_reports THEN 'DETERIORATING'
        WHEN highest_credit_score - lowest_credit_score > 100 THEN 'UNSTABLE'
        ELSE 'STABLE' END""",
    EVENT_CHURN_SCORE="""CASE
        WHEN churn_events > 0 THEN 90
        WHEN churn_risk_events > 2 THEN 75
        WHEN churn_risk_events > 0 THEN 50
        ELSE 25 END""",
    POINTS_PER_CHURN_EVENT=30,
    CHURN_PARTS=(
        """CASE
        WHEN at_risk_customer THEN 25
        ELSE 0 END""",
        """CASE
        WHEN min_satisfaction_score <= 2 THEN 20
        WHEN avg_satisfaction_score <= 2.5 THEN 15
        WHEN avg_satisfaction_score <= 3 THEN 10
        ELSE 0 END""",
        """CASE
        WHEN digital_activities_last_30_days = 0 AND total_digital_activities > 0 THEN 15
        WHEN digital_activities_last_30_days < floor(digital_activities_last_90_days / 3) THEN 10
        ELSE 0 END""",
        """CASE
        WHEN complaint_interactions > support_interactions THEN 15
        WHEN escalated_interactions > 2 THEN 10
        ELSE 0 END""",
        """CASE
        WHEN overall_risk_level IN ('HIGH_RISK', 'CRITICAL_RISK') THEN 10
        WHEN requires_immediate_review THEN 5
        ELSE 0 END""",
    ),
    OPPORTUNITY_PARTS=(
        """CASE
        WHEN customer_value_segment = 'HIGH_VALUE' THEN 30
        WHEN customer_value_segment = 'MEDIUM_VALUE' THEN 20
        WHEN customer_value_segment = 'LOW_VALUE' THEN 10
        ELSE 5 END""",
        """CASE
        WHEN relationship_years >= 5 THEN 25
        WHEN relationship_years >= 2 THEN 20
        WHEN relationship_years >= 1 THEN 15
        ELSE 10 END""",
        """CASE
        WHEN successful_retentions > 0 THEN 20
        WHEN retention_campaigns_sent > 0 THEN 10
        ELSE 0 END""",
        """CASE
        WHEN engagement_level = 'HIGHLY_ENGAGED' THEN 15
        WHEN engagement_level = 'MODERATELY_ENGAGED' THEN 10
        WHEN engagement_level = 'LIGHTLY_ENGAGED' THEN 5
        ELSE 0 END""",
        """CASE
        WHEN digital_preference = 'DIGITAL_FIRST' THEN 10
        WHEN digital_preference = 'DIGITAL_PREFERRED' THEN 10
        WHEN digital_preference = 'MULTI_CHANNEL' THEN 5
        ELSE 0 END""",
    ),
    RETENTION_STAGE="""CASE
        WHEN churn_events > 0 THEN 'CHURNED'
        WHEN churn_risk_events > 0 AND recent_churn_risk THEN 'HIGH_CHURN_RISK'
        WHEN avg_satisfaction_score <= 2 OR escalated_interactions > 2 THEN 'DISSATISFIED'
        WHEN digital_activities_last_30_days = 0 AND total_digital_activities > 0 THEN 'DISENGAGED'
        WHEN interactions_last_30_days > 3 AND complaint_interactions > 0 THEN 'COMPLAINT_PATTERN'
        WHEN successful_retentions > 0 THEN 'SUCCESSFULLY_RETAINED'
        WHEN engagement_level = 'HIGHLY_ENGAGED' THEN 'LOYAL'
        ELSE 'STABLE' END""",
    RETENTION_ACTION="""CASE
        WHEN churn_events > 0 THEN 'WIN_BACK_CAMPAIGN'
        WHEN churn_risk_events > 0 AND recent_churn_risk THEN 'IMMEDIATE_RETENTION_CALL'
        WHEN min_satisfaction_score <= 2 THEN 'SATISFACTION_RECOVERY'
        WHEN digital_activities_last_30_days = 0 AND total_digital_activities > 0 THEN 'RE_ENGAGEMENT_CAMPAIGN'
        WHEN complaint_interactions > support_interactions THEN 'PROACTIVE_OUTREACH'
        WHEN escalated_interactions > 1 THEN 'EXECUTIVE_ESCALATION'
        WHEN engagement_level = 'MINIMAL_ENGAGED' THEN 'ACTIVATION_CAMPAIGN'
        ELSE 'STANDARD_RETENTION' END""",
    RETENTION_STRATEGY="""CASE
        WHEN customer_value_segment = 'HIGH_VALUE' AND churn_risk_events > 0 THEN 'CONCIERGE_RETENTION'
        WHEN digital_preference = 'DIGITAL_FIRST' THEN 'DIGITAL_RETENTION_CAMPAIGN'
        WHEN complaint_interactions > 0 THEN 'SERVICE_RECOVERY'
        WHEN digital_activities_last_30_days = 0 THEN 'PRODUCT_EDUCATION'
        WHEN relationship_years >= 5 THEN 'LOYALTY_REWARDS'
        ELSE 'STANDARD_RETENTION' END""",
    RETENTION_PRIORITY="""CASE
        WHEN churn_events > 0 THEN 'WIN_BACK'
        WHEN churn_risk_events > 0 AND customer_value_segment = 'HIGH_VALUE' THEN 'CRITICAL'
        WHEN churn_risk_events > 0 OR avg_satisfaction_score <= 2 THEN 'HIGH'
        WHEN escalated_interactions > 1 OR digital_activities_last_30_days = 0 THEN 'MEDIUM'
        WHEN engagement_level = 'MINIMAL_ENGAGED' THEN 'LOW'
        ELSE 'MONITOR' END""",
    PROFITABILITY_PARTS=(
        """CASE
        WHEN monthly_fee > 0 THEN 20
        ELSE 0 END""",
        """CASE
        WHEN total_transaction_volume >= 50000 THEN 25
        WHEN total_transaction_volume >= 20000 THEN 20
        WHEN total_transaction_volume >= 10000 THEN 15
        WHEN total_transaction_volume >= 5000 THEN 10
        ELSE 5 END""",
        """CASE
        WHEN balance >= 100000 THEN 25
        WHEN balance >= 50000 THEN 20
        WHEN balance >= 25000 THEN 15
        WHEN balance >= 10000 THEN 10
        ELSE 5 END""",
        """CASE
        WHEN activity_level = 'VERY_ACTIVE' THEN 15
        WHEN activity_level = 'ACTIVE' THEN 12
        WHEN activity_level = 'MODERATE' THEN 8
        WHEN activity_level = 'LIGHT' THEN 5
        ELSE 0 END""",
        """CASE
        WHEN digital_transaction_percentage > 70 THEN 10
        ELSE 0 END""",
        """CASE
        WHEN account_age_years >= 5 THEN 5
        ELSE 0 END""",
    ),
    HEALTH_PARTS=(
        """CASE
        WHEN balance >= 10000 THEN 40
        WHEN balance >= 5000 THEN 30
        WHEN balance >= 1000 THEN 20
        WHEN balance >= 0 THEN 10
        ELSE 0 END""",
        """CASE
        WHEN total_transactions >= 50 THEN 20
        WHEN total_transactions >= 20 THEN 15
        WHEN total_transactions >= 10 THEN 10
        WHEN total_transactions >= 1 THEN 5
        ELSE 0 END""",
        """CASE
        WHEN overall_risk_level = 'LOW_RISK' THEN 20
        WHEN overall_risk_level = 'MODERATE_RISK' THEN 15
        WHEN overall_risk_level = 'ELEVATED_RISK' THEN 10
        WHEN overall_risk_level = 'HIGH_RISK' THEN 5
        ELSE 0 END""",
        """CASE
        WHEN avg_satisfaction_score >= 4 THEN 10
        WHEN avg_satisfaction_score >= 3 THEN 7
        WHEN avg_satisfaction_score >= 2 THEN 4
        ELSE 0 END""",
        """CASE
        WHEN compliance_status = 'COMPLIANT' THEN 10
        WHEN compliance_status = 'PENDING_VERIFICATION' THEN 5
        ELSE 0 END""",
    ),
    ACCOUNT_RISK_FLAG="""CASE
        WHEN requires_immediate_review THEN 'IMMEDIATE_REVIEW_REQUIRED'
        WHEN requires_enhanced_monitoring THEN 'ENHANCED_MONITORING'
        WHEN at_risk_customer THEN 'CUSTOMER_AT_RISK'
        WHEN total_transactions = 0 AND account_age_years > 1 THEN 'DORMANT_ACCOUNT'
        WHEN balance <= 0 THEN 'NEGATIVE_BALANCE'
        ELSE 'NORMAL' END""",
    ACCOUNT_OPPORTUNITY="""CASE
        WHEN cross_sell_opportunity_score >= 75 THEN 'HIGH_CROSS_SELL_OPPORTUNITY'
        WHEN wealth_tier IN ('PRIVATE_BANKING', 'WEALTH_MANAGEMENT') THEN 'WEALTH_MANAGEMENT_OPPORTUNITY'
        WHEN digital_transaction_percentage < 30 AND age < 50 THEN 'DIGITAL_CONVERSION_OPPORTUNITY'
        WHEN activity_level = 'MINIMAL' AND account_age_years < 2 THEN 'ACTIVATION_OPPORTUNITY'
        WHEN product_penetration_score < 40 THEN 'PRODUCT_EXPANSION_OPPORTUNITY'
        ELSE 'MAINTAIN_RELATIONSHIP' END""",
    ACCOUNT_ACTION="""CASE
        WHEN requires_immediate_review THEN 'RISK_REVIEW'
        WHEN at_risk_customer AND avg_satisfaction_score < 3 THEN 'RETENTION_CALL'
        WHEN total_transactions = 0 AND account_age_years > 1 THEN 'DORMANT_REACTIVATION'
        WHEN cross_sell_opportunity_score >= 75 THEN 'CROSS_SELL_CAMPAIGN'
        WHEN digital_transaction_percentage < 30 AND age < 50 THEN 'DIGITAL_ONBOARDING'
        WHEN balance >= 50000 AND total_investments = 0 THEN 'INVESTMENT_CONSULTATION'
        ELSE 'STANDARD_MAINTENANCE' END""",
    ACCOUNT_SERVICE_TIER="""CASE
        WHEN wealth_tier = 'PRIVATE_BANKING' THEN 'PRIVATE_BANKING'
        WHEN wealth_tier = 'WEALTH_MANAGEMENT' THEN 'WEALTH_MANAGEMENT'
        WHEN balance >= 100000 THEN 'PREMIUM'
        WHEN product_penetration_score >= 60 THEN 'PREFERRED'
        WHEN activity_level IN ('VERY_ACTIVE', 'ACTIVE') THEN 'ACTIVE'
        ELSE 'STANDARD' END""",
    PENETRATION_WEIGHT=0.3,
    LIFETIME_PARTS=(
        """CASE
        WHEN total_relationship_value >= 1000000 THEN 40
        WHEN total_relationship_value >= 250000 THEN 30
        WHEN total_relationship_value >= 100000 THEN 20
        WHEN total_relationship_value >= 25000 THEN 10
        ELSE 5 END""",
        """CASE
        WHEN relationship_years >= 10 THEN 20
        WHEN relationship_years >= 5 THEN 15
        WHEN relationship_years >= 2 THEN 10
        ELSE 5 END""",
        """CASE
        WHEN engagement_level = 'HIGHLY_ENGAGED' THEN 10
        WHEN engagement_level = 'MODERATELY_ENGAGED' THEN 7
        WHEN engagement_level = 'LIGHTLY_ENGAGED' THEN 4
        ELSE 1 END""",
    ),
    MASTER_CHURN_PARTS=(
        """CASE
        WHEN at_risk_customer THEN 40
        ELSE 0 END""",
        """CASE
        WHEN avg_satisfaction_score < 3 THEN 20
        ELSE 0 END""",
        """CASE
        WHEN delinquent_loans > 0 THEN 15
        ELSE 0 END""",
        """CASE
        WHEN total_transactions = 0 THEN 15
        ELSE 0 END""",
        """CASE
        WHEN overall_risk_level IN ('HIGH_RISK', 'CRITICAL_RISK') THEN 10
        ELSE 0 END""",
    ),
    MASTER_ACTION="""CASE
        WHEN requires_immediate_review THEN 'IMMEDIATE_RISK_REVIEW'
        WHEN at_risk_customer AND avg_satisfaction_score < 3 THEN 'RETENTION_OUTREACH'
        WHEN wealth_tier IN ('PRIVATE_BANKING', 'WEALTH_MANAGEMENT') AND total_investments = 0 THEN 'WEALTH_CONSULTATION'
        WHEN product_penetration_score < 40 AND lending_eligible THEN 'CROSS_SELL_LENDING'
        WHEN digital_transaction_percentage < 50 AND age < 50 THEN 'DIGITAL_ADOPTION_CAMPAIGN'
        WHEN avg_credit_utilization > 0.8 THEN 'CREDIT_LIMIT_INCREASE_OFFER'
        WHEN engagement_level = 'MINIMAL_ENGAGEMENT' THEN 'ENGAGEMENT_CAMPAIGN'
        ELSE 'MAINTAIN_RELATIONSHIP' END""",
    MASTER_TIER="""CASE
        WHEN wealth_tier = 'PRIVATE_BANKING' THEN 'ULTRA_HIGH_NET_WORTH'
        WHEN wealth_tier = 'WEALTH_MANAGEMENT' THEN 'HIGH_NET_WORTH'
        WHEN product_penetration_score >= 80 AND relationship_years >= 5 THEN 'PLATINUM_CUSTOMER'
        WHEN product_penetration_score >= 60 AND engagement_level = 'HIGHLY_ENGAGED' THEN 'GOLD_CUSTOMER'
        WHEN product_penetration_score >= 40 THEN 'SILVER_CUSTOMER'
        ELSE 'BRONZE_CUSTOMER' END""",
)

gold = SimpleNamespace(
    DIGITAL_FIRST="digital_preference IN ('DIGITAL_FIRST', 'DIGITAL_PREFERRED')",
    PRIORITY_RETENTION="retention_priority IN ('CRITICAL', 'WIN_BACK')",
    RESPONSIVE="marketing_responsiveness IN ('HIGHLY_RESPONSIVE', 'MODERATELY_RESPONSIVE')",
    DIGITAL_READY="digital_adoption_level IN ('DIGITAL_NATIVE', 'DIGITAL_ADOPTER')",
    HIGH_RISK="overall_risk_level IN ('HIGH_RISK', 'CRITICAL_RISK')",
    WEALTHY="wealth_tier IN ('PRIVATE_BANKING', 'WEALTH_MANAGEMENT')",
    NON_COMPLIANT="compliance_status <> 'COMPLIANT'",
    PORTFOLIO_HEALTH="""CASE
        WHEN total_customers = 0 THEN 'GROWTH_OPPORTUNITY'
        WHEN high_value_customers >= total_customers * 0.2 THEN 'STRONG_VALUE_MIX'
        WHEN high_value_customers >= total_customers * 0.1 THEN 'BALANCED_PORTFOLIO'
        ELSE 'GROWTH_OPPORTUNITY' END""",
    SEGMENT_HEALTH="""CASE
        WHEN customer_value_segment = 'High Value' THEN 'STRONG_VALUE_MIX'
        WHEN customer_value_segment = 'Medium Value' THEN 'BALANCED_PORTFOLIO'
        ELSE 'GROWTH_OPPORTUNITY' END""",
    DIGITAL_MATURITY="""CASE
        WHEN avg_digital_adoption >= 75 THEN 'DIGITAL_LEADER'
        WHEN avg_digital_adoption >= 50 THEN 'DIGITAL_PROGRESSIVE'
        ELSE 'DIGITAL_OPPORTUNITY' END""",
    RISK_STATUS="""CASE
        WHEN high_risk_customers <= total_customers * 0.05 THEN 'LOW_RISK_PORTFOLIO'
        WHEN high_risk_customers <= total_customers * 0.15 THEN 'MANAGED_RISK'
        ELSE 'HIGH_RISK_ATTENTION_NEEDED' END""",
    RISK_FACTOR="""CASE
        WHEN overall_risk_level = 'LOW_RISK' THEN 1.0
        WHEN overall_risk_level = 'MODERATE_RISK' THEN 0.8
        WHEN overall_risk_level = 'ELEVATED_RISK' THEN 0.6
        WHEN overall_risk_level = 'HIGH_RISK' THEN 0.3
        ELSE 0.1 END""",
    YIELD="""CASE
        WHEN net_revenue_yield >= 3 THEN 'HIGH_YIELD_PORTFOLIO'
        WHEN net_revenue_yield >= 2 THEN 'STRONG_YIELD'
        WHEN net_revenue_yield >= 1 THEN 'MODERATE_YIELD'
        ELSE 'YIELD_IMPROVEMENT_NEEDED' END""",
    ASSET_HEALTH="""CASE
        WHEN healthy_assets >= 80 THEN 'EXCELLENT_PORTFOLIO_HEALTH'
        WHEN healthy_assets >= 60 THEN 'GOOD_PORTFOLIO_HEALTH'
        WHEN healthy_assets >= 40 THEN 'FAIR_PORTFOLIO_HEALTH'
        ELSE 'PORTFOLIO_HEALTH_ATTENTION_NEEDED' END""",
    CROSS_SELL="""CASE
        WHEN avg_product_penetration >= 75 THEN 'EXCELLENT_CROSS_SELL'
        WHEN avg_product_penetration >= 50 THEN 'GOOD_CROSS_SELL_PERFORMANCE'
        WHEN avg_product_penetration >= 30 THEN 'MODERATE_CROSS_SELL'
        ELSE 'CROSS_SELL_OPPORTUNITY' END""",
    FINANCIAL_ACTION="""CASE
        WHEN dormancy_rate > 15 THEN 'ACTIVATION_CAMPAIGN_NEEDED'
        WHEN activation_rate < 85 THEN 'ENGAGEMENT_IMPROVEMENT_NEEDED'
        ELSE 'MAINTAIN_CURRENT_STRATEGY' END""",
    SEGMENT_IMPORTANCE="""CASE
        WHEN segment_value_share_pct >= 40 THEN 'PRIMARY_VALUE_DRIVER'
        WHEN segment_value_share_pct >= 20 THEN 'MAJOR_CONTRIBUTOR'
        WHEN segment_value_share_pct >= 10 THEN 'SIGNIFICANT_SEGMENT'
        ELSE 'NICHE_SEGMENT' END""",
    MARKETABILITY="""CASE
        WHEN marketing_response_rate_pct >= 70 THEN 'HIGHLY_MARKETABLE'
        WHEN marketing_response_rate_pct >= 50 THEN 'MODERATELY_MARKETABLE'
        WHEN marketing_response_rate_pct >= 30 THEN 'SELECTIVE_MARKETING'
        ELSE 'MARKETING_CHALLENGE' END""",
    DIGITAL_STRATEGY="""CASE
        WHEN digital_adoption_rate_pct >= 70 THEN 'DIGITAL_NATIVE'
        WHEN digital_adoption_rate_pct >= 50 THEN 'DIGITAL_ADOPTER'
        WHEN digital_adoption_rate_pct >= 30 THEN 'DIGITAL_OPPORTUNITY'
        ELSE 'TRADITIONAL_PREFERRED' END""",
    RETENTION_CLASS="""CASE
        WHEN avg_churn_risk <= 30 AND avg_retention_opportunity >= 70 THEN 'LOYALTY_CHAMPIONS'
        WHEN avg_churn_risk <= 50 AND avg_retention_opportunity >= 50 THEN 'STABLE_RELATIONSHIPS'
        WHEN avg_churn_risk >= 70 THEN 'RETENTION_CRITICAL'
        ELSE 'STANDARD_RETENTION' END""",
    MARKETING_ACTION="""CASE
        WHEN high_cross_sell_customers >= segment_customer_count * 0.5 THEN 'AGGRESSIVE_CROSS_SELL_CAMPAIGN'
        WHEN digital_adoption_rate_pct < 40 AND customer_value_segment = 'High Value' THEN 'DIGITAL_TRANSFORMATION_FOCUS'
        WHEN marketing_response_rate_pct < 30 THEN 'MESSAGING_STRATEGY_REVIEW'
        WHEN critical_retention_cases >= segment_customer_count * 0.1 THEN 'RETENTION_PROGRAM_PRIORITY'
        ELSE 'MAINTAIN_CURRENT_STRATEGY' END""",
    CROSS_SELL_STATUS="""CASE
        WHEN total_customers = 0 THEN 'CROSS_SELL_IMPROVEMENT_NEEDED'
        WHEN multi_product_customers >= total_customers * 0.6 THEN 'EXCELLENT_CROSS_SELL_PERFORMANCE'
        WHEN multi_product_customers >= total_customers * 0.4 THEN 'STRONG_CROSS_SELL_PERFORMANCE'
        WHEN multi_product_customers >= total_customers * 0.25 THEN 'MODERATE_CROSS_SELL_PERFORMANCE'
        ELSE 'CROSS_SELL_IMPROVEMENT_NEEDED' END""",
    SEGMENT_CROSS_SELL="""CASE
        WHEN customer_value_segment = 'High Value' THEN 'EXCELLENT_CROSS_SELL_PERFORMANCE'
        WHEN customer_value_segment = 'Medium Value' THEN 'STRONG_CROSS_SELL_PERFORMANCE'
        WHEN customer_value_segment = 'Standard Value' THEN 'MODERATE_CROSS_SELL_PERFORMANCE'
        ELSE 'CROSS_SELL_IMPROVEMENT_NEEDED' END""",
    PRODUCT_DIGITAL_MATURITY="""CASE
        WHEN total_customers = 0 THEN 'DIGITAL_TRANSFORMATION_NEEDED'
        WHEN digital_preferred_customers >= total_customers * 0.7 THEN 'DIGITAL_PRODUCT_LEADER'
        WHEN digital_preferred_customers >= total_customers * 0.5 THEN 'DIGITAL_PROGRESSIVE'
        WHEN digital_preferred_customers >= total_customers * 0.3 THEN 'DIGITAL_DEVELOPING'
        ELSE 'DIGITAL_TRANSFORMATION_NEEDED' END""",
    WEALTH_PRODUCTS="""CASE
        WHEN investment_penetration_rate >= 25 THEN 'STRONG_WEALTH_PRODUCTS'
        WHEN investment_penetration_rate >= 15 THEN 'DEVELOPING_WEALTH_PRODUCTS'
        WHEN investment_penetration_rate >= 5 THEN 'EMERGING_WEALTH_PRODUCTS'
        ELSE 'WEALTH_PRODUCT_OPPORTUNITY' END""",
    PRODUCT_STRATEGY="""CASE
        WHEN total_customers = 0 THEN 'OPTIMIZE_CURRENT_PORTFOLIO'
        WHEN high_cross_sell_opportunity >= total_customers * 0.3 THEN 'AGGRESSIVE_CROSS_SELL_CAMPAIGN'
        WHEN investment_penetration_rate < 15 AND avg_value > 50000 THEN 'WEALTH_PRODUCT_FOCUS'
        WHEN digital_first_rate < 50 THEN 'DIGITAL_PRODUCT_ENHANCEMENT'
        WHEN multi_product_customers < total_customers * 0.4 THEN 'PRODUCT_BUNDLING_STRATEGY'
        ELSE 'OPTIMIZE_CURRENT_PORTFOLIO' END""",
    PRODUCT_FOCUS="""CASE
        WHEN loan_penetration_rate < deposit_penetration_rate * 0.3 THEN 'LENDING_PRODUCT_EXPANSION'
        WHEN card_penetration_rate < 60 THEN 'PAYMENT_PRODUCT_GROWTH'
        WHEN investment_penetration_rate < 20 THEN 'WEALTH_MANAGEMENT_DEVELOPMENT'
        ELSE 'PRODUCT_OPTIMIZATION' END""",
    PORTFOLIO_RISK="""CASE
        WHEN critical_rate > 10 THEN 'CRITICAL_RISK_PORTFOLIO'
        WHEN concentration > 25 THEN 'HIGH_RISK_CONCENTRATION'
        WHEN non_compliance_rate > 5 THEN 'COMPLIANCE_ISSUES'
        WHEN deteriorating_rate > 15 THEN 'RISK_DETERIORATION'
        ELSE 'MANAGED_RISK_PROFILE' END""",
    TIER_RISK="""CASE
        WHEN total_customers = 0 THEN 'MANAGED_RISK_PROFILE'
        WHEN at_high_risk > total_customers * 0.1 THEN 'HIGH_RISK_CONCENTRATION'
        WHEN compliance_issues > total_customers * 0.05 THEN 'COMPLIANCE_ISSUES'
        WHEN avg_composite > 70 THEN 'RISK_DETERIORATION'
        ELSE 'MANAGED_RISK_PROFILE' END""",
    COMPLIANCE_HEALTH="""CASE
        WHEN non_compliance_rate > 10 THEN 'COMPLIANCE_CRISIS'
        WHEN non_compliance_rate > 5 THEN 'COMPLIANCE_ATTENTION_NEEDED'
        WHEN non_compliance_rate > 2 THEN 'COMPLIANCE_MONITORING_REQUIRED'
        ELSE 'COMPLIANCE_HEALTHY' END""",
    FRAUD_CLIMATE="""CASE
        WHEN fraud_rate > 20 THEN 'HIGH_FRAUD_ENVIRONMENT'
        WHEN fraud_rate > 10 THEN 'ELEVATED_FRAUD_RISK'
        WHEN fraud_rate > 5 THEN 'MODERATE_FRAUD_ACTIVITY'
        ELSE 'LOW_FRAUD_ENVIRONMENT' END""",
    RISK_ACTION="""CASE
        WHEN risk_actions > 100 THEN 'IMMEDIATE_RISK_COMMITTEE_MEETING'
        WHEN compliance_actions > 50 THEN 'COMPLIANCE_REMEDIATION_PLAN'
        WHEN high_fraud_alert_customers > 20 THEN 'FRAUD_INVESTIGATION_SURGE'
        WHEN high_value_exposure > 15 THEN 'HIGH_VALUE_CUSTOMER_REVIEW'
        ELSE 'STANDARD_RISK_MONITORING' END""",
    REGULATORY="""CASE
        WHEN non_compliance_rate > 5 OR compliance_actions > 25 THEN 'REGULATORY_REPORTING_REQUIRED'
        ELSE 'NO_REGULATORY_ALERTS' END""",
)

alternative = SimpleNamespace(
    LOAN_PERFORMANCE="""CASE
        WHEN percent_paid >= 80 THEN 'EXCELLENT'
        WHEN percent_paid >= 60 THEN 'GOOD'
        WHEN percent_paid >= 40 THEN 'FAIR'
        WHEN percent_paid >= 20 THEN 'POOR'
        ELSE 'NEW' END""",
    LOAN_TENURE="""CASE
        WHEN loan_age_years = 0 THEN 'CURRENT'
        WHEN loan_age_years <= 3 THEN 'NEW'
        WHEN loan_age_years <= 6 THEN 'ESTABLISHED'
        WHEN loan_age_years <= 9 THEN 'MATURE'
        ELSE 'LONG_TERM' END""",
    LOAN_RISK="""CASE
        WHEN loan_status = 'DEFAULTED' THEN 100
        WHEN loan_status = 'DEFAULT' THEN 95
        WHEN loan_age_years > 9 THEN 85
        WHEN loan_age_years > 6 THEN 70
        WHEN loan_age_years > 3 THEN 55
        ELSE 40 END""",
    LOAN_SIZE="""CASE
        WHEN loan_amount >= 500000 THEN 'JUMBO'
        WHEN loan_amount >= 200000 THEN 'LARGE'
        WHEN loan_amount >= 50000 THEN 'MEDIUM'
        WHEN loan_amount >= 10000 THEN 'SMALL'
        ELSE 'MICRO' END""",
    LOAN_RATE="""CASE
        WHEN loan_type = 'MORTGAGE' AND loan_amount < 200000 THEN 'EXCELLENT_RATE'
        WHEN loan_type = 'MORTGAGE' AND loan_amount < 500000 THEN 'GOOD_RATE'
        WHEN loan_type = 'PERSONAL' AND loan_amount < 100000 THEN 'EXCELLENT_RATE'
        WHEN loan_type = 'PERSONAL' AND loan_amount < 150000 THEN 'GOOD_RATE'
        WHEN loan_type = 'AUTO' AND loan_amount < 150000 THEN 'EXCELLENT_RATE'
        WHEN loan_type = 'AUTO' AND loan_amount < 200000 THEN 'GOOD_RATE'
        ELSE 'MARKET_RATE' END""",
    LOAN_MONTHS_LEFT="""CASE
        WHEN loan_age_years >= 10 THEN 120
        WHEN loan_age_years >= 5 THEN 60
        ELSE 12 END""",
    LOAN_INTEREST="""CASE
        WHEN loan_type = 'MORTGAGE' THEN 4.5
        WHEN loan_type = 'AUTO' THEN 6.8
        ELSE 12.5 END""",
    PHONE_DIGITS=10,
    PHONE_FLAGS={
        'is_mobile': "phone_type = 'MOBILE'",
        'is_primary_contact': "phone_type = 'PRIMARY' OR is_primary",
        'communication_ready': "phone_status = 'VERIFIED' AND is_valid_format",
        'sms_ready': "sms_enabled AND phone_status = 'VERIFIED'",
        'marketing_ready': "marketing_consent AND phone_status = 'VERIFIED'",
    },
    PHONE_QUALITY="""CASE
        WHEN phone_status = 'VERIFIED' AND is_valid_format AND sms_enabled THEN 95
        WHEN phone_status = 'VERIFIED' AND is_valid_format THEN 85
        WHEN phone_status = 'VERIFIED' THEN 70
        WHEN phone_status = 'UNVERIFIED' AND is_valid_format THEN 50
        ELSE 25 END""",
    COVERAGE="""CASE
        WHEN policy_type = 'LIFE' THEN 500000
        WHEN policy_type = 'AUTO' THEN 250000
        WHEN policy_type = 'HOME' THEN 400000
        ELSE 100000 END""",
    PREMIUM="""CASE
        WHEN policy_type = 'LIFE' THEN 2400
        WHEN policy_type = 'AUTO' THEN 1800
        WHEN policy_type = 'HOME' THEN 2200
        ELSE 1200 END""",
    LONG_TERM_HOLDINGS="investment_type IN ('STOCKS', 'BONDS')",
    RELATIONSHIP="""CASE
        WHEN total_deposit_accounts > 0 AND total_cards > 0 AND total_loans > 0 AND total_investments > 0 THEN 'FULL_RELATIONSHIP'
        WHEN total_deposit_accounts > 0 AND total_cards > 0 AND total_loans > 0 THEN 'CORE_BANKING'
        WHEN total_deposit_accounts > 0 AND total_cards > 0 THEN 'BASIC_BANKING'
        WHEN total_deposit_accounts > 0 THEN 'DEPOSIT_ONLY'
        ELSE 'MINIMAL_RELATIONSHIP' END""",
    VALUE_SEGMENT="""CASE
        WHEN business >= 1000000 THEN 'HIGH_VALUE'
        WHEN business >= 250000 THEN 'MEDIUM_VALUE'
        WHEN business >= 50000 THEN 'STANDARD_VALUE'
        ELSE 'LOW_VALUE' END""",
    CAMPAIGN_CHANNEL="""CASE
        WHEN campaign_type = 'EMAIL_PROMOTION' THEN 'EMAIL'
        WHEN campaign_type = 'DIRECT_MAIL' THEN 'MAIL'
        WHEN campaign_type = 'DIGITAL_ADS' THEN 'DIGITAL'
        WHEN campaign_type = 'SOCIAL_MEDIA' THEN 'SOCIAL'
        ELSE 'PHONE' END""",
    CAMPAIGN_VALUE="""CASE
        WHEN campaign_type = 'EMAIL_PROMOTION' THEN 200
        WHEN campaign_type = 'DIRECT_MAIL' THEN 300
        WHEN campaign_type = 'DIGITAL_ADS' THEN 150
        WHEN campaign_type = 'SOCIAL_MEDIA' THEN 100
        WHEN campaign_type = 'PHONE_CALL' THEN 500
        ELSE 250 END""",
    PRODUCT_KINDS={
        'digital_banking': "product_id IN ('CHCK001', 'SAVE001')",
        'lending': "product_id = 'LOAN001'",
        'investment': "product_id = 'INVT001'",
        'insurance': "product_id = 'CD001'",
    },
    FRAUD_SCORE="""CASE
        WHEN risk_level = 'HIGH' THEN 850
        WHEN risk_level = 'MEDIUM' THEN 650
        ELSE 450 END""",
    RISK_RATING="""CASE
        WHEN composite >= 750 THEN 'LOW_RISK'
        WHEN composite >= 600 THEN 'MEDIUM_RISK'
        ELSE 'HIGH_RISK' END""",
    COMPLIANCE="""CASE
        WHEN coalesce(total_compliance_flags, 0) = 0 THEN 'COMPLIANT'
        WHEN total_compliance_flags <= 2 THEN 'MINOR_CONCERNS'
        ELSE 'MAJOR_CONCERNS' END""",
    FRAUD_LEVEL="""CASE
        WHEN confirmed_fraud_incidents > 0 THEN 'HIGH_FRAUD_RISK'
        WHEN pending_fraud_investigations > 2 THEN 'MEDIUM_FRAUD_RISK'
        ELSE 'LOW_FRAUD_RISK' END""",
    KYC_STATUS="""CASE
        WHEN failed_kyc_checks > 0 THEN 'KYC_FAILED'
        WHEN passed_kyc_checks > 0 THEN 'KYC_PASSED'
        ELSE 'KYC_PENDING' END""",
    REVIEW_NEED="""CASE
        WHEN total_compliance_flags > 2 OR confirmed_fraud_incidents > 0 OR failed_kyc_checks > 0 THEN 'REQUIRES_IMMEDIATE_REVIEW'
        WHEN total_compliance_flags > 0 OR pending_fraud_investigations > 1 THEN 'REQUIRES_MONITORING'
        ELSE 'STANDARD_MONITORING' END""",
)

insights = SimpleNamespace(
    ACCOUNT_BAND="""CASE
        WHEN c_acctbal >= 7500 THEN 'HIGH'
        WHEN c_acctbal >= 2500 THEN 'MEDIUM'
        WHEN c_acctbal >= 0 THEN 'LOW'
        ELSE 'OVERDRAWN' END""",
    CUSTOMER_ACTION="""CASE
        WHEN orders IS NULL THEN 'FIRST_ORDER_OFFER'
        WHEN errors > 10 AND purchases = 0 THEN 'SERVICE_CALL'
        WHEN purchases > 0 AND spent >= 2000000 THEN 'VIP_PROGRAM'
        WHEN spent < 500000 THEN 'UPSELL'
        ELSE 'KEEP' END""",
    PRIORITY_WEIGHT="""CASE
        WHEN o_orderpriority = '1-URGENT' THEN 1.0
        WHEN o_orderpriority = '2-HIGH' THEN 0.75
        WHEN o_orderpriority = '3-MEDIUM' THEN 0.5
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0.25
        ELSE 0.0 END""",
    SUPPLIER_PARTS=(
        """CASE
        WHEN s_acctbal >= 7500 THEN 40
        WHEN s_acctbal >= 2500 THEN 25
        WHEN s_acctbal >= 0 THEN 10
        ELSE -20 END""",
        """CASE
        WHEN returned_share < 30 THEN 30
        WHEN returned_share < 35 THEN 15
        ELSE 0 END""",
        """CASE
        WHEN lines >= 500 THEN 40
        WHEN lines >= 100 THEN 20
        ELSE 0 END""",
    ),
    EVENTS_UNTIL="2024-01-31",
)

orders = SimpleNamespace(
    GRID_MESSAGE="This query should take about 20 seconds",
    PAYMENT_METHODS=(
        "credit_card",
        "coupon",
        "bank_transfer",
        "gift_card",
    ),
    SPEND_TIER="""CASE
        WHEN total_spent >= 300 THEN 'Gold'
        WHEN total_spent >= 100 THEN 'Silver'
        ELSE 'Bronze' END""",
)
