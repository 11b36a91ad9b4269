"""Portable types of result columns, by name."""

REAL, WHOLE, TEXT = "CAST({} AS DOUBLE)", "CAST({} AS BIGINT)", "CAST({} AS VARCHAR)"

MOMENT_ENDINGS = ("_date", "_datetime", "_timestamp", "_since", "_until", "date_of_birth", "last_updated", "_created_at")

REALS = {
    "account_activation_rate", "account_dormancy_rate", "annual_fee_revenue", "annual_interest_rate",
    "annual_net_revenue", "annual_premium", "at_risk_loan_balance", "available_balance", "available_credit",
    "average_balance", "avg_account_balance", "avg_account_health_score", "avg_account_profitability_score",
    "avg_accounts_per_customer", "avg_composite_risk_score", "avg_credit_risk_score", "avg_credit_score",
    "avg_credit_utilization", "avg_cross_sell_opportunity_score", "avg_cross_sell_score", "avg_customer_age",
    "avg_customer_relationship_value", "avg_customer_value", "avg_daily_transaction_frequency",
    "avg_digital_adoption_score", "avg_digital_score", "avg_fraud_alerts_per_customer", "avg_fraud_risk_score",
    "avg_loan_interest_rate", "avg_product_penetration", "avg_product_penetration_score",
    "avg_product_stickiness_score", "avg_relationship_value", "avg_relationship_years", "avg_retention_opportunity",
    "avg_retention_opportunity_score", "avg_risk_adjustment_factor", "avg_risk_score", "avg_satisfaction_score",
    "avg_service_satisfaction", "avg_transaction_amount", "avg_transaction_risk_score", "avg_usage_per_product",
    "balance_amount", "balance_change", "card_penetration_rate", "churn_risk_rate", "composite_risk_score",
    "cost_of_living_index", "coverage_amount", "credit_score_volatility", "critical_risk_assets",
    "critical_risk_customer_percentage", "current_balance", "current_price", "current_value",
    "customer_lifetime_value_score", "customer_relationship_value", "customer_total_balances",
    "customers_with_fraud_percentage", "deposit_amount", "deposit_penetration_rate", "deteriorating_risk_rate_pct",
    "digital_adoption_rate", "digital_adoption_rate_pct", "digital_adoption_score", "digital_deposit_percentage",
    "digital_transaction_percentage", "engagement_rate", "engagement_rate_pct", "expected_default_rate", "fee_amount",
    "fee_rate_on_transaction_volume", "fee_revenue_per_account", "fee_to_volume_ratio", "growth_potential_index",
    "healthy_assets_percentage", "high_cross_sell_rate", "high_risk_asset_concentration_pct", "high_risk_assets",
    "high_risk_percentage", "high_risk_portfolio_value", "high_value_customers_at_risk_assets",
    "high_value_percentage", "inbound_transfer_amount", "interest_amount", "interest_rate", "investment_aum",
    "investment_penetration_rate", "largest_transaction", "loan_penetration_rate", "marketing_conversion_rate",
    "marketing_response_rate_pct", "marketing_responsive_base", "marketing_roi_per_campaign", "monthly_fee",
    "monthly_fee_revenue", "monthly_interest_expense", "monthly_net_revenue", "multi_product_rate", "net_cash_flow",
    "net_revenue_yield_pct", "net_worth_with_bank", "non_compliance_rate_pct", "original_amount",
    "outbound_transfer_amount", "payment_amount", "payroll_deposit_amount", "penalty_fee_amount", "percent_paid",
    "premium_product_rate", "premium_rate_percent", "previous_balance", "principal_paid", "private_banking_assets",
    "private_banking_aum", "private_banking_customer_value", "private_banking_share", "private_banking_share_pct",
    "product_stickiness_score", "purchase_price", "purchase_value", "quantity", "retention_campaign_success_rate",
    "retention_value_index", "retirement_account_value", "return_percent", "revenue_per_customer",
    "risk_adjusted_assets_pct", "risk_adjusted_segment_value", "satisfaction_rate", "satisfaction_value_index",
    "segment_share_percentage", "segment_total_value", "segment_value_share_pct", "service_resolution_rate",
    "service_satisfaction_score", "total_annual_premiums", "total_aum", "total_credit_balance",
    "total_customer_assets", "total_deposit_amount", "total_deposit_balances", "total_deposits_amount",
    "total_fee_amount", "total_fees_paid", "total_inflows", "total_insurance_coverage", "total_investment_value",
    "total_loan_balance", "total_outflows", "total_payment_amount", "total_payments_amount", "total_portfolio_value",
    "total_product_portfolio_value", "total_relationship_value", "total_transaction_volume",
    "total_unrealized_gain_loss", "total_withdrawal_amount", "transaction_amount", "transaction_fee_income",
    "transfer_amount", "unrealized_gain_loss", "utilization_rate", "volatile_risk_rate_pct",
    "wealth_management_customer_value", "withdrawal_amount",
}

WHOLES = {
    "account_age_years", "account_health_score", "account_id", "account_profitability_score", "accrual_id",
    "active_cards", "active_deposit_accounts", "active_insurance_policies", "activity_id", "address_id",
    "address_quality_score", "age", "alert_id", "aml_flags", "annual_income", "assessment_id", "atm_withdrawals",
    "avg_conversion_value", "balance_id", "bill_payments", "campaign_response_id", "campaigns_clicked",
    "campaigns_converted", "campaigns_opened", "campaigns_opted_out", "card_age_years", "card_customers", "card_id",
    "cd_accounts", "channel_diversity_score", "checking_accounts", "churn_events", "churn_risk_events",
    "churn_risk_score", "claims_count", "complaint_interactions", "compliance_id", "compliance_review_required",
    "compliant_customers", "confirmed_fraud_incidents", "contact_count", "contact_window_hours", "credit_cards",
    "credit_limit", "credit_score", "critical_retention_cases", "critical_risk_customers", "cross_sell_campaigns",
    "cross_sell_conversions", "cross_sell_opportunities_available", "cross_sell_opportunity_score",
    "cross_sell_score", "current_credit_risk_score", "current_fraud_risk_score", "current_loans",
    "current_market_risk_score", "current_operational_risk_score", "customer_age", "customer_id",
    "customer_product_penetration", "customer_total_accounts", "customers_needing_review",
    "customers_with_fraud_alerts", "day_of_week", "days_past_due", "delinquent_loans", "deposit_account_customers",
    "deposit_hour", "deposit_id", "deteriorating_risk_customers", "digital_activities_last_30_days",
    "digital_activities_last_90_days", "digital_adopter_customers", "digital_banking_products",
    "digital_banking_usage", "digital_channel_usage", "digital_channels_used", "digital_deposits",
    "digital_financial_transactions", "digital_login_count", "digital_native_customers", "digital_platforms_used",
    "digital_preferred_customers", "digital_transactions", "dissatisfied_customers", "dormant_accounts_count",
    "dormant_accounts_requiring_attention", "duration_minutes", "enhanced_monitoring_required",
    "escalated_interactions", "estimated_months_remaining", "event_id", "failed_kyc_checks", "false_positive_alerts",
    "fee_id", "from_account_id", "growth_opportunities_available", "high_churn_risk_customers",
    "high_cross_sell_customers", "high_cross_sell_opportunities", "high_cross_sell_opportunity",
    "high_fraud_alert_customers", "high_risk_customers", "high_value_customers", "highest_credit_score",
    "highest_fraud_risk_score", "highly_engaged_count", "highly_engaged_customers", "highly_responsive_customers",
    "highly_satisfied_customers", "holding_id", "holding_years", "immediate_actions_required",
    "immediate_review_required", "inbound_transfers", "insurance_products", "insurance_usage", "interaction_hour",
    "interaction_id", "interactions_last_30_days", "interactions_last_90_days", "investment_customers",
    "investment_products", "investment_usage", "kyc_id", "large_amount_transactions", "latest_equifax_score",
    "latest_experian_score", "latest_transunion_score", "lending_products", "lending_usage", "linked_account_id",
    "loan_age_years", "loan_customers", "loan_id", "logins_last_30_days", "lowest_credit_score",
    "marketing_channels_used", "medium_cross_sell_opportunity", "min_satisfaction_score", "mobile_app_activities",
    "moderately_responsive_customers", "multi_product_customers", "non_compliant_customers", "off_hours_transactions",
    "omni_channel_customers", "outbound_transfers", "p2p_payments", "passed_kyc_checks", "payment_id",
    "payroll_deposits", "penalty_fees", "pending_account_alerts", "pending_fraud_investigations",
    "pending_verification", "phone_id", "phone_quality_score", "physical_channel_usage", "physical_channels_used",
    "policy_age_years", "policy_id", "premium_product_customers", "product_min_balance", "product_penetration_score",
    "relationship_years", "resolved_service_interactions", "retention_actions_required", "retention_calls_made",
    "retention_campaigns", "retention_campaigns_sent", "retention_interactions", "retention_offers_extended",
    "retention_opportunity_score", "risk_level", "risk_score", "sanctions_flags", "satisfaction_score",
    "savings_accounts", "score_id", "segment_customer_count", "segment_id", "service_channels_used",
    "successful_retentions", "support_interactions", "term_months", "to_account_id", "total_account_alerts",
    "total_accounts", "total_campaigns_converted", "total_campaigns_received", "total_campaigns_targeted",
    "total_cards", "total_channel_usage", "total_channels_used", "total_compliance_actions",
    "total_compliance_checks", "total_compliance_flags", "total_credit_limit", "total_customers",
    "total_deposit_accounts", "total_deposits", "total_digital_activities", "total_escalated_interactions",
    "total_fees", "total_fraud_alerts", "total_insurance_policies", "total_interactions", "total_investments",
    "total_kyc_checks", "total_loans", "total_logins", "total_marketing_value", "total_payments",
    "total_products_used", "total_resolved_interactions", "total_retention_events", "total_risk_actions_required",
    "total_service_interactions", "total_transactions", "total_usage_events", "total_withdrawals", "transaction_hour",
    "transaction_id", "transfer_id", "unusual_activity_alerts", "usage_count", "usage_frequency", "usage_id",
    "volatile_risk_customers", "wealth_management_customers", "web_portal_activities", "withdrawal_hour",
    "withdrawal_id", "years_at_address",
}

# One name, two meanings: an average or amount in one query, a whole number in another.
# Amounts of the alternative profile.
REALS |= {"loan_amount"}

SPECIAL = {
    ("int_customer_retention_analytics", "avg_churn_risk_score"): WHOLE,
    ("alt_int_customer_retention_analytics", "avg_churn_risk_score"): WHOLE,
    ("alt_stg_loans", "percent_paid"): WHOLE,
    ("alt_int_customer_financial_summary", "total_annual_premiums"): WHOLE,
    ("alt_int_customer_financial_summary", "total_insurance_coverage"): WHOLE,
}


def kinds_of(query: str, columns: list[str]) -> dict[str, str]:
    found = {}
    for column in columns:
        if (query, column) in SPECIAL:
            found[column] = SPECIAL[query, column]
        elif column.endswith(MOMENT_ENDINGS):
            found[column] = TEXT
        elif column in REALS or column == "avg_churn_risk_score":
            found[column] = REAL
        elif column in WHOLES:
            found[column] = WHOLE
    return found
