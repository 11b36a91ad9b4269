"""Check queries of the roll-ups."""

from __future__ import annotations

from oracles.fixed_rules import silver as R
from oracles.text import (
    Book,
    case,
    cases,
    mean,
    mean_of_means,
    n,
    pct,
    real,
    rounded,
    same,
    score,
    select,
    spread,
    total,
    truth,
    zero,
)


def ranked(source: str, keys: str, order: str, columns: dict[str, str]) -> str:
    """First row per key under an explicit order."""
    return select(columns, source, f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1")


def grouped(source: str, key: str, columns: dict[str, str], where: str = "TRUE", extra: str = "") -> str:
    keys = key + (f", {extra}" if extra else "")
    return select({key: key, **({extra: extra} if extra else {}), **columns}, source, f"WHERE {where} GROUP BY {keys}")


def full_joined(key: str, parts: list[str]) -> str:
    joins = " ".join(f"FULL JOIN ({part}) AS p{i} USING ({key})" for i, part in enumerate(parts[1:], 1))
    return f"SELECT * FROM ({parts[0]}) AS p0 {joins}"


def left_joined(base: str, key: str, parts: list[str]) -> str:
    joins = " ".join(f"LEFT JOIN ({part}) AS p{i} USING ({key})" for i, part in enumerate(parts))
    return f"SELECT * FROM ({base}) AS b {joins}"


def or_else(default: str, *names: str) -> dict[str, str]:
    return {name: f"COALESCE({name}, {default})" for name in names}


def build(book: Book, as_of: str = "2024-02-01") -> None:
    today = f"CAST('{as_of}' AS TIMESTAMP)"
    updated = {"last_updated": today}

    def day(name: str) -> str:
        return f"CAST({name} AS DATE)"

    def add(name: str, columns: dict[str, str], source: str, *reads: str) -> None:
        book.add(f"int_{name}", {**columns, **updated}, f"({source})", "", tuple(reads))

    # Customer profile
    profile = (
        "customer_id customer_number full_name first_name last_name age gender annual_income credit_score"
        " customer_status customer_since_date relationship_years age_cohort_name income_bracket_name"
        " credit_score_range_name risk_level lifecycle_stage_name customer_value_segment"
        " marketing_eligible lending_eligible premium_product_eligible"
    ).split()
    segment = ranked(
        "stg_customer_segments",
        "customer_id",
        "segment_date DESC NULLS FIRST, segment_id DESC",
        {"customer_id": "customer_id", "current_segment": "segment_name", "segment_assigned_date": "segment_date"},
    )
    profile_source = left_joined(
        "SELECT DISTINCT " + ", ".join(profile) + " FROM stg_customers_360",
        "customer_id",
        [
            ranked(
                "stg_customer_addresses",
                "customer_id",
                "(address_type = 'PRIMARY') DESC, address_since DESC NULLS FIRST, address_id DESC",
                {
                    **same("customer_id", "city", "state_code"),
                    "primary_address": "full_address",
                    "zip_code": "postal_code",
                    "address_verified": truth("address_status = 'VERIFIED'"),
                },
            ),
            ranked(
                "stg_customer_phones",
                "customer_id",
                "is_primary DESC, phone_id DESC",
                {
                    **same("customer_id", "call_eligible", "sms_eligible"),
                    "primary_phone": "formatted_phone",
                    "phone_verified": "is_verified",
                },
            ),
            segment,
            grouped(
                "stg_customer_interactions",
                "customer_id",
                {
                    "total_service_interactions": "count(*)",
                    "resolved_service_interactions": n("status = 'RESOLVED'"),
                    "escalated_interactions": n("was_escalated"),
                    "avg_satisfaction_score": "avg(satisfaction_score)",
                    "last_interaction_date": f"max({day('interaction_datetime')})",
                    "retention_interactions": n("resulted_in_retention"),
                },
            ),
            grouped(
                "stg_digital_activity",
                "customer_id",
                {
                    "total_digital_activities": "count(*)",
                    "mobile_app_activities": n("platform = 'MOBILE_APP'"),
                    "web_portal_activities": n("platform = 'WEB_PORTAL'"),
                    "last_digital_activity_date": f"max({day('activity_timestamp')})",
                    "digital_login_count": n("activity_type = 'LOGIN'"),
                    "digital_financial_transactions": n(R.MONEY_ACTIVITIES),
                },
            ),
        ],
    )
    add(
        "customer_profile",
        {
            **same(
                *profile,
                *(
                    "primary_address city state_code zip_code address_verified primary_phone phone_verified"
                    " call_eligible sms_eligible current_segment segment_assigned_date avg_satisfaction_score"
                    " last_interaction_date last_digital_activity_date"
                ).split(),
            ),
            **zero(
                *(
                    "total_service_interactions resolved_service_interactions escalated_interactions"
                    " retention_interactions total_digital_activities mobile_app_activities web_portal_activities"
                    " digital_login_count digital_financial_transactions"
                ).split()
            ),
            "engagement_level": case(R.ENGAGEMENT),
            "at_risk_customer": truth(R.AT_RISK),
            "digital_preference": case(R.DIGITAL_PREFERENCE),
        },
        profile_source,
        "stg_customers_360",
        "stg_customer_addresses",
        "stg_customer_phones",
        "stg_customer_segments",
        "stg_customer_interactions",
        "stg_digital_activity",
    )

    # Financial summary
    credit = "card_type = 'CREDIT'"
    holdings = full_joined(
        "customer_id",
        [
            grouped(
                "stg_accounts",
                "customer_id",
                {
                    "total_deposit_accounts": "count(*)",
                    "active_deposit_accounts": n("account_status = 'ACTIVE'"),
                    "checking_accounts": n("product_type = 'Checking'"),
                    "savings_accounts": n("product_type = 'Savings'"),
                    "cd_accounts": n("product_type = 'CD'"),
                    "total_deposit_balances": "sum(current_balance)",
                    "monthly_fee_revenue": "sum(monthly_fee_revenue)",
                    "first_account_opened_date": "min(opened_date)",
                },
            ),
            grouped(
                "stg_cards",
                "customer_id",
                {
                    "total_cards": "count(*)",
                    "active_cards": n("card_status = 'ACTIVE'"),
                    "credit_cards": n(credit),
                    "total_credit_limit": total("credit_limit", credit),
                    "total_credit_balance": total("current_balance", credit),
                    "avg_credit_utilization": mean(
                        f"CASE WHEN {credit} AND current_balance > 0 THEN CAST(utilization_rate AS DECIMAL(12,2)) END"
                    ),
                    "max_credit_utilization": f"max(CASE WHEN {credit} THEN utilization_rate ELSE 0 END)",
                },
            ),
            grouped(
                "stg_loans",
                "customer_id",
                {
                    "total_loans": "count(*)",
                    "current_loans": n("loan_status = 'CURRENT'"),
                    "total_loan_balance": "sum(current_balance)",
                    "avg_loan_interest_rate": mean("interest_rate"),
                    "delinquent_loans": n(R.TROUBLED_LOANS),
                    "at_risk_loan_balance": total("current_balance", R.TROUBLED_LOANS),
                },
            ),
            grouped(
                "stg_investments",
                "customer_id",
                {
                    "total_investments": "count(*)",
                    "total_investment_value": "sum(current_value)",
                    "total_unrealized_gain_loss": "sum(unrealized_gain_loss)",
                    "retirement_account_value": total("current_value", R.RETIREMENT_ACCOUNTS),
                },
            ),
            grouped(
                "stg_insurance_policies",
                "customer_id",
                {
                    "total_insurance_policies": "count(*)",
                    "active_insurance_policies": n("policy_status = 'ACTIVE'"),
                    "total_insurance_coverage": "sum(coverage_amount)",
                    "total_annual_premiums": "sum(annual_premium)",
                },
            ),
        ],
    )
    held = (
        "total_deposit_accounts active_deposit_accounts checking_accounts savings_accounts cd_accounts"
        " total_deposit_balances monthly_fee_revenue total_cards active_cards credit_cards total_credit_limit"
        " total_credit_balance avg_credit_utilization total_loans current_loans total_loan_balance"
        " avg_loan_interest_rate delinquent_loans at_risk_loan_balance total_investments total_investment_value"
        " total_unrealized_gain_loss retirement_account_value total_insurance_policies active_insurance_policies"
        " total_insurance_coverage total_annual_premiums"
    ).split()
    add(
        "customer_financial_summary",
        {
            **same("customer_id", "first_account_opened_date"),
            **zero(*held),
            "net_worth_with_bank": "wealth - COALESCE(total_loan_balance, 0) - COALESCE(total_credit_balance, 0)",
            "total_relationship_value": "wealth + COALESCE(total_credit_limit, 0)",
            "product_penetration_score": " + ".join(f"({case(part)})" for part in R.PENETRATION_PARTS),
            "financial_risk_level": case(R.FINANCIAL_RISK),
            "wealth_tier": case(R.WEALTH_TIER),
        },
        f"SELECT *, COALESCE(total_deposit_balances, 0) + COALESCE(total_investment_value, 0) AS wealth FROM ({holdings})",
        "stg_accounts",
        "stg_cards",
        "stg_loans",
        "stg_investments",
        "stg_insurance_policies",
    )

    # Transaction analytics
    def side(account: str, name: str) -> str:
        return select(
            {
                "account_id": account,
                f"{name}_transfers": "count(*)",
                f"{name}_transfer_amount": "sum(transfer_amount)",
            },
            "stg_transfers",
            f"WHERE transfer_status = 'COMPLETED' GROUP BY {account}",
        )

    penalty = "fee_classification = 'PENALTY'"
    flows = full_joined(
        "account_id",
        [
            grouped(
                "stg_transactions",
                "account_id",
                {
                    "total_transactions": "count(*)",
                    "total_transaction_volume": "sum(transaction_amount)",
                    "avg_transaction_amount": mean("transaction_amount"),
                    "largest_transaction": "max(transaction_amount)",
                    "first_transaction_date": "min(transaction_date)",
                    "last_transaction_date": "max(transaction_date)",
                    "total_inflows": total("transaction_amount", "flow_direction = 'INFLOW'"),
                    "total_outflows": total("transaction_amount", "flow_direction = 'OUTFLOW'"),
                    "digital_transactions": n("is_digital_transaction"),
                    "off_hours_transactions": n("time_category = 'OFF_HOURS'"),
                    "large_amount_transactions": n("amount_category = 'LARGE'"),
                    "avg_transaction_risk_score": "avg(risk_score)",
                },
                "transaction_status = 'COMPLETED'",
            ),
            grouped(
                "stg_deposits",
                "account_id",
                {
                    "total_deposits": "count(*)",
                    "total_deposit_amount": "sum(deposit_amount)",
                    "payroll_deposits": n("deposit_type = 'PAYROLL'"),
                    "payroll_deposit_amount": total("deposit_amount", "deposit_type = 'PAYROLL'"),
                    "digital_deposits": n("channel_type = 'DIGITAL'"),
                },
                "deposit_status = 'CLEARED'",
            ),
            grouped(
                "stg_withdrawals",
                "account_id",
                {
                    "total_withdrawals": "count(*)",
                    "total_withdrawal_amount": "sum(withdrawal_amount)",
                    "atm_withdrawals": n("withdrawal_type = 'ATM'"),
                },
                "withdrawal_status = 'COMPLETED'",
            ),
            side("from_account_id", "outbound"),
            side("to_account_id", "inbound"),
            grouped(
                "stg_payments",
                "account_id",
                {
                    "total_payments": "count(*)",
                    "total_payment_amount": "sum(payment_amount)",
                    "bill_payments": n("payment_type = 'BILL_PAY'"),
                    "p2p_payments": n("payment_type = 'PERSON_TO_PERSON'"),
                },
                "payment_status = 'COMPLETED'",
            ),
            grouped(
                "stg_fees",
                "account_id",
                {
                    "total_fees": "count(*)",
                    "total_fee_amount": "sum(fee_amount)",
                    "penalty_fees": n(penalty),
                    "penalty_fee_amount": total("fee_amount", penalty),
                },
                "fee_status = 'CHARGED'",
            ),
        ],
    )
    add(
        "transaction_analytics",
        {
            **same("account_id", "largest_transaction", "first_transaction_date", "last_transaction_date"),
            **zero(
                *(
                    "total_transactions total_transaction_volume avg_transaction_amount total_inflows total_outflows"
                    " digital_transactions off_hours_transactions large_amount_transactions"
                    " avg_transaction_risk_score total_deposits total_deposit_amount payroll_deposits"
                    " payroll_deposit_amount digital_deposits total_withdrawals total_withdrawal_amount"
                    " atm_withdrawals outbound_transfers outbound_transfer_amount inbound_transfers"
                    " inbound_transfer_amount total_payments total_payment_amount bill_payments p2p_payments"
                    " total_fees total_fee_amount penalty_fees penalty_fee_amount"
                ).split()
            ),
            "net_cash_flow": "COALESCE(total_inflows, 0) - COALESCE(total_outflows, 0)",
            "digital_transaction_percentage": pct("digital_transactions", "total_transactions", 2),
            "digital_deposit_percentage": pct("digital_deposits", "total_deposits", 2),
            "avg_daily_transaction_frequency": f"CASE WHEN last_transaction_date IS NULL THEN 0 ELSE {real('total_transactions')}"
            " / greatest(1, (last_transaction_date - first_transaction_date) + 1) END",
            "spending_category": case(R.SPENDING),
            "activity_level": case(R.ACTIVITY),
            "fee_to_volume_ratio": pct("COALESCE(total_fee_amount, 0)", "total_transaction_volume", 4),
        },
        flows,
        "stg_transactions",
        "stg_deposits",
        "stg_withdrawals",
        "stg_transfers",
        "stg_payments",
        "stg_fees",
    )

    # Channel effectiveness
    converted = "response_type = 'CONVERTED'"
    channels = full_joined(
        "customer_id",
        [
            grouped(
                "stg_channel_usage",
                "customer_id",
                {
                    "total_channels_used": "count(DISTINCT channel_type)",
                    "digital_channels_used": f"count(DISTINCT channel_type) FILTER (WHERE {R.DIGITAL_CHANNELS})",
                    "physical_channels_used": f"count(DISTINCT channel_type) FILTER (WHERE {R.PHYSICAL_CHANNELS})",
                    "total_channel_usage": "sum(usage_count)",
                    "digital_channel_usage": total("usage_count", R.DIGITAL_CHANNELS),
                    "physical_channel_usage": total("usage_count", R.PHYSICAL_CHANNELS),
                    "last_channel_usage_date": "max(usage_date)",
                },
            ),
            grouped(
                "("
                + grouped(
                    "stg_marketing_campaigns",
                    "customer_id",
                    {
                        "received": "count(*)",
                        "converted": n(converted),
                        "value": total(f"({case(R.CAMPAIGN_VALUE)})", converted),
                    },
                    extra="channel",
                )
                + ")",
                "customer_id",
                {
                    "marketing_channels_used": "count(DISTINCT channel)",
                    "total_campaigns_received": "sum(received)",
                    "total_campaigns_converted": "sum(converted)",
                    "total_marketing_value": "sum(value)",
                    "marketing_conversion_rate": mean_of_means(f"{real('converted')} / received"),
                },
            ),
            grouped(
                "("
                + grouped(
                    "stg_customer_interactions",
                    "customer_id",
                    {
                        "contacts": "count(*)",
                        "satisfaction": "avg(satisfaction_score)",
                        "escalated": n("was_escalated"),
                        "resolved": n("status = 'RESOLVED'"),
                    },
                    extra="interaction_type",
                )
                + ")",
                "customer_id",
                {
                    "service_channels_used": "count(DISTINCT interaction_type)",
                    "total_service_interactions": "sum(contacts)",
                    "service_satisfaction_score": mean_of_means("satisfaction"),
                    "total_escalated_interactions": "sum(escalated)",
                    "total_resolved_interactions": "sum(resolved)",
                },
            ),
            grouped(
                "stg_digital_activity",
                "customer_id",
                {
                    "digital_platforms_used": "count(DISTINCT platform)",
                    "total_digital_activities": "count(*)",
                    "last_digital_activity_date": f"max({day('activity_timestamp')})",
                },
            ),
        ],
    )
    usage_share = f"round({real('digital_channel_usage')} * {R.ADOPTION_SHARE_POINTS} / {real('total_channel_usage')})"

    def weighed(weights: dict[str, int]) -> str:
        return " + ".join(f"COALESCE({name}, 0) * {weight}" for name, weight in weights.items())

    add(
        "channel_effectiveness",
        {
            **same("customer_id", "last_channel_usage_date", "last_digital_activity_date"),
            **zero(
                *(
                    "total_channels_used digital_channels_used physical_channels_used total_channel_usage"
                    " digital_channel_usage physical_channel_usage marketing_channels_used total_campaigns_received"
                    " total_campaigns_converted total_marketing_value marketing_conversion_rate"
                    " service_channels_used total_service_interactions service_satisfaction_score"
                    " total_escalated_interactions total_resolved_interactions digital_platforms_used"
                    " total_digital_activities"
                ).split()
            ),
            "digital_adoption_score": score(
                weighed(R.ADOPTION_WEIGHTS), f"CASE WHEN total_channel_usage > 0 THEN {usage_share} ELSE 0 END"
            ),
            "channel_diversity_score": score(weighed(R.DIVERSITY_WEIGHTS), R.DIVERSITY_MIX),
            "service_resolution_rate": pct("total_resolved_interactions", "total_service_interactions", 2),
            "marketing_roi_per_campaign": "COALESCE("
            + rounded(f"{real('total_marketing_value')} / {real('total_campaigns_received')}", 2)
            + ", 0)",
            **cases(
                channel_preference=R.CHANNEL_PREFERENCE,
                channel_engagement_level=R.CHANNEL_ENGAGEMENT,
                digital_session_quality=R.SESSION_QUALITY,
                next_best_channel_action=R.CHANNEL_ACTION,
                channel_optimization_opportunity=R.CHANNEL_OPPORTUNITY,
            ),
        },
        channels,
        "stg_channel_usage",
        "stg_marketing_campaigns",
        "stg_customer_interactions",
        "stg_digital_activity",
    )

    # Product penetration
    invests, insures = "product_type = 'INVESTMENTS'", "product_type = 'INSURANCE'"

    def used(column: str, condition: str) -> str:
        return f"sum({column}) FILTER (WHERE {condition})"

    products = full_joined(
        "customer_id",
        [
            grouped(
                "stg_product_usage",
                "customer_id",
                {
                    "total_products_used": "count(DISTINCT product_type)",
                    "total_usage_events": "sum(usage_frequency)",
                    "avg_usage_per_product": "avg(usage_frequency)",
                    "first_product_usage_date": "min(usage_date)",
                    "last_product_usage_date": "max(usage_date)",
                    "digital_banking_products": n(R.BANKING_PRODUCTS),
                    "lending_products": n(R.LENDING_PRODUCTS),
                    "investment_products": n(invests),
                    "insurance_products": n(insures),
                    "digital_banking_usage": used("usage_frequency", R.BANKING_PRODUCTS),
                    "lending_usage": used("usage_frequency", R.LENDING_PRODUCTS),
                    "investment_usage": used("usage_frequency", invests),
                    "insurance_usage": used("usage_frequency", insures),
                },
            ),
            f"SELECT customer_id, current_segment, segment_assigned_date AS current_segment_date FROM ({segment})",
            grouped(
                "stg_marketing_campaigns",
                "customer_id",
                {
                    "total_campaigns_targeted": "count(*)",
                    "campaigns_opened": n("response_type = 'OPENED'"),
                    "campaigns_clicked": n("response_type = 'CLICKED'"),
                    "campaigns_converted": n(converted),
                    "campaigns_opted_out": n("response_type = 'NO_RESPONSE'"),
                    "last_campaign_response_date": "max(sent_date)",
                    "cross_sell_campaigns": n("contains(campaign_type, 'OFFER')"),
                    "cross_sell_conversions": n(f"contains(campaign_type, 'OFFER') AND {converted}"),
                    "retention_campaigns": n("campaign_type = 'DIGITAL_BANKING'"),
                    "avg_conversion_value": n(f"{converted} AND resulted_in_sale"),
                },
            ),
            grouped(
                "stg_channel_usage",
                "customer_id",
                {
                    "total_channels_used": "count(DISTINCT channel_type)",
                    "digital_channels_used": n(R.DIGITAL_CHANNELS),
                    "physical_channels_used": n(R.PHYSICAL_CHANNELS),
                    "digital_channel_usage": used("usage_count", R.DIGITAL_CHANNELS),
                    "physical_channel_usage": used("usage_count", R.PHYSICAL_CHANNELS),
                },
            ),
        ],
    )
    months = f"CAST(datesub('day', first_product_usage_date, {today}) AS DOUBLE) / 30"
    sticky = score(
        "total_products_used * 10",
        "least(50, total_usage_events)",
        f"CASE WHEN first_product_usage_date IS NULL THEN 0 ELSE least(30.0, {months}) END",
    )
    add(
        "product_penetration_analysis",
        {
            **same(
                *(
                    "customer_id first_product_usage_date last_product_usage_date current_segment"
                    " current_segment_date last_campaign_response_date"
                ).split()
            ),
            **zero(
                *(
                    "total_products_used total_usage_events avg_usage_per_product digital_banking_products"
                    " lending_products investment_products insurance_products digital_banking_usage lending_usage"
                    " investment_usage insurance_usage total_campaigns_targeted campaigns_opened campaigns_clicked"
                    " campaigns_converted campaigns_opted_out cross_sell_campaigns cross_sell_conversions"
                    " retention_campaigns avg_conversion_value total_channels_used digital_channels_used"
                    " physical_channels_used digital_channel_usage physical_channel_usage"
                ).split()
            ),
            "product_penetration_score": score(weighed(R.PRODUCT_WEIGHTS), R.PRODUCT_BREADTH),
            "cross_sell_opportunity_score": score(*R.CROSS_SELL_PARTS),
            "product_stickiness_score": f"CASE WHEN total_usage_events > 0 THEN {sticky} ELSE 0 END",
            **cases(
                digital_adoption_level=R.DIGITAL_ADOPTION,
                marketing_responsiveness=R.RESPONSIVENESS,
                channel_preference=R.PRODUCT_CHANNEL,
                product_specialization=R.SPECIALISATION,
                next_best_product=R.NEXT_PRODUCT,
            ),
        },
        products,
        "stg_product_usage",
        "stg_customer_segments",
        "stg_marketing_campaigns",
        "stg_channel_usage",
    )

    # Risk profile
    latest = ranked(
        "stg_risk_assessments",
        "customer_id, risk_type",
        "assessment_date DESC NULLS FIRST, assessment_id DESC",
        same("customer_id", "risk_type", "risk_score", "risk_rating", "assessment_date", "requires_review"),
    )

    def of(kind: str, column: str) -> str:
        return f"max({column}) FILTER (WHERE risk_type = '{kind}_RISK')"

    flagged = "compliance_status = 'FLAGGED'"
    alerts = grouped(
        "(SELECT a.customer_id, x.alert_id, x.alert_type, x.alert_status, x.alert_timestamp"
        " FROM stg_accounts a LEFT JOIN stg_account_alerts x ON x.account_id = a.account_id)",
        "customer_id",
        {
            "total_account_alerts": "count(alert_id)",
            "unusual_activity_alerts": n("alert_type = 'UNUSUAL_ACTIVITY'"),
            "pending_account_alerts": n("alert_status = 'PENDING'"),
            "last_account_alert_date": f"max({day('alert_timestamp')})",
        },
    )
    risks = full_joined(
        "customer_id",
        [
            grouped(
                f"({latest})",
                "customer_id",
                {
                    "current_credit_risk_score": of("CREDIT", "risk_score"),
                    "current_fraud_risk_score": of("FRAUD", "risk_score"),
                    "current_operational_risk_score": of("OPERATIONAL", "risk_score"),
                    "current_market_risk_score": of("MARKET", "risk_score"),
                    "credit_risk_rating": of("CREDIT", "risk_rating"),
                    "fraud_risk_rating": of("FRAUD", "risk_rating"),
                    "last_risk_assessment_date": "max(assessment_date)",
                    "assessments_requiring_review": n("requires_review"),
                },
            ),
            grouped(
                "stg_fraud_alerts",
                "customer_id",
                {
                    "total_fraud_alerts": "count(*)",
                    "confirmed_fraud_incidents": n("alert_status = 'CONFIRMED_FRAUD'"),
                    "false_positive_alerts": n("alert_status = 'FALSE_POSITIVE'"),
                    "pending_fraud_investigations": n("alert_status = 'UNDER_REVIEW'"),
                    "highest_fraud_risk_score": "max(risk_score)",
                    "last_fraud_alert_date": f"max({day('alert_timestamp')})",
                },
            ),
            grouped(
                "stg_compliance_records",
                "customer_id",
                {
                    "total_compliance_checks": "count(*)",
                    "total_compliance_flags": n(flagged),
                    "aml_flags": n(f"{flagged} AND compliance_type = 'AML_SCREENING'"),
                    "sanctions_flags": n(f"{flagged} AND compliance_type = 'SANCTIONS_CHECK'"),
                    "last_compliance_check_date": "max(check_date)",
                },
            ),
            grouped(
                "stg_credit_scores",
                "customer_id",
                {
                    "total_credit_reports": "count(*)",
                    "avg_credit_score": "avg(credit_score)",
                    "highest_credit_score": "max(credit_score)",
                    "lowest_credit_score": "min(credit_score)",
                    **{
                        f"latest_{bureau}_score": f"max(credit_score) FILTER (WHERE bureau = '{bureau.upper()}')"
                        for bureau in ("experian", "equifax", "transunion")
                    },
                    "credit_score_volatility": spread("credit_score"),
                    "last_credit_score_date": "max(score_date)",
                },
            ),
            grouped(
                "stg_kyc_records",
                "customer_id",
                {
                    "total_kyc_checks": "count(*)",
                    "passed_kyc_checks": n("status = 'PASSED'"),
                    "failed_kyc_checks": n("status = 'FAILED'"),
                    "last_kyc_check_date": "max(review_date)",
                    "initial_kyc_date": "max(review_date) FILTER (WHERE kyc_type = 'INITIAL')",
                },
            ),
            alerts,
        ],
    )
    unknown = str(R.UNKNOWN_SCORE)
    weights = dict(R.RISK_WEIGHTS)
    fraud_weight = weights.pop("highest_fraud_risk_score")
    composite = " + ".join(
        f"CAST(COALESCE({name}, {unknown}) AS DOUBLE) * CAST({weight} AS DOUBLE)" for name, weight in weights.items()
    )
    composite += f" + CAST({R.TOP_CREDIT_SCORE} - COALESCE(highest_fraud_risk_score, 0) AS DOUBLE) * CAST({fraud_weight} AS DOUBLE)"
    add(
        "comprehensive_risk_profile",
        {
            **same(
                *(
                    "customer_id credit_risk_rating fraud_risk_rating last_risk_assessment_date"
                    " last_fraud_alert_date last_compliance_check_date highest_credit_score lowest_credit_score"
                    " latest_experian_score latest_equifax_score latest_transunion_score last_credit_score_date"
                    " last_kyc_check_date initial_kyc_date last_account_alert_date"
                ).split()
            ),
            **or_else(
                unknown,
                "current_credit_risk_score",
                "current_fraud_risk_score",
                "current_operational_risk_score",
                "current_market_risk_score",
                "avg_credit_score",
            ),
            **zero(
                *(
                    "total_fraud_alerts confirmed_fraud_incidents false_positive_alerts"
                    " pending_fraud_investigations highest_fraud_risk_score total_compliance_checks"
                    " total_compliance_flags aml_flags sanctions_flags credit_score_volatility total_kyc_checks"
                    " passed_kyc_checks failed_kyc_checks total_account_alerts unusual_activity_alerts"
                    " pending_account_alerts"
                ).split()
            ),
            "composite_risk_score": composite,
            "overall_risk_level": case(R.RISK_LEVEL),
            "compliance_status": case(R.COMPLIANCE),
            "requires_enhanced_monitoring": truth(R.MONITORING),
            "requires_immediate_review": truth(R.IMMEDIATE_REVIEW),
            "risk_trend": case(R.RISK_TREND),
        },
        risks,
        "stg_risk_assessments",
        "stg_fraud_alerts",
        "stg_compliance_records",
        "stg_credit_scores",
        "stg_kyc_records",
        "stg_accounts",
        "stg_account_alerts",
    )

    # Retention
    def since(days: int, moment: str, more: str = "TRUE") -> str:
        return n(f"{moment} >= {today} - INTERVAL {days} DAY AND {more}")

    at_risk, login = "event_type = 'CHURN_RISK_IDENTIFIED'", "activity_type = 'LOGIN'"
    events = grouped(
        "stg_retention_events",
        "customer_id",
        {
            "total_retention_events": "count(*)",
            "churn_risk_events": n(at_risk),
            "retention_campaigns_sent": n("event_type = 'RETENTION_OFFER_SENT'"),
            "retention_offers_extended": n("event_type = 'RETENTION_OFFER_SENT'"),
            "retention_calls_made": n("event_type = 'CUSTOMER_SAVED'"),
            "successful_retentions": n("event_type = 'CUSTOMER_SAVED'"),
            "churn_events": n("event_type = 'ACCOUNT_CLOSED'"),
            "last_retention_event_date": "max(event_date)",
            "last_churn_risk_date": f"max(event_date) FILTER (WHERE {at_risk})",
        },
    )
    retention = full_joined(
        "customer_id",
        [
            f"SELECT *, {case(R.EVENT_CHURN_SCORE)} AS avg_churn_risk_score FROM ({events})",
            grouped(
                "stg_customer_interactions",
                "customer_id",
                {
                    "total_interactions": "count(*)",
                    "complaint_interactions": n("reason_code = 'FEES_COMPLAINT'"),
                    "support_interactions": n("reason_code = 'TECHNICAL_SUPPORT'"),
                    "escalated_interactions": n("was_escalated"),
                    "avg_satisfaction_score": "avg(satisfaction_score)",
                    "min_satisfaction_score": "min(satisfaction_score)",
                    "last_interaction_date": "max(interaction_date)",
                    "interactions_last_30_days": since(30, "interaction_date"),
                    "interactions_last_90_days": since(90, "interaction_date"),
                },
            ),
            grouped(
                "stg_digital_activity",
                "customer_id",
                {
                    "total_digital_activities": "count(*)",
                    "digital_activities_last_30_days": since(30, "activity_timestamp"),
                    "digital_activities_last_90_days": since(90, "activity_timestamp"),
                    "last_digital_activity_date": f"max({day('activity_timestamp')})",
                    "total_logins": n(login),
                    "logins_last_30_days": since(30, "activity_timestamp", login),
                },
            ),
            "SELECT customer_id, engagement_level, at_risk_customer, digital_preference, relationship_years,"
            " customer_value_segment, lifecycle_stage_name FROM int_customer_profile",
            "SELECT customer_id, overall_risk_level, compliance_status, composite_risk_score, total_fraud_alerts,"
            " requires_enhanced_monitoring, requires_immediate_review, risk_trend FROM int_comprehensive_risk_profile",
        ],
    )
    add(
        "customer_retention_analytics",
        {
            **same(
                *(
                    "customer_id last_retention_event_date last_churn_risk_date min_satisfaction_score"
                    " last_interaction_date last_digital_activity_date"
                ).split()
            ),
            **zero(
                *(
                    "total_retention_events churn_risk_events retention_campaigns_sent retention_calls_made"
                    " retention_offers_extended successful_retentions churn_events avg_churn_risk_score"
                    " total_interactions complaint_interactions support_interactions escalated_interactions"
                    " avg_satisfaction_score interactions_last_30_days interactions_last_90_days"
                    " total_digital_activities digital_activities_last_30_days digital_activities_last_90_days"
                    " total_logins logins_last_30_days relationship_years total_fraud_alerts"
                ).split()
            ),
            **or_else(
                "'UNKNOWN'",
                "engagement_level",
                "digital_preference",
                "customer_value_segment",
                "lifecycle_stage_name",
                "overall_risk_level",
                "compliance_status",
            ),
            **or_else("FALSE", "at_risk_customer", "requires_enhanced_monitoring"),
            **or_else(unknown, "composite_risk_score"),
            **or_else("'STABLE'", "risk_trend"),
            "retention_campaign_success_rate": pct("successful_retentions", "retention_campaigns_sent", 2),
            "churn_risk_score": score(f"COALESCE(churn_events, 0) * {R.POINTS_PER_CHURN_EVENT}", *R.CHURN_PARTS),
            "retention_opportunity_score": score(*R.OPPORTUNITY_PARTS),
            **cases(
                retention_lifecycle_stage=R.RETENTION_STAGE,
                next_best_retention_action=R.RETENTION_ACTION,
                retention_strategy=R.RETENTION_STRATEGY,
                retention_priority=R.RETENTION_PRIORITY,
            ),
        },
        f"SELECT *, last_churn_risk_date >= {today} - INTERVAL 30 DAY AS recent_churn_risk FROM ({retention})",
        "stg_retention_events",
        "stg_customer_interactions",
        "stg_digital_activity",
        "int_customer_profile",
        "int_comprehensive_risk_profile",
    )

    # Account performance
    newest_first = "balance_date DESC NULLS FIRST, balance_id DESC, balance_amount DESC, available_balance DESC"
    oldest_first = "balance_date ASC NULLS LAST, balance_id, balance_amount, available_balance"
    balances = (
        "SELECT account_id, balance_amount AS latest_balance, available_balance, balance_date AS last_balance_date,"
        f" lag(balance_amount) OVER (PARTITION BY account_id ORDER BY {oldest_first}) AS previous_balance"
        " FROM stg_account_balances"
        f" QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY {newest_first}) = 1"
    )
    base = (
        "SELECT account_id, customer_id, account_number, product_type, account_status, opened_date,"
        " annual_interest_rate, monthly_fee, current_balance AS own_balance,"
        f" CAST(date_part('year', age({today}, opened_date)) AS INTEGER) AS account_age_years FROM stg_accounts"
    )
    performance = (
        f"SELECT *, COALESCE(latest_balance, own_balance) AS balance FROM ({base}) AS a"
        f" LEFT JOIN ({balances}) AS lb USING (account_id)"
        " LEFT JOIN (SELECT account_id, total_transactions, total_transaction_volume, net_cash_flow,"
        " total_deposit_amount, total_payment_amount, total_fee_amount AS total_fees_paid,"
        " digital_transaction_percentage, spending_category, activity_level, last_transaction_date"
        " FROM int_transaction_analytics) AS ta USING (account_id)"
        " LEFT JOIN (SELECT customer_id, total_deposit_accounts AS customer_total_accounts,"
        " total_deposit_balances AS customer_total_balances, total_relationship_value AS customer_relationship_value,"
        " product_penetration_score, financial_risk_level AS customer_financial_risk, wealth_tier, total_investments"
        " FROM int_customer_financial_summary) AS fs USING (customer_id)"
        " LEFT JOIN (SELECT customer_id, full_name AS customer_name, age, relationship_years, lifecycle_stage_name,"
        " customer_value_segment, engagement_level, at_risk_customer, digital_preference, avg_satisfaction_score"
        " FROM int_customer_profile) AS cp USING (customer_id)"
        " LEFT JOIN (SELECT customer_id, overall_risk_level, compliance_status, composite_risk_score,"
        " total_fraud_alerts, requires_enhanced_monitoring, requires_immediate_review"
        " FROM int_comprehensive_risk_profile) AS rp USING (customer_id)"
        " LEFT JOIN (SELECT customer_id, digital_adoption_level, marketing_responsiveness, channel_preference,"
        " cross_sell_opportunity_score, product_stickiness_score, next_best_product"
        " FROM int_product_penetration_analysis) AS pp USING (customer_id)"
    )
    add(
        "account_performance_dashboard",
        {
            **same(
                *(
                    "account_id customer_id account_number product_type account_status opened_date"
                    " annual_interest_rate monthly_fee account_age_years customer_name relationship_years"
                    " lifecycle_stage_name customer_value_segment available_balance previous_balance"
                    " last_balance_date spending_category activity_level last_transaction_date"
                    " customer_financial_risk engagement_level digital_preference avg_satisfaction_score"
                    " next_best_product"
                ).split()
            ),
            "balance_change": "latest_balance - previous_balance",
            **zero(
                *(
                    "total_transactions total_transaction_volume net_cash_flow total_deposit_amount"
                    " total_payment_amount total_fees_paid digital_transaction_percentage customer_total_accounts"
                    " customer_total_balances customer_relationship_value total_fraud_alerts"
                    " cross_sell_opportunity_score product_stickiness_score"
                ).split()
            ),
            **or_else(
                "'UNKNOWN'",
                "digital_adoption_level",
                "marketing_responsiveness",
                "channel_preference",
                "overall_risk_level",
                "compliance_status",
            ),
            **or_else(unknown, "composite_risk_score"),
            **or_else("FALSE", "requires_enhanced_monitoring", "requires_immediate_review"),
            "customer_age": "age",
            "current_balance": "balance",
            "customer_product_penetration": "COALESCE(product_penetration_score, 0)",
            "customer_wealth_tier": "wealth_tier",
            "account_profitability_score": score(*R.PROFITABILITY_PARTS),
            "account_health_score": score(*R.HEALTH_PARTS),
            **cases(
                account_risk_flag=R.ACCOUNT_RISK_FLAG,
                account_opportunity=R.ACCOUNT_OPPORTUNITY,
                next_best_action=R.ACCOUNT_ACTION,
                account_service_tier=R.ACCOUNT_SERVICE_TIER,
            ),
        },
        performance,
        "stg_accounts",
        "stg_account_balances",
        "int_transaction_analytics",
        "int_customer_financial_summary",
        "int_customer_profile",
        "int_comprehensive_risk_profile",
        "int_product_penetration_analysis",
    )

    # Master view
    owned = "(SELECT a.customer_id, t.* FROM stg_accounts a LEFT JOIN int_transaction_analytics t ON t.account_id = a.account_id)"

    def most_common(column: str, name: str) -> str:
        """Ties go to the first label in sort order."""
        counts = f"SELECT customer_id, {column}, count(*) AS times FROM {owned} WHERE {column} IS NOT NULL GROUP BY ALL"
        return ranked(f"({counts})", "customer_id", f"times DESC, {column}", {"customer_id": "customer_id", name: column})

    summed = grouped(
        owned,
        "customer_id",
        {
            "total_transactions": "sum(total_transactions)",
            "total_transaction_volume": "sum(total_transaction_volume)",
            "net_cash_flow": "sum(net_cash_flow)",
            "total_deposits_amount": "sum(total_deposit_amount)",
            "total_payments_amount": "sum(total_payment_amount)",
            "total_fees_paid": "sum(total_fee_amount)",
            "digital_transaction_percentage": mean("CAST(digital_transaction_percentage AS DECIMAL(7,2))"),
            "last_transaction_date": "max(last_transaction_date)",
        },
    )
    holding_columns = (
        "total_deposit_accounts total_deposit_balances total_cards total_credit_limit total_loans total_loan_balance"
        " total_investments total_investment_value total_insurance_policies net_worth_with_bank"
        " total_relationship_value product_penetration_score"
    ).split()
    profile_columns = [
        *profile,
        *(
            "primary_address city state_code current_segment engagement_level digital_preference"
            " total_service_interactions avg_satisfaction_score total_digital_activities"
        ).split(),
    ]
    master = left_joined(
        "SELECT " + ", ".join(profile_columns) + ", at_risk_customer FROM int_customer_profile",
        "customer_id",
        [
            "SELECT customer_id, "
            + ", ".join(holding_columns)
            + ", wealth_tier, delinquent_loans, avg_credit_utilization FROM int_customer_financial_summary",
            summed,
            most_common("spending_category", "primary_spending_category"),
            most_common("activity_level", "primary_activity_level"),
            "SELECT customer_id, overall_risk_level, compliance_status, composite_risk_score,"
            " current_credit_risk_score, current_fraud_risk_score, total_fraud_alerts, confirmed_fraud_incidents,"
            " requires_enhanced_monitoring, requires_immediate_review FROM int_comprehensive_risk_profile",
        ],
    )
    add(
        "customer_360_master",
        {
            **same(
                *profile_columns,
                "wealth_tier",
                "last_transaction_date",
                "primary_spending_category",
                "primary_activity_level",
            ),
            **zero(
                *holding_columns,
                *(
                    "total_transactions total_transaction_volume net_cash_flow total_deposits_amount"
                    " total_payments_amount total_fees_paid digital_transaction_percentage total_fraud_alerts"
                    " confirmed_fraud_incidents"
                ).split(),
            ),
            **or_else("'UNKNOWN'", "overall_risk_level"),
            **or_else("'PENDING_VERIFICATION'", "compliance_status"),
            **or_else(
                unknown, "composite_risk_score", "current_credit_risk_score", "current_fraud_risk_score"
            ),
            **or_else("FALSE", "requires_enhanced_monitoring", "requires_immediate_review"),
            "customer_lifetime_value_score": score(
                f"CAST(COALESCE(product_penetration_score, 0) AS DOUBLE) * CAST({R.PENETRATION_WEIGHT} AS DOUBLE)",
                *R.LIFETIME_PARTS,
            ),
            "churn_risk_score": score(*R.MASTER_CHURN_PARTS),
            "next_best_action": case(R.MASTER_ACTION),
            "executive_customer_tier": case(R.MASTER_TIER),
        },
        master,
        "int_customer_profile",
        "int_customer_financial_summary",
        "int_transaction_analytics",
        "int_comprehensive_risk_profile",
        "stg_accounts",
    )
