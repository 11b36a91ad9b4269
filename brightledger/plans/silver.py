"""Roll-ups: one row per customer, or per account.

Each source is summarised on its own key first (partial sums travel, not rows), then
the summaries are aligned. All summaries of one model share their partitioning, so a
model costs one shuffle per source and none for putting them together.
"""

from __future__ import annotations

from dataclasses import dataclass

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from brightledger.functions.dates import age_years, whole_days
from brightledger.functions.scoring import (
    choice,
    choices,
    clamped,
    flag,
    mean,
    mean_of_means,
    n_if,
    named,
    or_else,
    or_zero,
    points,
    rate_pct,
    spread,
    sum_if,
    truth,
    weighted,
)
from brightledger.operators.keyed import (
    align,
    left_align,
    newest,
    newest_two,
    nulls_first,
    outer_join,
    recent_count,
    spread_join,
    with_most_common,
)
from brightledger.params import RunParams
from brightledger.rules import silver as R
from brightledger.rules.base import Rules

CUSTOMER = "customer_id"
ACCOUNT = "account_id"
UNKNOWN_SCORE = float(R.UNKNOWN_SCORE)


def _others(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [c for c in df.columns if c not in names]


# --- customer profile --------------------------------------------------------
PROFILE_COLUMNS = (
    "customer_id customer_number full_name first_name last_name age gender annual_income credit_score"
    " customer_status customer_since_date relationship_years age_cohort_name income_bracket_name"
    " credit_score_range_name risk_level lifecycle_stage_name customer_value_segment"
    " marketing_eligible lending_eligible premium_product_eligible"
).split()


def best_address(addresses: DataFrame) -> DataFrame:
    """Primary address before others, then the newest."""
    return newest(
        addresses,
        CUSTOMER,
        [flag("address_type = 'PRIMARY'"), *nulls_first("address_since"), F.col("address_id")],
        {
            "primary_address": "full_address",
            "city": "city",
            "state_code": "state_code",
            "zip_code": "postal_code",
            "address_verified": flag("address_status = 'VERIFIED'"),
        },
    )


def best_phone(phones: DataFrame) -> DataFrame:
    return newest(
        phones,
        CUSTOMER,
        [flag("is_primary"), *nulls_first("phone_id")],
        {
            "primary_phone": "formatted_phone",
            "phone_verified": "is_verified",
            "call_eligible": "call_eligible",
            "sms_eligible": "sms_eligible",
        },
    )


def current_segment(segments: DataFrame) -> DataFrame:
    return newest(
        segments,
        CUSTOMER,
        [*nulls_first("segment_date"), F.col("segment_id")],
        {"current_segment": "segment_name", "segment_assigned_date": "segment_date"},
    )


def interaction_summary(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy(CUSTOMER).agg(
        *named(
            total_service_interactions="count(*)",
            resolved_service_interactions=n_if("status = 'RESOLVED'"),
            escalated_interactions=n_if("was_escalated"),
            avg_satisfaction_score="avg(satisfaction_score)",
            last_interaction_date="max(to_date(interaction_datetime))",
            retention_interactions=n_if("resulted_in_retention"),
        )
    )


def digital_engagement(activity: DataFrame) -> DataFrame:
    return activity.groupBy(CUSTOMER).agg(
        *named(
            total_digital_activities="count(*)",
            mobile_app_activities=n_if("platform = 'MOBILE_APP'"),
            web_portal_activities=n_if("platform = 'WEB_PORTAL'"),
            last_digital_activity_date="max(to_date(activity_timestamp))",
            digital_login_count=n_if("activity_type = 'LOGIN'"),
            digital_financial_transactions=n_if(R.MONEY_ACTIVITIES),
        )
    )


# Models that others build on are split where a reader may need only a part: a left
# join the optimizer cannot drop would cost every reader its scans and shuffles.
def customer_base(customers_360: DataFrame) -> DataFrame:
    """Customers without duplicates. Each task drops its duplicates before the shuffle, which
    deals by all columns, so the versions of one customer never meet in one task."""
    return customers_360.select(*PROFILE_COLUMNS).distinct()


def profile_core(
    p: RunParams, customer_base: DataFrame, customer_interactions: DataFrame, digital_activity: DataFrame
) -> DataFrame:
    """The profile without addresses, phones and segments."""
    joined = left_align(
        customer_base, [interaction_summary(customer_interactions), digital_engagement(digital_activity)], CUSTOMER
    )
    return joined.select(
        *PROFILE_COLUMNS,
        "avg_satisfaction_score",
        "last_interaction_date",
        "last_digital_activity_date",
        *or_zero(
            "total_service_interactions",
            "resolved_service_interactions",
            "escalated_interactions",
            "retention_interactions",
            "total_digital_activities",
            "mobile_app_activities",
            "web_portal_activities",
            "digital_login_count",
            "digital_financial_transactions",
        ),
        *named(
            engagement_level=choice(R.ENGAGEMENT),
            at_risk_customer=truth(R.AT_RISK),
            digital_preference=choice(R.DIGITAL_PREFERENCE),
            last_updated=p.stamp,
        ),
    )


def customer_profile(
    profile_core: DataFrame, customer_addresses: DataFrame, customer_phones: DataFrame, customer_segments: DataFrame
) -> DataFrame:
    return left_align(
        profile_core,
        [best_address(customer_addresses), best_phone(customer_phones), current_segment(customer_segments)],
        CUSTOMER,
    )


# --- financial summary -------------------------------------------------------
def account_summary(accounts: DataFrame) -> DataFrame:
    # The catalog's product types never carry these three labels, so the three
    # counts stay at 0; kept because readers expect the columns.
    return accounts.groupBy(CUSTOMER).agg(
        *named(
            total_deposit_accounts="count(*)",
            active_deposit_accounts=n_if("account_status = 'ACTIVE'"),
            checking_accounts=n_if("product_type = 'Checking'"),
            savings_accounts=n_if("product_type = 'Savings'"),
            cd_accounts=n_if("product_type = 'CD'"),
            total_deposit_balances="sum(current_balance)",
            monthly_fee_revenue="sum(monthly_fee_revenue)",
            first_account_opened_date="min(opened_date)",
        )
    )


def card_summary(cards: DataFrame) -> DataFrame:
    credit = "card_type = 'CREDIT'"
    return cards.groupBy(CUSTOMER).agg(
        *named(
            total_cards="count(*)",
            active_cards=n_if("card_status = 'ACTIVE'"),
            credit_cards=n_if(credit),
            total_credit_limit=sum_if(credit, "credit_limit"),
            total_credit_balance=sum_if(credit, "current_balance"),
            avg_credit_utilization=mean(
                f"CASE WHEN {credit} AND current_balance > 0 THEN CAST(utilization_rate AS DECIMAL(12,2)) END"
            ),
            max_credit_utilization=f"max(CASE WHEN {credit} THEN utilization_rate ELSE 0D END)",
        )
    )


def loan_summary(loans: DataFrame) -> DataFrame:
    return loans.groupBy(CUSTOMER).agg(
        *named(
            total_loans="count(*)",
            current_loans=n_if("loan_status = 'CURRENT'"),
            total_loan_balance="sum(current_balance)",
            avg_loan_interest_rate=mean("interest_rate"),
            delinquent_loans=n_if(R.TROUBLED_LOANS),
            at_risk_loan_balance=sum_if(R.TROUBLED_LOANS, "current_balance"),
        )
    )


def investment_summary(investments: DataFrame) -> DataFrame:
    return investments.groupBy(CUSTOMER).agg(
        *named(
            total_investments="count(*)",
            total_investment_value="sum(current_value)",
            total_unrealized_gain_loss="sum(unrealized_gain_loss)",
            retirement_account_value=sum_if(R.RETIREMENT_ACCOUNTS, "current_value"),
        )
    )


def insurance_summary(policies: DataFrame) -> DataFrame:
    return policies.groupBy(CUSTOMER).agg(
        *named(
            total_insurance_policies="count(*)",
            active_insurance_policies=n_if("policy_status = 'ACTIVE'"),
            total_insurance_coverage="sum(coverage_amount)",
            total_annual_premiums="sum(annual_premium)",
        )
    )


def customer_financial_summary(
    p: RunParams,
    accounts: DataFrame,
    cards: DataFrame,
    loans: DataFrame,
    investments: DataFrame,
    insurance_policies: DataFrame,
) -> DataFrame:
    held = align(
        [
            account_summary(accounts),
            card_summary(cards),
            loan_summary(loans),
            investment_summary(investments),
            insurance_summary(insurance_policies),
        ],
        CUSTOMER,
    )

    hidden = (CUSTOMER, "first_account_opened_date", "max_credit_utilization")
    assets = "coalesce(total_deposit_balances, 0) + coalesce(total_investment_value, 0)"
    return held.select("*", *named(wealth=assets)).select(
        CUSTOMER,
        "first_account_opened_date",
        *or_zero(*_others(held, hidden)),
        *named(
            net_worth_with_bank="wealth - coalesce(total_loan_balance, 0) - coalesce(total_credit_balance, 0)",
            total_relationship_value="wealth + coalesce(total_credit_limit, 0)",
            product_penetration_score=points(*R.PENETRATION_PARTS),
            financial_risk_level=choice(R.FINANCIAL_RISK),
            wealth_tier=choice(R.WEALTH_TIER),
            last_updated=p.stamp,
        ),
    )


# --- transaction analytics ---------------------------------------------------
def transaction_summary(transactions: DataFrame) -> DataFrame:
    return (
        transactions.where("transaction_status = 'COMPLETED'")
        .groupBy(ACCOUNT)
        .agg(
            *named(
                total_transactions="count(*)",
                total_transaction_volume="sum(transaction_amount)",
                avg_transaction_amount=mean("transaction_amount"),
                largest_transaction="max(transaction_amount)",
                first_transaction_date="min(transaction_date)",
                last_transaction_date="max(transaction_date)",
                total_inflows=sum_if("flow_direction = 'INFLOW'", "transaction_amount"),
                total_outflows=sum_if("flow_direction = 'OUTFLOW'", "transaction_amount"),
                digital_transactions=n_if("is_digital_transaction"),
                off_hours_transactions=n_if("time_category = 'OFF_HOURS'"),
                large_amount_transactions=n_if("amount_category = 'LARGE'"),
                avg_transaction_risk_score="avg(risk_score)",
            )
        )
    )


def deposit_summary(deposits: DataFrame) -> DataFrame:
    return (
        deposits.where("deposit_status = 'CLEARED'")
        .groupBy(ACCOUNT)
        .agg(
            *named(
                total_deposits="count(*)",
                total_deposit_amount="sum(deposit_amount)",
                payroll_deposits=n_if("deposit_type = 'PAYROLL'"),
                payroll_deposit_amount=sum_if("deposit_type = 'PAYROLL'", "deposit_amount"),
                digital_deposits=n_if("channel_type = 'DIGITAL'"),
            )
        )
    )


def withdrawal_summary(withdrawals: DataFrame) -> DataFrame:
    return (
        withdrawals.where("withdrawal_status = 'COMPLETED'")
        .groupBy(ACCOUNT)
        .agg(
            *named(
                total_withdrawals="count(*)",
                total_withdrawal_amount="sum(withdrawal_amount)",
                atm_withdrawals=n_if("withdrawal_type = 'ATM'"),
            )
        )
    )


def transfer_summary(transfers: DataFrame, side: str, direction: str) -> DataFrame:
    """Completed transfers by the account on one side of them."""
    return (
        transfers.where("transfer_status = 'COMPLETED'")
        .groupBy(F.col(side).alias(ACCOUNT))
        .agg(
            *named(
                **{f"{direction}_transfers": "count(*)", f"{direction}_transfer_amount": "sum(transfer_amount)"}
            )
        )
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    return (
        payments.where("payment_status = 'COMPLETED'")
        .groupBy(ACCOUNT)
        .agg(
            *named(
                total_payments="count(*)",
                total_payment_amount="sum(payment_amount)",
                bill_payments=n_if("payment_type = 'BILL_PAY'"),
                p2p_payments=n_if("payment_type = 'PERSON_TO_PERSON'"),
            )
        )
    )


def fee_summary(fees: DataFrame) -> DataFrame:
    penalty = "fee_classification = 'PENALTY'"
    return (
        fees.where("fee_status = 'CHARGED'")
        .groupBy(ACCOUNT)
        .agg(
            *named(
                total_fees="count(*)",
                total_fee_amount="sum(fee_amount)",
                penalty_fees=n_if(penalty),
                penalty_fee_amount=sum_if(penalty, "fee_amount"),
            )
        )
    )


def transaction_analytics(
    p: RunParams,
    transactions: DataFrame,
    deposits: DataFrame,
    withdrawals: DataFrame,
    transfers: DataFrame,
    payments: DataFrame,
    fees: DataFrame,
) -> DataFrame:
    flows = align(
        [
            transaction_summary(transactions),
            deposit_summary(deposits),
            withdrawal_summary(withdrawals),
            transfer_summary(transfers, "from_account_id", "outbound"),
            transfer_summary(transfers, "to_account_id", "inbound"),
            payment_summary(payments),
            fee_summary(fees),
        ],
        ACCOUNT,
    )
    as_is = [ACCOUNT, "largest_transaction", "first_transaction_date", "last_transaction_date"]
    days = "greatest(datediff(last_transaction_date, first_transaction_date) + 1, 1)"
    return flows.select(
        *as_is,
        *or_zero(*_others(flows, as_is)),
        *named(
            net_cash_flow="coalesce(total_inflows, 0) - coalesce(total_outflows, 0)",
            digital_transaction_percentage=rate_pct("digital_transactions", "total_transactions", 2),
            digital_deposit_percentage=rate_pct("digital_deposits", "total_deposits", 2),
            avg_daily_transaction_frequency=f"coalesce(CAST(total_transactions AS DOUBLE) / {days}, 0D)",
            spending_category=choice(R.SPENDING),
            activity_level=choice(R.ACTIVITY),
            fee_to_volume_ratio=rate_pct("coalesce(total_fee_amount, 0)", "total_transaction_volume", 4),
            last_updated=p.stamp,
        ),
    )


# --- channel effectiveness ---------------------------------------------------
def channel_summary(channel_usage: DataFrame) -> DataFrame:
    """Per channel first, per customer second: the second step has a row per channel."""
    per_channel = channel_usage.groupBy(CUSTOMER, "channel_type").agg(
        *named(used="sum(usage_count)", last_used="max(usage_date)")
    )
    return per_channel.groupBy(CUSTOMER).agg(
        *named(
            total_channels_used="count(channel_type)",
            digital_channels_used=n_if(R.DIGITAL_CHANNELS),
            physical_channels_used=n_if(R.PHYSICAL_CHANNELS),
            total_channel_usage="sum(used)",
            digital_channel_usage=sum_if(R.DIGITAL_CHANNELS, "used"),
            physical_channel_usage=sum_if(R.PHYSICAL_CHANNELS, "used"),
            last_channel_usage_date="max(last_used)",
        )
    )


def marketing_summary(campaigns: DataFrame) -> DataFrame:
    converted = "response_type = 'CONVERTED'"
    per_channel = campaigns.groupBy(CUSTOMER, "channel").agg(
        *named(
            received="count(*)",
            converted=n_if(converted),
            value=sum_if(converted, choice(R.CAMPAIGN_VALUE)),
        )
    )
    return marketing_totals(per_channel)


def marketing_totals(per_channel: DataFrame) -> DataFrame:
    return per_channel.groupBy(CUSTOMER).agg(
        *named(
            marketing_channels_used="count(channel)",
            total_campaigns_received="sum(received)",
            total_campaigns_converted="sum(converted)",
            total_marketing_value="sum(value)",
            marketing_conversion_rate=mean_of_means("CAST(converted AS DOUBLE) / received"),
        )
    )


def service_summary(interactions: DataFrame) -> DataFrame:
    per_type = interactions.groupBy(CUSTOMER, "interaction_type").agg(
        *named(
            contacts="count(*)",
            satisfaction="avg(satisfaction_score)",
            escalated=n_if("was_escalated"),
            resolved=n_if("status = 'RESOLVED'"),
        )
    )
    return per_type.groupBy(CUSTOMER).agg(
        *named(
            service_channels_used="count(interaction_type)",
            total_service_interactions="sum(contacts)",
            service_satisfaction_score=mean_of_means("satisfaction"),
            total_escalated_interactions="sum(escalated)",
            total_resolved_interactions="sum(resolved)",
        )
    )


def platform_summary(activity: DataFrame) -> DataFrame:
    return activity.groupBy(CUSTOMER).agg(
        *named(
            digital_platforms_used="count(DISTINCT platform)",
            total_digital_activities="count(*)",
            last_digital_activity_date="max(to_date(activity_timestamp))",
        )
    )


def channel_effectiveness(
    p: RunParams,
    channel_usage: DataFrame,
    marketing_campaigns: DataFrame,
    customer_interactions: DataFrame,
    digital_activity: DataFrame,
) -> DataFrame:
    return channel_scores(
        p,
        channel_summary(channel_usage),
        marketing_summary(marketing_campaigns),
        service_summary(customer_interactions),
        platform_summary(digital_activity),
    )


def channel_scores(p: RunParams, *summaries: DataFrame) -> DataFrame:
    used = align(summaries, CUSTOMER)
    as_is = [CUSTOMER, "last_channel_usage_date", "last_digital_activity_date"]
    points_by_share = (
        "CASE WHEN total_channel_usage > 0"
        f" THEN round(digital_channel_usage * {R.ADOPTION_SHARE_POINTS} / total_channel_usage) ELSE 0D END"
    )
    return used.select(
        *as_is,
        *or_zero(*_others(used, as_is)),
        *named(
            digital_adoption_score=clamped(weighted(R.ADOPTION_WEIGHTS), points_by_share),
            channel_diversity_score=clamped(weighted(R.DIVERSITY_WEIGHTS), R.DIVERSITY_MIX),
            service_resolution_rate=rate_pct("total_resolved_interactions", "total_service_interactions", 2),
            marketing_roi_per_campaign="coalesce(round(total_marketing_value / total_campaigns_received, 2), 0D)",
            **choices(
                channel_preference=R.CHANNEL_PREFERENCE,
                channel_engagement_level=R.CHANNEL_ENGAGEMENT,
                digital_session_quality=R.SESSION_QUALITY,
                next_best_channel_action=R.CHANNEL_ACTION,
                channel_optimization_opportunity=R.CHANNEL_OPPORTUNITY,
            ),
            last_updated=p.stamp,
        ),
    )


# --- product penetration -----------------------------------------------------
def product_usage_summary(product_usage: DataFrame) -> DataFrame:
    def used(condition: str) -> str:
        """NULL, not 0, where a customer never used such a product."""
        return f"sum(CASE WHEN {condition} THEN usage_frequency END)"

    invests, insures = "product_type = 'INVESTMENTS'", "product_type = 'INSURANCE'"
    return product_usage.groupBy(CUSTOMER).agg(
        *named(
            total_products_used="count(DISTINCT product_type)",
            total_usage_events="sum(usage_frequency)",
            avg_usage_per_product="avg(usage_frequency)",
            first_product_usage_date="min(usage_date)",
            last_product_usage_date="max(usage_date)",
            digital_banking_products=n_if(R.BANKING_PRODUCTS),
            lending_products=n_if(R.LENDING_PRODUCTS),
            investment_products=n_if(invests),
            insurance_products=n_if(insures),
            digital_banking_usage=used(R.BANKING_PRODUCTS),
            lending_usage=used(R.LENDING_PRODUCTS),
            investment_usage=used(invests),
            insurance_usage=used(insures),
        )
    )


def campaign_response(campaigns: DataFrame) -> DataFrame:
    offer, converted = "campaign_type LIKE '%OFFER%'", "response_type = 'CONVERTED'"
    return campaigns.groupBy(CUSTOMER).agg(
        *named(
            total_campaigns_targeted="count(*)",
            campaigns_opened=n_if("response_type = 'OPENED'"),
            campaigns_clicked=n_if("response_type = 'CLICKED'"),
            campaigns_converted=n_if(converted),
            campaigns_opted_out=n_if("response_type = 'NO_RESPONSE'"),
            last_campaign_response_date="max(sent_date)",
            cross_sell_campaigns=n_if(offer),
            cross_sell_conversions=n_if(f"{offer} AND {converted}"),
            retention_campaigns=n_if("campaign_type = 'DIGITAL_BANKING'"),
            # A count, whatever its name says.
            avg_conversion_value=n_if(f"{converted} AND resulted_in_sale"),
        )
    )


def channel_events(channel_usage: DataFrame) -> DataFrame:
    def used(condition: str) -> str:
        return f"sum(CASE WHEN {condition} THEN usage_count END)"

    return channel_usage.groupBy(CUSTOMER).agg(
        *named(
            total_channels_used="count(DISTINCT channel_type)",
            digital_channels_used=n_if(R.DIGITAL_CHANNELS),
            physical_channels_used=n_if(R.PHYSICAL_CHANNELS),
            digital_channel_usage=used(R.DIGITAL_CHANNELS),
            physical_channel_usage=used(R.PHYSICAL_CHANNELS),
        )
    )


def product_penetration_analysis(
    p: RunParams,
    product_usage: DataFrame,
    customer_segments: DataFrame,
    marketing_campaigns: DataFrame,
    channel_usage: DataFrame,
) -> DataFrame:
    days_known = whole_days("first_product_usage_date", p.now)
    return product_scores(
        p,
        days_known,
        product_usage_summary(product_usage),
        current_segment(customer_segments).withColumnRenamed("segment_assigned_date", "current_segment_date"),
        campaign_response(marketing_campaigns),
        channel_events(channel_usage),
    )


def product_scores(p: RunParams, days_known: str, *summaries: DataFrame) -> DataFrame:
    seen = align(summaries, CUSTOMER)
    as_is = [
        CUSTOMER,
        "first_product_usage_date",
        "last_product_usage_date",
        "current_segment",
        "current_segment_date",
        "last_campaign_response_date",
    ]
    months_known = f"{days_known} / 30"
    stickiness = clamped(
        "total_products_used * 10",
        "least(50, total_usage_events)",
        f"CASE WHEN first_product_usage_date IS NULL THEN 0D ELSE least(30D, {months_known}) END",
    )
    return seen.select(
        *as_is,
        *or_zero(*_others(seen, as_is)),
        *named(
            product_penetration_score=clamped(weighted(R.PRODUCT_WEIGHTS), R.PRODUCT_BREADTH),
            cross_sell_opportunity_score=clamped(*R.CROSS_SELL_PARTS),
            product_stickiness_score=f"CASE WHEN total_usage_events > 0 THEN {stickiness} ELSE 0D END",
            **choices(
                digital_adoption_level=R.DIGITAL_ADOPTION,
                marketing_responsiveness=R.RESPONSIVENESS,
                channel_preference=R.PRODUCT_CHANNEL,
                product_specialization=R.SPECIALISATION,
                next_best_product=R.NEXT_PRODUCT,
            ),
            last_updated=p.stamp,
        ),
    )


# --- risk profile ------------------------------------------------------------
def assessment_summary(assessments: DataFrame) -> DataFrame:
    """Newest assessment per risk type, turned into one row per customer."""
    latest = newest(
        assessments,
        [CUSTOMER, "risk_type"],
        [*nulls_first("assessment_date"), F.col("assessment_id")],
        {c: c for c in ("risk_score", "risk_rating", "assessment_date", "requires_review")},
    )

    def of(kind: str, column: str) -> str:
        return f"max(CASE WHEN risk_type = '{kind}_RISK' THEN {column} END)"

    return latest.groupBy(CUSTOMER).agg(
        *named(
            current_credit_risk_score=of("CREDIT", "risk_score"),
            current_fraud_risk_score=of("FRAUD", "risk_score"),
            current_operational_risk_score=of("OPERATIONAL", "risk_score"),
            current_market_risk_score=of("MARKET", "risk_score"),
            credit_risk_rating=of("CREDIT", "risk_rating"),
            fraud_risk_rating=of("FRAUD", "risk_rating"),
            last_risk_assessment_date="max(assessment_date)",
            assessments_requiring_review=n_if("requires_review"),
        )
    )


def fraud_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(CUSTOMER).agg(
        *named(
            total_fraud_alerts="count(*)",
            confirmed_fraud_incidents=n_if("alert_status = 'CONFIRMED_FRAUD'"),
            false_positive_alerts=n_if("alert_status = 'FALSE_POSITIVE'"),
            pending_fraud_investigations=n_if("alert_status = 'UNDER_REVIEW'"),
            highest_fraud_risk_score="max(risk_score)",
            last_fraud_alert_date="max(to_date(alert_timestamp))",
        )
    )


def compliance_summary(records: DataFrame) -> DataFrame:
    flagged = "compliance_status = 'FLAGGED'"
    return records.groupBy(CUSTOMER).agg(
        *named(
            total_compliance_checks="count(*)",
            total_compliance_flags=n_if(flagged),
            aml_flags=n_if(f"{flagged} AND compliance_type = 'AML_SCREENING'"),
            sanctions_flags=n_if(f"{flagged} AND compliance_type = 'SANCTIONS_CHECK'"),
            last_compliance_check_date="max(check_date)",
        )
    )


def credit_summary(scores: DataFrame) -> DataFrame:
    def best(bureau: str) -> str:
        return f"max(CASE WHEN bureau = '{bureau}' THEN credit_score END)"

    return scores.groupBy(CUSTOMER).agg(
        *named(
            total_credit_reports="count(*)",
            avg_credit_score="avg(credit_score)",
            highest_credit_score="max(credit_score)",
            lowest_credit_score="min(credit_score)",
            latest_experian_score=best("EXPERIAN"),
            latest_equifax_score=best("EQUIFAX"),
            latest_transunion_score=best("TRANSUNION"),
            credit_score_volatility=spread("credit_score"),
            last_credit_score_date="max(score_date)",
        )
    )


def kyc_summary(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy(CUSTOMER).agg(
        *named(
            total_kyc_checks="count(*)",
            passed_kyc_checks=n_if("status = 'PASSED'"),
            failed_kyc_checks=n_if("status = 'FAILED'"),
            last_kyc_check_date="max(review_date)",
            initial_kyc_date="max(CASE WHEN kyc_type = 'INITIAL' THEN review_date END)",
        )
    )


def account_alert_summary(accounts: DataFrame, account_alerts: DataFrame) -> DataFrame:
    """Alerts are counted per account before they meet the accounts, so the join is
    one row to one row; customers without any alert keep counts of 0."""
    per_account = account_alerts.groupBy(ACCOUNT).agg(
        *named(
            alerts="count(alert_id)",
            unusual=n_if("alert_type = 'UNUSUAL_ACTIVITY'"),
            pending=n_if("alert_status = 'PENDING'"),
            last_alert="max(to_date(alert_timestamp))",
        )
    )

    def total(name: str) -> str:
        return f"sum(coalesce({name}, 0))"

    return (
        accounts.select(ACCOUNT, CUSTOMER)
        .join(per_account, ACCOUNT, "left")
        .groupBy(CUSTOMER)
        .agg(
            *named(
                total_account_alerts=total("alerts"),
                unusual_activity_alerts=total("unusual"),
                pending_account_alerts=total("pending"),
                last_account_alert_date="max(last_alert)",
            )
        )
    )


def composite_risk_score() -> str:
    """Weighted sum of the scores on file; an unknown score counts as the middle one,
    and fraud alerts take away from the best credit score there is."""
    known = {name: f"coalesce({name}, {R.UNKNOWN_SCORE})" for name in R.RISK_WEIGHTS}
    known["highest_fraud_risk_score"] = f"({R.TOP_CREDIT_SCORE} - coalesce(highest_fraud_risk_score, 0))"
    return " + ".join(f"CAST({known[name]} AS DOUBLE) * {weight}D" for name, weight in R.RISK_WEIGHTS.items())


def comprehensive_risk_profile(
    p: RunParams,
    risk_assessments: DataFrame,
    fraud_alerts: DataFrame,
    compliance_records: DataFrame,
    credit_scores: DataFrame,
    kyc_records: DataFrame,
    accounts: DataFrame,
    account_alerts: DataFrame,
) -> DataFrame:
    known = align(
        [
            assessment_summary(risk_assessments),
            fraud_summary(fraud_alerts),
            compliance_summary(compliance_records),
            credit_summary(credit_scores),
            kyc_summary(kyc_records),
            account_alert_summary(accounts, account_alerts),
        ],
        CUSTOMER,
    )
    return known.select(
        *risk_measures(),
        *named(
            composite_risk_score=composite_risk_score(),
            overall_risk_level=choice(R.RISK_LEVEL),
            compliance_status=choice(R.COMPLIANCE),
            requires_enhanced_monitoring=truth(R.MONITORING),
            requires_immediate_review=truth(R.IMMEDIATE_REVIEW),
            risk_trend=choice(R.RISK_TREND),
            last_updated=p.stamp,
        ),
    )


def risk_measures() -> list:
    """Scores, counts and dates of an aligned risk frame, with defaults for what is unknown."""
    scores = [f"current_{kind}_risk_score" for kind in ("credit", "fraud", "operational", "market")]
    return [
        CUSTOMER,
        *or_else(R.UNKNOWN_SCORE, *scores),
        *or_else(UNKNOWN_SCORE, "avg_credit_score"),
        *[
            "credit_risk_rating",
            "fraud_risk_rating",
            "last_risk_assessment_date",
            "last_fraud_alert_date",
            "last_compliance_check_date",
            "highest_credit_score",
            "lowest_credit_score",
            "latest_experian_score",
            "latest_equifax_score",
            "latest_transunion_score",
            "last_credit_score_date",
            "last_kyc_check_date",
            "initial_kyc_date",
            "last_account_alert_date",
        ],
        *or_zero(
            "total_fraud_alerts",
            "confirmed_fraud_incidents",
            "false_positive_alerts",
            "pending_fraud_investigations",
            "highest_fraud_risk_score",
            "total_compliance_checks",
            "total_compliance_flags",
            "aml_flags",
            "sanctions_flags",
            "credit_score_volatility",
            "total_kyc_checks",
            "passed_kyc_checks",
            "failed_kyc_checks",
            "total_account_alerts",
            "unusual_activity_alerts",
            "pending_account_alerts",
        ),
    ]


# --- retention ---------------------------------------------------------------
def retention_event_summary(events: DataFrame) -> DataFrame:
    at_risk = "event_type = 'CHURN_RISK_IDENTIFIED'"
    offered, saved = n_if("event_type = 'RETENTION_OFFER_SENT'"), n_if("event_type = 'CUSTOMER_SAVED'")
    return (
        events.groupBy(CUSTOMER)
        .agg(
            *named(
                total_retention_events="count(*)",
                churn_risk_events=n_if(at_risk),
                # Two pairs of columns share one rule each.
                retention_campaigns_sent=offered,
                retention_offers_extended=offered,
                retention_calls_made=saved,
                successful_retentions=saved,
                churn_events=n_if("event_type = 'ACCOUNT_CLOSED'"),
                last_retention_event_date="max(event_date)",
                last_churn_risk_date=f"max(CASE WHEN {at_risk} THEN event_date END)",
            )
        )
        .select("*", *named(avg_churn_risk_score=choice(R.EVENT_CHURN_SCORE)))
    )


def interaction_patterns(interactions: DataFrame, p: RunParams) -> DataFrame:
    dated = interactions.withColumn("interaction_day", F.to_date("interaction_datetime"))
    return dated.groupBy(CUSTOMER).agg(
        *named(
            total_interactions="count(*)",
            complaint_interactions=n_if("reason_code = 'FEES_COMPLAINT'"),
            support_interactions=n_if("reason_code = 'TECHNICAL_SUPPORT'"),
            escalated_interactions=n_if("was_escalated"),
            avg_satisfaction_score="avg(satisfaction_score)",
            min_satisfaction_score="min(satisfaction_score)",
            last_interaction_date="max(interaction_day)",
            interactions_last_30_days=recent_count("interaction_day", p.days_ago(30)),
            interactions_last_90_days=recent_count("interaction_day", p.days_ago(90)),
        )
    )


def digital_trends(activity: DataFrame, p: RunParams) -> DataFrame:
    login = "activity_type = 'LOGIN'"
    return activity.groupBy(CUSTOMER).agg(
        *named(
            total_digital_activities="count(*)",
            digital_activities_last_30_days=recent_count("activity_timestamp", p.days_ago(30)),
            digital_activities_last_90_days=recent_count("activity_timestamp", p.days_ago(90)),
            last_digital_activity_date="max(to_date(activity_timestamp))",
            total_logins=n_if(login),
            logins_last_30_days=recent_count("activity_timestamp", p.days_ago(30), login),
        )
    )


def customer_retention_analytics(
    p: RunParams,
    retention_events: DataFrame,
    customer_interactions: DataFrame,
    digital_activity: DataFrame,
    profile_core: DataFrame,
    comprehensive_risk_profile: DataFrame,
) -> DataFrame:
    profile_columns = [
        "engagement_level",
        "at_risk_customer",
        "digital_preference",
        "relationship_years",
        "customer_value_segment",
        "lifecycle_stage_name",
    ]
    risk_columns = [
        "overall_risk_level",
        "compliance_status",
        "composite_risk_score",
        "total_fraud_alerts",
        "requires_enhanced_monitoring",
        "requires_immediate_review",
        "risk_trend",
    ]
    summaries = align(
        [
            retention_event_summary(retention_events),
            interaction_patterns(customer_interactions, p),
            digital_trends(digital_activity, p),
            comprehensive_risk_profile.select(CUSTOMER, *risk_columns),
        ],
        CUSTOMER,
    )
    # A customer may have several versions of the profile, each of which is a row.
    known = outer_join(summaries, profile_core.select(CUSTOMER, *profile_columns), CUSTOMER).select("*", *named(recent_churn_risk=f"last_churn_risk_date >= {p.days_ago(30)}"))
    as_is = [
        CUSTOMER,
        "last_retention_event_date",
        "last_churn_risk_date",
        "min_satisfaction_score",
        "last_interaction_date",
        "last_digital_activity_date",
    ]
    special = {
        "engagement_level": "UNKNOWN",
        "digital_preference": "UNKNOWN",
        "customer_value_segment": "UNKNOWN",
        "lifecycle_stage_name": "UNKNOWN",
        "overall_risk_level": "UNKNOWN",
        "compliance_status": "UNKNOWN",
        "risk_trend": "STABLE",
        "at_risk_customer": False,
        "requires_enhanced_monitoring": False,
        "composite_risk_score": UNKNOWN_SCORE,
    }
    hidden = {"requires_immediate_review", "recent_churn_risk"}
    counts = _others(known, {*as_is, *special, *hidden})
    lost = f"coalesce(churn_events, 0) * {R.POINTS_PER_CHURN_EVENT}"
    return known.select(
        *as_is,
        *or_zero(*counts),
        *[column for name, default in special.items() for column in or_else(default, name)],
        *named(
            retention_campaign_success_rate=rate_pct("successful_retentions", "retention_campaigns_sent", 2),
            churn_risk_score=clamped(lost, *R.CHURN_PARTS),
            retention_opportunity_score=clamped(*R.OPPORTUNITY_PARTS),
            **choices(
                retention_lifecycle_stage=R.RETENTION_STAGE,
                next_best_retention_action=R.RETENTION_ACTION,
                retention_strategy=R.RETENTION_STRATEGY,
                retention_priority=R.RETENTION_PRIORITY,
            ),
            last_updated=p.stamp,
        ),
    )


# --- account performance -----------------------------------------------------
def balance_movement(balances: DataFrame) -> DataFrame:
    """Newest daily balance per account and the step from the one before it."""
    order = [
        F.col("balance_date").desc_nulls_first(),
        F.col("balance_id").desc(),
        F.col("balance_amount").desc(),
        F.col("available_balance").desc(),
    ]
    two = newest_two(
        balances.select(ACCOUNT, "balance_id", "balance_amount", "available_balance", "balance_date"), ACCOUNT, order
    )

    def at(rank: int, column: str) -> str:
        return f"max(CASE WHEN age_rank = {rank} THEN {column} END)"

    return two.groupBy(ACCOUNT).agg(
        *named(
            latest_balance=at(1, "balance_amount"),
            available_balance=at(1, "available_balance"),
            last_balance_date=at(1, "balance_date"),
            previous_balance=at(2, "balance_amount"),
            balance_change=f"{at(1, 'balance_amount')} - {at(2, 'balance_amount')}",
        )
    )


def account_activity(
    p: RunParams, accounts: DataFrame, account_balances: DataFrame, transaction_analytics: DataFrame
) -> DataFrame:
    """What an account shows on its own: balance, movements, profitability."""
    return activity_at_age(age_years("opened_date", p.now), accounts, account_balances, transaction_analytics)


def activity_at_age(
    age: str, accounts: DataFrame, account_balances: DataFrame, transaction_analytics: DataFrame
) -> DataFrame:
    base = accounts.select(
        ACCOUNT,
        CUSTOMER,
        "account_number",
        "product_type",
        "account_status",
        "opened_date",
        "annual_interest_rate",
        "monthly_fee",
        "current_balance",
        *named(account_age_years=age),
    )
    movements = transaction_analytics.select(
        ACCOUNT,
        "total_transactions",
        "total_transaction_volume",
        "net_cash_flow",
        "total_deposit_amount",
        "total_payment_amount",
        "digital_transaction_percentage",
        "spending_category",
        "activity_level",
        "last_transaction_date",
        *named(total_fees_paid="total_fee_amount"),
    )
    joined = left_align(base, [balance_movement(account_balances), movements], ACCOUNT)
    balance = named(balance="coalesce(latest_balance, current_balance)")
    return joined.select("*", *balance).select(
        "*", *named(account_profitability_score=clamped(*R.PROFITABILITY_PARTS))
    )


@dataclass(frozen=True)
class AccountRules:
    """The rules of the account dashboard that differ by profile."""

    health: tuple
    opportunity: Rules
    service_tier: Rules


def account_performance_dashboard(
    p: RunParams,
    accounts: DataFrame,
    account_activity: DataFrame,
    customer_financial_summary: DataFrame,
    profile_core: DataFrame,
    comprehensive_risk_profile: DataFrame,
    product_penetration_analysis: DataFrame,
) -> DataFrame:
    return accounts_with_owners(
        p,
        AccountRules(R.HEALTH_PARTS, R.ACCOUNT_OPPORTUNITY, R.ACCOUNT_SERVICE_TIER),
        accounts,
        account_activity,
        customer_financial_summary,
        profile_core,
        comprehensive_risk_profile,
        product_penetration_analysis,
    )


def accounts_with_owners(
    p: RunParams,
    account_rules: AccountRules,
    accounts: DataFrame,
    account_activity: DataFrame,
    customer_financial_summary: DataFrame,
    profile_core: DataFrame,
    comprehensive_risk_profile: DataFrame,
    product_penetration_analysis: DataFrame,
) -> DataFrame:
    # All that is known about an owner is put together first, so accounts are moved to
    # their owners once, in the one join that a large owner could skew; there the accounts
    # of such an owner are dealt over several tasks.
    summaries = align(
        [
            customer_financial_summary.select(
                CUSTOMER,
                F.col("total_deposit_accounts").alias("customer_total_accounts"),
                F.col("total_deposit_balances").alias("customer_total_balances"),
                F.col("total_relationship_value").alias("customer_relationship_value"),
                "product_penetration_score",
                F.col("financial_risk_level").alias("customer_financial_risk"),
                "wealth_tier",
                "total_investments",
            ),
            comprehensive_risk_profile.select(
                CUSTOMER,
                "overall_risk_level",
                "compliance_status",
                "composite_risk_score",
                "total_fraud_alerts",
                "requires_enhanced_monitoring",
                "requires_immediate_review",
            ),
            product_penetration_analysis.select(
                CUSTOMER,
                "digital_adoption_level",
                "marketing_responsiveness",
                "channel_preference",
                "cross_sell_opportunity_score",
                "product_stickiness_score",
                "next_best_product",
            ),
        ],
        CUSTOMER,
    )
    profile = profile_core.select(
        CUSTOMER,
        F.col("full_name").alias("customer_name"),
        "age",
        "relationship_years",
        "lifecycle_stage_name",
        "customer_value_segment",
        "engagement_level",
        "at_risk_customer",
        "digital_preference",
        "avg_satisfaction_score",
    )
    owner = outer_join(summaries, profile, CUSTOMER)
    return spread_join(account_activity, owner, CUSTOMER, accounts.select(CUSTOMER), ACCOUNT).select(
        ACCOUNT,
        CUSTOMER,
        "account_number",
        "product_type",
        "account_status",
        "opened_date",
        "annual_interest_rate",
        "monthly_fee",
        "account_age_years",
        "account_profitability_score",
        "customer_name",
        "relationship_years",
        "lifecycle_stage_name",
        "customer_value_segment",
        "available_balance",
        "previous_balance",
        "balance_change",
        "last_balance_date",
        "spending_category",
        "activity_level",
        "last_transaction_date",
        "customer_financial_risk",
        "engagement_level",
        "digital_preference",
        "avg_satisfaction_score",
        "next_best_product",
        *or_zero(
            "total_transactions",
            "total_transaction_volume",
            "net_cash_flow",
            "total_deposit_amount",
            "total_payment_amount",
            "total_fees_paid",
            "digital_transaction_percentage",
            "customer_total_accounts",
            "customer_total_balances",
            "customer_relationship_value",
            "total_fraud_alerts",
            "cross_sell_opportunity_score",
            "product_stickiness_score",
        ),
        *or_else(
            "UNKNOWN",
            "digital_adoption_level",
            "marketing_responsiveness",
            "channel_preference",
            "overall_risk_level",
            "compliance_status",
        ),
        *or_else(UNKNOWN_SCORE, "composite_risk_score"),
        *or_else(False, "requires_enhanced_monitoring"),
        *or_else(False, "requires_immediate_review"),
        *named(
            customer_age="age",
            current_balance="balance",
            customer_product_penetration="coalesce(product_penetration_score, 0)",
            customer_wealth_tier="wealth_tier",
            account_health_score=clamped(*account_rules.health),
            account_risk_flag=choice(R.ACCOUNT_RISK_FLAG),
            account_opportunity=choice(account_rules.opportunity),
            next_best_action=choice(R.ACCOUNT_ACTION),
            account_service_tier=choice(account_rules.service_tier),
            last_updated=p.stamp,
        ),
    )


# --- master view -------------------------------------------------------------
def owner_transactions(accounts: DataFrame, transaction_analytics: DataFrame) -> DataFrame:
    """Account analytics added up per owner, with the most common labels (the first
    in sort order on a tie)."""
    per_account = transaction_analytics.drop("last_updated")
    return with_most_common(
        accounts.select(ACCOUNT, CUSTOMER).join(per_account, ACCOUNT, "left"),
        CUSTOMER,
        named(
            total_transactions="sum(total_transactions)",
            total_transaction_volume="sum(total_transaction_volume)",
            net_cash_flow="sum(net_cash_flow)",
            total_deposits_amount="sum(total_deposit_amount)",
            total_payments_amount="sum(total_payment_amount)",
            total_fees_paid="sum(total_fee_amount)",
            digital_transaction_percentage=mean("CAST(digital_transaction_percentage AS DECIMAL(7,2))"),
            last_transaction_date="max(last_transaction_date)",
        ),
        {"primary_spending_category": "spending_category", "primary_activity_level": "activity_level"},
    )


MASTER_PROFILE_COLUMNS = [
    *PROFILE_COLUMNS,
    "primary_address",
    "city",
    "state_code",
    "current_segment",
    "engagement_level",
    "digital_preference",
    "total_service_interactions",
    "avg_satisfaction_score",
    "total_digital_activities",
]


@dataclass(frozen=True)
class MasterRules:
    """The rules of the master view that differ by profile."""

    unknown_compliance: str
    churn: tuple
    action: Rules
    tier: Rules


def customer_360_master(
    p: RunParams,
    customer_profile: DataFrame,
    customer_financial_summary: DataFrame,
    accounts: DataFrame,
    transaction_analytics: DataFrame,
    comprehensive_risk_profile: DataFrame,
) -> DataFrame:
    return master_view(
        p,
        MasterRules("PENDING_VERIFICATION", R.MASTER_CHURN_PARTS, R.MASTER_ACTION, R.MASTER_TIER),
        customer_profile,
        customer_financial_summary,
        accounts,
        transaction_analytics,
        comprehensive_risk_profile,
    )


def master_view(
    p: RunParams,
    master_rules: MasterRules,
    customer_profile: DataFrame,
    customer_financial_summary: DataFrame,
    accounts: DataFrame,
    transaction_analytics: DataFrame,
    comprehensive_risk_profile: DataFrame,
) -> DataFrame:
    holdings = [
        "total_deposit_accounts",
        "total_deposit_balances",
        "total_cards",
        "total_credit_limit",
        "total_loans",
        "total_loan_balance",
        "total_investments",
        "total_investment_value",
        "total_insurance_policies",
        "net_worth_with_bank",
        "total_relationship_value",
        "product_penetration_score",
    ]
    owned = owner_transactions(accounts, transaction_analytics)
    joined = left_align(
        customer_profile.select(*MASTER_PROFILE_COLUMNS, "at_risk_customer"),
        [
            customer_financial_summary.select(
                CUSTOMER, *holdings, "wealth_tier", "delinquent_loans", "avg_credit_utilization"
            ),
            owned,
            comprehensive_risk_profile.select(
                CUSTOMER,
                "overall_risk_level",
                "compliance_status",
                "composite_risk_score",
                "current_credit_risk_score",
                "current_fraud_risk_score",
                "total_fraud_alerts",
                "confirmed_fraud_incidents",
                "requires_enhanced_monitoring",
                "requires_immediate_review",
            ),
        ],
        CUSTOMER,
    )
    penetration = "CAST(coalesce(product_penetration_score, 0) AS DOUBLE)"
    return joined.select(
        *MASTER_PROFILE_COLUMNS,
        "wealth_tier",
        "last_transaction_date",
        "primary_spending_category",
        "primary_activity_level",
        *or_zero(
            *holdings,
            "total_transactions",
            "total_transaction_volume",
            "net_cash_flow",
            "total_deposits_amount",
            "total_payments_amount",
            "total_fees_paid",
            "digital_transaction_percentage",
            "total_fraud_alerts",
            "confirmed_fraud_incidents",
        ),
        *or_else("UNKNOWN", "overall_risk_level"),
        *or_else(master_rules.unknown_compliance, "compliance_status"),
        *or_else(UNKNOWN_SCORE, "composite_risk_score"),
        *or_else(R.UNKNOWN_SCORE, "current_credit_risk_score"),
        *or_else(R.UNKNOWN_SCORE, "current_fraud_risk_score"),
        *or_else(False, "requires_enhanced_monitoring"),
        *or_else(False, "requires_immediate_review"),
        *named(
            customer_lifetime_value_score=clamped(
                f"{penetration} * {R.PENETRATION_WEIGHT}D", *R.LIFETIME_PARTS
            ),
            churn_risk_score=clamped(*master_rules.churn),
            next_best_action=choice(master_rules.action),
            executive_customer_tier=choice(master_rules.tier),
            last_updated=p.stamp,
        ),
    )


# Per model: the function; its parameters after ``p`` name the inputs it reads.
MODELS = {
    "customer_profile": customer_profile,
    "customer_financial_summary": customer_financial_summary,
    "transaction_analytics": transaction_analytics,
    "channel_effectiveness": channel_effectiveness,
    "product_penetration_analysis": product_penetration_analysis,
    "comprehensive_risk_profile": comprehensive_risk_profile,
    "customer_retention_analytics": customer_retention_analytics,
    "account_performance_dashboard": account_performance_dashboard,
    "customer_360_master": customer_360_master,
}

# Parts of models that other models read.
PARTS = {"customer_base": customer_base, "profile_core": profile_core, "account_activity": account_activity}
