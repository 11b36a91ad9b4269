"""The alternative profile: the same tables under other inputs and rules.

Only what differs is here; everything else is shared with the main profile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightledger.functions.scoring import choice, choices, decide_all, flags, mean, n_if, named, or_zero, points, sum_if
from brightledger.operators.keyed import align, newest, nulls_first
from brightledger.params import RunParams
from brightledger.plans import gold, silver, staging
from brightledger.rules import alternative as A
from brightledger.rules import silver as R

CUSTOMER = silver.CUSTOMER


def calendar_years(start: str, end: str) -> str:
    """Year boundaries passed, whatever the day."""
    return f"(year({end}) - year({start}))"


def calendar_months(start: str, end: str) -> str:
    """Month boundaries passed, whatever the day."""
    return f"({calendar_years(start, end)} * 12 + month({end}) - month({start}))"


# --- cleaning ----------------------------------------------------------------
def calendar_ages(p: RunParams) -> dict[str, str]:
    """Ages by the calendar; here the months of a relationship are all of them."""
    return {
        "age": calendar_years("date_of_birth", p.now),
        "relationship_years": calendar_years("customer_since_date", p.now),
        "relationship_month_part": calendar_months("customer_since_date", p.now),
    }


def customers_360(raw: DataFrame, p: RunParams, *references: DataFrame) -> DataFrame:
    return staging.customers_360(raw, p, *references, ages=calendar_ages)


def loans(raw: DataFrame, p: RunParams) -> DataFrame:
    clean = raw.where("loan_status <> 'INVALID'").withColumns(
        {
            "loan_type": F.upper("loan_type"),
            # The share paid is told by the status as it came in.
            "percent_paid": F.expr("CASE WHEN loan_status = 'PAID_OFF' THEN 100 ELSE 0 END"),
            "loan_status": F.upper("loan_status"),
            "loan_age_years": F.expr(calendar_years("loan_date", p.now)),
        }
    )
    return clean.withColumns(
        {
            **decide_all(
                tenure_category=A.LOAN_TENURE,
                risk_score=A.LOAN_RISK,
                payment_performance=A.LOAN_PERFORMANCE,
                loan_size_category=A.LOAN_SIZE,
                rate_competitiveness=A.LOAN_RATE,
                estimated_months_remaining=A.LOAN_MONTHS_LEFT,
            ),
            **flags({"is_performing": "loan_status = 'PAID_OFF'"}),
            "dbt_created_at": p.stamp,
        }
    )


def customer_phones(raw: DataFrame, p: RunParams) -> DataFrame:
    clean = raw.where("phone_status <> 'INVALID'").withColumns(
        {
            "phone_type": F.upper("phone_type"),
            "phone_status": F.upper("phone_status"),
            "digits_only": F.regexp_replace("phone_number", "[^0-9]", ""),
            "international_format": F.expr("'+1-' || phone_number"),
        }
    )
    valid = clean.withColumn("is_valid_format", F.expr(f"coalesce(length(digits_only) = {A.PHONE_DIGITS}, false)"))
    return valid.withColumns(
        {**flags(A.PHONE_FLAGS), **decide_all(phone_quality_score=A.PHONE_QUALITY), "dbt_created_at": p.stamp}
    ).withColumnRenamed("phone_number", "formatted_phone")


# --- roll-ups ----------------------------------------------------------------
def loan_summary(loans: DataFrame) -> DataFrame:
    active, defaulted = "loan_status = 'ACTIVE'", "loan_status = 'DEFAULTED'"
    return loans.groupBy(CUSTOMER).agg(
        *named(
            total_loans="count(*)",
            current_loans=n_if(active),
            total_loan_balance=sum_if(active, "(loan_amount * (100 - percent_paid) / 100)"),
            avg_loan_interest_rate=mean(f"CAST({choice(A.LOAN_INTEREST)} AS DECIMAL(6,2))"),
            delinquent_loans=n_if(defaulted),
            at_risk_loan_balance=sum_if(defaulted, "loan_amount"),
        )
    )


def investment_summary(investments: DataFrame) -> DataFrame:
    value = "(investment_amount * current_price)"
    return investments.groupBy(CUSTOMER).agg(
        *named(
            total_investments="count(*)",
            total_investment_value=f"sum{value}",
            total_unrealized_gain_loss=f"sum({value} - investment_amount)",
            retirement_account_value=sum_if(A.LONG_TERM_HOLDINGS, value),
        )
    )


def insurance_summary(policies: DataFrame) -> DataFrame:
    """Cover and premium are set amounts per kind of policy."""
    return policies.groupBy(CUSTOMER).agg(
        *named(
            total_insurance_policies="count(*)",
            active_insurance_policies=n_if("policy_status = 'ACTIVE'"),
            total_insurance_coverage=f"sum({choice(A.COVERAGE)})",
            total_annual_premiums=f"sum({choice(A.PREMIUM)})",
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
            silver.account_summary(accounts),
            silver.card_summary(cards),
            loan_summary(loans),
            investment_summary(investments),
            insurance_summary(insurance_policies),
        ],
        CUSTOMER,
    )
    hidden = (CUSTOMER, "first_account_opened_date", "max_credit_utilization")
    assets = "coalesce(total_deposit_balances, 0) + coalesce(total_investment_value, 0)"
    lent = "coalesce(total_loan_balance, 0)"
    return held.select("*", *named(wealth=assets, business=f"{assets} + {lent}")).select(
        CUSTOMER,
        "first_account_opened_date",
        *or_zero(*[c for c in held.columns if c not in hidden]),
        *named(
            net_worth_with_bank=f"wealth - {lent} - coalesce(total_credit_balance, 0)",
            total_relationship_value="wealth + coalesce(total_credit_limit, 0)",
            product_penetration_score=points(*R.PENETRATION_PARTS),
            customer_risk_profile=choice(R.FINANCIAL_RISK),
            relationship_category=choice(A.RELATIONSHIP),
            customer_value_segment=choice(A.VALUE_SEGMENT),
            last_updated=p.stamp,
        ),
    )


def marketing_summary(campaigns: DataFrame) -> DataFrame:
    """Campaigns by a channel that follows from their type."""
    by_channel = campaigns.select(CUSTOMER, *named(channel=choice(A.CAMPAIGN_CHANNEL), answer="response_status", campaign_type="campaign_type"))
    converted = "answer = 'CONVERTED'"
    per_channel = by_channel.groupBy(CUSTOMER, "channel").agg(
        *named(received="count(*)", converted=n_if(converted), value=sum_if(converted, choice(A.CAMPAIGN_VALUE)))
    )
    return silver.marketing_totals(per_channel)


def channel_effectiveness(
    p: RunParams,
    channel_usage: DataFrame,
    marketing_campaigns: DataFrame,
    customer_interactions: DataFrame,
    digital_activity: DataFrame,
) -> DataFrame:
    return silver.channel_scores(
        p,
        silver.channel_summary(channel_usage),
        marketing_summary(marketing_campaigns),
        silver.service_summary(customer_interactions),
        silver.platform_summary(digital_activity),
    )


def product_usage_summary(product_usage: DataFrame) -> DataFrame:
    """Products are told apart by their id."""
    counted = {f"{kind}_products": n_if(text) for kind, text in A.PRODUCT_KINDS.items()}
    used = {f"{kind}_usage": f"sum(CASE WHEN {text} THEN usage_count END)" for kind, text in A.PRODUCT_KINDS.items()}
    return product_usage.groupBy(CUSTOMER).agg(
        *named(
            total_products_used="count(DISTINCT product_id)",
            total_usage_events="sum(usage_count)",
            avg_usage_per_product="avg(usage_count)",
            first_product_usage_date="min(usage_date)",
            last_product_usage_date="max(usage_date)",
            **counted,
            **used,
        )
    )


def campaign_response(campaigns: DataFrame) -> DataFrame:
    mail, converted = "campaign_type = 'EMAIL_PROMOTION'", "response_status = 'CONVERTED'"
    return campaigns.groupBy(CUSTOMER).agg(
        *named(
            total_campaigns_targeted="count(*)",
            campaigns_opened="0L",
            campaigns_clicked=n_if("response_status = 'ENGAGED'"),
            campaigns_converted=n_if(converted),
            campaigns_opted_out=n_if("response_status = 'NO_RESPONSE'"),
            last_campaign_response_date="max(campaign_date)",
            cross_sell_campaigns=n_if(mail),
            cross_sell_conversions=n_if(f"{mail} AND {converted}"),
            retention_campaigns=n_if("campaign_type = 'PHONE_CALL'"),
            avg_conversion_value=n_if(converted),
        )
    )


def product_penetration_analysis(
    p: RunParams,
    product_usage: DataFrame,
    customer_segments: DataFrame,
    marketing_campaigns: DataFrame,
    channel_usage: DataFrame,
) -> DataFrame:
    return silver.product_scores(
        p,
        f"datediff({p.now}, first_product_usage_date)",
        product_usage_summary(product_usage),
        silver.current_segment(customer_segments).withColumnRenamed("segment_assigned_date", "current_segment_date"),
        campaign_response(marketing_campaigns),
        silver.channel_events(channel_usage),
    )


def assessment_summary(assessments: DataFrame) -> DataFrame:
    """The market score is the newest compliance assessment here."""
    latest = newest(
        assessments,
        [CUSTOMER, "risk_type"],
        [*nulls_first("assessment_date"), F.col("assessment_id")],
        {c: c for c in ("risk_score", "risk_level", "assessment_date")},
    )

    def of(kind: str, column: str) -> str:
        return f"max(CASE WHEN risk_type = '{kind}_RISK' THEN {column} END)"

    return latest.groupBy(CUSTOMER).agg(
        *named(
            current_credit_risk_score=of("CREDIT", "risk_score"),
            current_fraud_risk_score=of("FRAUD", "risk_score"),
            current_operational_risk_score=of("OPERATIONAL", "risk_score"),
            current_market_risk_score=of("COMPLIANCE", "risk_score"),
            credit_risk_rating=of("CREDIT", "risk_level"),
            fraud_risk_rating=of("FRAUD", "risk_level"),
            last_risk_assessment_date="max(assessment_date)",
            assessments_requiring_review=n_if(A.NEEDS_REVIEW),
        )
    )


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
    scored_alerts = fraud_alerts.select("*", *named(risk_score=choice(A.FRAUD_SCORE)))
    scores = credit_scores.withColumnRenamed("score_value", "credit_score")
    # The same review outcomes under other names.
    reviews = kyc_records.select(
        CUSTOMER,
        "kyc_type",
        *named(
            review_date="verification_date",
            status="CASE verification_status WHEN 'VERIFIED' THEN 'PASSED' ELSE verification_status END",
        ),
    )
    known = align(
        [
            assessment_summary(risk_assessments),
            silver.fraud_summary(scored_alerts),
            silver.compliance_summary(compliance_records),
            silver.credit_summary(scores),
            silver.kyc_summary(reviews),
            silver.account_alert_summary(accounts, account_alerts),
        ],
        CUSTOMER,
    ).select("*", *named(composite=silver.composite_risk_score()))
    return known.select(
        *silver.risk_measures(),
        *named(
            composite_risk_score="composite",
            **choices(
                composite_risk_rating=A.RISK_RATING,
                compliance_status=A.COMPLIANCE,
                fraud_risk_level=A.FRAUD_LEVEL,
                kyc_status=A.KYC_STATUS,
                overall_risk_assessment=A.REVIEW_NEED,
            ),
            last_updated=p.stamp,
        ),
    )


# Overrides of the main models by table name.


# --- roll-ups and reports whose rules are the main ones, under this profile's labels ---------
def risk_in_main_terms(risk: DataFrame) -> DataFrame:
    """The risk profile under the names that shared models read; it has no trend of its own."""
    return risk.withColumns(
        {
            "overall_risk_level": F.col("composite_risk_rating"),
            **flags(
                {
                    "requires_enhanced_monitoring": "overall_risk_assessment = 'REQUIRES_MONITORING'",
                    "requires_immediate_review": "overall_risk_assessment = 'REQUIRES_IMMEDIATE_REVIEW'",
                }
            ),
            "risk_trend": F.lit("STABLE"),
        }
    )


def finance_in_main_terms(finance: DataFrame) -> DataFrame:
    """The financial summary likewise: value segments stand for wealth tiers."""
    return finance.withColumns(
        {"wealth_tier": F.col("customer_value_segment"), "financial_risk_level": F.col("customer_risk_profile")}
    )


def customer_profile(
    profile_core: DataFrame, customer_addresses: DataFrame, customer_phones: DataFrame, customer_segments: DataFrame
) -> DataFrame:
    phones = customer_phones.withColumns(
        {
            **flags({"is_verified": "phone_status = 'VERIFIED'"}),
            "call_eligible": F.col("communication_ready"),
            "sms_eligible": F.col("sms_ready"),
        }
    )
    return silver.customer_profile(profile_core, customer_addresses, phones, customer_segments)


def customer_retention_analytics(
    p: RunParams,
    retention_events: DataFrame,
    customer_interactions: DataFrame,
    digital_activity: DataFrame,
    profile_core: DataFrame,
    comprehensive_risk_profile: DataFrame,
) -> DataFrame:
    risk = risk_in_main_terms(comprehensive_risk_profile)
    return silver.customer_retention_analytics(
        p, retention_events, customer_interactions, digital_activity, profile_core, risk
    )


def account_activity(
    p: RunParams, accounts: DataFrame, account_balances: DataFrame, transaction_analytics: DataFrame
) -> DataFrame:
    age = calendar_years("opened_date", p.now)
    return silver.activity_at_age(age, accounts, account_balances, transaction_analytics)


def account_performance_dashboard(
    p: RunParams,
    accounts: DataFrame,
    account_activity: DataFrame,
    customer_financial_summary: DataFrame,
    profile_core: DataFrame,
    comprehensive_risk_profile: DataFrame,
    product_penetration_analysis: DataFrame,
) -> DataFrame:
    return silver.accounts_with_owners(
        p,
        silver.AccountRules(A.HEALTH_PARTS, A.ACCOUNT_OPPORTUNITY, A.ACCOUNT_SERVICE_TIER),
        accounts,
        account_activity,
        finance_in_main_terms(customer_financial_summary),
        profile_core,
        risk_in_main_terms(comprehensive_risk_profile),
        product_penetration_analysis,
    )


def customer_360_master(
    p: RunParams,
    customer_profile: DataFrame,
    customer_financial_summary: DataFrame,
    accounts: DataFrame,
    transaction_analytics: DataFrame,
    comprehensive_risk_profile: DataFrame,
) -> DataFrame:
    return silver.master_view(
        p,
        silver.MasterRules("COMPLIANT", A.MASTER_CHURN_PARTS, A.MASTER_ACTION, A.MASTER_TIER),
        customer_profile,
        finance_in_main_terms(customer_financial_summary),
        accounts,
        transaction_analytics,
        risk_in_main_terms(comprehensive_risk_profile),
    )


def financial_performance_summary(
    p: RunParams,
    account_performance_dashboard: DataFrame,
    customer_financial_summary: DataFrame,
    product_penetration_analysis: DataFrame,
    profile_core: DataFrame,
) -> DataFrame:
    """Accounts are told apart by their owner's value segment, whose labels are written in
    another way than the tiers asked for, so no account counts as private banking."""
    return gold.financial_overview(
        p,
        gold.FinanceRules(A.RISK_FACTOR, "customer_value_segment", "HIGH_VALUE", "MEDIUM_VALUE"),
        account_performance_dashboard,
        finance_in_main_terms(customer_financial_summary),
        product_penetration_analysis,
        profile_core,
    )


def product_performance_analytics(
    p: RunParams,
    product_penetration_analysis: DataFrame,
    profile_core: DataFrame,
    customer_financial_summary: DataFrame,
    account_activity: DataFrame,
) -> DataFrame:
    finance = finance_in_main_terms(customer_financial_summary)
    return gold.product_performance_analytics(p, product_penetration_analysis, profile_core, finance, account_activity)


def risk_management_dashboard(
    p: RunParams,
    comprehensive_risk_profile: DataFrame,
    customer_base: DataFrame,
    customer_financial_summary: DataFrame,
) -> DataFrame:
    """One level stands for high and critical risk, and one label for open reviews; the trend
    follows from the scores."""
    own = gold.RiskRules("HIGH_RISK", "HIGH_RISK", A.HIGH_RISK, "MAJOR_CONCERNS", "MINOR_CONCERNS", "MINOR_CONCERNS")
    risk = risk_in_main_terms(comprehensive_risk_profile).withColumn("risk_trend", F.expr(choice(A.RISK_TREND)))
    return gold.risk_overview(p, own, risk, customer_base, finance_in_main_terms(customer_financial_summary))


def customer_health(
    profile_core: DataFrame,
    customer_financial_summary: DataFrame,
    comprehensive_risk_profile: DataFrame,
    channel_effectiveness: DataFrame,
    customer_retention_analytics: DataFrame,
    product_penetration_analysis: DataFrame,
) -> DataFrame:
    return gold.customer_health(
        profile_core,
        finance_in_main_terms(customer_financial_summary),
        risk_in_main_terms(comprehensive_risk_profile),
        channel_effectiveness,
        customer_retention_analytics,
        product_penetration_analysis,
    )


STAGING = {
    "customers_360": (customers_360, staging.MODELS["customers_360"][1]),
    "loans": (loans, ()),
    "customer_phones": (customer_phones, ()),
    **{name: (staging.load_stamped, ()) for name in (
        "investments", "product_usage", "marketing_campaigns", "risk_assessments", "fraud_alerts", "credit_scores", "kyc_records",
    )},
}
# Roll-ups whose rules are those of the main profile.
SHARED = {
    "customer_base": silver.customer_base,
    "profile_core": silver.profile_core,
    "transaction_analytics": silver.transaction_analytics,
    "customer_health": customer_health,
    "account_activity": account_activity,
}
ROLL_UPS = {
    "customer_financial_summary": customer_financial_summary,
    "channel_effectiveness": channel_effectiveness,
    "product_penetration_analysis": product_penetration_analysis,
    "comprehensive_risk_profile": comprehensive_risk_profile,
    "customer_profile": customer_profile,
    "customer_retention_analytics": customer_retention_analytics,
    "account_performance_dashboard": account_performance_dashboard,
    "customer_360_master": customer_360_master,
}
REPORTS = {
    "executive_customer_dashboard": gold.executive_customer_dashboard,
    "customer_segmentation_analysis": gold.customer_segmentation_analysis,
    "financial_performance_summary": financial_performance_summary,
    "product_performance_analytics": product_performance_analytics,
    "risk_management_dashboard": risk_management_dashboard,
}
