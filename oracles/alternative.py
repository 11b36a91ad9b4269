"""Check queries of the alternative profile."""

from __future__ import annotations

import re

from oracles.fixed_inputs import ALTERNATIVE
from oracles.fixed_rules import alternative as A
from oracles.fixed_rules import gold as G
from oracles.fixed_rules import silver as R
from oracles.silver import full_joined, grouped, or_else, ranked
from oracles.text import Book, case, cases, mean, mean_of_means, n, pct, real, rounded, same, score, spread, total, truths, zero


def build(book: Book, as_of: str = "2024-02-01") -> None:
    today = f"CAST('{as_of}' AS TIMESTAMP)"
    updated = {"last_updated": today}
    for name, (table, columns) in ALTERNATIVE.items():
        book.add(f"_alt_{name}", columns, table)

    # Cleaning
    loans = (
        "SELECT loan_id, customer_id, upper(loan_type) AS loan_type, loan_date, loan_amount,"
        " upper(loan_status) AS loan_status, last_updated, CASE WHEN loan_status = 'PAID_OFF' THEN 100 ELSE 0 END AS percent_paid,"
        f" date_diff('year', loan_date, {today}) AS loan_age_years FROM _alt_loans WHERE loan_status <> 'INVALID'"
    )
    book.add(
        "alt_stg_loans",
        {
            **same(*"loan_id customer_id loan_type loan_date loan_amount loan_status last_updated percent_paid loan_age_years".split()),
            **cases(
                tenure_category=A.LOAN_TENURE,
                risk_score=A.LOAN_RISK,
                payment_performance=A.LOAN_PERFORMANCE,
                loan_size_category=A.LOAN_SIZE,
                rate_competitiveness=A.LOAN_RATE,
                estimated_months_remaining=A.LOAN_MONTHS_LEFT,
            ),
            "is_performing": "loan_status = 'PAID_OFF'",
            "dbt_created_at": today,
        },
        f"({loans})",
        "",
        ("_alt_loans",),
    )
    phones = (
        "SELECT phone_id, customer_id, sms_enabled, is_primary, upper(phone_type) AS phone_type,"
        " phone_number AS formatted_phone, upper(phone_status) AS phone_status, marketing_consent, last_updated,"
        " list_reduce(list_concat([''], list_filter(string_split(phone_number, ''), lambda c: c BETWEEN '0' AND '9')),"
        " lambda a, b: a || b) AS digits_only, concat('+1-', phone_number) AS international_format"
        " FROM _alt_customer_phones WHERE phone_status <> 'INVALID'"
    )
    book.add(
        "alt_stg_customer_phones",
        {
            **same(
                *(
                    "phone_id customer_id sms_enabled is_primary phone_type formatted_phone phone_status"
                    " marketing_consent last_updated digits_only international_format is_valid_format"
                ).split()
            ),
            **truths(A.PHONE_FLAGS),
            "phone_quality_score": case(A.PHONE_QUALITY),
            "dbt_created_at": today,
        },
        f"(SELECT *, length(digits_only) = {A.PHONE_DIGITS} AS is_valid_format FROM ({phones}))",
        "",
        ("_alt_customer_phones",),
    )

    # Financial summary
    credit, active, defaulted = "card_type = 'CREDIT'", "loan_status = 'ACTIVE'", "loan_status = 'DEFAULTED'"
    worth = "investment_amount * current_price"
    held = full_joined(
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
                "alt_stg_loans",
                "customer_id",
                {
                    "total_loans": "count(*)",
                    "current_loans": n(active),
                    "total_loan_balance": f"CAST({total('loan_amount', active + ' AND percent_paid = 0')} AS DECIMAL(28,2))",
                    "avg_loan_interest_rate": mean(f"CAST({case(A.LOAN_INTEREST)} AS DECIMAL(6,2))"),
                    "delinquent_loans": n(defaulted),
                    "at_risk_loan_balance": total("loan_amount", defaulted),
                },
            ),
            grouped(
                "_alt_investments",
                "customer_id",
                {
                    "total_investments": "count(*)",
                    "total_investment_value": f"sum({worth})",
                    "total_unrealized_gain_loss": f"sum({worth} - investment_amount)",
                    "retirement_account_value": total(worth, A.LONG_TERM_HOLDINGS),
                },
            ),
            grouped(
                "stg_insurance_policies",
                "customer_id",
                {
                    "total_insurance_policies": "count(*)",
                    "active_insurance_policies": n("policy_status = 'ACTIVE'"),
                    "total_insurance_coverage": f"sum({case(A.COVERAGE)})",
                    "total_annual_premiums": f"sum({case(A.PREMIUM)})",
                },
            ),
        ],
    )
    held_columns = [
        c
        for c in book.columns["int_customer_financial_summary"]
        if c not in ("net_worth_with_bank", "total_relationship_value", "product_penetration_score", "financial_risk_level", "wealth_tier", "last_updated", "customer_id", "first_account_opened_date")
    ]
    book.add(
        "alt_int_customer_financial_summary",
        {
            **same("customer_id", "first_account_opened_date"),
            **zero(*held_columns),
            "net_worth_with_bank": "wealth - COALESCE(total_loan_balance, 0) - COALESCE(total_credit_balance, 0)",
            "total_relationship_value": "wealth + COALESCE(total_credit_limit, 0)",
            "product_penetration_score": " + ".join(f"({case(part)})" for part in R.PENETRATION_PARTS),
            "customer_risk_profile": case(R.FINANCIAL_RISK),
            "relationship_category": case(A.RELATIONSHIP),
            "customer_value_segment": case(A.VALUE_SEGMENT),
            **updated,
        },
        "(SELECT *, wealth + COALESCE(total_loan_balance, 0) AS business FROM (SELECT *,"
        f" COALESCE(total_deposit_balances, 0) + COALESCE(total_investment_value, 0) AS wealth FROM ({held})))",
        "",
        ("stg_accounts", "stg_cards", "alt_stg_loans", "_alt_investments", "stg_insurance_policies"),
    )

    # Channels
    converted = "response_status = 'CONVERTED'"
    per_channel = (
        f"SELECT customer_id, {case(A.CAMPAIGN_CHANNEL)} AS channel, count(*) AS received, {n(converted)} AS converted,"
        f" {total('(' + case(A.CAMPAIGN_VALUE) + ')', converted)} AS value FROM _alt_marketing_campaigns GROUP BY ALL"
    )
    used = full_joined(
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
                f"({per_channel})",
                "customer_id",
                {
                    "marketing_channels_used": "count(DISTINCT channel)",
                    "total_campaigns_received": "sum(received)",
                    "total_campaigns_converted": "sum(converted)",
                    "total_marketing_value": "sum(value)",
                    "marketing_conversion_rate": mean_of_means(f"{real('converted')} / received"),
                },
            ),
            "SELECT customer_id, service_channels_used, total_service_interactions, service_satisfaction_score,"
            " total_escalated_interactions, total_resolved_interactions FROM int_channel_effectiveness"
            " WHERE total_service_interactions > 0",
            "SELECT customer_id, digital_platforms_used, total_digital_activities, last_digital_activity_date"
            " FROM int_channel_effectiveness WHERE total_digital_activities > 0",
        ],
    )
    channel_share = f"round({real('digital_channel_usage')} * {R.ADOPTION_SHARE_POINTS} / {real('total_channel_usage')})"

    def weighed(weights: dict[str, int]) -> str:
        return " + ".join(f"COALESCE({name}, 0) * {weight}" for name, weight in weights.items())

    as_is = ("customer_id", "last_channel_usage_date", "last_digital_activity_date")
    scored = (
        "digital_adoption_score channel_diversity_score service_resolution_rate marketing_roi_per_campaign"
        " channel_preference channel_engagement_level digital_session_quality next_best_channel_action"
        " channel_optimization_opportunity last_updated"
    ).split()
    book.add(
        "alt_int_channel_effectiveness",
        {
            **same(*as_is),
            **zero(*[c for c in book.columns["int_channel_effectiveness"] if c not in (*as_is, *scored)]),
            "digital_adoption_score": score(
                weighed(R.ADOPTION_WEIGHTS), f"CASE WHEN total_channel_usage > 0 THEN {channel_share} ELSE 0 END"
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
            **updated,
        },
        f"({used})",
        "",
        ("stg_channel_usage", "_alt_marketing_campaigns", "int_channel_effectiveness"),
    )

    # Products
    kinds = A.PRODUCT_KINDS
    seen = full_joined(
        "customer_id",
        [
            grouped(
                "_alt_product_usage",
                "customer_id",
                {
                    "total_products_used": "count(DISTINCT product_id)",
                    "total_usage_events": "sum(usage_count)",
                    "avg_usage_per_product": "avg(usage_count)",
                    "first_product_usage_date": "min(usage_date)",
                    "last_product_usage_date": "max(usage_date)",
                    **{f"{kind}_products": n(text) for kind, text in kinds.items()},
                    **{f"{kind}_usage": f"sum(usage_count) FILTER (WHERE {text})" for kind, text in kinds.items()},
                },
            ),
            ranked(
                "stg_customer_segments",
                "customer_id",
                "segment_date DESC NULLS FIRST, segment_id DESC",
                {"customer_id": "customer_id", "current_segment": "segment_name", "current_segment_date": "segment_date"},
            ),
            grouped(
                "_alt_marketing_campaigns",
                "customer_id",
                {
                    "total_campaigns_targeted": "count(*)",
                    "campaigns_opened": "0",
                    "campaigns_clicked": n("response_status = 'ENGAGED'"),
                    "campaigns_converted": n(converted),
                    "campaigns_opted_out": n("response_status = 'NO_RESPONSE'"),
                    "last_campaign_response_date": "max(campaign_date)",
                    "cross_sell_campaigns": n("campaign_type = 'EMAIL_PROMOTION'"),
                    "cross_sell_conversions": n(f"campaign_type = 'EMAIL_PROMOTION' AND {converted}"),
                    "retention_campaigns": n("campaign_type = 'PHONE_CALL'"),
                    "avg_conversion_value": n(converted),
                },
            ),
            grouped(
                "stg_channel_usage",
                "customer_id",
                {
                    "total_channels_used": "count(DISTINCT channel_type)",
                    "digital_channels_used": n(R.DIGITAL_CHANNELS),
                    "physical_channels_used": n(R.PHYSICAL_CHANNELS),
                    "digital_channel_usage": f"sum(usage_count) FILTER (WHERE {R.DIGITAL_CHANNELS})",
                    "physical_channel_usage": f"sum(usage_count) FILTER (WHERE {R.PHYSICAL_CHANNELS})",
                },
            ),
        ],
    )
    months = f"CAST(date_diff('day', CAST(first_product_usage_date AS DATE), DATE '{as_of}') AS DOUBLE) / 30"
    sticky = score(
        "total_products_used * 10",
        "least(50, total_usage_events)",
        f"CASE WHEN first_product_usage_date IS NULL THEN 0 ELSE least(30.0, {months}) END",
    )
    product_same = (
        "customer_id first_product_usage_date last_product_usage_date current_segment current_segment_date"
        " last_campaign_response_date"
    ).split()
    product_scored = {
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
        **updated,
    }
    book.add(
        "alt_int_product_penetration_analysis",
        {
            **same(*product_same),
            **zero(
                *[
                    c
                    for c in book.columns["int_product_penetration_analysis"]
                    if c not in product_same and c not in product_scored
                ]
            ),
            **product_scored,
        },
        f"({seen})",
        "",
        ("_alt_product_usage", "stg_customer_segments", "_alt_marketing_campaigns", "stg_channel_usage"),
    )

    # Risk profile
    latest = ranked(
        "_alt_risk_assessments",
        "customer_id, risk_type",
        "assessment_date DESC NULLS FIRST, assessment_id DESC",
        same("customer_id", "risk_type", "risk_score", "risk_level", "assessment_date"),
    )

    def of(kind: str, column: str) -> str:
        return f"max({column}) FILTER (WHERE risk_type = '{kind}_RISK')"

    flagged = "compliance_status = 'FLAGGED'"
    known = full_joined(
        "customer_id",
        [
            grouped(
                f"({latest})",
                "customer_id",
                {
                    "current_credit_risk_score": of("CREDIT", "risk_score"),
                    "current_fraud_risk_score": of("FRAUD", "risk_score"),
                    "current_operational_risk_score": of("OPERATIONAL", "risk_score"),
                    "current_market_risk_score": of("COMPLIANCE", "risk_score"),
                    "credit_risk_rating": of("CREDIT", "risk_level"),
                    "fraud_risk_rating": of("FRAUD", "risk_level"),
                    "last_risk_assessment_date": "max(assessment_date)",
                },
            ),
            grouped(
                "_alt_fraud_alerts",
                "customer_id",
                {
                    "total_fraud_alerts": "count(*)",
                    "confirmed_fraud_incidents": n("alert_status = 'CONFIRMED_FRAUD'"),
                    "false_positive_alerts": n("alert_status = 'FALSE_POSITIVE'"),
                    "pending_fraud_investigations": n("alert_status = 'UNDER_REVIEW'"),
                    "highest_fraud_risk_score": f"max({case(A.FRAUD_SCORE)})",
                    "last_fraud_alert_date": "max(CAST(alert_timestamp AS DATE))",
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
                "_alt_credit_scores",
                "customer_id",
                {
                    "avg_credit_score": "avg(score_value)",
                    "highest_credit_score": "max(score_value)",
                    "lowest_credit_score": "min(score_value)",
                    **{
                        f"latest_{bureau}_score": f"max(score_value) FILTER (WHERE bureau = '{bureau.upper()}')"
                        for bureau in ("experian", "equifax", "transunion")
                    },
                    "credit_score_volatility": spread("score_value"),
                    "last_credit_score_date": "max(score_date)",
                },
            ),
            grouped(
                "_alt_kyc_records",
                "customer_id",
                {
                    "total_kyc_checks": "count(*)",
                    "passed_kyc_checks": n("verification_status = 'VERIFIED'"),
                    "failed_kyc_checks": n("verification_status = 'FAILED'"),
                    "last_kyc_check_date": "max(verification_date)",
                    "initial_kyc_date": "max(verification_date) FILTER (WHERE kyc_type = 'INITIAL')",
                },
            ),
            grouped(
                "(SELECT a.customer_id, x.alert_id, x.alert_type, x.alert_status, x.alert_timestamp"
                " FROM stg_accounts a LEFT JOIN stg_account_alerts x ON x.account_id = a.account_id)",
                "customer_id",
                {
                    "total_account_alerts": "count(alert_id)",
                    "unusual_activity_alerts": n("alert_type = 'UNUSUAL_ACTIVITY'"),
                    "pending_account_alerts": n("alert_status = 'PENDING'"),
                    "last_account_alert_date": "max(CAST(alert_timestamp AS DATE))",
                },
            ),
        ],
    )
    unknown = str(R.UNKNOWN_SCORE)
    parts = {name: f"COALESCE({name}, {unknown})" for name in R.RISK_WEIGHTS}
    parts["highest_fraud_risk_score"] = f"{R.TOP_CREDIT_SCORE} - COALESCE(highest_fraud_risk_score, 0)"
    composite = " + ".join(
        f"CAST({parts[name]} AS DOUBLE) * CAST({weight} AS DOUBLE)" for name, weight in R.RISK_WEIGHTS.items()
    )
    middle = [f"current_{kind}_risk_score" for kind in ("credit", "fraud", "operational", "market")] + ["avg_credit_score"]
    counts = (
        "total_fraud_alerts confirmed_fraud_incidents false_positive_alerts pending_fraud_investigations"
        " highest_fraud_risk_score total_compliance_checks total_compliance_flags aml_flags sanctions_flags"
        " credit_score_volatility total_kyc_checks passed_kyc_checks failed_kyc_checks total_account_alerts"
        " unusual_activity_alerts pending_account_alerts"
    ).split()
    dropped = {
        "composite_risk_score", "overall_risk_level", "compliance_status", "requires_enhanced_monitoring",
        "requires_immediate_review", "risk_trend", "last_updated", *middle, *counts,
    }
    book.add(
        "alt_int_comprehensive_risk_profile",
        {
            **same(*[c for c in book.columns["int_comprehensive_risk_profile"] if c not in dropped]),
            **or_else(unknown, *middle),
            **zero(*counts),
            "composite_risk_score": "composite",
            **cases(
                composite_risk_rating=A.RISK_RATING,
                compliance_status=A.COMPLIANCE,
                fraud_risk_level=A.FRAUD_LEVEL,
                kyc_status=A.KYC_STATUS,
                overall_risk_assessment=A.REVIEW_NEED,
            ),
            **updated,
        },
        f"(SELECT *, {composite} AS composite FROM ({known}))",
        "",
        (
            "_alt_risk_assessments",
            "_alt_fraud_alerts",
            "stg_compliance_records",
            "_alt_credit_scores",
            "_alt_kyc_records",
            "stg_accounts",
            "stg_account_alerts",
        ),
    )

    # Models with the main rules, over this profile's tables
    book.add_text(
        "_alt_risk_as_main",
        "SELECT *, composite_risk_rating AS overall_risk_level,"
        " coalesce(overall_risk_assessment = 'REQUIRES_MONITORING', FALSE) AS requires_enhanced_monitoring,"
        " coalesce(overall_risk_assessment = 'REQUIRES_IMMEDIATE_REVIEW', FALSE) AS requires_immediate_review,"
        " 'STABLE' AS risk_trend FROM alt_int_comprehensive_risk_profile",
        [],
        ("alt_int_comprehensive_risk_profile",),
    )
    book.add_text(
        "_alt_finance_as_main",
        "SELECT *, customer_value_segment AS wealth_tier, customer_risk_profile AS financial_risk_level"
        " FROM alt_int_customer_financial_summary",
        [],
        ("alt_int_customer_financial_summary",),
    )
    book.add_text(
        "_alt_phones_as_main",
        "SELECT *, coalesce(phone_status = 'VERIFIED', FALSE) AS is_verified, communication_ready AS call_eligible,"
        " sms_ready AS sms_eligible FROM alt_stg_customer_phones",
        [],
        ("alt_stg_customer_phones",),
    )
    instead = {
        "stg_customers_360": "alt_stg_customers_360",
        "stg_customer_phones": "_alt_phones_as_main",
        "int_customer_profile": "alt_int_customer_profile",
        "int_customer_retention_analytics": "alt_int_customer_retention_analytics",
        "int_customer_financial_summary": "_alt_finance_as_main",
        "int_comprehensive_risk_profile": "_alt_risk_as_main",
        "int_channel_effectiveness": "alt_int_channel_effectiveness",
        "int_product_penetration_analysis": "alt_int_product_penetration_analysis",
    }
    made = {}
    # The account dashboard's own rules; ages there go by the calendar.
    health = list(R.HEALTH_PARTS)
    health[2] = "CASE WHEN overall_risk_level = 'LOW_RISK' THEN 20 WHEN overall_risk_level = 'MEDIUM_RISK' THEN 10 WHEN overall_risk_level = 'HIGH_RISK' THEN 5 ELSE 0 END"
    health[4] = "CASE WHEN compliance_status = 'COMPLIANT' THEN 10 WHEN compliance_status = 'MINOR_CONCERNS' THEN 5 ELSE 0 END"
    tier = {"'PRIVATE_BANKING', 'WEALTH_MANAGEMENT'": "'HIGH_VALUE', 'MEDIUM_VALUE'"}
    services = {"wealth_tier = 'PRIVATE_BANKING'": "wealth_tier = 'HIGH_VALUE'", "wealth_tier = 'WEALTH_MANAGEMENT'": "wealth_tier = 'MEDIUM_VALUE'"}

    def replaced(text: str, pairs: dict[str, str]) -> str:
        for old, new in pairs.items():
            text = text.replace(old, new)
        return text

    other_rules = {
        score(*R.HEALTH_PARTS): score(*health),
        case(R.ACCOUNT_OPPORTUNITY): replaced(case(R.ACCOUNT_OPPORTUNITY), tier),
        case(R.ACCOUNT_SERVICE_TIER): replaced(case(R.ACCOUNT_SERVICE_TIER), services),
        f"CAST(date_part('year', age({today}, opened_date)) AS INTEGER)": f"CAST(date_diff('year', opened_date, {today}) AS INTEGER)",
    }

    # What the master view and three reports say in other words, by query.
    level, status = "overall_risk_level = '{}'".format, "compliance_status = '{}'".format
    own_words = {
        "int_customer_360_master": {
            "COALESCE(compliance_status, 'PENDING_VERIFICATION')": "COALESCE(compliance_status, 'COMPLIANT')",
            case(R.MASTER_ACTION): replaced(case(R.MASTER_ACTION), tier),
            case(R.MASTER_TIER): replaced(case(R.MASTER_TIER), services),
        },
        "financial_performance_summary": {
            case(G.RISK_FACTOR): "CASE overall_risk_level WHEN 'LOW_RISK' THEN 1.0 WHEN 'MEDIUM_RISK' THEN 0.8 WHEN 'HIGH_RISK' THEN 0.6 ELSE 0.8 END",
            "customer_wealth_tier = 'PRIVATE_BANKING'": "customer_value_segment = 'HIGH_VALUE'",
            "wealth_tier = 'PRIVATE_BANKING'": "wealth_tier = 'HIGH_VALUE'",
            "wealth_tier = 'WEALTH_MANAGEMENT'": "wealth_tier = 'MEDIUM_VALUE'",
        },
        "risk_management_dashboard": {
            G.HIGH_RISK: level("HIGH_RISK"),
            level("CRITICAL_RISK"): level("HIGH_RISK"),
            status("NON_COMPLIANT"): status("MAJOR_CONCERNS"),
            status("REVIEW_REQUIRED"): status("MINOR_CONCERNS"),
            status("PENDING_VERIFICATION"): status("MINOR_CONCERNS"),
        },
        "_risk_customers": {
            "SELECT rp.*,": "SELECT rp.* REPLACE (CASE WHEN credit_score_volatility > 50 THEN 'VOLATILE' WHEN composite_risk_score > 700"
            " THEN 'DETERIORATING' WHEN composite_risk_score > 600 THEN 'UNSTABLE' ELSE 'STABLE' END AS risk_trend),",
        },
    }

    def over_alternative(name: str) -> str:
        """The main query ``name`` with this profile's tables put in for the main ones."""
        if name in instead and not name.startswith("int_customer_profile") and name != "int_customer_retention_analytics":
            return instead[name]
        if name not in made:
            text, reads = book.queries[name]
            swapped = {read: over_alternative(read) for read in reads}
            if all(old == new for old, new in swapped.items()):
                return name
            made[name] = instead.get(name, f"alt_{name}" if not name.startswith("_") else f"_alt{name}")
            for old, new in {**own_words.get(name, {}), **other_rules}.items():
                assert name not in own_words or old in other_rules or old in text, (name, old)
                text = text.replace(old, new)
            for old, new in sorted(swapped.items(), key=lambda pair: -len(pair[0])):
                text = re.sub(rf"(?<![\w.]){old}(?!\w)", new, text)
            book.add_text(made[name], text, book.columns[name], tuple(swapped.values()))
        return made[name]

    for name in (
        "int_customer_profile",
        "int_customer_retention_analytics",
        "int_account_performance_dashboard",
        "int_customer_360_master",
        "executive_customer_dashboard",
        "customer_segmentation_analysis",
        "financial_performance_summary",
        "product_performance_analytics",
        "risk_management_dashboard",
    ):
        over_alternative(name)
