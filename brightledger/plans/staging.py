"""Cleaning layer: one function per input, all row-local except for joins to
reference tables of a handful of rows.

Nothing here shuffles: the built-in reference tables are marked for broadcasting where they
are made, and the optimizer decides about loaded ones by their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brightledger.functions.dates import age_month_part, age_years, clock_hours, day_of_week
from brightledger.functions.scoring import decide, decide_all, flags, rate_pct
from brightledger.functions.text import joined, title_case
from brightledger.params import RunParams
from brightledger.rules import staging as R

NOT_INVALID = "{} <> 'INVALID'"


def _stamped(df: DataFrame, p: RunParams) -> DataFrame:
    return df.withColumn("dbt_created_at", p.stamp)


def _upper(*names: str) -> dict[str, Column]:
    return {name: F.upper(name) for name in names}


def _texts(**texts: str) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in texts.items()}


def load_stamped(raw: DataFrame, p: RunParams) -> DataFrame:
    """Inputs that are taken as they come."""
    return _stamped(raw, p)


def completed_ages(p: RunParams) -> dict[str, str]:
    """Ages in completed years, and the months of the relationship beyond them."""
    return {
        "age": age_years("date_of_birth", p.now),
        "relationship_years": age_years("customer_since_date", p.now),
        "relationship_month_part": age_month_part("customer_since_date", p.now),
    }


def customers_360(
    raw: DataFrame,
    p: RunParams,
    age_cohorts: DataFrame,
    income_brackets: DataFrame,
    credit_score_ranges: DataFrame,
    risk_categories: DataFrame,
    lifecycle_stages: DataFrame,
    ages=completed_ages,
) -> DataFrame:
    clean = raw.where(NOT_INVALID.format("customer_status")).withColumns(
        {
            **_texts(
                first_name=title_case("first_name"),
                last_name=title_case("last_name"),
                email_address="lower(email_address)",
                **ages(p),
            ),
            **_upper("gender", "customer_status"),
        }
    )
    banded = clean.withColumns(
        {
            **_texts(full_name=joined("first_name", "' '", "last_name")),
            **decide_all(
                age_cohort_id=R.AGE_COHORT,
                income_bracket_id=R.INCOME_BRACKET,
                credit_score_range_id=R.CREDIT_RANGE,
                risk_category_id=R.RISK_CATEGORY,
                lifecycle_stage_id=R.LIFECYCLE_STAGE,
                customer_value_segment=R.VALUE_SEGMENT,
            ),
            **flags(R.CUSTOMER_FLAGS),
        }
    ).drop("relationship_month_part")
    cohorts = age_cohorts.select(
        F.col("cohort_id").alias("age_cohort_id"),
        F.col("cohort_name").alias("age_cohort_name"),
        F.col("characteristics").alias("age_cohort_characteristics"),
    )
    brackets = income_brackets.select(
        F.col("bracket_id").alias("income_bracket_id"),
        F.col("bracket_name").alias("income_bracket_name"),
        F.col("marketing_priority").alias("income_marketing_priority"),
    )
    ranges = credit_score_ranges.select(
        F.col("score_range_id").alias("credit_score_range_id"),
        F.col("range_name").alias("credit_score_range_name"),
        F.col("grade").alias("credit_grade"),
        F.col("default_rate").alias("expected_default_rate"),
    )
    risks = risk_categories.select(
        "risk_category_id", "risk_level", "risk_name", F.col("monitoring_frequency").alias("risk_monitoring_frequency")
    )
    stages = lifecycle_stages.select(
        F.col("stage_id").alias("lifecycle_stage_id"),
        F.col("stage_name").alias("lifecycle_stage_name"),
        F.col("characteristics").alias("lifecycle_characteristics"),
    )
    labelled = (
        banded.join(cohorts, "age_cohort_id", "left")
        .join(brackets, "income_bracket_id", "left")
        .join(ranges, "credit_score_range_id", "left")
        .join(risks, "risk_category_id", "left")
        .join(stages, "lifecycle_stage_id", "left")
    )
    return _stamped(labelled, p)


def accounts(raw: DataFrame, p: RunParams, product_catalog: DataFrame) -> DataFrame:
    products = product_catalog.select(
        "product_id",
        "product_name",
        "product_type",
        F.col("category").alias("product_category"),
        F.col("min_balance").alias("product_min_balance"),
        F.col("risk_level").alias("product_risk_level"),
    )
    clean = raw.where(NOT_INVALID.format("account_status")).withColumns(
        {
            **_upper("account_status"),
            **_texts(
                annual_interest_rate="CAST(interest_rate * 0.01 AS DECIMAL(10,4))",
                is_active="closed_date IS NULL",
                account_age_years=f"coalesce({age_years('opened_date', f'coalesce(closed_date, {p.now})')}, 0)",
            ),
        }
    )
    expense = "CAST(average_balance * annual_interest_rate AS DOUBLE) / 12"
    return _stamped(
        clean.drop("interest_rate")
        .join(products, "product_id", "left")
        .withColumns(
            {
                **decide_all(
                    balance_tier=R.BALANCE_TIER,
                    relationship_tenure=R.ACCOUNT_TENURE,
                    digital_adoption_level=R.ACCOUNT_DIGITAL,
                    risk_status=R.ACCOUNT_RISK,
                    service_tier=R.SERVICE_TIER,
                    cross_sell_score=R.ACCOUNT_CROSS_SELL,
                ),
                **flags(R.ACCOUNT_FLAGS),
                **_texts(
                    monthly_interest_expense=expense,
                    monthly_fee_revenue="monthly_fee",
                    monthly_net_revenue=f"CAST(monthly_fee AS DOUBLE) - {expense}",
                ),
            }
        ),
        p,
    )


def transactions(raw: DataFrame, p: RunParams) -> DataFrame:
    at = "transaction_datetime"
    return _stamped(
        raw.where(NOT_INVALID.format("transaction_status"))
        .withColumns(
            {
                **_upper("transaction_type", "transaction_status", "channel"),
                **_texts(transaction_date=f"to_date({at})", transaction_hour=f"hour({at})", day_of_week=day_of_week(at)),
                "amount_category": decide(R.TRANSACTION_SIZE),
            }
        )
        .withColumns(
            {
                **decide_all(
                    channel_category=R.CHANNEL_GROUP,
                    time_category=R.time_of_day("transaction_hour"),
                    day_category=R.DAY_KIND,
                    flow_direction=R.FLOW,
                ),
                **flags(R.TRANSACTION_FLAGS),
            }
        )
        .withColumn("risk_score", decide(R.TRANSACTION_RISK)),
        p,
    )


def deposits(raw: DataFrame, p: RunParams) -> DataFrame:
    return _stamped(
        raw.withColumns(
            {
                **_texts(deposit_hour="hour(deposit_datetime)", day_of_week=day_of_week("deposit_datetime")),
                **decide_all(amount_category=R.DEPOSIT_SIZE, channel_type=R.DEPOSIT_CHANNEL),
            }
        ),
        p,
    )


def withdrawals(raw: DataFrame, p: RunParams) -> DataFrame:
    return _stamped(
        raw.withColumns(
            {"withdrawal_hour": F.hour("withdrawal_datetime"), "amount_category": decide(R.WITHDRAWAL_SIZE)}
        ),
        p,
    )


def fees(raw: DataFrame, p: RunParams) -> DataFrame:
    return _stamped(raw.withColumns(decide_all(fee_category=R.FEE_SIZE, fee_classification=R.FEE_CLASS)), p)


def account_balances(raw: DataFrame, p: RunParams) -> DataFrame:
    return _stamped(raw.withColumn("balance_category", decide(R.DAILY_BALANCE)), p)


def cards(raw: DataFrame, p: RunParams) -> DataFrame:
    used = rate_pct("current_balance", "credit_limit", 2)
    return _stamped(
        raw.where(NOT_INVALID.format("card_status"))
        .withColumns(
            {
                **_upper("card_type", "card_brand", "card_status"),
                **_texts(
                    utilization_rate=f"CASE WHEN current_balance > 0 THEN {used} ELSE 0D END",
                    card_age_years=age_years("issue_date", p.now),
                    available_credit="CASE WHEN credit_limit > 0 THEN credit_limit - current_balance END",
                ),
                **flags({"is_expired": f"expiry_date < {p.now}"}),
            }
        )
        .withColumns(
            {
                **decide_all(
                    utilization_category=R.CARD_UTILISATION,
                    risk_score=R.CARD_RISK,
                    digital_feature_level=R.CARD_DIGITAL,
                    card_tier=R.CARD_TIER,
                    tenure_category=R.CARD_TENURE,
                ),
                **flags(R.CARD_FLAGS),
            }
        ),
        p,
    )


def loans(raw: DataFrame, p: RunParams) -> DataFrame:
    repaid = "original_amount - current_balance"
    age = age_years("origination_date", p.now)
    return _stamped(
        raw.where(NOT_INVALID.format("loan_status"))
        .withColumns(
            {
                **_upper("loan_type", "loan_status"),
                **_texts(
                    principal_paid=repaid,
                    interest_rate="round(interest_rate, 2)",
                    loan_age_years=age,
                    percent_paid="CASE WHEN current_balance > 0 AND original_amount > 0"
                    f" THEN {rate_pct(repaid, 'original_amount', 2)} ELSE 100D END",
                    estimated_months_remaining=f"coalesce({age_month_part(p.now, 'maturity_date')}, term_months - {age} * 12)",
                ),
            }
        )
        .withColumns(
            {
                **decide_all(
                    delinquency_bucket=R.LOAN_DELINQUENCY,
                    risk_score=R.LOAN_RISK,
                    payment_performance=R.LOAN_PERFORMANCE,
                    loan_size_category=R.LOAN_SIZE,
                    rate_competitiveness=R.LOAN_RATE,
                    tenure_category=R.LOAN_TENURE,
                ),
                **flags(R.LOAN_FLAGS),
            }
        ),
        p,
    )


def investments(raw: DataFrame, p: RunParams) -> DataFrame:
    return _stamped(
        raw.withColumns(
            {
                **_upper("investment_type", "symbol", "account_type", "risk_rating"),
                **_texts(
                    purchase_value="round(quantity * purchase_price, 2)",
                    current_value="round(quantity * current_price, 2)",
                    unrealized_gain_loss="round(quantity * current_price - quantity * purchase_price, 2)",
                    return_percent=rate_pct("current_price - purchase_price", "purchase_price", 2),
                    holding_years=age_years("purchase_date", p.now),
                ),
            }
        ).withColumns(
            {
                **decide_all(
                    asset_class=R.ASSET_CLASS,
                    performance_category=R.PERFORMANCE,
                    holding_size=R.HOLDING_SIZE,
                    tax_status=R.TAX_STATUS,
                    risk_return_profile=R.RISK_RETURN,
                    liquidity_level=R.LIQUIDITY,
                    tenure_category=R.HOLDING_TENURE,
                ),
                **flags(R.HOLDING_FLAGS),
            }
        ),
        p,
    )


def insurance_policies(raw: DataFrame, p: RunParams) -> DataFrame:
    rate = rate_pct("annual_premium", "coverage_amount", 4)
    return _stamped(
        raw.withColumns(
            {
                **_texts(
                    policy_end_date="policy_start_date + INTERVAL 1 YEAR",
                    policy_age_years=age_years("policy_start_date", p.now),
                    premium_rate_percent=f"CASE WHEN annual_premium > 0 THEN {rate} ELSE 0D END",
                ),
                "claims_category": decide(R.CLAIMS),
            }
        ),
        p,
    )


def customer_addresses(raw: DataFrame, p: RunParams, geographic_regions: DataFrame) -> DataFrame:
    regions = geographic_regions.select(
        "state_code", "state_name", "region_name", "market_type", "cost_of_living_index", "population_density"
    )
    # The full address is put together from the parts as they came in.
    state = joined("state_code", "' '", "postal_code")
    clean = raw.where(NOT_INVALID.format("address_status")).selectExpr(
        "*",
        f"concat_ws(', ', concat_ws(' ', street_address, unit_number), city, {state}) AS full_address",
        "address_until IS NULL AS is_current",
        f"coalesce({age_years('address_since', f'coalesce(address_until, {p.now})')}, 0) AS years_at_address",
    )
    return _stamped(
        clean.withColumns(
            {
                **_upper("address_type", "state_code", "address_status"),
                **_texts(**{name: title_case(name) for name in ("street_address", "unit_number", "city")}),
            }
        )
        .join(regions, "state_code", "left")
        .withColumns(
            {
                **decide_all(
                    cost_of_living_category=R.LIVING_COST,
                    address_stability=R.ADDRESS_STABILITY,
                    address_quality_score=R.ADDRESS_QUALITY,
                ),
                **flags(R.ADDRESS_FLAGS),
            }
        ),
        p,
    )


def customer_phones(raw: DataFrame, p: RunParams) -> DataFrame:
    area, exchange, line = "area_code", "exchange", "line_number"
    return _stamped(
        raw.where(NOT_INVALID.format("phone_status"))
        .withColumns(
            {
                **_upper("phone_type", "phone_status"),
                **_texts(
                    formatted_phone=joined(area, "'-'", exchange, "'-'", line),
                    phone_digits_only=joined(area, exchange, line),
                    contact_window_hours=clock_hours("preferred_contact_start", "preferred_contact_end"),
                ),
                "is_valid_format": decide(R.PHONE_FORMAT),
            }
        )
        .withColumns(
            {
                **flags(R.PHONE_FLAGS),
                **decide_all(phone_quality_score=R.PHONE_QUALITY, preferred_contact_method=R.CONTACT_METHOD),
            }
        )
        .withColumns(flags(R.PHONE_MARKETING_FLAGS)),
        p,
    )


def customer_interactions(raw: DataFrame, p: RunParams) -> DataFrame:
    at = "interaction_datetime"
    return _stamped(
        raw.where(NOT_INVALID.format("status"))
        .withColumns(
            {
                **_upper("interaction_type", "reason_code", "status", "priority", "agent_tier"),
                **_texts(interaction_date=f"to_date({at})", interaction_hour=f"hour({at})", day_of_week=day_of_week(at)),
                "duration_category": decide(R.DURATION),
            }
        )
        .withColumns(
            {
                **decide_all(
                    channel_category=R.CONTACT_CHANNEL,
                    time_category=R.time_of_day("interaction_hour"),
                    day_category=R.DAY_KIND,
                    customer_effort=R.EFFORT,
                    satisfaction_category=R.SATISFACTION,
                    resolution_type=R.RESOLUTION,
                    complexity_level=R.COMPLEXITY,
                ),
                **flags(R.INTERACTION_FLAGS),
            }
        ),
        p,
    )


def marketing_campaigns(raw: DataFrame, p: RunParams) -> DataFrame:
    return _stamped(raw.withColumns(decide_all(engagement_level=R.CAMPAIGN_ENGAGEMENT, channel_type=R.CAMPAIGN_CHANNEL)), p)


def credit_scores(raw: DataFrame, p: RunParams) -> DataFrame:
    return _stamped(raw.withColumn("score_category", decide(R.BUREAU_SCORE)), p)


def risk_assessments(raw: DataFrame, p: RunParams) -> DataFrame:
    return _stamped(raw.withColumn("score_category", decide(R.ASSESSMENT_SCORE)), p)


# Per bank input: the function and the reference tables it joins.
MODELS = {
    "account_alerts": (load_stamped, ()),
    "account_balances": (account_balances, ()),
    "accounts": (accounts, ("product_catalog",)),
    "cards": (cards, ()),
    "channel_usage": (load_stamped, ()),
    "compliance_records": (load_stamped, ()),
    "credit_scores": (credit_scores, ()),
    "customer_addresses": (customer_addresses, ("geographic_regions",)),
    "customer_interactions": (customer_interactions, ()),
    "customer_phones": (customer_phones, ()),
    "customer_segments": (load_stamped, ()),
    "customers_360": (
        customers_360,
        ("age_cohorts", "income_brackets", "credit_score_ranges", "risk_categories", "lifecycle_stages"),
    ),
    "deposits": (deposits, ()),
    "digital_activity": (load_stamped, ()),
    "fees": (fees, ()),
    "fraud_alerts": (load_stamped, ()),
    "insurance_policies": (insurance_policies, ()),
    "interest_accruals": (load_stamped, ()),
    "investments": (investments, ()),
    "kyc_records": (load_stamped, ()),
    "loans": (loans, ()),
    "marketing_campaigns": (marketing_campaigns, ()),
    "payments": (load_stamped, ()),
    "product_usage": (load_stamped, ()),
    "retention_events": (load_stamped, ()),
    "risk_assessments": (risk_assessments, ()),
    "transactions": (transactions, ()),
    "transfers": (load_stamped, ()),
    "withdrawals": (withdrawals, ()),
}
