"""Check queries of the cleaning layer."""

from __future__ import annotations

from oracles.fixed_inputs import BANK, REFERENCES
from oracles.fixed_rules import staging as R
from oracles.text import Book, case, cases, pct, select, truth, truths


def build(book: Book, as_of: str = "2024-02-01") -> None:
    today = f"CAST('{as_of}' AS TIMESTAMP)"

    def years(start: str, end: str = today) -> str:
        return f"CAST(date_part('year', age(CAST({end} AS TIMESTAMP), CAST({start} AS TIMESTAMP))) AS INTEGER)"

    def months(start: str, end: str) -> str:
        return f"CAST(date_part('month', age(CAST({end} AS TIMESTAMP), CAST({start} AS TIMESTAMP))) AS INTEGER)"

    def title(expr: str) -> str:
        words = f"regexp_extract_all({expr}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+')"
        return (
            f"CASE WHEN {expr} IS NOT NULL THEN array_to_string(list_transform({words},"
            " lambda w: upper(w[1:1]) || lower(w[2:])), '') END"
        )

    def upper(*names: str) -> dict[str, str]:
        return {name: f"upper({name})" for name in names}

    def time_of_day(hour: str) -> str:
        return (
            f"CASE WHEN {hour} BETWEEN 9 AND 17 THEN 'BUSINESS_HOURS' WHEN {hour} BETWEEN 18 AND 22 THEN 'EVENING'"
            f" WHEN {hour} BETWEEN 6 AND 8 THEN 'MORNING' ELSE 'OFF_HOURS' END"
        )

    def clock(name: str) -> str:
        return f"CAST({name} AS TIME)"

    def stage(name: str, *steps: dict[str, str], status: str | None = None, drop=(), refs=(), prefix="") -> None:
        """Projection steps over an input; ``refs`` are (table, key, {column: source})
        joined before the last step."""
        table, columns = BANK[name]
        text = select(columns, table)
        known = list(columns)
        if status:
            text = f"SELECT * FROM ({text}) WHERE {status} <> 'INVALID'"
        for i, step in enumerate(steps):
            if i == len(steps) - 1:
                for table_name, key, taken in refs:
                    ref = select({key[0]: key[1], **taken}, f"({REFERENCES[table_name]})")
                    text = f"SELECT * FROM ({text}) LEFT JOIN ({ref}) USING ({key[0]})"
                    known += [c for c in taken if c not in known]
            merged = {c: step.get(c, c) for c in known} | {c: t for c, t in step.items() if c not in known}
            text = select(merged, f"({text})")
            known = list(merged)
        final = {c: c for c in known if c not in drop} | {"dbt_created_at": today}
        book.add(f"{prefix}stg_{name}", final, f"({text})")

    def boundaries(unit: str, start: str) -> str:
        return f"CAST(date_diff('{unit}', {start}, {today}) AS INTEGER)"

    completed = {
        "age": years("date_of_birth"),
        "relationship_years": years("customer_since_date"),
        "relationship_month_part": months("customer_since_date", today),
    }
    by_calendar = {
        "age": boundaries("year", "date_of_birth"),
        "relationship_years": boundaries("year", "customer_since_date"),
        "relationship_month_part": boundaries("month", "customer_since_date"),
    }
    for prefix, ages in (("alt_", by_calendar), ("", completed)):
        stage(
            "customers_360",
            {
                "first_name": title("first_name"),
                "last_name": title("last_name"),
                "email_address": "lower(email_address)",
                **ages,
                **upper("gender", "customer_status"),
            },
            {
                "full_name": "concat(first_name, ' ', last_name)",
                **cases(
                    age_cohort_id=R.AGE_COHORT,
                    income_bracket_id=R.INCOME_BRACKET,
                    credit_score_range_id=R.CREDIT_RANGE,
                    risk_category_id=R.RISK_CATEGORY,
                    lifecycle_stage_id=R.LIFECYCLE_STAGE,
                    customer_value_segment=R.VALUE_SEGMENT,
                ),
                **truths(R.CUSTOMER_FLAGS),
            },
            {},
            status="customer_status",
            drop=("relationship_month_part",),
            refs=(
                (
                    "age_cohorts",
                    ("age_cohort_id", "cohort_id"),
                    {"age_cohort_name": "cohort_name", "age_cohort_characteristics": "characteristics"},
                ),
                (
                    "income_brackets",
                    ("income_bracket_id", "bracket_id"),
                    {"income_bracket_name": "bracket_name", "income_marketing_priority": "marketing_priority"},
                ),
                (
                    "credit_score_ranges",
                    ("credit_score_range_id", "score_range_id"),
                    {"credit_score_range_name": "range_name", "credit_grade": "grade", "expected_default_rate": "default_rate"},
                ),
                (
                    "risk_categories",
                    ("risk_category_id", "risk_category_id"),
                    {"risk_level": "risk_level", "risk_name": "risk_name", "risk_monitoring_frequency": "monitoring_frequency"},
                ),
                (
                    "lifecycle_stages",
                    ("lifecycle_stage_id", "stage_id"),
                    {"lifecycle_stage_name": "stage_name", "lifecycle_characteristics": "characteristics"},
                ),
            ),
            prefix=prefix,
        )
    expense = "CAST(average_balance * annual_interest_rate AS DOUBLE) / 12"
    stage(
        "accounts",
        {
            **upper("account_status"),
            "annual_interest_rate": "CAST(interest_rate * 0.01 AS DECIMAL(10,4))",
            "is_active": "closed_date IS NULL",
            "account_age_years": f"COALESCE({years('opened_date', f'COALESCE(closed_date, {today})')}, 0)",
        },
        {
            **cases(
                balance_tier=R.BALANCE_TIER,
                relationship_tenure=R.ACCOUNT_TENURE,
                digital_adoption_level=R.ACCOUNT_DIGITAL,
                risk_status=R.ACCOUNT_RISK,
                service_tier=R.SERVICE_TIER,
                cross_sell_score=R.ACCOUNT_CROSS_SELL,
            ),
            **truths(R.ACCOUNT_FLAGS),
            "monthly_interest_expense": expense,
            "monthly_fee_revenue": "monthly_fee",
            "monthly_net_revenue": f"CAST(monthly_fee AS DOUBLE) - {expense}",
        },
        status="account_status",
        drop=("interest_rate",),
        refs=(
            (
                "product_catalog",
                ("product_id", "product_id"),
                {
                    "product_name": "product_name",
                    "product_type": "product_type",
                    "product_category": "category",
                    "product_min_balance": "min_balance",
                    "product_risk_level": "risk_level",
                },
            ),
        ),
    )
    stage(
        "transactions",
        {
            **upper("transaction_type", "transaction_status", "channel"),
            "transaction_date": "CAST(transaction_datetime AS DATE)",
            "transaction_hour": "date_part('hour', transaction_datetime)",
            "day_of_week": "date_part('dow', transaction_datetime)",
            "amount_category": case(R.TRANSACTION_SIZE),
        },
        {
            **cases(
                channel_category=R.CHANNEL_GROUP,
                time_category=time_of_day("transaction_hour"),
                day_category=R.DAY_KIND,
                flow_direction=R.FLOW,
            ),
            **truths(R.TRANSACTION_FLAGS),
        },
        {"risk_score": case(R.TRANSACTION_RISK)},
        status="transaction_status",
    )
    stage(
        "deposits",
        {
            "deposit_hour": "date_part('hour', deposit_datetime)",
            "day_of_week": "date_part('dow', deposit_datetime)",
            **cases(amount_category=R.DEPOSIT_SIZE, channel_type=R.DEPOSIT_CHANNEL),
        },
    )
    stage(
        "withdrawals",
        {"withdrawal_hour": "date_part('hour', withdrawal_datetime)", "amount_category": case(R.WITHDRAWAL_SIZE)},
    )
    stage("fees", cases(fee_category=R.FEE_SIZE, fee_classification=R.FEE_CLASS))
    stage("account_balances", {"balance_category": case(R.DAILY_BALANCE)})
    used = pct("current_balance", "credit_limit", 2)
    stage(
        "cards",
        {
            **upper("card_type", "card_brand", "card_status"),
            "utilization_rate": f"CASE WHEN current_balance > 0 THEN {used} ELSE 0 END",
            "is_expired": truth(f"expiry_date < {today}"),
            "card_age_years": years("issue_date"),
            "available_credit": "CASE WHEN credit_limit > 0 THEN credit_limit - current_balance END",
        },
        {
            **cases(
                utilization_category=R.CARD_UTILISATION,
                risk_score=R.CARD_RISK,
                digital_feature_level=R.CARD_DIGITAL,
                card_tier=R.CARD_TIER,
                tenure_category=R.CARD_TENURE,
            ),
            **truths(R.CARD_FLAGS),
        },
        status="card_status",
    )
    repaid = pct("original_amount - current_balance", "original_amount", 2)
    stage(
        "loans",
        {
            **upper("loan_type", "loan_status"),
            "principal_paid": "original_amount - current_balance",
            "interest_rate": "round(interest_rate, 2)",
            "loan_age_years": years("origination_date"),
            "percent_paid": f"CASE WHEN current_balance > 0 AND original_amount > 0 THEN {repaid} ELSE 100 END",
            "estimated_months_remaining": f"CASE WHEN maturity_date IS NOT NULL THEN {months(today, 'maturity_date')}"
            f" ELSE term_months - {years('origination_date')} * 12 END",
        },
        {
            **cases(
                delinquency_bucket=R.LOAN_DELINQUENCY,
                risk_score=R.LOAN_RISK,
                payment_performance=R.LOAN_PERFORMANCE,
                loan_size_category=R.LOAN_SIZE,
                rate_competitiveness=R.LOAN_RATE,
                tenure_category=R.LOAN_TENURE,
            ),
            **truths(R.LOAN_FLAGS),
        },
        status="loan_status",
    )
    stage(
        "investments",
        {
            **upper("investment_type", "symbol", "account_type", "risk_rating"),
            "purchase_value": "round(quantity * purchase_price, 2)",
            "current_value": "round(quantity * current_price, 2)",
            "unrealized_gain_loss": "round(quantity * current_price - quantity * purchase_price, 2)",
            "return_percent": pct("current_price - purchase_price", "purchase_price", 2),
            "holding_years": years("purchase_date"),
        },
        {
            **cases(
                asset_class=R.ASSET_CLASS,
                performance_category=R.PERFORMANCE,
                holding_size=R.HOLDING_SIZE,
                tax_status=R.TAX_STATUS,
                risk_return_profile=R.RISK_RETURN,
                liquidity_level=R.LIQUIDITY,
                tenure_category=R.HOLDING_TENURE,
            ),
            **truths(R.HOLDING_FLAGS),
        },
    )
    rate = pct("annual_premium", "coverage_amount", 4)
    stage(
        "insurance_policies",
        {
            "policy_end_date": "policy_start_date + INTERVAL 1 YEAR",
            "policy_age_years": years("policy_start_date"),
            "claims_category": case(R.CLAIMS),
            "premium_rate_percent": f"CASE WHEN annual_premium > 0 THEN {rate} ELSE 0 END",
        },
    )
    stage(
        "customer_addresses",
        {
            "full_address": "concat_ws(', ', concat_ws(' ', street_address, unit_number), city,"
            " concat(state_code, ' ', postal_code))",
            "is_current": "address_until IS NULL",
            "years_at_address": f"COALESCE({years('address_since', f'COALESCE(address_until, {today})')}, 0)",
            **upper("address_type", "state_code", "address_status"),
            "street_address": title("street_address"),
            "unit_number": title("unit_number"),
            "city": title("city"),
        },
        {
            **cases(
                cost_of_living_category=R.LIVING_COST,
                address_stability=R.ADDRESS_STABILITY,
                address_quality_score=R.ADDRESS_QUALITY,
            ),
            **truths(R.ADDRESS_FLAGS),
        },
        status="address_status",
        refs=(
            (
                "geographic_regions",
                ("state_code", "state_code"),
                {
                    c: c
                    for c in ("state_name", "region_name", "market_type", "cost_of_living_index", "population_density")
                },
            ),
        ),
    )
    stage(
        "customer_phones",
        {
            **upper("phone_type", "phone_status"),
            "formatted_phone": "concat(area_code, '-', exchange, '-', line_number)",
            "phone_digits_only": "concat(area_code, exchange, line_number)",
            "is_valid_format": case(R.PHONE_FORMAT),
            "contact_window_hours": f"date_diff('minute', {clock('preferred_contact_start')}, {clock('preferred_contact_end')}) // 60",
        },
        {
            **truths(R.PHONE_FLAGS),
            **cases(phone_quality_score=R.PHONE_QUALITY, preferred_contact_method=R.CONTACT_METHOD),
        },
        truths(R.PHONE_MARKETING_FLAGS),
        status="phone_status",
    )
    stage(
        "customer_interactions",
        {
            **upper("interaction_type", "reason_code", "status", "priority", "agent_tier"),
            "interaction_date": "CAST(interaction_datetime AS DATE)",
            "interaction_hour": "date_part('hour', interaction_datetime)",
            "day_of_week": "date_part('dow', interaction_datetime)",
            "duration_category": case(R.DURATION),
        },
        {
            **cases(
                channel_category=R.CONTACT_CHANNEL,
                time_category=time_of_day("interaction_hour"),
                day_category=R.DAY_KIND,
                customer_effort=R.EFFORT,
                satisfaction_category=R.SATISFACTION,
                resolution_type=R.RESOLUTION,
                complexity_level=R.COMPLEXITY,
            ),
            **truths(R.INTERACTION_FLAGS),
        },
        status="status",
    )
    stage("marketing_campaigns", cases(engagement_level=R.CAMPAIGN_ENGAGEMENT, channel_type=R.CAMPAIGN_CHANNEL))
    stage("credit_scores", {"score_category": case(R.BUREAU_SCORE)})
    stage("risk_assessments", {"score_category": case(R.ASSESSMENT_SCORE)})
    for name in BANK:
        if f"stg_{name}" not in book.queries:
            stage(name)
