"""Executive summaries over the roll-ups.

Each report joins one-row-per-customer roll-ups, which all share their partitioning,
and reduces them to a few rows with map-side partial aggregation. Totals and group
rows of a report come out of one pass over the join (grouping sets).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from brightledger.functions.scoring import (
    choice,
    literal,
    mean,
    mean_of_means,
    n_if,
    named,
    ratio,
    share_pct,
    sum_if,
    truncated_pct,
)
from brightledger.operators.keyed import left_align, total_of
from brightledger.operators.sections import one_row, totals_and_groups
from brightledger.params import RunParams
from brightledger.rules import gold as R
from brightledger.rules.base import Rules

CUSTOMER = "customer_id"
VALUE = "total_relationship_value"


def _is(section: str) -> str:
    return f"section = {literal(section)}"


def _only(section: str, same: Iterable[str] = (), **texts: str) -> list[Column]:
    """Columns filled in one section and NULL in the others; ``same`` keep their name."""
    texts = {name: name for name in same} | texts
    return named(**{name: f"CASE WHEN {_is(section)} THEN {text} END" for name, text in texts.items()})


def _both(section: str, **texts: tuple[str, str]) -> list[Column]:
    """Columns with one meaning in ``section`` and another elsewhere."""
    return named(
        **{name: f"CASE WHEN {_is(section)} THEN {here} ELSE {there} END" for name, (here, there) in texts.items()}
    )


def _over_report(facts: DataFrame, section: str, measure: str) -> Column:
    """Sum over a section's rows, however many labels it has."""
    return total_of(facts.where(_is(section)), measure)


# --- executive dashboard -----------------------------------------------------
def customer_health(
    profile_core: DataFrame,
    customer_financial_summary: DataFrame,
    comprehensive_risk_profile: DataFrame,
    channel_effectiveness: DataFrame,
    customer_retention_analytics: DataFrame,
    product_penetration_analysis: DataFrame,
) -> DataFrame:
    return left_align(
        profile_core.select(
            CUSTOMER,
            "customer_value_segment",
            "lifecycle_stage_name",
            "engagement_level",
            "at_risk_customer",
            "digital_preference",
            "age",
            "relationship_years",
        ),
        [
            customer_financial_summary.select(
                CUSTOMER, VALUE, "product_penetration_score", "wealth_tier", "financial_risk_level"
            ),
            comprehensive_risk_profile.select(
                CUSTOMER,
                "overall_risk_level",
                "compliance_status",
                "composite_risk_score",
                "requires_immediate_review",
            ),
            channel_effectiveness.select(
                CUSTOMER,
                "digital_adoption_score",
                "channel_diversity_score",
                "channel_preference",
                "service_satisfaction_score",
            ),
            customer_retention_analytics.select(
                CUSTOMER,
                "churn_risk_score",
                "retention_opportunity_score",
                "retention_lifecycle_stage",
                "retention_priority",
            ),
            product_penetration_analysis.select(
                CUSTOMER, "cross_sell_opportunity_score", "product_stickiness_score", "marketing_responsiveness"
            ),
        ],
        CUSTOMER,
    )


def executive_customer_dashboard(p: RunParams, customer_health: DataFrame) -> DataFrame:
    total, segment = "EXECUTIVE_SUMMARY", "SEGMENT_PERFORMANCE"
    facts = totals_and_groups(
        customer_health,
        [[], ["customer_value_segment"]],
        [total, segment],
        named(
            total_customers="count(*)",
            high_value_customers=n_if("customer_value_segment = 'High Value'"),
            wealth_management_customers=n_if(R.WEALTHY),
            highly_engaged_customers=n_if("engagement_level = 'HIGHLY_ENGAGED'"),
            at_risk_count=n_if("at_risk_customer"),
            total_customer_assets=f"sum({VALUE})",
            avg_relationship_value=mean(VALUE),
            private_banking_assets=sum_if("wealth_tier = 'PRIVATE_BANKING'", VALUE),
            avg_penetration="avg(product_penetration_score)",
            high_risk_customers=n_if(R.HIGH_RISK),
            non_compliant_customers=n_if(R.NON_COMPLIANT),
            customers_needing_review=n_if("requires_immediate_review"),
            avg_risk=mean_of_means("composite_risk_score"),
            digital_preferred_customers=n_if(R.DIGITAL_FIRST),
            avg_digital_adoption=mean_of_means("digital_adoption_score"),
            omni_channel_customers=n_if("channel_preference = 'OMNI_CHANNEL'"),
            high_churn_risk_customers=n_if("churn_risk_score >= 70"),
            avg_churn="avg(churn_risk_score)",
            critical_retention_cases=n_if("retention_priority = 'CRITICAL'"),
            high_cross_sell_opportunities=n_if("cross_sell_opportunity_score >= 75"),
            avg_opportunity="avg(retention_opportunity_score)",
            avg_satisfaction=mean_of_means("service_satisfaction_score"),
            highly_satisfied_customers=n_if("service_satisfaction_score >= 4"),
            dissatisfied_customers=n_if("service_satisfaction_score <= 2"),
        ),
    )
    # The segments add up to the customers that have one, which may be fewer than all.
    facts = facts.select("*", *named(in_segments=_over_report(facts, segment, "total_customers")))
    return facts.select(
        F.col("section").alias("dashboard_section"),
        p.today.alias("report_date"),
        "total_customers",
        "total_customer_assets",
        "avg_relationship_value",
        "high_cross_sell_opportunities",
        *_only(
            total,
            (
                "high_value_customers",
                "wealth_management_customers",
                "highly_engaged_customers",
                "private_banking_assets",
                "high_risk_customers",
                "non_compliant_customers",
                "customers_needing_review",
                "digital_preferred_customers",
                "omni_channel_customers",
                "high_churn_risk_customers",
                "critical_retention_cases",
                "highly_satisfied_customers",
                "dissatisfied_customers",
            ),
            engagement_rate=share_pct("highly_engaged_customers", "total_customers"),
            private_banking_share=share_pct("private_banking_assets", "total_customer_assets"),
            high_risk_percentage=share_pct("high_risk_customers", "total_customers"),
            avg_risk_score="round(avg_risk, 0)",
            digital_adoption_rate=share_pct("digital_preferred_customers", "total_customers"),
            avg_retention_opportunity="round(avg_opportunity, 1)",
            avg_service_satisfaction="round(avg_satisfaction, 2)",
            satisfaction_rate=share_pct("highly_satisfied_customers", "total_customers"),
            digital_maturity=choice(R.DIGITAL_MATURITY),
            risk_profile_status=choice(R.RISK_STATUS),
            immediate_actions_required="customers_needing_review",
        ),
        *_both(
            total,
            high_value_percentage=(
                share_pct("high_value_customers", "total_customers"),
                share_pct("total_customers", "in_segments"),
            ),
            avg_product_penetration=("round(avg_penetration, 1)", "avg_penetration"),
            avg_digital_score=("round(avg_digital_adoption, 1)", "avg_digital_adoption"),
            churn_risk_rate=(share_pct("high_churn_risk_customers", "total_customers"), "avg_churn"),
            portfolio_health=(choice(R.PORTFOLIO_HEALTH), choice(R.SEGMENT_HEALTH)),
            retention_actions_required=("critical_retention_cases", "at_risk_count"),
        ),
        *named(growth_opportunities_available="high_cross_sell_opportunities", last_updated=p.stamp),
    ).orderBy("dashboard_section", F.desc_nulls_last("high_value_percentage"))


def risk_heatmap(health: DataFrame) -> DataFrame:
    return (
        health.where("overall_risk_level IS NOT NULL AND financial_risk_level IS NOT NULL")
        .groupBy("overall_risk_level", "financial_risk_level")
        .agg(
            *named(
                customer_count="count(*)",
                assets_at_risk=f"sum({VALUE})",
                avg_risk_score=f"round({mean_of_means('composite_risk_score')}, 4)",
                immediate_action_required=n_if("requires_immediate_review"),
            )
        )
    )


def retention_insights(health: DataFrame) -> DataFrame:
    return (
        health.where("retention_lifecycle_stage IS NOT NULL")
        .groupBy("retention_lifecycle_stage")
        .agg(
            *named(
                customer_count="count(*)",
                revenue_at_risk=f"sum({VALUE})",
                avg_churn_risk="avg(churn_risk_score)",
                avg_retention_opportunity="avg(retention_opportunity_score)",
                priority_actions_needed=n_if(R.PRIORITY_RETENTION),
            )
        )
    )


def _by_preference(health: DataFrame):
    keys = ("digital_preference", "channel_preference")
    return health.where(" AND ".join(f"{key} IS NOT NULL" for key in keys)).groupBy(*keys)


def digital_transformation_metrics(health: DataFrame) -> DataFrame:
    return _by_preference(health).agg(
        *named(
            customer_count="count(*)",
            avg_digital_adoption=f"round({mean_of_means('digital_adoption_score')}, 4)",
            avg_channel_diversity="avg(channel_diversity_score)",
            avg_satisfaction=f"round({mean_of_means('service_satisfaction_score')}, 4)",
            segment_value=f"sum({VALUE})",
        )
    )


def digital_preference_segments(health: DataFrame) -> DataFrame:
    return _by_preference(health).agg(
        *named(
            customer_count="count(*)",
            avg_digital_score=f"round({mean_of_means('digital_adoption_score')}, 4)",
            avg_channel_diversity="avg(channel_diversity_score)",
            avg_satisfaction=f"round({mean_of_means('service_satisfaction_score')}, 4)",
            avg_customer_value=mean(VALUE),
            marketing_response_rate=share_pct(n_if(R.RESPONSIVE), "count(*)"),
        )
    )


# --- segmentation ------------------------------------------------------------
def customer_segmentation_analysis(p: RunParams, customer_health: DataFrame) -> DataFrame:
    overview, lifecycle = "SEGMENT_OVERVIEW", "LIFECYCLE_ANALYSIS"
    facts = totals_and_groups(
        customer_health,
        [["customer_value_segment"], ["lifecycle_stage_name"]],
        [overview, lifecycle],
        named(
            segment_customer_count="count(*)",
            segment_total_value=f"sum({VALUE})",
            avg_value=mean(VALUE),
            avg_age="avg(age)",
            avg_tenure="avg(relationship_years)",
            highly_engaged_count=n_if("engagement_level = 'HIGHLY_ENGAGED'"),
            avg_satisfaction=mean_of_means("service_satisfaction_score"),
            avg_digital_adoption=mean_of_means("digital_adoption_score"),
            digital_preferred_customers=n_if(R.DIGITAL_FIRST),
            avg_penetration="avg(product_penetration_score)",
            avg_cross_sell="avg(cross_sell_opportunity_score)",
            high_cross_sell_customers=n_if("cross_sell_opportunity_score >= 75"),
            avg_stickiness=mean_of_means("product_stickiness_score"),
            highly_responsive_customers=n_if("marketing_responsiveness = 'HIGHLY_RESPONSIVE'"),
            moderately_responsive_customers=n_if("marketing_responsiveness = 'MODERATELY_RESPONSIVE'"),
            avg_churn_risk="avg(churn_risk_score)",
            avg_retention_opportunity="avg(retention_opportunity_score)",
            critical_retention_cases=n_if(R.PRIORITY_RETENTION),
            high_churn_risk_customers=n_if("churn_risk_score >= 70"),
            high_risk_customers=n_if(R.HIGH_RISK),
        ),
    )

    facts = facts.select(
        "*",
        *named(
            all_customers=_over_report(facts, overview, "segment_customer_count"),
            all_value=_over_report(facts, overview, "segment_total_value"),
            marketing_response_rate_pct=share_pct(
                "highly_responsive_customers + moderately_responsive_customers", "segment_customer_count"
            ),
            digital_adoption_rate_pct=share_pct("digital_preferred_customers", "segment_customer_count"),
        ),
    )
    facts = facts.select("*", *named(segment_value_share_pct=share_pct("segment_total_value", "all_value")))
    value = "CAST(segment_total_value AS DOUBLE)"
    return facts.select(
        F.col("section").alias("analysis_section"),
        p.today.alias("report_date"),
        *named(customer_value_segment="coalesce(customer_value_segment, lifecycle_stage_name)"),
        "segment_customer_count",
        "high_cross_sell_customers",
        *named(
            avg_customer_value="round(avg_value, 0)",
            engagement_rate_pct=share_pct("highly_engaged_count", "segment_customer_count"),
            avg_digital_adoption_score="round(avg_digital_adoption, 1)",
            avg_product_penetration_score="round(avg_penetration, 1)",
            avg_churn_risk_score="round(avg_churn_risk, 1)",
            segment_strategic_importance=f"CASE WHEN {_is(overview)} THEN {choice(R.SEGMENT_IMPORTANCE)}"
            " ELSE 'LIFECYCLE_STAGE' END",
        ),
        *_only(
            overview,
            (
                "segment_total_value",
                "segment_value_share_pct",
                "highly_engaged_count",
                "digital_preferred_customers",
                "digital_adoption_rate_pct",
                "highly_responsive_customers",
                "moderately_responsive_customers",
                "marketing_response_rate_pct",
                "high_churn_risk_customers",
                "critical_retention_cases",
                "high_risk_customers",
            ),
            segment_share_percentage=share_pct("segment_customer_count", "all_customers"),
            avg_customer_age="round(avg_age, 1)",
            avg_relationship_years="round(avg_tenure, 1)",
            avg_satisfaction_score="round(avg_satisfaction, 2)",
            avg_cross_sell_score="round(avg_cross_sell, 1)",
            avg_product_stickiness_score="round(avg_stickiness, 1)",
            avg_retention_opportunity_score="round(avg_retention_opportunity, 1)",
            marketing_effectiveness=choice(R.MARKETABILITY),
            digital_strategy_classification=choice(R.DIGITAL_STRATEGY),
            retention_strategy_classification=choice(R.RETENTION_CLASS),
            recommended_marketing_action=choice(R.MARKETING_ACTION),
            satisfaction_value_index=f"round(avg_satisfaction * {value} / 1000000, 2)",
            growth_potential_index="round(avg_cross_sell * segment_customer_count / 100, 0)",
            retention_value_index=f"round(avg_retention_opportunity * {value} / 10000000, 2)",
            marketing_responsive_base="round(marketing_response_rate_pct / 100 * segment_customer_count, 0)",
            risk_adjusted_segment_value=f"round((100 - coalesce(avg_churn_risk, 0D)) / 100 * {value}, 0)",
        ),
        p.stamp.alias("last_updated"),
    ).orderBy(
        "analysis_section",
        F.desc_nulls_last("segment_share_percentage"),
        F.desc_nulls_last("avg_customer_value"),
    )


# --- product performance -----------------------------------------------------
def product_customers(
    product_penetration_analysis: DataFrame,
    profile_core: DataFrame,
    customer_financial_summary: DataFrame,
    account_activity: DataFrame,
) -> DataFrame:
    """Customers with the weight they carry in the product report.

    The report counts a customer once per account (once if there is none). Instead of
    repeating the customer's row per account, which would pile up all rows of a large
    owner in one task, the accounts are reduced to a weight first and every measure
    is weighted.
    """
    owned = account_activity.groupBy(CUSTOMER).agg(
        *named(
            accounts="count(*)",
            profitability_sum="sum(account_profitability_score)",
            profitability_count="count(account_profitability_score)",
        )
    )
    return left_align(
        product_penetration_analysis.select(
            CUSTOMER,
            F.col("product_penetration_score").alias("penetration"),
            "digital_adoption_level",
            "cross_sell_opportunity_score",
            "product_stickiness_score",
            "next_best_product",
        ),
        [
            profile_core.select(CUSTOMER, "customer_value_segment", "digital_preference"),
            customer_financial_summary.select(
                CUSTOMER, VALUE, "total_deposit_accounts", "total_cards", "total_loans", "total_investments"
            ),
            owned,
        ],
        CUSTOMER,
    ).select(
        "*",
        *named(
            weight="coalesce(accounts, 1)",
            kinds_held=" + ".join(
                f"CAST(coalesce({kind}, 0) > 0 AS INT)"
                for kind in ("total_deposit_accounts", "total_cards", "total_loans", "total_investments")
            ),
        ),
    )


def _n(condition: str = "TRUE") -> str:
    return sum_if(condition, "weight")


def _weighted_sum(name: str) -> str:
    return f"sum({name} * weight)"


def _weighted_mean(name: str, exact: str) -> str:
    return ratio(f"sum(CAST({name} AS {exact}) * weight)", _n(f"{name} IS NOT NULL"))


def product_performance_analytics(
    p: RunParams,
    product_penetration_analysis: DataFrame,
    profile_core: DataFrame,
    customer_financial_summary: DataFrame,
    account_activity: DataFrame,
) -> DataFrame:
    customers = product_customers(
        product_penetration_analysis,
        profile_core,
        customer_financial_summary,
        account_activity,
    )
    total, by_segment, by_product = (
        "PRODUCT_PORTFOLIO_OVERVIEW",
        "SEGMENT_PRODUCT_PERFORMANCE",
        "NEXT_BEST_PRODUCT_OPPORTUNITIES",
    )
    facts = totals_and_groups(
        customers,
        [[], ["customer_value_segment"], ["next_best_product"]],
        [total, by_segment, by_product],
        named(
            total_customers=_n(),
            deposit_customers=_n("total_deposit_accounts > 0"),
            card_customers=_n("total_cards > 0"),
            loan_customers=_n("total_loans > 0"),
            investment_customers=_n("total_investments > 0"),
            multi_product_customers=_n("kinds_held >= 2"),
            premium_product_customers=_n("kinds_held >= 3"),
            avg_penetration=_weighted_mean("penetration", "decimal(12,0)"),
            avg_cross_sell=_weighted_mean("cross_sell_opportunity_score", "decimal(12,0)"),
            avg_stickiness=_weighted_mean("product_stickiness_score", "decimal(18,9)"),
            avg_profitability=ratio("sum(profitability_sum)", "sum(profitability_count)"),
            digital_native_customers=_n("digital_adoption_level = 'DIGITAL_NATIVE'"),
            digital_adopter_customers=_n("digital_adoption_level = 'DIGITAL_ADOPTER'"),
            digital_preferred_customers=_n(R.DIGITAL_FIRST),
            high_cross_sell_opportunity=_n("cross_sell_opportunity_score >= 75"),
            medium_cross_sell_opportunity=_n("cross_sell_opportunity_score >= 50"),
            total_product_portfolio_value=_weighted_sum(VALUE),
            valued_customers=_n(f"{VALUE} IS NOT NULL"),
            high_value_opportunities=_n("customer_value_segment = 'High Value'"),
        ),
    )
    kinds = ("deposit", "card", "loan", "investment")
    facts = facts.select(
        "*",
        *named(
            **{f"{kind}_penetration_rate": share_pct(f"{kind}_customers", "total_customers") for kind in kinds},
            digital_first_rate=share_pct("digital_preferred_customers", "total_customers"),
            digital_ready_rate=share_pct("digital_native_customers + digital_adopter_customers", "total_customers"),
            avg_value=ratio("total_product_portfolio_value", "valued_customers"),
        ),
    )

    def not_product(text: str) -> str:
        return f"CASE WHEN NOT {_is(by_product)} THEN {text} END"

    per_head = ratio("total_product_portfolio_value", "total_customers")
    return facts.select(
        F.col("section").alias("analytics_section"),
        p.today.alias("report_date"),
        "total_customers",
        "total_product_portfolio_value",
        *_only(
            total,
            (
                "card_customers",
                "loan_customers",
                "investment_customers",
                "multi_product_customers",
                "premium_product_customers",
                "digital_native_customers",
                "digital_adopter_customers",
                "digital_preferred_customers",
                "medium_cross_sell_opportunity",
            ),
            premium_product_rate=share_pct("premium_product_customers", "total_customers"),
            digital_product_maturity=choice(R.PRODUCT_DIGITAL_MATURITY),
            wealth_product_performance=choice(R.WEALTH_PRODUCTS),
            recommended_product_strategy=choice(R.PRODUCT_STRATEGY),
            priority_product_focus=choice(R.PRODUCT_FOCUS),
        ),
        *_both(
            total,
            deposit_account_customers=("deposit_customers", "total_customers"),
            digital_adoption_rate=("digital_first_rate", "digital_ready_rate"),
        ),
        *_both(
            by_product,
            high_cross_sell_opportunity=("high_value_opportunities", "high_cross_sell_opportunity"),
        ),
        *named(
            **{f"{kind}_penetration_rate": not_product(f"{kind}_penetration_rate") for kind in kinds},
            multi_product_rate=not_product(share_pct("multi_product_customers", "total_customers")),
            avg_product_penetration_score=not_product("round(avg_penetration, 1)"),
            avg_cross_sell_opportunity_score="round(avg_cross_sell, 1)",
            avg_product_stickiness_score=not_product("round(avg_stickiness, 1)"),
            avg_account_profitability_score=not_product("round(avg_profitability, 1)"),
            high_cross_sell_rate=not_product(share_pct("high_cross_sell_opportunity", "total_customers")),
            avg_customer_relationship_value=f"round(CASE WHEN {_is(by_segment)} THEN {per_head} ELSE avg_value END, 0)",
            cross_sell_performance_status=f"CASE WHEN {_is(total)} THEN {choice(R.CROSS_SELL_STATUS)}"
            f" WHEN {_is(by_segment)} THEN {choice(R.SEGMENT_CROSS_SELL)} ELSE 'NEXT_BEST_PRODUCT' END",
            last_updated=p.stamp,
        ),
    ).orderBy("analytics_section", F.desc_nulls_last("deposit_penetration_rate"))


def channel_product_effectiveness(
    product_penetration_analysis: DataFrame,
    profile_core: DataFrame,
    customer_financial_summary: DataFrame,
    account_activity: DataFrame,
    channel_effectiveness: DataFrame,
) -> DataFrame:
    customers = product_customers(
        product_penetration_analysis, profile_core, customer_financial_summary, account_activity
    )
    channels = channel_effectiveness.select(CUSTOMER, "channel_preference", "service_satisfaction_score")
    return (
        customers.join(channels, CUSTOMER, "left")
        .where("channel_preference IS NOT NULL")
        .groupBy("channel_preference")
        .agg(
            *named(
                customer_count=_n(),
                avg_penetration_score=_weighted_mean("penetration", "decimal(12,0)"),
                avg_cross_sell_score=_weighted_mean("cross_sell_opportunity_score", "decimal(12,0)"),
                avg_satisfaction_score=f"round({_weighted_mean('service_satisfaction_score', 'decimal(18,9)')}, 4)",
                channel_total_value=_weighted_sum(VALUE),
                high_cross_sell_customers=_n("cross_sell_opportunity_score >= 75"),
            )
        )
    )


# --- financial summary -------------------------------------------------------
@dataclass(frozen=True)
class FinanceRules:
    """The rules of the financial summary that differ by profile: how much of a balance its
    owner's risk leaves, the account column that tells private banking, and the tiers."""

    risk_factor: Rules
    account_tier: str
    private: str
    wealth: str


def financial_performance_summary(
    p: RunParams,
    account_performance_dashboard: DataFrame,
    customer_financial_summary: DataFrame,
    product_penetration_analysis: DataFrame,
    profile_core: DataFrame,
) -> DataFrame:
    return financial_overview(
        p,
        FinanceRules(R.RISK_FACTOR, "customer_wealth_tier", "PRIVATE_BANKING", "WEALTH_MANAGEMENT"),
        account_performance_dashboard,
        customer_financial_summary,
        product_penetration_analysis,
        profile_core,
    )


def financial_overview(
    p: RunParams,
    finance_rules: FinanceRules,
    account_performance_dashboard: DataFrame,
    customer_financial_summary: DataFrame,
    product_penetration_analysis: DataFrame,
    profile_core: DataFrame,
) -> DataFrame:
    factor = f"CAST({choice(finance_rules.risk_factor)} AS DECIMAL(3,1))"
    accounts = account_performance_dashboard.select(
        "account_id",
        CUSTOMER,
        "product_type",
        "account_age_years",
        "current_balance",
        "account_profitability_score",
        "account_health_score",
        "total_transactions",
        "total_transaction_volume",
        "total_fees_paid",
        *named(
            account_tier=finance_rules.account_tier,
            annual_fee="monthly_fee * 12",
            annual_net="monthly_fee * 12 - current_balance * annual_interest_rate",
            risk_factor=factor,
            risk_adjusted=f"current_balance * {factor}",
        ),
    )
    portfolio = accounts.agg(
        *named(
            aum="sum(current_balance)",
            avg_balance=mean("current_balance"),
            private_aum=sum_if(f"account_tier = {literal(finance_rules.private)}", "current_balance"),
            investment_assets=sum_if("product_type = 'INVESTMENT'", "current_balance"),
            fee_revenue="sum(annual_fee)",
            net_revenue="sum(annual_net)",
            fee_income="sum(total_fees_paid)",
            avg_profitability="avg(account_profitability_score)",
            volume="sum(total_transaction_volume)",
            avg_health="avg(account_health_score)",
            healthy_value=sum_if("account_health_score >= 80", "current_balance"),
            risk_adjusted="sum(risk_adjusted)",
            avg_factor=mean("risk_factor"),
            active_accounts=n_if("total_transactions > 0"),
            dormant_accounts=n_if("total_transactions = 0 AND account_age_years > 1"),
        )
    )
    owners = left_align(
        customer_financial_summary.select(
            CUSTOMER, VALUE, "wealth_tier", "product_penetration_score", "total_deposit_accounts"
        ),
        [
            product_penetration_analysis.select(CUSTOMER, "cross_sell_opportunity_score"),
            profile_core.select(CUSTOMER, "customer_value_segment", "engagement_level", "relationship_years"),
        ],
        CUSTOMER,
    ).agg(
        *named(
            high_value_customers=n_if("customer_value_segment = 'High Value'"),
            avg_customer_value=mean(VALUE),
            private_value=sum_if(f"wealth_tier = {literal(finance_rules.private)}", VALUE),
            wealth_value=sum_if(f"wealth_tier = {literal(finance_rules.wealth)}", VALUE),
            avg_product_penetration="avg(product_penetration_score)",
            avg_accounts="avg(total_deposit_accounts)",
            high_cross_sell=n_if("cross_sell_opportunity_score >= 75"),
            avg_cross_sell="avg(cross_sell_opportunity_score)",
            avg_tenure="avg(relationship_years)",
            highly_engaged_customers=n_if("engagement_level = 'HIGHLY_ENGAGED'"),
        )
    )
    # An account may stand in several rows, one per version of its owner's profile; ids are
    # made distinct on their own, so that no account row is repeated for it.
    counts = [
        accounts.select(F.col(key).alias("id")).distinct().agg(F.count("id").alias(name))
        for key, name in (("account_id", "total_accounts"), (CUSTOMER, "total_customers"))
    ]
    facts = one_row(portfolio, *counts, owners).select(
        "*",
        *named(
            net_revenue_yield=f"{ratio('net_revenue', 'aum')} * 100",
            healthy_assets=f"{ratio('healthy_value', 'aum')} * 100",
            activation_rate=truncated_pct("active_accounts", "total_accounts"),
            dormancy_rate=truncated_pct("dormant_accounts", "total_accounts"),
        ),
    )

    def whole(name: str) -> str:
        return f"round({name}, 0)"

    def per(part: str, base: str, digits: int, factor: str = "") -> str:
        return f"round({ratio(part, base)}{factor}, {digits})"

    return facts.select(
        F.lit("FINANCIAL_OVERVIEW").alias("dashboard_section"),
        p.today.alias("report_date"),
        "total_customers",
        "total_accounts",
        "high_value_customers",
        "highly_engaged_customers",
        *named(
            total_aum=whole("aum"),
            avg_account_balance=whole("avg_balance"),
            private_banking_aum=whole("private_aum"),
            investment_aum=whole("investment_assets"),
            annual_net_revenue=whole("net_revenue"),
            annual_fee_revenue=whole("fee_revenue"),
            transaction_fee_income=whole("fee_income"),
            revenue_per_customer=per("net_revenue", "total_customers", 0),
            fee_revenue_per_account=per("fee_revenue", "total_accounts", 0),
            avg_account_profitability_score="round(avg_profitability, 1)",
            avg_account_health_score="round(avg_health, 1)",
            healthy_assets_percentage="round(healthy_assets, 1)",
            account_activation_rate="CAST(activation_rate AS DOUBLE)",
            risk_adjusted_assets_pct=per("risk_adjusted", "aum", 1, " * 100"),
            avg_risk_adjustment_factor="round(avg_factor, 2)",
            account_dormancy_rate="CAST(dormancy_rate AS DOUBLE)",
            dormant_accounts_count="dormant_accounts",
            avg_customer_relationship_value=whole("avg_customer_value"),
            private_banking_customer_value=whole("private_value"),
            wealth_management_customer_value=whole("wealth_value"),
            avg_product_penetration_score="round(avg_product_penetration, 1)",
            avg_accounts_per_customer="round(avg_accounts, 1)",
            high_cross_sell_customers="high_cross_sell",
            avg_cross_sell_opportunity_score="round(avg_cross_sell, 1)",
            net_revenue_yield_pct="round(net_revenue_yield, 2)",
            fee_rate_on_transaction_volume=per("fee_income", "volume", 4, " * 100"),
            private_banking_share_pct=per("private_aum", "aum", 1, " * 100"),
            avg_relationship_years="round(avg_tenure, 1)",
            portfolio_yield_assessment=choice(R.YIELD),
            portfolio_health_status=choice(R.ASSET_HEALTH),
            cross_sell_performance=choice(R.CROSS_SELL),
            dormant_accounts_requiring_attention="dormant_accounts",
            cross_sell_opportunities_available="high_cross_sell",
            recommended_action=choice(R.FINANCIAL_ACTION),
            last_updated=p.stamp,
        ),
    )


# --- risk dashboard ----------------------------------------------------------
@dataclass(frozen=True)
class RiskRules:
    """The levels and compliance labels of the risk dashboard that differ by profile."""

    critical: str
    high: str
    at_high_risk: str
    non_compliant: str
    under_review: str
    unverified: str


def risk_management_dashboard(
    p: RunParams,
    comprehensive_risk_profile: DataFrame,
    customer_base: DataFrame,
    customer_financial_summary: DataFrame,
) -> DataFrame:
    main = RiskRules("CRITICAL_RISK", "HIGH_RISK", R.HIGH_RISK, "NON_COMPLIANT", "REVIEW_REQUIRED", "PENDING_VERIFICATION")
    return risk_overview(p, main, comprehensive_risk_profile, customer_base, customer_financial_summary)


def risk_overview(
    p: RunParams,
    risk_rules: RiskRules,
    comprehensive_risk_profile: DataFrame,
    customer_base: DataFrame,
    customer_financial_summary: DataFrame,
) -> DataFrame:
    customers = left_align(
        comprehensive_risk_profile.select(
            CUSTOMER,
            "overall_risk_level",
            "compliance_status",
            "composite_risk_score",
            "current_credit_risk_score",
            "current_fraud_risk_score",
            "total_fraud_alerts",
            "requires_enhanced_monitoring",
            "requires_immediate_review",
            "risk_trend",
        ),
        [
            customer_base.select(CUSTOMER, "customer_value_segment"),
            customer_financial_summary.select(CUSTOMER, VALUE, "wealth_tier"),
        ],
        CUSTOMER,
    )
    total, tier = "RISK_OVERVIEW", "WEALTH_TIER_RISK_BREAKDOWN"

    def level(name: str) -> str:
        return f"overall_risk_level = {literal(name)}"

    def status(name: str) -> str:
        return f"compliance_status = {literal(name)}"

    facts = totals_and_groups(
        customers,
        [[], ["wealth_tier"]],
        [total, tier],
        named(
            total_customers="count(*)",
            total_portfolio_value=f"sum({VALUE})",
            critical=n_if(level(risk_rules.critical)),
            high_risk_customers=n_if(level(risk_rules.high)),
            at_high_risk=n_if(risk_rules.at_high_risk),
            critical_risk_assets=sum_if(level(risk_rules.critical), VALUE),
            high_assets=sum_if(level(risk_rules.high), VALUE),
            high_risk_portfolio_value=sum_if(risk_rules.at_high_risk, VALUE),
            non_compliant=n_if(status(risk_rules.non_compliant)),
            compliance_issues=n_if(R.NON_COMPLIANT),
            compliance_review_required=n_if(status(risk_rules.under_review)),
            pending_verification=n_if(status(risk_rules.unverified)),
            compliant_customers=n_if(status("COMPLIANT")),
            immediate_review_required=n_if("requires_immediate_review"),
            enhanced_monitoring_required=n_if("requires_enhanced_monitoring"),
            total_fraud_alerts="sum(total_fraud_alerts)",
            customers_with_fraud_alerts=n_if("total_fraud_alerts > 0"),
            high_fraud_alert_customers=n_if("total_fraud_alerts >= 3"),
            volatile_risk_customers=n_if("risk_trend = 'VOLATILE'"),
            deteriorating_risk_customers=n_if("risk_trend = 'DETERIORATING'"),
            avg_composite=mean_of_means("composite_risk_score"),
            avg_credit="avg(current_credit_risk_score)",
            avg_fraud="avg(current_fraud_risk_score)",
            high_value_customers_at_risk_assets=sum_if(
                f"customer_value_segment = 'High Value' AND {risk_rules.at_high_risk}", VALUE
            ),
        ),
    )
    facts = facts.select(
        "*",
        *named(
            risk_actions="immediate_review_required + enhanced_monitoring_required",
            compliance_actions="non_compliant + compliance_review_required",
            concentration=f"{ratio('high_risk_portfolio_value', 'total_portfolio_value')} * 100",
            high_value_exposure=f"{ratio('high_value_customers_at_risk_assets', 'total_portfolio_value')} * 100",
            critical_rate=truncated_pct("critical", "total_customers"),
            non_compliance_rate=truncated_pct("non_compliant", "total_customers"),
            deteriorating_rate=truncated_pct("deteriorating_risk_customers", "total_customers"),
            volatile_rate=truncated_pct("volatile_risk_customers", "total_customers"),
            fraud_rate=truncated_pct("customers_with_fraud_alerts", "total_customers"),
        ),
    )
    return facts.select(
        F.col("section").alias("dashboard_section"),
        p.today.alias("report_date"),
        "total_customers",
        "total_portfolio_value",
        "immediate_review_required",
        *_both(
            total,
            critical_risk_customers=("critical", "at_high_risk"),
            critical_risk_customer_percentage=(
                "CAST(critical_rate AS DOUBLE)",
                share_pct("at_high_risk", "total_customers"),
            ),
            high_risk_assets=("high_assets", "high_risk_portfolio_value"),
            non_compliant_customers=("non_compliant", "compliance_issues"),
            non_compliance_rate_pct=(
                "CAST(non_compliance_rate AS DOUBLE)",
                share_pct("compliance_issues", "total_customers"),
            ),
            portfolio_risk_status=(choice(R.PORTFOLIO_RISK), choice(R.TIER_RISK)),
        ),
        *named(
            high_risk_asset_concentration_pct="round(concentration, 1)",
            avg_composite_risk_score="round(avg_composite, 0)",
        ),
        *_only(
            total,
            (
                "high_risk_customers",
                "critical_risk_assets",
                "high_risk_portfolio_value",
                "high_value_customers_at_risk_assets",
                "compliance_review_required",
                "pending_verification",
                "compliant_customers",
                "enhanced_monitoring_required",
                "total_fraud_alerts",
                "customers_with_fraud_alerts",
                "high_fraud_alert_customers",
                "deteriorating_risk_customers",
                "volatile_risk_customers",
            ),
            total_risk_actions_required="risk_actions",
            total_compliance_actions="compliance_actions",
            avg_fraud_alerts_per_customer=f"round({ratio('total_fraud_alerts', 'total_customers')}, 2)",
            customers_with_fraud_percentage="CAST(fraud_rate AS DOUBLE)",
            deteriorating_risk_rate_pct="CAST(deteriorating_rate AS DOUBLE)",
            volatile_risk_rate_pct="CAST(volatile_rate AS DOUBLE)",
            avg_credit_risk_score="round(avg_credit, 0)",
            avg_fraud_risk_score="round(avg_fraud, 0)",
            compliance_health_status=choice(R.COMPLIANCE_HEALTH),
            fraud_risk_environment=choice(R.FRAUD_CLIMATE),
            recommended_action=choice(R.RISK_ACTION),
            regulatory_status=choice(R.REGULATORY),
        ),
        p.stamp.alias("last_updated"),
    ).orderBy("dashboard_section", F.desc_nulls_last("critical_risk_customer_percentage"))


# What several reports read.
PARTS = {"customer_health": customer_health}

MODELS = {
    "executive_customer_dashboard": executive_customer_dashboard,
    "financial_performance_summary": financial_performance_summary,
    "customer_segmentation_analysis": customer_segmentation_analysis,
    "product_performance_analytics": product_performance_analytics,
    "risk_management_dashboard": risk_management_dashboard,
}
