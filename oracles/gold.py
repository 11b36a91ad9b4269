"""Check queries of the executive summaries: each section on its own, stacked."""

from __future__ import annotations

from oracles.fixed_rules import gold as R
from oracles.text import (
    Book,
    case,
    literal,
    mean,
    mean_of_means,
    n,
    quotient,
    real,
    rounded,
    select,
    share,
    total,
    truncated,
)

VALUE = "total_relationship_value"


def stacked(sections: list[tuple[dict[str, str], str]]) -> tuple[str, list[str]]:
    """UNION ALL of sections; a column a section lacks is NULL there."""
    names = list(dict.fromkeys(name for columns, _ in sections for name in columns))
    texts = [select({name: columns.get(name, "NULL") for name in names}, source) for columns, source in sections]
    return " UNION ALL ".join(texts), names


def build(book: Book, as_of: str = "2024-02-01") -> None:
    stamps = {"report_date": f"DATE '{as_of}'", "last_updated": f"CAST('{as_of}' AS TIMESTAMP)"}

    def report(name: str, section_column: str, sections: list[tuple[str, dict[str, str], str]], *reads: str) -> None:
        text, names = stacked(
            [({section_column: literal(label), **stamps, **columns}, source) for label, columns, source in sections]
        )
        book.add_text(name, text, names, reads)

    def as_named(*names: str) -> dict[str, str]:
        return {name: name for name in names}

    # Executive dashboard and segmentation share one join.
    book.add_text(
        "_health",
        "SELECT cp.customer_id, cp.customer_value_segment, cp.lifecycle_stage_name, cp.engagement_level,"
        " cp.at_risk_customer, cp.digital_preference, cp.age, cp.relationship_years,"
        " fs.total_relationship_value, fs.product_penetration_score, fs.wealth_tier, fs.financial_risk_level,"
        " rp.overall_risk_level, rp.compliance_status, rp.composite_risk_score, rp.requires_immediate_review,"
        " ce.digital_adoption_score, ce.channel_diversity_score, ce.channel_preference, ce.service_satisfaction_score,"
        " ra.churn_risk_score, ra.retention_opportunity_score, ra.retention_lifecycle_stage, ra.retention_priority,"
        " pp.cross_sell_opportunity_score, pp.product_stickiness_score, pp.marketing_responsiveness"
        " FROM int_customer_profile cp"
        " LEFT JOIN int_customer_financial_summary fs ON fs.customer_id = cp.customer_id"
        " LEFT JOIN int_comprehensive_risk_profile rp ON rp.customer_id = cp.customer_id"
        " LEFT JOIN int_channel_effectiveness ce ON ce.customer_id = cp.customer_id"
        " LEFT JOIN int_customer_retention_analytics ra ON ra.customer_id = cp.customer_id"
        " LEFT JOIN int_product_penetration_analysis pp ON pp.customer_id = cp.customer_id",
        [],
        (
            "int_customer_profile",
            "int_customer_financial_summary",
            "int_comprehensive_risk_profile",
            "int_channel_effectiveness",
            "int_customer_retention_analytics",
            "int_product_penetration_analysis",
        ),
    )
    whole = select(
        {
            "total_customers": "count(*)",
            "high_value_customers": n("customer_value_segment = 'High Value'"),
            "wealth_management_customers": n(R.WEALTHY),
            "highly_engaged_customers": n("engagement_level = 'HIGHLY_ENGAGED'"),
            "total_customer_assets": f"sum({VALUE})",
            "avg_relationship_value": mean(VALUE),
            "private_banking_assets": total(VALUE, "wealth_tier = 'PRIVATE_BANKING'"),
            "avg_penetration": "avg(product_penetration_score)",
            "high_risk_customers": n(R.HIGH_RISK),
            "non_compliant_customers": n(R.NON_COMPLIANT),
            "customers_needing_review": n("requires_immediate_review"),
            "avg_risk": mean_of_means("composite_risk_score"),
            "digital_preferred_customers": n(R.DIGITAL_FIRST),
            "avg_digital_adoption": mean_of_means("digital_adoption_score"),
            "omni_channel_customers": n("channel_preference = 'OMNI_CHANNEL'"),
            "high_churn_risk_customers": n("churn_risk_score >= 70"),
            "critical_retention_cases": n("retention_priority = 'CRITICAL'"),
            "high_cross_sell_opportunities": n("cross_sell_opportunity_score >= 75"),
            "avg_opportunity": "avg(retention_opportunity_score)",
            "avg_satisfaction": mean_of_means("service_satisfaction_score"),
            "highly_satisfied_customers": n("service_satisfaction_score >= 4"),
            "dissatisfied_customers": n("service_satisfaction_score <= 2"),
        },
        "_health",
    )
    per_segment = select(
        {
            "customer_value_segment": "customer_value_segment",
            "total_customers": "count(*)",
            "high_value_percentage": share("count(*)", "sum(count(*)) OVER ()"),
            "total_customer_assets": f"sum({VALUE})",
            "avg_relationship_value": mean(VALUE),
            "avg_product_penetration": "avg(product_penetration_score)",
            "avg_digital_score": mean_of_means("digital_adoption_score"),
            "churn_risk_rate": "avg(churn_risk_score)",
            "retention_actions_required": n("at_risk_customer"),
            "high_cross_sell_opportunities": n("cross_sell_opportunity_score >= 75"),
        },
        "_health",
        "WHERE customer_value_segment IS NOT NULL GROUP BY customer_value_segment",
    )
    report(
        "executive_customer_dashboard",
        "dashboard_section",
        [
            (
                "EXECUTIVE_SUMMARY",
                {
                    **as_named(
                        *(
                            "total_customers high_value_customers wealth_management_customers highly_engaged_customers"
                            " total_customer_assets avg_relationship_value private_banking_assets high_risk_customers"
                            " non_compliant_customers customers_needing_review digital_preferred_customers"
                            " omni_channel_customers high_churn_risk_customers critical_retention_cases"
                            " high_cross_sell_opportunities highly_satisfied_customers dissatisfied_customers"
                        ).split()
                    ),
                    "high_value_percentage": share("high_value_customers", "total_customers"),
                    "engagement_rate": share("highly_engaged_customers", "total_customers"),
                    "private_banking_share": share("private_banking_assets", "total_customer_assets"),
                    "avg_product_penetration": rounded("avg_penetration", 1),
                    "high_risk_percentage": share("high_risk_customers", "total_customers"),
                    "avg_risk_score": rounded("avg_risk", 0),
                    "digital_adoption_rate": share("digital_preferred_customers", "total_customers"),
                    "avg_digital_score": rounded("avg_digital_adoption", 1),
                    "churn_risk_rate": share("high_churn_risk_customers", "total_customers"),
                    "avg_retention_opportunity": rounded("avg_opportunity", 1),
                    "avg_service_satisfaction": rounded("avg_satisfaction", 2),
                    "satisfaction_rate": share("highly_satisfied_customers", "total_customers"),
                    "portfolio_health": case(R.PORTFOLIO_HEALTH),
                    "digital_maturity": case(R.DIGITAL_MATURITY),
                    "risk_profile_status": case(R.RISK_STATUS),
                    "immediate_actions_required": "customers_needing_review",
                    "retention_actions_required": "critical_retention_cases",
                    "growth_opportunities_available": "high_cross_sell_opportunities",
                },
                f"({whole})",
            ),
            (
                "SEGMENT_PERFORMANCE",
                {
                    **as_named(
                        *(
                            "total_customers high_value_percentage total_customer_assets avg_relationship_value"
                            " avg_product_penetration avg_digital_score churn_risk_rate high_cross_sell_opportunities"
                            " retention_actions_required"
                        ).split()
                    ),
                    "portfolio_health": case(R.SEGMENT_HEALTH),
                    "growth_opportunities_available": "high_cross_sell_opportunities",
                },
                f"({per_segment})",
            ),
        ],
        "_health",
    )

    # Group-bys published on their own
    def side(name: str, keys: str, columns: dict[str, str], source: str, read: str) -> None:
        key_list = keys.split()
        where = " AND ".join(f"{key} IS NOT NULL" for key in key_list)
        book.add(
            name,
            {**as_named(*key_list), **columns},
            source,
            f"WHERE {where} GROUP BY {', '.join(key_list)}",
            (read,),
        )

    side(
        "risk_heatmap",
        "overall_risk_level financial_risk_level",
        {
            "customer_count": "count(*)",
            "assets_at_risk": real(f"sum({VALUE})"),
            "avg_risk_score": rounded(mean_of_means("composite_risk_score"), 4),
            "immediate_action_required": n("requires_immediate_review"),
        },
        "_health",
        "_health",
    )
    side(
        "retention_insights",
        "retention_lifecycle_stage",
        {
            "customer_count": "count(*)",
            "revenue_at_risk": real(f"sum({VALUE})"),
            "avg_churn_risk": "avg(churn_risk_score)",
            "avg_retention_opportunity": "avg(retention_opportunity_score)",
            "priority_actions_needed": n(R.PRIORITY_RETENTION),
        },
        "_health",
        "_health",
    )
    adoption = {
        "avg_channel_diversity": "avg(channel_diversity_score)",
        "avg_satisfaction": rounded(mean_of_means("service_satisfaction_score"), 4),
    }
    side(
        "digital_transformation_metrics",
        "digital_preference channel_preference",
        {
            "customer_count": "count(*)",
            "avg_digital_adoption": rounded(mean_of_means("digital_adoption_score"), 4),
            **adoption,
            "segment_value": real(f"sum({VALUE})"),
        },
        "_health",
        "_health",
    )
    side(
        "digital_preference_segments",
        "digital_preference channel_preference",
        {
            "customer_count": "count(*)",
            "avg_digital_score": rounded(mean_of_means("digital_adoption_score"), 4),
            **adoption,
            "avg_customer_value": mean(VALUE),
            "marketing_response_rate": share(n(R.RESPONSIVE), "count(*)"),
        },
        "_health",
        "_health",
    )

    # Segmentation
    segments = select(
        {
            "customer_value_segment": "customer_value_segment",
            "segment_customer_count": "count(*)",
            "segment_share_percentage": share("count(*)", "sum(count(*)) OVER ()"),
            "segment_total_value": f"sum({VALUE})",
            "avg_value": mean(VALUE),
            "segment_value_share_pct": share(f"sum({VALUE})", f"sum(sum({VALUE})) OVER ()"),
            "avg_age": "avg(age)",
            "avg_tenure": "avg(relationship_years)",
            "highly_engaged_count": n("engagement_level = 'HIGHLY_ENGAGED'"),
            "avg_satisfaction": mean_of_means("service_satisfaction_score"),
            "avg_digital_adoption": mean_of_means("digital_adoption_score"),
            "digital_preferred_customers": n(R.DIGITAL_FIRST),
            "digital_adoption_rate_pct": share(n(R.DIGITAL_FIRST), "count(*)"),
            "avg_penetration": "avg(product_penetration_score)",
            "avg_cross_sell": "avg(cross_sell_opportunity_score)",
            "high_cross_sell_customers": n("cross_sell_opportunity_score >= 75"),
            "avg_stickiness": mean_of_means("product_stickiness_score"),
            "highly_responsive_customers": n("marketing_responsiveness = 'HIGHLY_RESPONSIVE'"),
            "moderately_responsive_customers": n("marketing_responsiveness = 'MODERATELY_RESPONSIVE'"),
            "marketing_response_rate_pct": share(n(R.RESPONSIVE), "count(*)"),
            "avg_churn_risk": "avg(churn_risk_score)",
            "avg_retention_opportunity": "avg(retention_opportunity_score)",
            "critical_retention_cases": n(R.PRIORITY_RETENTION),
            "high_churn_risk_customers": n("churn_risk_score >= 70"),
            "high_risk_customers": n(R.HIGH_RISK),
        },
        "_health",
        "WHERE customer_value_segment IS NOT NULL GROUP BY customer_value_segment",
    )
    stages = select(
        {
            "customer_value_segment": "lifecycle_stage_name",
            "segment_customer_count": "count(*)",
            "avg_value": mean(VALUE),
            "avg_penetration": "avg(product_penetration_score)",
            "avg_digital_adoption": mean_of_means("digital_adoption_score"),
            "avg_churn_risk": "avg(churn_risk_score)",
            "high_cross_sell_customers": n("cross_sell_opportunity_score >= 75"),
            "engagement_rate_pct": share(n("engagement_level = 'HIGHLY_ENGAGED'"), "count(*)"),
        },
        "_health",
        "WHERE lifecycle_stage_name IS NOT NULL GROUP BY lifecycle_stage_name",
    )
    in_both = {
        **as_named("customer_value_segment", "segment_customer_count", "high_cross_sell_customers"),
        "avg_customer_value": rounded("avg_value", 0),
        "avg_digital_adoption_score": rounded("avg_digital_adoption", 1),
        "avg_product_penetration_score": rounded("avg_penetration", 1),
        "avg_churn_risk_score": rounded("avg_churn_risk", 1),
    }
    value = real("segment_total_value")
    report(
        "customer_segmentation_analysis",
        "analysis_section",
        [
            (
                "SEGMENT_OVERVIEW",
                {
                    **in_both,
                    **as_named(
                        *(
                            "segment_share_percentage segment_total_value segment_value_share_pct highly_engaged_count"
                            " digital_preferred_customers digital_adoption_rate_pct highly_responsive_customers"
                            " moderately_responsive_customers marketing_response_rate_pct high_churn_risk_customers"
                            " critical_retention_cases high_risk_customers"
                        ).split()
                    ),
                    "avg_customer_age": rounded("avg_age", 1),
                    "avg_relationship_years": rounded("avg_tenure", 1),
                    "engagement_rate_pct": share("highly_engaged_count", "segment_customer_count"),
                    "avg_satisfaction_score": rounded("avg_satisfaction", 2),
                    "avg_cross_sell_score": rounded("avg_cross_sell", 1),
                    "avg_product_stickiness_score": rounded("avg_stickiness", 1),
                    "avg_retention_opportunity_score": rounded("avg_retention_opportunity", 1),
                    "segment_strategic_importance": case(R.SEGMENT_IMPORTANCE),
                    "marketing_effectiveness": case(R.MARKETABILITY),
                    "digital_strategy_classification": case(R.DIGITAL_STRATEGY),
                    "retention_strategy_classification": case(R.RETENTION_CLASS),
                    "recommended_marketing_action": case(R.MARKETING_ACTION),
                    "satisfaction_value_index": rounded(f"avg_satisfaction * {value} / 1000000", 2),
                    "growth_potential_index": rounded("avg_cross_sell * segment_customer_count / 100", 0),
                    "retention_value_index": rounded(f"avg_retention_opportunity * {value} / 10000000", 2),
                    "marketing_responsive_base": rounded(
                        f"{real('marketing_response_rate_pct')} / 100 * segment_customer_count", 0
                    ),
                    "risk_adjusted_segment_value": rounded(
                        f"(100 - COALESCE(avg_churn_risk, 0)) / 100 * {value}", 0
                    ),
                },
                f"({segments})",
            ),
            (
                "LIFECYCLE_ANALYSIS",
                {
                    **in_both,
                    "engagement_rate_pct": "engagement_rate_pct",
                    "segment_strategic_importance": "'LIFECYCLE_STAGE'",
                },
                f"({stages})",
            ),
        ],
        "_health",
    )

    # Product performance: one row per customer and account, as the report counts them.
    kinds = " + ".join(
        f"COALESCE(CAST(fs.{kind} > 0 AS INTEGER), 0)"
        for kind in ("total_deposit_accounts", "total_cards", "total_loans", "total_investments")
    )
    book.add_text(
        "_product_customers",
        "SELECT pp.customer_id, pp.product_penetration_score, pp.digital_adoption_level,"
        " pp.cross_sell_opportunity_score, pp.product_stickiness_score, pp.next_best_product,"
        " cp.customer_value_segment, cp.digital_preference, fs.total_relationship_value, fs.total_deposit_accounts,"
        f" fs.total_cards, fs.total_loans, fs.total_investments, {kinds} AS kinds_held,"
        " ap.account_profitability_score, ce.channel_preference, ce.service_satisfaction_score"
        " FROM int_product_penetration_analysis pp"
        " LEFT JOIN int_customer_profile cp ON cp.customer_id = pp.customer_id"
        " LEFT JOIN int_customer_financial_summary fs ON fs.customer_id = pp.customer_id"
        " LEFT JOIN int_account_performance_dashboard ap ON ap.customer_id = pp.customer_id"
        " LEFT JOIN int_channel_effectiveness ce ON ce.customer_id = pp.customer_id",
        [],
        (
            "int_product_penetration_analysis",
            "int_customer_profile",
            "int_customer_financial_summary",
            "int_account_performance_dashboard",
            "int_channel_effectiveness",
        ),
    )
    owners = {
        "deposit": "total_deposit_accounts > 0",
        "card": "total_cards > 0",
        "loan": "total_loans > 0",
        "investment": "total_investments > 0",
    }
    rates = {f"{kind}_penetration_rate": share(n(holds), "count(*)") for kind, holds in owners.items()}
    scores = {
        "avg_product_penetration_score": rounded("avg(product_penetration_score)", 1),
        "avg_cross_sell_opportunity_score": rounded("avg(cross_sell_opportunity_score)", 1),
        "avg_product_stickiness_score": rounded(mean_of_means("product_stickiness_score"), 1),
        "avg_account_profitability_score": rounded("avg(account_profitability_score)", 1),
    }
    high = n("cross_sell_opportunity_score >= 75")
    portfolio = select(
        {
            "total_customers": "count(*)",
            "deposit_account_customers": n(owners["deposit"]),
            "card_customers": n(owners["card"]),
            "loan_customers": n(owners["loan"]),
            "investment_customers": n(owners["investment"]),
            **rates,
            **scores,
            "multi_product_customers": n("kinds_held >= 2"),
            "premium_product_customers": n("kinds_held >= 3"),
            "digital_native_customers": n("digital_adoption_level = 'DIGITAL_NATIVE'"),
            "digital_adopter_customers": n("digital_adoption_level = 'DIGITAL_ADOPTER'"),
            "digital_preferred_customers": n(R.DIGITAL_FIRST),
            "digital_first_rate": share(n(R.DIGITAL_FIRST), "count(*)"),
            "high_cross_sell_opportunity": high,
            "medium_cross_sell_opportunity": n("cross_sell_opportunity_score >= 50"),
            "total_product_portfolio_value": f"sum({VALUE})",
            "avg_value": mean(VALUE),
        },
        "_product_customers",
    )
    report(
        "product_performance_analytics",
        "analytics_section",
        [
            (
                "PRODUCT_PORTFOLIO_OVERVIEW",
                {
                    **as_named(
                        *(
                            "total_customers deposit_account_customers card_customers loan_customers"
                            " investment_customers multi_product_customers premium_product_customers"
                            " digital_native_customers digital_adopter_customers digital_preferred_customers"
                            " high_cross_sell_opportunity medium_cross_sell_opportunity total_product_portfolio_value"
                        ).split(),
                        *rates,
                        *scores,
                    ),
                    "multi_product_rate": share("multi_product_customers", "total_customers"),
                    "premium_product_rate": share("premium_product_customers", "total_customers"),
                    "digital_adoption_rate": "digital_first_rate",
                    "high_cross_sell_rate": share("high_cross_sell_opportunity", "total_customers"),
                    "avg_customer_relationship_value": rounded("avg_value", 0),
                    "cross_sell_performance_status": case(R.CROSS_SELL_STATUS),
                    "digital_product_maturity": case(R.PRODUCT_DIGITAL_MATURITY),
                    "wealth_product_performance": case(R.WEALTH_PRODUCTS),
                    "recommended_product_strategy": case(R.PRODUCT_STRATEGY),
                    "priority_product_focus": case(R.PRODUCT_FOCUS),
                },
                f"({portfolio})",
            ),
            (
                "SEGMENT_PRODUCT_PERFORMANCE",
                {
                    "total_customers": "count(*)",
                    "deposit_account_customers": "count(*)",
                    **rates,
                    **scores,
                    "multi_product_rate": share(n("kinds_held >= 2"), "count(*)"),
                    "digital_adoption_rate": share(n(R.DIGITAL_READY), "count(*)"),
                    "high_cross_sell_opportunity": high,
                    "high_cross_sell_rate": share(high, "count(*)"),
                    "total_product_portfolio_value": f"sum({VALUE})",
                    "avg_customer_relationship_value": rounded(f"{real(f'sum({VALUE})')} / count(*)", 0),
                    "cross_sell_performance_status": case(R.SEGMENT_CROSS_SELL),
                },
                "_product_customers WHERE customer_value_segment IS NOT NULL GROUP BY customer_value_segment",
            ),
            (
                "NEXT_BEST_PRODUCT_OPPORTUNITIES",
                {
                    "total_customers": "count(*)",
                    "deposit_account_customers": "count(*)",
                    "avg_cross_sell_opportunity_score": scores["avg_cross_sell_opportunity_score"],
                    "digital_adoption_rate": share(n(R.DIGITAL_READY), "count(*)"),
                    "high_cross_sell_opportunity": n("customer_value_segment = 'High Value'"),
                    "total_product_portfolio_value": f"sum({VALUE})",
                    "avg_customer_relationship_value": rounded(mean(VALUE), 0),
                    "cross_sell_performance_status": "'NEXT_BEST_PRODUCT'",
                },
                "_product_customers WHERE next_best_product IS NOT NULL GROUP BY next_best_product",
            ),
        ],
        "_product_customers",
    )
    side(
        "channel_product_effectiveness",
        "channel_preference",
        {
            "customer_count": "count(*)",
            "avg_penetration_score": "avg(product_penetration_score)",
            "avg_cross_sell_score": "avg(cross_sell_opportunity_score)",
            "avg_satisfaction_score": rounded(mean_of_means("service_satisfaction_score"), 4),
            "channel_total_value": real(f"sum({VALUE})"),
            "high_cross_sell_customers": high,
        },
        "_product_customers",
        "_product_customers",
    )

    # Financial summary
    factor = f"CAST({case(R.RISK_FACTOR)} AS DECIMAL(3,1))"
    accounts = select(
        {
            "total_accounts": "count(DISTINCT account_id)",
            "total_customers": "count(DISTINCT customer_id)",
            "aum": "sum(current_balance)",
            "avg_balance": mean("current_balance"),
            "private_aum": total("current_balance", "customer_wealth_tier = 'PRIVATE_BANKING'"),
            "investment_assets": total("current_balance", "product_type = 'INVESTMENT'"),
            "fee_revenue": "sum(monthly_fee * 12)",
            "net_revenue": "sum(monthly_fee * 12 - current_balance * annual_interest_rate)",
            "fee_income": "sum(total_fees_paid)",
            "avg_profitability": "avg(account_profitability_score)",
            "volume": "sum(total_transaction_volume)",
            "avg_health": "avg(account_health_score)",
            "healthy_value": total("current_balance", "account_health_score >= 80"),
            "risk_adjusted": f"sum(current_balance * {factor})",
            "avg_factor": mean(factor),
            "active_accounts": n("total_transactions > 0"),
            "dormant_accounts": n("total_transactions = 0 AND account_age_years > 1"),
        },
        "int_account_performance_dashboard",
    )
    customers = select(
        {
            "high_value_customers": n("cp.customer_value_segment = 'High Value'"),
            "avg_customer_value": mean(VALUE),
            "private_value": total(VALUE, "wealth_tier = 'PRIVATE_BANKING'"),
            "wealth_value": total(VALUE, "wealth_tier = 'WEALTH_MANAGEMENT'"),
            "avg_product_penetration": "avg(fs.product_penetration_score)",
            "avg_accounts": "avg(total_deposit_accounts)",
            "high_cross_sell": n("cross_sell_opportunity_score >= 75"),
            "avg_cross_sell": "avg(cross_sell_opportunity_score)",
            "avg_tenure": "avg(relationship_years)",
            "highly_engaged_customers": n("engagement_level = 'HIGHLY_ENGAGED'"),
        },
        "int_customer_financial_summary fs"
        " LEFT JOIN int_product_penetration_analysis pp ON pp.customer_id = fs.customer_id"
        " LEFT JOIN int_customer_profile cp ON cp.customer_id = fs.customer_id",
    )
    facts = (
        f"SELECT *, {quotient('net_revenue', 'aum')} * 100 AS net_revenue_yield,"
        f" {quotient('healthy_value', 'aum')} * 100 AS healthy_assets,"
        f" {truncated('active_accounts', 'total_accounts')} AS activation_rate,"
        f" {truncated('dormant_accounts', 'total_accounts')} AS dormancy_rate"
        f" FROM ({accounts}) AS a CROSS JOIN ({customers}) AS c"
    )
    sums = {
        "total_aum": "aum",
        "private_banking_aum": "private_aum",
        "investment_aum": "investment_assets",
        "annual_net_revenue": "net_revenue",
        "annual_fee_revenue": "fee_revenue",
        "transaction_fee_income": "fee_income",
        "private_banking_customer_value": "private_value",
        "wealth_management_customer_value": "wealth_value",
    }
    report(
        "financial_performance_summary",
        "dashboard_section",
        [
            (
                "FINANCIAL_OVERVIEW",
                {
                    **as_named("total_customers", "total_accounts", "high_value_customers", "highly_engaged_customers"),
                    **{name: real(f"round({source}, 0)") for name, source in sums.items()},
                    "avg_account_balance": rounded("avg_balance", 0),
                    "revenue_per_customer": rounded(quotient("net_revenue", "total_customers"), 0),
                    "fee_revenue_per_account": rounded(quotient("fee_revenue", "total_accounts"), 0),
                    "avg_account_profitability_score": rounded("avg_profitability", 1),
                    "avg_account_health_score": rounded("avg_health", 1),
                    "healthy_assets_percentage": rounded("healthy_assets", 1),
                    "account_activation_rate": "activation_rate",
                    "risk_adjusted_assets_pct": rounded(f"{quotient('risk_adjusted', 'aum')} * 100", 1),
                    "avg_risk_adjustment_factor": rounded("avg_factor", 2),
                    "account_dormancy_rate": "dormancy_rate",
                    "dormant_accounts_count": "dormant_accounts",
                    "avg_customer_relationship_value": rounded("avg_customer_value", 0),
                    "avg_product_penetration_score": rounded("avg_product_penetration", 1),
                    "avg_accounts_per_customer": rounded("avg_accounts", 1),
                    "high_cross_sell_customers": "high_cross_sell",
                    "avg_cross_sell_opportunity_score": rounded("avg_cross_sell", 1),
                    "net_revenue_yield_pct": rounded("net_revenue_yield", 2),
                    "fee_rate_on_transaction_volume": rounded(f"{quotient('fee_income', 'volume')} * 100", 4),
                    "private_banking_share_pct": rounded(f"{quotient('private_aum', 'aum')} * 100", 1),
                    "avg_relationship_years": rounded("avg_tenure", 1),
                    "portfolio_yield_assessment": case(R.YIELD),
                    "portfolio_health_status": case(R.ASSET_HEALTH),
                    "cross_sell_performance": case(R.CROSS_SELL),
                    "dormant_accounts_requiring_attention": "dormant_accounts",
                    "cross_sell_opportunities_available": "high_cross_sell",
                    "recommended_action": case(R.FINANCIAL_ACTION),
                },
                f"({facts})",
            )
        ],
        "int_account_performance_dashboard",
        "int_customer_financial_summary",
        "int_product_penetration_analysis",
        "int_customer_profile",
    )

    # Risk dashboard
    book.add_text(
        "_risk_customers",
        "SELECT rp.*, cp.customer_value_segment, fs.total_relationship_value, fs.wealth_tier"
        " FROM int_comprehensive_risk_profile rp"
        " LEFT JOIN int_customer_profile cp ON cp.customer_id = rp.customer_id"
        " LEFT JOIN int_customer_financial_summary fs ON fs.customer_id = rp.customer_id",
        [],
        ("int_comprehensive_risk_profile", "int_customer_profile", "int_customer_financial_summary"),
    )
    overview = select(
        {
            "total_customers": "count(*)",
            "total_portfolio_value": f"sum({VALUE})",
            "critical_risk_customers": n("overall_risk_level = 'CRITICAL_RISK'"),
            "high_risk_customers": n("overall_risk_level = 'HIGH_RISK'"),
            "critical_risk_assets": total(VALUE, "overall_risk_level = 'CRITICAL_RISK'"),
            "high_risk_assets": total(VALUE, "overall_risk_level = 'HIGH_RISK'"),
            "high_risk_portfolio_value": total(VALUE, R.HIGH_RISK),
            "high_value_customers_at_risk_assets": total(
                VALUE, f"customer_value_segment = 'High Value' AND {R.HIGH_RISK}"
            ),
            "non_compliant_customers": n("compliance_status = 'NON_COMPLIANT'"),
            "compliance_review_required": n("compliance_status = 'REVIEW_REQUIRED'"),
            "pending_verification": n("compliance_status = 'PENDING_VERIFICATION'"),
            "compliant_customers": n("compliance_status = 'COMPLIANT'"),
            "immediate_review_required": n("requires_immediate_review"),
            "enhanced_monitoring_required": n("requires_enhanced_monitoring"),
            "total_fraud_alerts": "sum(total_fraud_alerts)",
            "customers_with_fraud_alerts": n("total_fraud_alerts > 0"),
            "high_fraud_alert_customers": n("total_fraud_alerts >= 3"),
            "deteriorating_risk_customers": n("risk_trend = 'DETERIORATING'"),
            "volatile_risk_customers": n("risk_trend = 'VOLATILE'"),
            "avg_composite_risk_score": rounded(mean_of_means("composite_risk_score"), 0),
            "avg_credit_risk_score": rounded("avg(current_credit_risk_score)", 0),
            "avg_fraud_risk_score": rounded("avg(current_fraud_risk_score)", 0),
        },
        "_risk_customers",
    )
    steps = {
        "risk_actions": "immediate_review_required + enhanced_monitoring_required",
        "compliance_actions": "non_compliant_customers + compliance_review_required",
        "concentration": f"{quotient('high_risk_portfolio_value', 'total_portfolio_value')} * 100",
        "high_value_exposure": f"{quotient('high_value_customers_at_risk_assets', 'total_portfolio_value')} * 100",
        "critical_rate": truncated("critical_risk_customers", "total_customers"),
        "non_compliance_rate": truncated("non_compliant_customers", "total_customers"),
        "deteriorating_rate": truncated("deteriorating_risk_customers", "total_customers"),
        "volatile_rate": truncated("volatile_risk_customers", "total_customers"),
        "fraud_rate": truncated("customers_with_fraud_alerts", "total_customers"),
    }
    tiers = select(
        {
            "wealth_tier": "wealth_tier",
            "total_customers": "count(*)",
            "total_portfolio_value": f"sum({VALUE})",
            "at_high_risk": n(R.HIGH_RISK),
            "risky_assets": total(VALUE, R.HIGH_RISK),
            "avg_composite": mean_of_means("composite_risk_score"),
            "immediate_actions": n("requires_immediate_review"),
            "compliance_issues": n(R.NON_COMPLIANT),
        },
        "_risk_customers",
        "WHERE wealth_tier IS NOT NULL GROUP BY wealth_tier",
    )
    report(
        "risk_management_dashboard",
        "dashboard_section",
        [
            (
                "RISK_OVERVIEW",
                {
                    **as_named(
                        *(
                            "total_customers total_portfolio_value critical_risk_customers high_risk_customers"
                            " critical_risk_assets high_risk_assets high_risk_portfolio_value"
                            " high_value_customers_at_risk_assets non_compliant_customers compliance_review_required"
                            " pending_verification compliant_customers immediate_review_required"
                            " enhanced_monitoring_required total_fraud_alerts customers_with_fraud_alerts"
                            " high_fraud_alert_customers deteriorating_risk_customers volatile_risk_customers"
                            " avg_composite_risk_score avg_credit_risk_score avg_fraud_risk_score"
                        ).split()
                    ),
                    "critical_risk_customer_percentage": real("critical_rate"),
                    "high_risk_asset_concentration_pct": rounded("concentration", 1),
                    "non_compliance_rate_pct": real("non_compliance_rate"),
                    "total_risk_actions_required": "risk_actions",
                    "total_compliance_actions": "compliance_actions",
                    "avg_fraud_alerts_per_customer": rounded(quotient("total_fraud_alerts", "total_customers"), 2),
                    "customers_with_fraud_percentage": "fraud_rate",
                    "deteriorating_risk_rate_pct": "deteriorating_rate",
                    "volatile_risk_rate_pct": "volatile_rate",
                    "portfolio_risk_status": case(R.PORTFOLIO_RISK),
                    "compliance_health_status": case(R.COMPLIANCE_HEALTH),
                    "fraud_risk_environment": case(R.FRAUD_CLIMATE),
                    "recommended_action": case(R.RISK_ACTION),
                    "regulatory_status": case(R.REGULATORY),
                },
                "(SELECT *, " + ", ".join(f"{text} AS {name}" for name, text in steps.items()) + f" FROM ({overview}))",
            ),
            (
                "WEALTH_TIER_RISK_BREAKDOWN",
                {
                    **as_named("total_customers", "total_portfolio_value"),
                    "critical_risk_customers": "at_high_risk",
                    "critical_risk_customer_percentage": share("at_high_risk", "total_customers"),
                    "high_risk_asset_concentration_pct": rounded(
                        f"{quotient('risky_assets', 'total_portfolio_value')} * 100", 1
                    ),
                    "high_risk_assets": "risky_assets",
                    "non_compliant_customers": "compliance_issues",
                    "non_compliance_rate_pct": share("compliance_issues", "total_customers"),
                    "immediate_review_required": "immediate_actions",
                    "avg_composite_risk_score": rounded("avg_composite", 0),
                    "portfolio_risk_status": case(R.TIER_RISK),
                },
                f"({tiers})",
            ),
        ],
        "_risk_customers",
    )
