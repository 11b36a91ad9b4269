"""Typed reference tables.

``load_reference`` reads a CSV under a fixed schema (no inference). The tables the
cleaning layer joins are also kept here as fixed values, a handful of rows each,
so that a run needs no extra files; ``builtin_reference`` turns them into local
relations whose size the optimizer knows, which is what lets it broadcast them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Schemas of the reference CSVs, by table.
SCHEMAS = {
    "age_cohorts": "cohort_id string, cohort_name string, birth_year_start int, birth_year_end int, "
    "age_range string, characteristics string, preferred_channels string",
    "channel_definitions": "channel_id string, channel_name string, channel_type string, description string, "
    "is_digital boolean, cost_per_interaction decimal(10,2), availability string",
    "compliance_rules": "rule_id string, rule_name string, rule_type string, threshold int, "
    "action_required string, severity_level string",
    "country_risk_ratings": "country_code string, country_name string, risk_rating string, "
    "economic_stability string, political_stability string, regulatory_environment string",
    "credit_score_ranges": "score_range_id string, range_name string, min_score int, max_score int, grade string, "
    "description string, typical_products string, default_rate decimal(6,2)",
    "currency_codes": "currency_code string, currency_name string, symbol string, decimal_places int, "
    "exchange_rate_usd decimal(18,4), is_major_currency boolean",
    "economic_indicators": "indicator_id string, indicator_name string, current_value decimal(18,2), unit string, "
    "trend string, impact_on_lending string",
    "fee_structures": "fee_id string, fee_name string, product_type string, fee_amount decimal(10,2), "
    "fee_type string, waiver_conditions string",
    "geographic_regions": "region_id string, state_code string, state_name string, region_name string, "
    "market_type string, cost_of_living_index decimal(6,1), population_density string",
    "holiday_calendars": "holiday_id string, holiday_name string, holiday_date date, is_bank_holiday boolean, "
    "affects_processing boolean, holiday_type string",
    "income_brackets": "bracket_id string, bracket_name string, min_income int, max_income int, "
    "percentile_range string, target_products string, marketing_priority string",
    "interest_rate_tiers": "tier_id string, product_type string, balance_min int, balance_max int, "
    "interest_rate decimal(6,2), tier_name string",
    "lifecycle_stages": "stage_id string, stage_name string, typical_duration_months int, next_stage string, "
    "characteristics string",
    "marketing_segments": "segment_id string, segment_name string, target_products string, age_range string, "
    "income_range string, priority_level string",
    "occupation_categories": "occupation_id string, category_name string, risk_level string, "
    "income_stability string, typical_income_range string, credit_risk_modifier decimal(6,2)",
    "product_catalog": "product_id string, product_name string, product_type string, category string, "
    "min_balance int, monthly_fee decimal(8,2), interest_rate decimal(6,2), risk_level string",
    "regulatory_requirements": "requirement_id string, regulation_name string, product_types string, "
    "threshold_amount int, reporting_frequency string, mandatory_fields string",
    "risk_categories": "risk_category_id string, risk_level int, risk_name string, score_min int, score_max int, "
    "description string, monitoring_frequency string, approval_required boolean",
    "service_level_agreements": "sla_id string, customer_tier string, response_time_hours decimal(6,1), "
    "resolution_time_hours int, availability_percentage decimal(6,2), dedicated_support boolean",
    "transaction_types": "transaction_type_id string, type_name string, category string, description string, "
    "is_debit boolean, risk_weight decimal(4,2), fee_applicable boolean",
    "raw_customers": "id bigint, first_name string, last_name string",
    "raw_orders": "id bigint, user_id bigint, order_date date, status string",
    "raw_payments": "id bigint, order_id bigint, payment_method string, amount bigint",
    "shop_customers": "customer_id bigint, first_name string, last_name string, email string",
    "shop_orders": "order_id bigint, customer_id bigint, order_date date, amount decimal(18,2), status string",
}

# Fixed values of the joined reference tables: the columns the cleaning layer uses.
FIXED_VALUES = {
    "age_cohorts": (
        ("cohort_id", "cohort_name", "characteristics"),
        [
            ("AC001", "Gen Z", "Digital native social conscious"),
            ("AC002", "Millennial", "Tech-savvy career-focused"),
            ("AC003", "Gen X", "Established families wealth-building"),
            ("AC004", "Baby Boomer", "Pre-retirement wealth preservation"),
            ("AC005", "Silent Generation", "Conservative fixed-income focused"),
            ("AC006", "Young Professional", "Career growth investment-focused"),
            ("AC007", "Mid-Career", "Peak earning family-focused"),
            ("AC008", "Pre-Retirement", "Wealth preservation planning"),
            ("AC009", "Retired", "Income preservation legacy planning"),
            ("AC010", "Young Adult", "Student early career"),
        ],
    ),
    "income_brackets": (
        ("bracket_id", "bracket_name", "marketing_priority"),
        [
            ("IB001", "Low Income", "Medium"),
            ("IB002", "Lower Middle", "High"),
            ("IB003", "Middle Income", "High"),
            ("IB004", "Upper Middle", "Very High"),
            ("IB005", "High Income", "Very High"),
            ("IB006", "Affluent", "Critical"),
            ("IB007", "High Net Worth", "Critical"),
            ("IB008", "Ultra High Net Worth", "Critical"),
            ("IB009", "Very Wealthy", "Critical"),
            ("IB010", "Ultra Wealthy", "Critical"),
        ],
    ),
    "credit_score_ranges": (
        ("score_range_id", "range_name", "grade", "default_rate"),
        [
            ("CSR001", "Exceptional", "A+", 0.5),
            ("CSR002", "Very Good", "A", 1.2),
            ("CSR003", "Good", "B+", 2.8),
            ("CSR004", "Fair", "B", 8.5),
            ("CSR005", "Poor", "C", 18.2),
            ("CSR006", "Very Poor", "D", 35.0),
            ("CSR007", "No Score", "N/A", 12.0),
            ("CSR008", "Thin File", "C-", 15.5),
            ("CSR009", "New Credit", "B", 6.2),
            ("CSR010", "Rebuilt Credit", "B-", 9.8),
        ],
    ),
    "risk_categories": (
        ("risk_category_id", "risk_level", "risk_name", "monitoring_frequency"),
        [
            ("RC001", 1, "Minimal Risk", "Annual"),
            ("RC002", 2, "Low Risk", "Semi-Annual"),
            ("RC003", 3, "Moderate Risk", "Quarterly"),
            ("RC004", 4, "Elevated Risk", "Monthly"),
            ("RC005", 5, "High Risk", "Weekly"),
            ("RC006", 6, "Severe Risk", "Daily"),
            ("RC007", 7, "Critical Risk", "Real-time"),
            ("RC008", 8, "Regulatory Watch", "Daily"),
            ("RC009", 9, "Sanctions Risk", "Real-time"),
            ("RC010", 10, "Fraud Alert", "Real-time"),
        ],
    ),
    "lifecycle_stages": (
        ("stage_id", "stage_name", "characteristics"),
        [
            ("LS001", "Prospect", "Potential customer showing interest"),
            ("LS002", "Onboarding", "Recently opened first account"),
            ("LS003", "New Customer", "Learning product features and usage"),
            ("LS004", "Growing", "Adding products and increasing usage"),
            ("LS005", "Established", "Stable relationship with multiple products"),
            ("LS006", "Mature", "Long-term customer with deep relationship"),
            ("LS007", "Loyal", "Highly satisfied advocating for bank"),
            ("LS008", "Champion", "Top tier customer with referrals"),
            ("LS009", "At Risk", "Declining usage or satisfaction"),
            ("LS010", "Dormant", "Inactive account minimal activity"),
        ],
    ),
    "product_catalog": (
        ("product_id", "product_name", "product_type", "category", "min_balance", "risk_level"),
        [
            ("CHCK001", "Basic Checking", "account", "banking", 0, "Low"),
            ("SAVE001", "High Yield Savings", "account", "banking", 1000, "Low"),
            ("CRDT001", "Platinum Credit Card", "credit_card", "lending", 0, "Medium"),
            ("LOAN001", "Personal Loan", "loan", "lending", 0, "Medium"),
            ("MORT001", "30-Year Fixed Mortgage", "mortgage", "lending", 0, "High"),
            ("INVT001", "Brokerage Account", "investment", "investments", 2500, "High"),
            ("INSUR001", "Auto Insurance", "insurance", "insurance", 0, "Low"),
            ("CD001", "12-Month CD", "certificate", "banking", 5000, "Low"),
            ("BUSI001", "Business Checking", "account", "commercial", 2500, "Medium"),
            ("CRED002", "Cash Back Credit Card", "credit_card", "lending", 0, "Medium"),
        ],
    ),
    "geographic_regions": (
        ("state_code", "state_name", "region_name", "market_type", "cost_of_living_index", "population_density"),
        [
            ("CA", "California", "West Coast", "Urban", 148.5, "High"),
            ("TX", "Texas", "Southwest", "Mixed", 95.2, "Medium"),
            ("NY", "New York", "Northeast", "Urban", 139.8, "High"),
            ("FL", "Florida", "Southeast", "Mixed", 102.3, "Medium"),
            ("IL", "Illinois", "Midwest", "Urban", 108.7, "High"),
            ("MT", "Montana", "Mountain West", "Rural", 98.1, "Low"),
            ("OH", "Ohio", "Midwest", "Mixed", 92.4, "Medium"),
            ("WA", "Washington", "Pacific Northwest", "Urban", 118.9, "Medium"),
            ("GA", "Georgia", "Southeast", "Mixed", 96.7, "Medium"),
            ("CO", "Colorado", "Mountain West", "Mixed", 104.8, "Medium"),
        ],
    ),
}


def values_sql(name: str) -> str:
    """The fixed rows of a reference table as a SELECT over VALUES."""
    columns, rows = FIXED_VALUES[name]
    text = ", ".join("(" + ", ".join(repr(value) for value in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {text}) AS fixed_rows({', '.join(columns)})"


def builtin_reference(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(values_sql(name))


class BuiltinReferences(Mapping[str, DataFrame]):
    """The fixed reference tables by name, made when first asked for. They are marked for
    broadcasting, being about ten rows each whatever the size of the bank; tables loaded from
    files are not."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def __getitem__(self, name: str) -> DataFrame:
        return F.broadcast(builtin_reference(self._spark, name))

    def __iter__(self) -> Iterator[str]:
        return iter(FIXED_VALUES)

    def __len__(self) -> int:
        return len(FIXED_VALUES)


class HeaderMismatch(ValueError):
    """A file whose header does not name the declared columns."""


def load_reference(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``folder/name.csv`` under its declared schema. The header decides which column is
    which: columns in another order are put right, a header with other names fails at once,
    and a malformed row, or a further file of the folder with another header, fails the read."""
    declared = T.StructType.fromDDL(SCHEMAS[name])
    place = f"{folder.rstrip('/')}/{name}.csv"
    trimmed = dict(header=True, ignoreTrailingWhiteSpace=True, ignoreLeadingWhiteSpace=True)
    header = [column.strip().lower() for column in spark.read.options(**trimmed).csv(place).columns]
    if sorted(header) != sorted(declared.names):
        raise HeaderMismatch(f"{place} has columns {header}, not {declared.names}")
    in_file = T.StructType([declared[column] for column in header])
    rows = spark.read.schema(in_file).options(**trimmed, mode="FAILFAST", enforceSchema=False).csv(place)
    return rows.select(declared.names)


def load_orders_demo(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three CSVs of the order demo."""
    return {name: load_reference(spark, folder, name) for name in ("raw_customers", "raw_orders", "raw_payments")}
