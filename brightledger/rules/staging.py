"""Rules of the cleaning layer.

Fixed values: labels, cut points and scores below are given by the business and
must not be changed without it.
"""

from brightledger.rules.base import any_of, band, lookup, rules

# --- customers ---------------------------------------------------------------
AGE_COHORT = band("age", [(25, "AC010"), (35, "AC006"), (50, "AC007"), (65, "AC008")], "AC009", op="<")
INCOME_BRACKET = band(
    "annual_income",
    [(25000, "IB001"), (50000, "IB002"), (75000, "IB003"), (100000, "IB004"), (150000, "IB005"), (250000, "IB006")],
    "IB007",
    op="<=",
)
CREDIT_RANGE = band(
    "credit_score",
    [(800, "CSR001"), (740, "CSR002"), (670, "CSR003"), (580, "CSR004"), (500, "CSR005")],
    "CSR006",
)
RISK_CATEGORY = rules(
    "RC006",
    ("credit_score >= 740 AND annual_income >= 75000", "RC002"),
    ("credit_score >= 670 AND annual_income >= 50000", "RC003"),
    ("credit_score >= 580", "RC004"),
    ("credit_score >= 500", "RC005"),
)
LIFECYCLE_STAGE = rules(
    "LS007",
    ("relationship_month_part <= 2", "LS003"),
    ("relationship_years < 1", "LS004"),
    ("relationship_years < 3", "LS005"),
    ("relationship_years < 5", "LS006"),
)
VALUE_SEGMENT = rules(
    "Standard Value",
    ("annual_income >= 250000 AND credit_score >= 740", "High Value"),
    ("annual_income >= 100000 AND credit_score >= 670", "Medium Value"),
)
CUSTOMER_FLAGS = {
    "marketing_eligible": "age >= 18 AND customer_status = 'ACTIVE'",
    "lending_eligible": "credit_score >= 580",
    "premium_product_eligible": "annual_income >= 50000",
}

# --- accounts ----------------------------------------------------------------
BALANCE_TIER = band(
    "current_balance",
    [(100000, "High Balance"), (25000, "Medium Balance"), (5000, "Standard Balance")],
    "Low Balance",
)
SERVICE_TIER = band(
    "current_balance", [(250000, "Private Banking"), (100000, "Premium"), (25000, "Preferred")], "Standard"
)
ACCOUNT_TENURE = band("account_age_years", [(10, "Long Term"), (5, "Established"), (2, "Mature")], "New")
ACCOUNT_DIGITAL = rules(
    "Traditional",
    ("online_banking_enabled AND mobile_banking_enabled", "Full Digital"),
    ("online_banking_enabled OR mobile_banking_enabled", "Partial Digital"),
)
ACCOUNT_RISK = rules(
    "Normal",
    ("current_balance <= 0", "Negative Balance"),
    ("current_balance < product_min_balance", "Below Minimum"),
    ("account_status = 'RESTRICTED'", "Restricted"),
    ("account_status = 'DORMANT'", "Dormant"),
)
ACCOUNT_CROSS_SELL = rules(
    20,
    ("current_balance >= 50000 AND account_age_years >= 2", 90),
    ("current_balance >= 25000 AND account_age_years >= 1", 75),
    ("current_balance >= 10000", 60),
    ("account_status = 'ACTIVE'", 45),
)
ACCOUNT_FLAGS = {
    "below_minimum_balance": "current_balance < product_min_balance",
    "fee_waiver_eligible": "current_balance >= product_min_balance AND monthly_fee > 0",
}
DAILY_BALANCE = band("balance_amount", [(50000, "HIGH_BALANCE"), (10000, "MEDIUM_BALANCE")], "LOW_BALANCE")

# --- transactions and other account events -----------------------------------
TRANSACTION_SIZE = band("transaction_amount", [(10000, "LARGE"), (1000, "MEDIUM"), (100, "SMALL")], "MICRO")
CHANNEL_GROUP = rules(
    "OTHER",
    (any_of("channel", "ONLINE", "MOBILE"), "DIGITAL"),
    (any_of("channel", "ATM", "CARD"), "SELF_SERVICE"),
    (any_of("channel", "BRANCH", "PHONE"), "ASSISTED"),
)


def time_of_day(hour: str):
    return rules(
        "OFF_HOURS",
        (f"{hour} BETWEEN 9 AND 17", "BUSINESS_HOURS"),
        (f"{hour} BETWEEN 18 AND 22", "EVENING"),
        (f"{hour} BETWEEN 6 AND 8", "MORNING"),
    )


# Days count from 0 = Sunday, so 1 is Monday and 7 never occurs; kept as given.
DAY_KIND = rules("WEEKDAY", ("day_of_week IN (1, 7)", "WEEKEND"))
FLOW = rules(
    "NEUTRAL",
    (any_of("transaction_type", "DEPOSIT", "TRANSFER_IN", "INTEREST", "DIVIDEND", "REFUND"), "INFLOW"),
    (any_of("transaction_type", "WITHDRAWAL", "TRANSFER_OUT", "PAYMENT", "PURCHASE", "FEE"), "OUTFLOW"),
)
TRANSACTION_RISK = rules(
    20,
    ("is_high_risk", 90),
    ("amount_category = 'LARGE' AND time_category = 'OFF_HOURS'", 75),
    ("amount_category = 'LARGE'", 60),
    ("time_category = 'OFF_HOURS'", 45),
)
TRANSACTION_FLAGS = {"is_digital_transaction": any_of("channel", "ONLINE", "MOBILE")}
DEPOSIT_SIZE = band("deposit_amount", [(10000, "LARGE"), (1000, "MEDIUM")], "SMALL")
DEPOSIT_CHANNEL = rules("TRADITIONAL", (any_of("deposit_type", "MOBILE_DEPOSIT", "ACH"), "DIGITAL"))
WITHDRAWAL_SIZE = band("withdrawal_amount", [(5000, "LARGE"), (500, "MEDIUM")], "SMALL")
FEE_SIZE = band("fee_amount", [(25, "HIGH_FEE"), (10, "MEDIUM_FEE")], "LOW_FEE")
FEE_CLASS = rules(
    "TRANSACTION",
    (any_of("fee_type", "OVERDRAFT", "LATE_PAYMENT"), "PENALTY"),
    ("fee_type = 'MONTHLY_MAINTENANCE'", "SERVICE"),
)

# --- cards -------------------------------------------------------------------
CARD_UTILISATION = band(
    "utilization_rate",
    [(90, "HIGH_UTILIZATION"), (70, "MEDIUM_UTILIZATION"), (30, "LOW_UTILIZATION")],
    "MINIMAL_UTILIZATION",
    op=">",
)
CARD_RISK = rules(
    20,
    ("utilization_rate > 85", 90),
    ("utilization_rate > 70", 70),
    ("utilization_rate > 50", 50),
    ("card_status = 'BLOCKED'", 95),
)
CARD_DIGITAL = rules(
    "TRADITIONAL",
    ("contactless_enabled AND online_enabled", "FULL_DIGITAL"),
    ("contactless_enabled OR online_enabled", "PARTIAL_DIGITAL"),
)
CARD_TIER = rules(
    "N/A",
    ("credit_limit >= 50000", "PREMIUM"),
    ("credit_limit >= 25000", "GOLD"),
    ("credit_limit >= 10000", "SILVER"),
    ("credit_limit > 0", "STANDARD"),
)
CARD_TENURE = band("card_age_years", [(5, "LONG_TERM"), (2, "ESTABLISHED"), (1, "MATURE")], "NEW")
CARD_FLAGS = {"is_usable": "card_status = 'ACTIVE' AND NOT is_expired"}

# --- loans -------------------------------------------------------------------
LOAN_DELINQUENCY = rules(
    "LATE_90_PLUS",
    ("days_past_due = 0", "CURRENT"),
    ("days_past_due <= 30", "LATE_1_30"),
    ("days_past_due <= 60", "LATE_31_60"),
    ("days_past_due <= 90", "LATE_61_90"),
)
LOAN_RISK = rules(
    20,
    ("loan_status = 'CHARGED_OFF'", 100),
    ("loan_status = 'DEFAULT'", 95),
    ("days_past_due > 90", 85),
    ("days_past_due > 60", 70),
    ("days_past_due > 30", 55),
    ("days_past_due > 0", 40),
)
LOAN_PERFORMANCE = band("percent_paid", [(80, "EXCELLENT"), (60, "GOOD"), (40, "FAIR"), (20, "POOR")], "NEW")
LOAN_SIZE = band(
    "original_amount", [(500000, "JUMBO"), (200000, "LARGE"), (50000, "MEDIUM"), (10000, "SMALL")], "MICRO"
)
# Upper rate limits per loan type: (type, excellent below, good below).
LOAN_RATE_LIMITS = (("MORTGAGE", 4, 5), ("PERSONAL", 10, 12), ("AUTO", 5, 7))
LOAN_RATE = rules(
    "MARKET_RATE",
    *[
        (f"loan_type = '{kind}' AND interest_rate < {limit}", label)
        for kind, excellent, good in LOAN_RATE_LIMITS
        for limit, label in ((excellent, "EXCELLENT_RATE"), (good, "GOOD_RATE"))
    ],
)
LOAN_TENURE = band("loan_age_years", [(10, "LONG_TERM"), (5, "ESTABLISHED"), (2, "MATURE")], "NEW")
LOAN_FLAGS = {"is_performing": any_of("loan_status", "CURRENT", "PAID_OFF") + " AND days_past_due = 0"}

# --- investments -------------------------------------------------------------
ASSET_CLASS = lookup(
    "investment_type",
    {
        "STOCK": "EQUITY",
        "ETF": "EQUITY",
        "BOND": "FIXED_INCOME",
        "MUTUAL_FUND": "POOLED_INVESTMENT",
        "CD": "CASH_EQUIVALENT",
        "MONEY_MARKET": "CASH_EQUIVALENT",
    },
    "OTHER",
)
LIQUIDITY = lookup(
    "investment_type",
    {"MUTUAL_FUND": "MEDIUM_LIQUIDITY", "BOND": "MEDIUM_LIQUIDITY", "CD": "LOW_LIQUIDITY"},
    "HIGH_LIQUIDITY",
)
PERFORMANCE = band(
    "return_percent",
    [(20, "STRONG_PERFORMER"), (10, "GOOD_PERFORMER"), (0, "MODERATE_PERFORMER"), (-10, "POOR_PERFORMER")],
    "SIGNIFICANT_LOSS",
)
HOLDING_SIZE = band(
    "current_value", [(100000, "LARGE_HOLDING"), (25000, "MEDIUM_HOLDING"), (5000, "SMALL_HOLDING")], "MINIMAL_HOLDING"
)
TAX_STATUS = rules(
    "NO_TAX_IMPACT",
    ("account_type = 'TAXABLE' AND unrealized_gain_loss > 0", "TAXABLE_GAIN"),
    ("account_type = 'TAXABLE' AND unrealized_gain_loss < 0", "TAX_LOSS_HARVEST"),
    (any_of("account_type", "IRA", "ROTH_IRA", "401K"), "TAX_DEFERRED"),
)
RISK_RETURN = rules(
    "MODERATE_RISK_RETURN",
    ("risk_rating = 'HIGH' AND return_percent > 15", "HIGH_RISK_HIGH_RETURN"),
    ("risk_rating = 'HIGH' AND return_percent < 0", "HIGH_RISK_POOR_RETURN"),
    ("risk_rating = 'LOW' AND return_percent > 5", "LOW_RISK_GOOD_RETURN"),
    ("risk_rating = 'LOW' AND return_percent < 0", "LOW_RISK_POOR_RETURN"),
)
HOLDING_TENURE = band("holding_years", [(5, "LONG_TERM"), (2, "MEDIUM_TERM"), (1, "SHORT_TERM")], "VERY_SHORT_TERM")
HOLDING_FLAGS = {"is_major_holding": "current_value >= 50000", "requires_review": "return_percent < -20"}

# --- insurance, scores, assessments ------------------------------------------
CLAIMS = rules(
    "HIGH_CLAIMS",
    ("claims_count = 0", "NO_CLAIMS"),
    ("claims_count <= 2", "LOW_CLAIMS"),
    ("claims_count <= 4", "MODERATE_CLAIMS"),
)
BUREAU_SCORE = band("credit_score", [(800, "EXCEPTIONAL"), (740, "VERY_GOOD"), (670, "GOOD"), (580, "FAIR")], "POOR")
ASSESSMENT_SCORE = band("risk_score", [(800, "EXCELLENT"), (740, "VERY_GOOD"), (670, "GOOD"), (580, "FAIR")], "POOR")

# --- addresses and phones ----------------------------------------------------
LIVING_COST = band("cost_of_living_index", [(130, "High Cost Area"), (110, "Medium Cost Area")], "Low Cost Area", op=">")
ADDRESS_STABILITY = band("years_at_address", [(5, "Stable"), (2, "Moderate")], "New")
ADDRESS_QUALITY = rules(
    20,
    ("address_status = 'VERIFIED' AND years_at_address >= 2", 90),
    ("address_status = 'VERIFIED' AND years_at_address >= 1", 75),
    ("address_status = 'VERIFIED'", 60),
    ("address_status = 'UNVERIFIED'", 40),
)
ADDRESS_FLAGS = {
    "service_deliverable": "is_deliverable AND address_status = 'VERIFIED'",
    "urban_area": "population_density = 'High'",
}
# Number parts no real line has, and area codes set apart for special use.
DUMMY_PARTS = (("area_code", "000", "111", "999"), ("exchange", "000", "111", "999"), ("line_number", "0000", "1111", "9999"))
PHONE_FORMAT = rules(True, *[(any_of(*part), False) for part in DUMMY_PARTS])
PHONE_FLAGS = {
    "call_eligible": "is_verified AND phone_status = 'ACTIVE' AND NOT do_not_call",
    "sms_eligible": "sms_enabled AND phone_type = 'MOBILE' AND phone_status = 'ACTIVE'",
    "is_mobile": "phone_type = 'MOBILE'",
    "is_landline": any_of("phone_type", "HOME", "WORK"),
    "is_special_number": any_of("area_code", "555", "800", "888", "877", "866"),
    "verification_required": "NOT is_verified AND phone_status = 'ACTIVE'",
}
PHONE_MARKETING_FLAGS = {
    "marketing_call_eligible": "marketing_opt_in AND call_eligible",
    "marketing_sms_eligible": "marketing_opt_in AND sms_eligible",
}
PHONE_QUALITY = rules(
    30,
    ("is_verified AND is_valid_format AND phone_status = 'ACTIVE'", 95),
    ("is_valid_format AND phone_status = 'ACTIVE'", 80),
    ("is_valid_format", 60),
)
CONTACT_METHOD = rules(
    "NO_CONTACT",
    ("phone_type = 'MOBILE' AND sms_enabled", "SMS_PREFERRED"),
    ("phone_type = 'MOBILE'", "MOBILE_CALL"),
    ("phone_type = 'HOME'", "HOME_CALL"),
    ("phone_type = 'WORK'", "WORK_CALL"),
)

# --- interactions and campaigns ----------------------------------------------
DURATION = band("duration_minutes", [(15, "QUICK"), (60, "STANDARD"), (120, "EXTENDED")], "LENGTHY", op="<=")
DIGITAL_CONTACT = any_of("interaction_type", "EMAIL", "CHAT", "SOCIAL_MEDIA")
CONTACT_CHANNEL = rules(
    "OTHER",
    (DIGITAL_CONTACT, "DIGITAL"),
    ("interaction_type = 'PHONE_CALL'", "VOICE"),
    ("interaction_type = 'BRANCH_VISIT'", "IN_PERSON"),
)
EFFORT = band("contact_count", [(3, "HIGH_EFFORT"), (1, "MEDIUM_EFFORT")], "LOW_EFFORT", op=">")
SATISFACTION = band("satisfaction_score", [(4, "SATISFIED"), (3, "NEUTRAL"), (1, "DISSATISFIED")], "NOT_RATED")
RESOLUTION = rules(
    "UNRESOLVED_PENDING",
    ("status = 'RESOLVED' AND contact_count = 1 AND NOT was_escalated", "FIRST_CONTACT_RESOLUTION"),
    ("status = 'RESOLVED' AND NOT was_escalated", "RESOLVED_NO_ESCALATION"),
    ("status = 'RESOLVED' AND was_escalated", "RESOLVED_WITH_ESCALATION"),
    ("status = 'ESCALATED'", "UNRESOLVED_ESCALATED"),
)
COMPLEXITY = rules(
    "SIMPLE",
    (any_of("reason_code", "TRANSACTION_DISPUTE", "LOAN_QUESTION") + " AND was_escalated", "COMPLEX"),
    (any_of("agent_tier", "SPECIALIST", "SUPERVISOR"), "MODERATE"),
)
INTERACTION_FLAGS = {
    "is_digital_interaction": DIGITAL_CONTACT,
    "high_risk_interaction": "(reason_code = 'FEES_COMPLAINT' AND satisfaction_score <= 2)"
    " OR (priority = 'URGENT' AND status <> 'RESOLVED')",
}
CAMPAIGN_ENGAGEMENT = lookup(
    "response_type",
    {"CONVERTED": "HIGH_ENGAGEMENT", "CLICKED": "MEDIUM_ENGAGEMENT", "OPENED": "LOW_ENGAGEMENT"},
    "NO_ENGAGEMENT",
)
CAMPAIGN_CHANNEL = rules("TRADITIONAL", (any_of("channel", "EMAIL", "DIGITAL_AD"), "DIGITAL"))
