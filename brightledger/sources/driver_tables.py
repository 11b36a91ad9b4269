"""Bank inputs mapped from the order and event tables.

There is no stored bank data, so each bank input is a projection of a whole given
table: an order plays an account, a card, an address and a phone; an order line
plays the events on that account; an event plays the customer-level activity; a
part plays a loan and a policy. One input row gives one output row.

Codes, such as statuses, kinds and regions, follow from measures of the given row.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# Days that bring order dates (1995-2001) next to the event dates (2024).
SHIFT = 8036


class SparkText:
    @staticmethod
    def day(base: str, days: str) -> str:
        return f"CAST(date_add(DATE '{base}', CAST({days} AS INT)) AS TIMESTAMP)"

    @staticmethod
    def plus(moment: str, days: str = "0", minutes: str = "0") -> str:
        return f"CAST({moment} AS TIMESTAMP) + make_dt_interval(CAST({days} AS INT), 0, CAST({minutes} AS INT))"

    @staticmethod
    def whole(expr: str) -> str:
        return f"CAST(floor({expr}) AS BIGINT)"


# Whole numbers from 0 to 99 that columns of a given row have, by table.
customer_share = "(c_nationkey * 4)"
order_share = "(CAST(floor(o_totalprice) AS BIGINT) % 100)"
price_share = "(CAST(floor(o_totalprice / 100) AS BIGINT) % 100)"
part_share = "(CAST(substr(p_brand, 7) AS INT) * 4 - 4)"
line_share = "(CAST(floor(l_extendedprice) AS BIGINT) % 100)"
cost_share = "(CAST(floor(l_extendedprice / 100) AS BIGINT) % 100)"
unit_share = "(CAST(l_quantity AS BIGINT) * 2 - 2)"
event_share = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
value_share = "(CAST(floor(value) AS BIGINT) % 100)"


def labelled(share: str, *labels) -> str:
    """The label in whose part of 0..99 the share lies; the parts are as even as whole numbers
    allow. The labels, wherever this is used, are fixed values: those that the rules and
    reports tell apart."""
    parts = len(labels)
    arms = " ".join(f"WHEN {share} < {-(-100 * at // parts)} THEN {_literal(label)}" for at, label in enumerate(labels[:-1], 1))
    return f"CASE {arms} ELSE {_literal(labels[-1])} END"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _money(expr: str, digits: int = 14) -> str:
    return f"CAST({expr} AS DECIMAL({digits},2))"


def _padded(prefix: str, expr: str, width: int) -> str:
    """The number with zeros in front up to ``width`` digits; a longer one stays whole."""
    number = f"CAST({expr} AS STRING)"
    return f"concat('{prefix}', lpad({number}, CAST(greatest({width}, length({number})) AS INT), '0'))"


def bank_inputs(d=SparkText, as_of: str = "2024-02-01") -> dict[str, tuple[str, dict[str, str]]]:
    """Per bank input: the given table it comes from, and its columns."""
    loaded = {"last_updated": f"CAST('{as_of}' AS TIMESTAMP)"}

    order_day = d.plus("o_orderdate", str(SHIFT))
    ship_day = d.plus("l_shipdate", str(SHIFT))
    ship_time = d.plus("l_shipdate", str(SHIFT), "l_partkey % 1440")
    # A reference to an order line; the given lines do not have it for themselves alone.
    line_ref = "l_orderkey * 10 + l_linenumber"
    price = _money("o_totalprice")
    units = d.whole("l_quantity")
    spread = {n: f"user_id * 10 + event_id % {n}" for n in (7, 8, 9, 10, 11)}
    event_day = f"CAST(CAST({d.plus('ts', '-(event_id % 60)')} AS DATE) AS TIMESTAMP)"

    customers = {
        "customer_id": "c_custkey",
        "customer_number": _padded("CUST", "c_custkey", 6),
        "first_name": labelled(customer_share, "JANE", "mary-ann", "o'neil", "john"),
        "last_name": "c_mktsegment",
        "date_of_birth": d.day("1944-01-01", "c_custkey * 97 % 22000"),
        "gender": labelled(customer_share, "f", "m"),
        "email_address": "concat('Customer', CAST(c_custkey AS STRING), '@Email.com')",
        "phone_number": _padded("555-", "c_custkey % 10000", 4),
        "annual_income": "CAST(20000 + c_custkey * 7919 % 300000 AS INT)",
        "credit_score": "CAST(450 + c_custkey * 131 % 400 AS INT)",
        "customer_status": "CASE WHEN c_acctbal < -900 THEN 'closed' WHEN c_acctbal < -500 THEN 'suspended' ELSE 'active' END",
        "customer_since_date": d.day("2012-01-01", "c_custkey * 53 % 4400"),
    }
    closed = "o_orderstatus = 'P' AND o_totalprice < 50000"
    urgent, quiet = "o_orderpriority IN ('1-URGENT', '2-HIGH')", "o_orderpriority = '5-LOW'"
    accounts = {
        "account_id": "o_orderkey",
        "account_number": _padded("ACC", "o_orderkey", 8),
        "customer_id": "o_custkey",
        "product_id": "CASE WHEN o_orderkey % 97 = 0 THEN 'NEW001' WHEN o_orderpriority = '1-URGENT' THEN 'CHCK001'"
        " WHEN o_orderpriority = '2-HIGH' THEN 'SAVE001' WHEN o_orderpriority = '3-MEDIUM' THEN 'CD001'"
        " WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'INVT001' ELSE 'BUSI001' END",
        "current_balance": _money(f"{price} - 100000 * (o_orderkey % 4)"),
        "average_balance": price,
        "account_status": "CASE WHEN o_orderstatus <> 'P' THEN 'active' WHEN o_totalprice < 50000 THEN 'closed'"
        " WHEN o_totalprice < 100000 THEN 'dormant' WHEN o_totalprice < 150000 THEN 'restricted' ELSE 'active' END",
        "opened_date": order_day,
        "closed_date": f"CASE WHEN {closed} THEN {d.plus('o_orderdate', str(SHIFT + 400))} END",
        "interest_rate": "CAST(CAST(o_orderkey % 500 AS DOUBLE) / 100 AS DECIMAL(6,2))",
        "monthly_fee": _money("5 * (o_orderkey % 4)", 8),
        "online_banking_enabled": f"NOT ({quiet})",
        "mobile_banking_enabled": f"{urgent} OR o_orderstatus = 'O'",
        "overdraft_protection": "o_totalprice >= 200000",
        "is_joint_account": "o_orderstatus = 'F' AND o_totalprice >= 400000",
    }
    cards = {
        "card_id": "o_orderkey",
        "card_number_masked": _padded("CARD", "o_orderkey", 8),
        "customer_id": "o_custkey",
        "linked_account_id": f"CASE WHEN {order_share} < 34 THEN o_orderkey END",
        "card_type": labelled(order_share, "debit", "credit", "prepaid"),
        "card_brand": labelled(order_share, "visa", "mastercard", "amex", "discover"),
        "card_status": f"CASE WHEN o_orderstatus <> 'P' THEN 'active' WHEN {quiet} THEN 'blocked'"
        f" WHEN {urgent} THEN 'expired' ELSE 'inactive' END",
        "credit_limit": f"CASE WHEN {order_share} BETWEEN 34 AND 66 THEN {labelled(price_share, 50000, 25000, 10000, 5000, 0)} END",
        "current_balance": f"CASE WHEN {order_share} < 34 THEN {_money('0')}"
        f" ELSE {_money(d.whole('o_totalprice') + ' % 9973')} END",
        "issue_date": order_day,
        "expiry_date": f"{order_day} + INTERVAL 4 YEAR",
        "contactless_enabled": "o_orderstatus <> 'P'",
        "online_enabled": f"NOT ({quiet})",
        "international_enabled": urgent,
        "is_business_card": "o_totalprice >= 400000",
    }
    principal = _money("CAST(p_retailprice AS DECIMAL(12,2)) * (1 + 5 * p_size)")
    loans = {
        "loan_id": "p_partkey",
        "loan_number": _padded("LOAN", "p_partkey", 8),
        "customer_id": d.whole("p_partkey / 3.0"),
        "loan_type": labelled(part_share, "mortgage", "personal", "auto", "home_equity"),
        "original_amount": principal,
        "current_balance": f"CASE WHEN p_partkey % 9 = 0 THEN {_money('0')} ELSE "
        + _money(f"{principal} - (CAST(p_retailprice AS DECIMAL(12,2)) * (p_partkey % 6))")
        + " END",
        "interest_rate": "CAST(CAST(350 + p_partkey % 120 * 10 AS DOUBLE) / 100 AS DECIMAL(6,2))",
        "term_months": labelled(part_share, 360, 60, 72, 180),
        "loan_status": "CASE WHEN p_size <= 4 THEN 'charged_off' WHEN p_size <= 8 THEN 'default'"
        " WHEN p_size <= 12 THEN 'delinquent' WHEN p_size <= 18 THEN 'paid_off' ELSE 'current' END",
        "origination_date": d.day("2013-01-01", "p_partkey * 37 % 3900"),
        "maturity_date": f"CASE WHEN p_size BETWEEN 13 AND 18 THEN {d.day('2013-01-01', 'p_partkey * 37 % 3900')} + INTERVAL 9 YEAR END",
        "days_past_due": "CASE WHEN p_size <= 14 THEN CAST(9 * (14 - p_size) AS INT) ELSE 0 END",
        "has_collateral": "p_size > 40",
        "is_secured": "p_size > 30",
    }
    investments = {
        "holding_id": line_ref,
        "holding_number": _padded("INV", line_ref, 10),
        "customer_id": "l_partkey",
        "investment_type": labelled(line_share, "stock", "bond", "mutual_fund", "etf", "cd", "money_market"),
        "symbol": labelled(line_share, "aapl", "us_treasury_10yr", "fund_500", "vti", "bank_cd_5yr", "cash"),
        "quantity": _money("l_quantity"),
        "purchase_price": _money(f"1 + {d.whole('l_extendedprice / 5')} * 0.01", 12),
        "current_price": _money(f"{units} % 31 - 10 + {d.whole('l_extendedprice / 5')} * 0.01", 12),
        "purchase_date": ship_day,
        "account_type": labelled(cost_share, "taxable", "ira", "roth_ira", "401k"),
        "risk_rating": labelled(cost_share, "medium", "low", "high"),
    }
    policies = {
        "policy_id": "p_partkey",
        "policy_number": _padded("POL", "p_partkey", 8),
        "customer_id": d.whole("p_partkey / 2.0"),
        "policy_type": labelled(part_share, "LIFE", "AUTO", "HOME", "HEALTH"),
        "coverage_amount": _money("CAST(p_retailprice AS DECIMAL(12,2)) * p_size"),
        "annual_premium": _money("p_retailprice", 10),
        "policy_start_date": d.day("2018-01-01", "p_partkey * 29 % 2100"),
        "policy_status": "CASE WHEN p_size > 47 THEN 'CANCELLED' WHEN p_size > 44 THEN 'LAPSED'"
        " WHEN p_size > 41 THEN 'SUSPENDED' ELSE 'ACTIVE' END",
        "claims_count": "CAST(p_partkey % 7 AS INT)",
    }
    places = ["los angeles", "CHICAGO", "houston", "phoenix", "philadelphia", "san antonio", "winston-salem", "seattle", "denver", "new york"]
    addresses = {
        "address_id": "o_orderkey",
        "customer_id": "o_custkey",
        "address_type": labelled(order_share, "primary", "business", "previous", "mailing"),
        "street_address": "concat(CAST(100 + o_orderkey % 9900 AS STRING), "
        + labelled(order_share, " oak avenue", " pine road", " elm drive", " maple lane", " main street")
        + ")",
        "unit_number": f"CASE WHEN {order_share} < 34 THEN concat('apt ', CAST(o_orderkey % 50 + 1 AS STRING)) END",
        "city": labelled(order_share, *places),
        "state_code": labelled(order_share, "ca", "il", "tx", "az", "pa", "tx", "nc", "wa", "co", "ny"),
        "postal_code": "CAST(10000 + o_orderkey % 89999 AS STRING)",
        "address_status": "CASE WHEN o_totalprice < 20000 THEN 'INVALID' WHEN o_totalprice < 30000 THEN NULL"
        " WHEN o_orderstatus = 'P' THEN 'UNVERIFIED' ELSE 'VERIFIED' END",
        "address_since": f"CASE WHEN o_totalprice < 480000 THEN {order_day} END",
        "address_until": f"CASE WHEN o_orderstatus = 'F' THEN {d.plus('o_orderdate', str(SHIFT + 900))} END",
        "is_deliverable": f"NOT ({quiet})",
    }
    phones = {
        "phone_id": "o_orderkey",
        "customer_id": "o_custkey",
        "phone_type": labelled(order_share, "mobile", "home", "work", "fax"),
        "area_code": labelled(order_share, "444", "333", "000", "800", "555"),
        "exchange": "lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')",
        "line_number": "lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0')",
        "is_verified": "o_orderstatus <> 'P'",
        "sms_enabled": f"NOT ({quiet})",
        "marketing_opt_in": "o_totalprice >= 150000",
        "do_not_call": "o_totalprice < 25000",
        "phone_status": "CASE WHEN o_totalprice < 30000 THEN 'inactive' WHEN o_totalprice < 60000 THEN 'unverified' ELSE 'active' END",
        "is_primary": urgent,
        "preferred_contact_start": labelled(order_share, "09:30:00", "10:00:00", "08:00:00"),
        "preferred_contact_end": labelled(order_share, "18:00:00", "19:15:00", "20:00:00"),
    }
    interactions = {
        "interaction_id": "event_id",
        "interaction_number": _padded("INT", "event_id", 10),
        "customer_id": spread[11],
        "interaction_type": labelled(event_share, "phone_call", "email", "chat", "branch_visit", "social_media"),
        "reason_code": labelled(event_share, "account_inquiry", "transaction_dispute", "card_issue", "loan_question", "fees_complaint", "technical_support", "product_information", "general_inquiry"),
        "status": "CASE WHEN event_type = 'error' THEN 'escalated' WHEN value < 5 THEN 'pending'"
        " WHEN value < 10 THEN 'reopened' ELSE 'resolved' END",
        "priority": labelled(event_share, "urgent", "high", "medium", "low"),
        "interaction_datetime": d.plus("ts", "-(event_id % 120)"),
        "duration_minutes": "CAST(event_id * 7 % 150 + 5 AS INT)",
        "agent_id": _padded("AGENT", "event_id % 50", 3),
        "agent_tier": labelled(event_share, "tier_1", "tier_2", "specialist", "supervisor"),
        "contact_count": "CAST(event_id % 5 + 1 AS INT)",
        "satisfaction_score": f"CASE WHEN event_id % 4 <> 0 THEN CAST({d.whole('value')} % 5 + 1 AS INT) END",
        "was_escalated": "event_type = 'error'",
        "required_followup": "event_type = 'view'",
        "resulted_in_retention": "event_type = 'signup'",
    }
    digital = {
        "activity_id": "event_id",
        "customer_id": "user_id",
        "activity_type": "CASE event_type WHEN 'signup' THEN 'LOGIN' WHEN 'view' THEN 'BALANCE_CHECK'"
        " WHEN 'click' THEN 'TRANSFER' WHEN 'purchase' THEN 'BILL_PAY' ELSE 'ACCOUNT_SETTINGS' END",
        "platform": labelled(event_share, "MOBILE_APP", "MOBILE_APP", "WEB_PORTAL"),
        "activity_timestamp": d.plus("ts", "-(event_id % 100)"),
    }
    lines = {"account_id": "l_orderkey"}
    line_amount = (
        f"CASE WHEN l_linenumber % 2 = 1 THEN {_money('l_extendedprice', 12)}"
        f" WHEN l_linenumber = 2 THEN {_money('l_quantity', 12)} ELSE {_money('l_quantity * 50', 12)} END"
    )
    transactions = {
        "transaction_id": line_ref,
        "transaction_number": _padded("TXN", line_ref, 10),
        **lines,
        "transaction_type": labelled(line_share, "deposit", "withdrawal", "transfer_in", "transfer_out", "payment", "purchase", "fee", "interest", "dividend", "refund"),
        "transaction_amount": line_amount,
        "transaction_status": "CASE WHEN l_quantity <= 2 THEN 'failed' WHEN l_quantity <= 4 THEN 'pending'"
        " WHEN l_quantity <= 6 THEN 'cancelled' ELSE 'completed' END",
        "channel": labelled(unit_share, "atm", "online", "mobile", "branch", "phone", "card"),
        "transaction_datetime": ship_time,
        "transaction_location": labelled(line_share, "Chicago, IL", "Online", "New York, NY"),
        "merchant_name": labelled(line_share, "Grocer", None, "Fuel", None),
        "is_high_risk": "l_returnflag = 'R' AND l_discount >= 0.1",
        "requires_approval": "l_returnflag = 'R'",
    }
    deposits = {
        "deposit_id": line_ref,
        "deposit_number": _padded("DEP", line_ref, 10),
        **lines,
        "deposit_type": labelled(line_share, "PAYROLL", "CASH", "CHECK", "WIRE_TRANSFER", "ACH", "MOBILE_DEPOSIT"),
        "deposit_amount": line_amount,
        "deposit_datetime": ship_time,
        "deposit_status": "CASE WHEN l_quantity <= 4 THEN 'PENDING' WHEN l_quantity <= 8 THEN 'HELD' ELSE 'CLEARED' END",
    }
    withdrawals = {
        "withdrawal_id": line_ref,
        "withdrawal_number": _padded("WDL", line_ref, 10),
        **lines,
        "withdrawal_type": labelled(line_share, "ATM", "TELLER", "ONLINE", "WIRE_TRANSFER", "CHECK"),
        "withdrawal_amount": _money("l_quantity * 137", 12),
        "withdrawal_datetime": ship_time,
        "withdrawal_status": "CASE WHEN l_quantity <= 4 THEN 'FAILED' WHEN l_quantity <= 8 THEN 'PENDING' ELSE 'COMPLETED' END",
    }
    transfers = {
        "transfer_id": line_ref,
        "from_account_id": "l_orderkey",
        "to_account_id": "l_partkey * 8",
        "transfer_amount": _money("l_quantity * 11", 12),
        "transfer_date": ship_day,
        "transfer_status": "CASE WHEN l_quantity <= 5 THEN 'FAILED' ELSE 'COMPLETED' END",
    }
    payments = {
        "payment_id": line_ref,
        "payment_number": _padded("PAY", line_ref, 10),
        **lines,
        "payment_type": labelled(line_share, "BILL_PAY", "PERSON_TO_PERSON", "MERCHANT_PAYMENT", "LOAN_PAYMENT", "TAX_PAYMENT"),
        "payment_amount": _money("l_quantity * 23", 12),
        "payment_date": ship_day,
        "payment_status": "CASE WHEN l_quantity <= 3 THEN 'FAILED' WHEN l_quantity <= 7 THEN 'PENDING' ELSE 'COMPLETED' END",
    }
    fees = {
        "fee_id": line_ref,
        "fee_number": _padded("FEE", line_ref, 8),
        **lines,
        "fee_type": labelled(line_share, "MONTHLY_MAINTENANCE", "OVERDRAFT", "ATM_FEE", "WIRE_TRANSFER", "FOREIGN_TRANSACTION", "LATE_PAYMENT"),
        "fee_amount": _money("l_tax * 500", 10),
        "fee_date": ship_day,
        "fee_status": "CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' WHEN l_discount = 0 THEN 'WAIVED' ELSE 'CHARGED' END",
    }
    balances = {
        "balance_id": line_ref,
        **lines,
        "balance_amount": _money("l_extendedprice - 5000", 12),
        "available_balance": _money("l_extendedprice - 5100", 12),
        "balance_date": ship_day,
    }
    accruals = {
        "accrual_id": line_ref,
        **lines,
        "interest_amount": _money("l_discount * 100", 10),
        "interest_rate": "CAST(l_discount * 50 AS DECIMAL(6,2))",
        "accrual_date": ship_day,
    }
    account_alerts = {
        "alert_id": line_ref,
        **lines,
        "alert_type": labelled(line_share, "LOW_BALANCE", "LARGE_DEPOSIT", "UNUSUAL_ACTIVITY", "PAYMENT_DUE", "RATE_CHANGE"),
        "alert_timestamp": ship_time,
        "alert_status": "CASE WHEN l_quantity > 49 AND l_discount = 0 THEN 'PENDING' WHEN l_linestatus = 'F' THEN 'ACTIONED' ELSE 'DISMISSED' END",
    }
    channel_usage = {
        "usage_id": "event_id",
        "customer_id": spread[11],
        "channel_type": labelled(event_share, "ONLINE", "MOBILE", "ATM", "BRANCH", "MOBILE", "PHONE"),
        "usage_count": f"CAST({d.whole('value')} % 20 + 1 AS INT)",
        "usage_date": event_day,
    }
    product_usage = {
        "usage_id": "event_id",
        "customer_id": spread[9],
        "product_type": labelled(event_share, "CHECKING", "SAVINGS", "CREDIT_CARD", "MORTGAGE", "INVESTMENTS", "INSURANCE", "LOANS", "MOBILE_BANKING"),
        "usage_frequency": f"CAST({d.whole('value')} % 10 + 1 AS INT)",
        "usage_date": d.plus("ts", "-(event_id % 200)"),
    }
    segments = {
        "segment_id": "event_id",
        "customer_id": spread[10],
        "segment_name": labelled(event_share, "PREMIUM", "MASS_AFFLUENT", "EMERGING_AFFLUENT", "MASS_MARKET", "YOUNG_PROFESSIONAL", "PREMIUM", "STUDENT"),
        "segment_date": event_day,
    }
    campaigns = {
        "campaign_response_id": "event_id",
        "campaign_id": _padded("CAMP", "event_id % 50", 6),
        "customer_id": spread[8],
        "campaign_type": labelled(event_share, "SAVINGS_PROMOTION", "LOAN_OFFER", "INVESTMENT_SEMINAR", "INSURANCE_QUOTE", "DIGITAL_BANKING", "REFERRAL", "CREDIT_CARD_OFFER"),
        "channel": labelled(value_share, "EMAIL", "DIRECT_MAIL", "PHONE", "DIGITAL_AD"),
        "sent_date": event_day,
        "response_type": "CASE event_type WHEN 'purchase' THEN 'CONVERTED' WHEN 'click' THEN 'CLICKED' WHEN 'view' THEN 'OPENED' ELSE 'NO_RESPONSE' END",
        "resulted_in_sale": "event_type IN ('purchase', 'signup')",
    }
    retention = {
        "event_id": "event_id",
        "customer_id": spread[7],
        "event_type": "CASE event_type WHEN 'view' THEN 'RETENTION_OFFER_SENT' WHEN 'purchase' THEN 'CUSTOMER_SAVED'"
        " WHEN 'click' THEN 'WIN_BACK_CAMPAIGN' WHEN 'signup' THEN 'LOYALTY_PROGRAM_ENROLLED'"
        " ELSE CASE WHEN value > 100 THEN 'ACCOUNT_CLOSED' ELSE 'CHURN_RISK_IDENTIFIED' END END",
        "event_date": event_day,
        "event_outcome": labelled(event_share, "FAILED", "PENDING", "SUCCESSFUL"),
    }
    assessment_score = "CAST(400 + event_id * 37 % 450 AS INT)"
    assessments = {
        "assessment_id": "event_id",
        "assessment_number": _padded("RISK", "event_id", 8),
        "customer_id": spread[11],
        "risk_type": labelled(event_share, "CREDIT_RISK", "FRAUD_RISK", "OPERATIONAL_RISK", "MARKET_RISK"),
        "risk_score": assessment_score,
        "risk_rating": f"CASE WHEN {assessment_score} >= 750 THEN 'LOW' WHEN {assessment_score} >= 650 THEN 'MEDIUM'"
        f" WHEN {assessment_score} >= 550 THEN 'HIGH' ELSE 'VERY_HIGH' END",
        "assessment_date": event_day,
        "requires_review": "event_id % 30 = 1",
    }
    fraud = {
        "alert_id": "event_id",
        "customer_id": spread[9],
        "alert_type": labelled(event_share, "UNUSUAL_TRANSACTION", "LOCATION_ANOMALY", "VELOCITY_CHECK", "MERCHANT_RISK", "BEHAVIORAL_PATTERN"),
        "risk_score": "CAST(event_id * 13 % 100 AS INT)",
        "alert_timestamp": d.plus("ts", "-(event_id % 60)"),
        "alert_status": "CASE WHEN value > 150 THEN 'CONFIRMED_FRAUD' WHEN value > 120 THEN 'UNDER_REVIEW' ELSE 'FALSE_POSITIVE' END",
    }
    compliance = {
        "compliance_id": "event_id",
        "customer_id": spread[8],
        "compliance_type": labelled(event_share, "AML_SCREENING", "SANCTIONS_CHECK", "PEP_SCREENING", "ADVERSE_MEDIA"),
        "check_date": event_day,
        "compliance_status": "CASE WHEN value > 160 THEN 'FLAGGED' ELSE 'CLEAR' END",
    }
    scores = {
        "score_id": "event_id",
        "customer_id": spread[11],
        "credit_score": "CAST(600 + event_id * 41 % 250 - 3 * (user_id % 40) AS INT)",
        "score_date": event_day,
        "bureau": labelled(event_share, "EXPERIAN", "EQUIFAX", "TRANSUNION"),
    }
    kyc = {
        "kyc_id": "event_id",
        "customer_id": spread[10],
        "kyc_type": labelled(event_share, "INITIAL", "PERIODIC_REVIEW", "ENHANCED_DD"),
        "review_date": event_day,
        "status": "CASE WHEN value > 160 THEN 'FAILED' ELSE 'PASSED' END",
    }
    mapped = {
        "customers_360": ("customer", customers),
        "accounts": ("orders", accounts),
        "cards": ("orders", cards),
        "loans": ("part", loans),
        "investments": ("lineitem", investments),
        "insurance_policies": ("part", policies),
        "customer_addresses": ("orders", addresses),
        "customer_phones": ("orders", phones),
        "customer_interactions": ("events", interactions),
        "digital_activity": ("events", digital),
        "transactions": ("lineitem", transactions),
        "deposits": ("lineitem", deposits),
        "withdrawals": ("lineitem", withdrawals),
        "transfers": ("lineitem", transfers),
        "payments": ("lineitem", payments),
        "fees": ("lineitem", fees),
        "account_balances": ("lineitem", balances),
        "interest_accruals": ("lineitem", accruals),
        "account_alerts": ("lineitem", account_alerts),
        "channel_usage": ("events", channel_usage),
        "product_usage": ("events", product_usage),
        "customer_segments": ("events", segments),
        "marketing_campaigns": ("events", campaigns),
        "retention_events": ("events", retention),
        "risk_assessments": ("events", assessments),
        "fraud_alerts": ("events", fraud),
        "compliance_records": ("events", compliance),
        "credit_scores": ("events", scores),
        "kyc_records": ("events", kyc),
    }
    return {name: (table, {**columns, **loaded}) for name, (table, columns) in mapped.items()}


def alternative_inputs(d=SparkText, as_of: str = "2024-02-01") -> dict[str, tuple[str, dict[str, str]]]:
    """Inputs of the alternative rules where they differ; the others are shared."""
    shared = bank_inputs(d, as_of)
    loaded = {"last_updated": f"CAST('{as_of}' AS TIMESTAMP)"}

    def of(name: str, *columns: str) -> dict[str, str]:
        return {column: shared[name][1][column] for column in columns}

    level = labelled(event_share, "HIGH", "MEDIUM", "LOW")
    own = {
        "loans": (
            "part",
            {
                "loan_id": "p_partkey",
                "customer_id": d.whole("p_partkey / 3.0"),
                "loan_type": labelled(part_share, "personal", "auto", "mortgage", "student"),
                "loan_date": d.day("2013-01-01", "p_partkey * 37 % 3900"),
                "loan_amount": shared["loans"][1]["original_amount"],
                "loan_status": "CASE WHEN p_size <= 4 THEN 'defaulted' WHEN p_size <= 8 THEN 'paid_off'"
                " WHEN p_size <= 10 THEN 'INVALID' ELSE 'active' END",
            },
        ),
        "customer_phones": (
            "orders",
            {
                **of("customer_phones", "phone_id", "customer_id", "sms_enabled", "is_primary"),
                "phone_type": labelled(order_share, "mobile", "home", "work", "primary", "emergency"),
                "phone_number": "concat("
                + labelled(order_share, "555-1", "(212) 555-", "555-0")
                + ", lpad(CAST(o_orderkey % 9000 + 1000 AS STRING), 4, '0'))",
                "phone_status": "CASE WHEN o_totalprice < 30000 THEN 'INVALID' WHEN o_orderstatus = 'P'"
                " THEN 'unverified' ELSE 'verified' END",
                "marketing_consent": "o_totalprice >= 100000",
            },
        ),
        "investments": (
            "lineitem",
            {
                "investment_id": "l_orderkey * 10 + l_linenumber",
                "customer_id": "l_partkey",
                "investment_type": labelled(line_share, "STOCKS", "BONDS", "MUTUAL_FUNDS", "ETF", "REAL_ESTATE"),
                "investment_amount": _money("l_extendedprice", 12),
                "current_price": _money(f"1 + {d.whole('l_quantity')} % 20 * 0.05 - 0.3", 8),
            },
        ),
        "product_usage": (
            "events",
            {
                "usage_id": "event_id",
                "customer_id": "user_id * 10 + event_id % 9",
                "product_id": labelled(event_share, "SAVE001", "LOAN001", "INVT001", "CD001", "CHCK001", "SAVE001", "CHCK001"),
                "usage_count": f"CAST({d.whole('value')} % 10 + 1 AS INT)",
                "usage_date": d.plus("ts", "-(event_id % 200)"),
            },
        ),
        "marketing_campaigns": (
            "events",
            {
                "campaign_id": "event_id",
                "customer_id": "user_id * 10 + event_id % 8",
                "campaign_type": labelled(event_share, "DIRECT_MAIL", "DIGITAL_ADS", "SOCIAL_MEDIA", "PHONE_CALL", "EVENT", "EMAIL_PROMOTION"),
                "campaign_date": shared["marketing_campaigns"][1]["sent_date"],
                "response_status": "CASE event_type WHEN 'purchase' THEN 'CONVERTED' WHEN 'click' THEN 'ENGAGED' ELSE 'NO_RESPONSE' END",
            },
        ),
        "risk_assessments": (
            "events",
            {
                **of("risk_assessments", "assessment_id", "customer_id", "risk_score", "assessment_date"),
                "risk_type": labelled(event_share, "CREDIT_RISK", "FRAUD_RISK", "OPERATIONAL_RISK", "COMPLIANCE_RISK"),
                "risk_level": level,
            },
        ),
        "fraud_alerts": (
            "events",
            {
                **of("fraud_alerts", "alert_id", "customer_id", "alert_type", "alert_timestamp", "alert_status"),
                "risk_level": level,
            },
        ),
        "credit_scores": (
            "events",
            {
                **of("credit_scores", "score_id", "customer_id", "score_date", "bureau"),
                "score_value": shared["credit_scores"][1]["credit_score"],
            },
        ),
        "kyc_records": (
            "events",
            {
                **of("kyc_records", "kyc_id", "customer_id", "kyc_type"),
                "verification_date": shared["kyc_records"][1]["review_date"],
                "verification_status": "CASE WHEN value > 160 THEN 'FAILED' WHEN value > 130 THEN 'PENDING' ELSE 'VERIFIED' END",
            },
        ),
    }
    return {**shared, **{name: (table, {**columns, **loaded}) for name, (table, columns) in own.items()}}


def shop_inputs(d=SparkText) -> dict[str, tuple[str, dict[str, str]]]:
    """Per input of the order demo: the given table it comes from, and its columns."""
    first, last = labelled(customer_share, "Bo", "Cy", None, "Ann"), "c_mktsegment"
    status = (
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN "
        + labelled(order_share, "shipped", "placed")
        + " ELSE "
        + labelled(order_share, "returned", "return_pending")
        + " END"
    )
    return {
        "raw_customers": ("customer", {"id": "c_custkey", "first_name": first, "last_name": last}),
        "raw_orders": (
            "orders",
            {
                "id": "o_orderkey",
                "user_id": "o_custkey",
                "order_date": "CAST(o_orderdate AS DATE)",
                "status": status,
            },
        ),
        "raw_payments": (
            "lineitem",
            {
                "id": "l_orderkey * 10 + l_linenumber",
                "order_id": "CASE WHEN l_partkey % 50 = 0 THEN -1 ELSE l_orderkey END",
                "payment_method": labelled(cost_share, "coupon", "bank_transfer", "gift_card", "credit_card"),
                "amount": d.whole("l_extendedprice * 100"),
            },
        ),
        "shop_customers": (
            "customer",
            {
                "customer_id": "c_custkey",
                "first_name": first,
                "last_name": last,
                "email": "concat('c', CAST(c_custkey AS STRING), '@example.com')",
            },
        ),
        "shop_orders": (
            "orders",
            {
                "order_id": "o_orderkey",
                "customer_id": "o_custkey",
                "order_date": "CAST(o_orderdate AS TIMESTAMP)",
                "amount": _money(f"{d.whole('o_totalprice')} % 500"),
                "status": status,
            },
        ),
        "pairs": ("lineitem", {"i": "l_partkey + 1", "j": "l_suppkey + 1"}),
    }


def table_path(folder: str, name: str) -> str:
    return f"{folder}/{name}.parquet"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


class TableFrames(Mapping[str, DataFrame]):
    """Inputs as lazy frames over the given tables; a table is opened when an input
    that needs it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str, inputs: dict[str, tuple[str, dict[str, str]]]):
        self._spark, self._folder, self._inputs = spark, folder, inputs
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        table, columns = self._inputs[name]
        if table not in self._tables:
            self._tables[table] = read_table(self._spark, self._folder, table)
        return self._tables[table].selectExpr(*[f"{text} AS {column}" for column, text in columns.items()])

    def source(self, name: str) -> str:
        """Where the given table of an input lies."""
        return table_path(self._folder, self._inputs[name][0])

    def sources(self) -> set[str]:
        return {self.source(name) for name in self._inputs}

    def __iter__(self) -> Iterator[str]:
        return iter(self._inputs)

    def __len__(self) -> int:
        return len(self._inputs)


def bank_frames(spark: SparkSession, folder: str, as_of: str = "2024-02-01") -> TableFrames:
    return TableFrames(spark, folder, bank_inputs(SparkText, as_of))


def alternative_frames(spark: SparkSession, folder: str, as_of: str = "2024-02-01") -> TableFrames:
    return TableFrames(spark, folder, alternative_inputs(SparkText, as_of))


def shop_frames(spark: SparkSession, folder: str) -> TableFrames:
    return TableFrames(spark, folder, shop_inputs(SparkText))
