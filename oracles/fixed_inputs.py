"""The bank and shop inputs as the check queries read them: per input the given table and its
columns in DuckDB's SQL, and the fixed rows of the joined reference tables."""

LOADED = "TIMESTAMP '2024-02-01'"

# Whole numbers from 0 to 99 by which labels are dealt, from columns of the given tables.
HOME = "4 * c_nationkey"
ORDER = "(CAST(floor(o_totalprice) AS BIGINT) % 100)"
PRICE = "(CAST(floor(o_totalprice / 100) AS BIGINT) % 100)"
BRAND = "4 * (CAST(split_part(p_brand, '#', 2) AS INTEGER) - 1)"
LINE = "(CAST(floor(l_extendedprice) AS BIGINT) % 100)"
COST = "(CAST(floor(l_extendedprice / 100) AS BIGINT) % 100)"
UNITS = "(2 * (CAST(l_quantity AS BIGINT) - 1))"
EVENT = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
VALUE = "(CAST(floor(value) AS BIGINT) % 100)"


def label(share: str, *labels) -> str:
    """The label at the share's place in an even cut of 0..99."""
    listed = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in labels)
    return f"([{listed}])[1 + CAST({share} AS BIGINT) * {len(labels)} // 100]"


def number(prefix: str, expr: str, width: int) -> str:
    return f"printf('{prefix}%0{width}d', CAST({expr} AS BIGINT))"


def moved(column: str, days: str, minutes: str = "0") -> str:
    return f"(CAST({column} AS TIMESTAMP) + INTERVAL 1 DAY * ({days}) + INTERVAL 1 MINUTE * ({minutes}))"


def since(start: str, days: str) -> str:
    return f"(TIMESTAMP '{start}' + INTERVAL 1 DAY * ({days}))"


BANK: dict[str, tuple[str, dict[str, str]]] = {
    "customers_360": (
        "customer",
        {
            "customer_id": "c_custkey",
            "customer_number": number("CUST", "c_custkey", 6),
            "first_name": label(HOME, 'JANE', 'mary-ann', "o'neil", 'john'),
            "last_name": "c_mktsegment",
            "date_of_birth": since("1944-01-01", "c_custkey * 97 % 22000"),
            "gender": label(HOME, 'f', 'm'),
            "email_address": "concat('Customer', CAST(c_custkey AS STRING), '@Email.com')",
            "phone_number": number("555-", "c_custkey % 10000", 4),
            "annual_income": "CAST(20000 + c_custkey * 7919 % 300000 AS INT)",
            "credit_score": "CAST(450 + c_custkey * 131 % 400 AS INT)",
            "customer_status": "CASE WHEN c_acctbal < -900 THEN 'closed' WHEN c_acctbal < -500 THEN 'suspended' ELSE 'active' END",
            "customer_since_date": since("2012-01-01", "c_custkey * 53 % 4400"),
            "last_updated": LOADED,
        },
    ),
    "accounts": (
        "orders",
        {
            "account_id": "o_orderkey",
            "account_number": number("ACC", "o_orderkey", 8),
            "customer_id": "o_custkey",
            "product_id": "CASE WHEN o_orderkey % 97 = 0 THEN 'NEW001' WHEN o_orderpriority = '1-URGENT' THEN 'CHCK001' WHEN o_orderpriority = '2-HIGH' THEN 'SAVE001' WHEN o_orderpriority = '3-MEDIUM' THEN 'CD001' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'INVT001' ELSE 'BUSI001' END",
            "current_balance": "CAST(CAST(o_totalprice AS DECIMAL(14,2)) - 100000 * (o_orderkey % 4) AS DECIMAL(14,2))",
            "average_balance": "CAST(o_totalprice AS DECIMAL(14,2))",
            "account_status": "CASE WHEN o_orderstatus <> 'P' THEN 'active' WHEN o_totalprice < 50000 THEN 'closed' WHEN o_totalprice < 100000 THEN 'dormant' WHEN o_totalprice < 150000 THEN 'restricted' ELSE 'active' END",
            "opened_date": moved("o_orderdate", "8036"),
            "closed_date": "CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN " + moved("o_orderdate", "8436") + " END",
            "interest_rate": "CAST(CAST(o_orderkey % 500 AS DOUBLE) / 100 AS DECIMAL(6,2))",
            "monthly_fee": "CAST(5 * (o_orderkey % 4) AS DECIMAL(8,2))",
            "online_banking_enabled": "NOT (o_orderpriority = '5-LOW')",
            "mobile_banking_enabled": "o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderstatus = 'O'",
            "overdraft_protection": "o_totalprice >= 200000",
            "is_joint_account": "o_orderstatus = 'F' AND o_totalprice >= 400000",
            "last_updated": LOADED,
        },
    ),
    "cards": (
        "orders",
        {
            "card_id": "o_orderkey",
            "card_number_masked": number("CARD", "o_orderkey", 8),
            "customer_id": "o_custkey",
            "linked_account_id": "CASE WHEN " + ORDER + " < 34 THEN o_orderkey END",
            "card_type": label(ORDER, 'debit', 'credit', 'prepaid'),
            "card_brand": label(ORDER, 'visa', 'mastercard', 'amex', 'discover'),
            "card_status": "CASE WHEN o_orderstatus <> 'P' THEN 'active' WHEN o_orderpriority = '5-LOW' THEN 'blocked' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'expired' ELSE 'inactive' END",
            "credit_limit": "CASE WHEN " + ORDER + " BETWEEN 34 AND 66 THEN " + label(PRICE, 50000, 25000, 10000, 5000, 0) + " END",
            "current_balance": "CASE WHEN " + ORDER + " < 34 THEN CAST(0 AS DECIMAL(14,2)) ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 9973 AS DECIMAL(14,2)) END",
            "issue_date": moved("o_orderdate", "8036"),
            "expiry_date": moved("o_orderdate", "8036") + " + INTERVAL 4 YEAR",
            "contactless_enabled": "o_orderstatus <> 'P'",
            "online_enabled": "NOT (o_orderpriority = '5-LOW')",
            "international_enabled": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
            "is_business_card": "o_totalprice >= 400000",
            "last_updated": LOADED,
        },
    ),
    "loans": (
        "part",
        {
            "loan_id": "p_partkey",
            "loan_number": number("LOAN", "p_partkey", 8),
            "customer_id": "CAST(floor(p_partkey / 3.0) AS BIGINT)",
            "loan_type": label(BRAND, 'mortgage', 'personal', 'auto', 'home_equity'),
            "original_amount": "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * (1 + 5 * p_size) AS DECIMAL(14,2))",
            "current_balance": "CASE WHEN p_partkey % 9 = 0 THEN CAST(0 AS DECIMAL(14,2)) ELSE CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) * (1 + 5 * p_size) AS DECIMAL(14,2)) - (CAST(p_retailprice AS DECIMAL(12,2)) * (p_partkey % 6)) AS DECIMAL(14,2)) END",
            "interest_rate": "CAST(CAST(350 + p_partkey % 120 * 10 AS DOUBLE) / 100 AS DECIMAL(6,2))",
            "term_months": label(BRAND, 360, 60, 72, 180),
            "loan_status": "CASE WHEN p_size <= 4 THEN 'charged_off' WHEN p_size <= 8 THEN 'default' WHEN p_size <= 12 THEN 'delinquent' WHEN p_size <= 18 THEN 'paid_off' ELSE 'current' END",
            "origination_date": since("2013-01-01", "p_partkey * 37 % 3900"),
            "maturity_date": "CASE WHEN p_size BETWEEN 13 AND 18 THEN " + since("2013-01-01", "p_partkey * 37 % 3900") + " + INTERVAL 9 YEAR END",
            "days_past_due": "CASE WHEN p_size <= 14 THEN CAST(9 * (14 - p_size) AS INT) ELSE 0 END",
            "has_collateral": "p_size > 40",
            "is_secured": "p_size > 30",
            "last_updated": LOADED,
        },
    ),
    "investments": (
        "lineitem",
        {
            "holding_id": "l_orderkey * 10 + l_linenumber",
            "holding_number": number("INV", "l_orderkey * 10 + l_linenumber", 10),
            "customer_id": "l_partkey",
            "investment_type": label(LINE, 'stock', 'bond', 'mutual_fund', 'etf', 'cd', 'money_market'),
            "symbol": label(LINE, 'aapl', 'us_treasury_10yr', 'fund_500', 'vti', 'bank_cd_5yr', 'cash'),
            "quantity": "CAST(l_quantity AS DECIMAL(14,2))",
            "purchase_price": "CAST(1 + CAST(floor(l_extendedprice / 5) AS BIGINT) * 0.01 AS DECIMAL(12,2))",
            "current_price": "CAST(CAST(floor(l_quantity) AS BIGINT) % 31 - 10 + CAST(floor(l_extendedprice / 5) AS BIGINT) * 0.01 AS DECIMAL(12,2))",
            "purchase_date": moved("l_shipdate", "8036"),
            "account_type": label(COST, 'taxable', 'ira', 'roth_ira', '401k'),
            "risk_rating": label(COST, 'medium', 'low', 'high'),
            "last_updated": LOADED,
        },
    ),
    "insurance_policies": (
        "part",
        {
            "policy_id": "p_partkey",
            "policy_number": number("POL", "p_partkey", 8),
            "customer_id": "CAST(floor(p_partkey / 2.0) AS BIGINT)",
            "policy_type": label(BRAND, 'LIFE', 'AUTO', 'HOME', 'HEALTH'),
            "coverage_amount": "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * p_size AS DECIMAL(14,2))",
            "annual_premium": "CAST(p_retailprice AS DECIMAL(10,2))",
            "policy_start_date": since("2018-01-01", "p_partkey * 29 % 2100"),
            "policy_status": "CASE WHEN p_size > 47 THEN 'CANCELLED' WHEN p_size > 44 THEN 'LAPSED' WHEN p_size > 41 THEN 'SUSPENDED' ELSE 'ACTIVE' END",
            "claims_count": "CAST(p_partkey % 7 AS INT)",
            "last_updated": LOADED,
        },
    ),
    "customer_addresses": (
        "orders",
        {
            "address_id": "o_orderkey",
            "customer_id": "o_custkey",
            "address_type": label(ORDER, 'primary', 'business', 'previous', 'mailing'),
            "street_address": "concat(CAST(100 + o_orderkey % 9900 AS STRING), " + label(ORDER, ' oak avenue', ' pine road', ' elm drive', ' maple lane', ' main street') + ")",
            "unit_number": "CASE WHEN " + ORDER + " < 34 THEN concat('apt ', CAST(o_orderkey % 50 + 1 AS STRING)) END",
            "city": label(ORDER, 'los angeles', 'CHICAGO', 'houston', 'phoenix', 'philadelphia', 'san antonio', 'winston-salem', 'seattle', 'denver', 'new york'),
            "state_code": label(ORDER, 'ca', 'il', 'tx', 'az', 'pa', 'tx', 'nc', 'wa', 'co', 'ny'),
            "postal_code": "CAST(10000 + o_orderkey % 89999 AS STRING)",
            "address_status": "CASE WHEN o_totalprice < 20000 THEN 'INVALID' WHEN o_totalprice < 30000 THEN NULL WHEN o_orderstatus = 'P' THEN 'UNVERIFIED' ELSE 'VERIFIED' END",
            "address_since": "CASE WHEN o_totalprice < 480000 THEN " + moved("o_orderdate", "8036") + " END",
            "address_until": "CASE WHEN o_orderstatus = 'F' THEN " + moved("o_orderdate", "8936") + " END",
            "is_deliverable": "NOT (o_orderpriority = '5-LOW')",
            "last_updated": LOADED,
        },
    ),
    "customer_phones": (
        "orders",
        {
            "phone_id": "o_orderkey",
            "customer_id": "o_custkey",
            "phone_type": label(ORDER, 'mobile', 'home', 'work', 'fax'),
            "area_code": label(ORDER, '444', '333', '000', '800', '555'),
            "exchange": "lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')",
            "line_number": "lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0')",
            "is_verified": "o_orderstatus <> 'P'",
            "sms_enabled": "NOT (o_orderpriority = '5-LOW')",
            "marketing_opt_in": "o_totalprice >= 150000",
            "do_not_call": "o_totalprice < 25000",
            "phone_status": "CASE WHEN o_totalprice < 30000 THEN 'inactive' WHEN o_totalprice < 60000 THEN 'unverified' ELSE 'active' END",
            "is_primary": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
            "preferred_contact_start": label(ORDER, '09:30:00', '10:00:00', '08:00:00'),
            "preferred_contact_end": label(ORDER, '18:00:00', '19:15:00', '20:00:00'),
            "last_updated": LOADED,
        },
    ),
    "customer_interactions": (
        "events",
        {
            "interaction_id": "event_id",
            "interaction_number": number("INT", "event_id", 10),
            "customer_id": "user_id * 10 + event_id % 11",
            "interaction_type": label(EVENT, 'phone_call', 'email', 'chat', 'branch_visit', 'social_media'),
            "reason_code": label(EVENT, 'account_inquiry', 'transaction_dispute', 'card_issue', 'loan_question', 'fees_complaint', 'technical_support', 'product_information', 'general_inquiry'),
            "status": "CASE WHEN event_type = 'error' THEN 'escalated' WHEN value < 5 THEN 'pending' WHEN value < 10 THEN 'reopened' ELSE 'resolved' END",
            "priority": label(EVENT, 'urgent', 'high', 'medium', 'low'),
            "interaction_datetime": moved("ts", "-(event_id % 120)"),
            "duration_minutes": "CAST(event_id * 7 % 150 + 5 AS INT)",
            "agent_id": number("AGENT", "event_id % 50", 3),
            "agent_tier": label(EVENT, 'tier_1', 'tier_2', 'specialist', 'supervisor'),
            "contact_count": "CAST(event_id % 5 + 1 AS INT)",
            "satisfaction_score": "CASE WHEN event_id % 4 <> 0 THEN CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS INT) END",
            "was_escalated": "event_type = 'error'",
            "required_followup": "event_type = 'view'",
            "resulted_in_retention": "event_type = 'signup'",
            "last_updated": LOADED,
        },
    ),
    "digital_activity": (
        "events",
        {
            "activity_id": "event_id",
            "customer_id": "user_id",
            "activity_type": "CASE event_type WHEN 'signup' THEN 'LOGIN' WHEN 'view' THEN 'BALANCE_CHECK' WHEN 'click' THEN 'TRANSFER' WHEN 'purchase' THEN 'BILL_PAY' ELSE 'ACCOUNT_SETTINGS' END",
            "platform": label(EVENT, 'MOBILE_APP', 'MOBILE_APP', 'WEB_PORTAL'),
            "activity_timestamp": moved("ts", "-(event_id % 100)"),
            "last_updated": LOADED,
        },
    ),
    "transactions": (
        "lineitem",
        {
            "transaction_id": "l_orderkey * 10 + l_linenumber",
            "transaction_number": number("TXN", "l_orderkey * 10 + l_linenumber", 10),
            "account_id": "l_orderkey",
            "transaction_type": label(LINE, 'deposit', 'withdrawal', 'transfer_in', 'transfer_out', 'payment', 'purchase', 'fee', 'interest', 'dividend', 'refund'),
            "transaction_amount": "CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_extendedprice AS DECIMAL(12,2)) WHEN l_linenumber = 2 THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE CAST(l_quantity * 50 AS DECIMAL(12,2)) END",
            "transaction_status": "CASE WHEN l_quantity <= 2 THEN 'failed' WHEN l_quantity <= 4 THEN 'pending' WHEN l_quantity <= 6 THEN 'cancelled' ELSE 'completed' END",
            "channel": label(UNITS, "atm", "online", "mobile", "branch", "phone", "card"),
            "transaction_datetime": moved("l_shipdate", "8036", "l_partkey % 1440"),
            "transaction_location": label(LINE, 'Chicago, IL', 'Online', 'New York, NY'),
            "merchant_name": label(LINE, 'Grocer', None, 'Fuel', None),
            "is_high_risk": "l_returnflag = 'R' AND l_discount >= 0.1",
            "requires_approval": "l_returnflag = 'R'",
            "last_updated": LOADED,
        },
    ),
    "deposits": (
        "lineitem",
        {
            "deposit_id": "l_orderkey * 10 + l_linenumber",
            "deposit_number": number("DEP", "l_orderkey * 10 + l_linenumber", 10),
            "account_id": "l_orderkey",
            "deposit_type": label(LINE, 'PAYROLL', 'CASH', 'CHECK', 'WIRE_TRANSFER', 'ACH', 'MOBILE_DEPOSIT'),
            "deposit_amount": "CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_extendedprice AS DECIMAL(12,2)) WHEN l_linenumber = 2 THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE CAST(l_quantity * 50 AS DECIMAL(12,2)) END",
            "deposit_datetime": moved("l_shipdate", "8036", "l_partkey % 1440"),
            "deposit_status": "CASE WHEN l_quantity <= 4 THEN 'PENDING' WHEN l_quantity <= 8 THEN 'HELD' ELSE 'CLEARED' END",
            "last_updated": LOADED,
        },
    ),
    "withdrawals": (
        "lineitem",
        {
            "withdrawal_id": "l_orderkey * 10 + l_linenumber",
            "withdrawal_number": number("WDL", "l_orderkey * 10 + l_linenumber", 10),
            "account_id": "l_orderkey",
            "withdrawal_type": label(LINE, 'ATM', 'TELLER', 'ONLINE', 'WIRE_TRANSFER', 'CHECK'),
            "withdrawal_amount": "CAST(l_quantity * 137 AS DECIMAL(12,2))",
            "withdrawal_datetime": moved("l_shipdate", "8036", "l_partkey % 1440"),
            "withdrawal_status": "CASE WHEN l_quantity <= 4 THEN 'FAILED' WHEN l_quantity <= 8 THEN 'PENDING' ELSE 'COMPLETED' END",
            "last_updated": LOADED,
        },
    ),
    "transfers": (
        "lineitem",
        {
            "transfer_id": "l_orderkey * 10 + l_linenumber",
            "from_account_id": "l_orderkey",
            "to_account_id": "l_partkey * 8",
            "transfer_amount": "CAST(l_quantity * 11 AS DECIMAL(12,2))",
            "transfer_date": moved("l_shipdate", "8036"),
            "transfer_status": "CASE WHEN l_quantity <= 5 THEN 'FAILED' ELSE 'COMPLETED' END",
            "last_updated": LOADED,
        },
    ),
    "payments": (
        "lineitem",
        {
            "payment_id": "l_orderkey * 10 + l_linenumber",
            "payment_number": number("PAY", "l_orderkey * 10 + l_linenumber", 10),
            "account_id": "l_orderkey",
            "payment_type": label(LINE, 'BILL_PAY', 'PERSON_TO_PERSON', 'MERCHANT_PAYMENT', 'LOAN_PAYMENT', 'TAX_PAYMENT'),
            "payment_amount": "CAST(l_quantity * 23 AS DECIMAL(12,2))",
            "payment_date": moved("l_shipdate", "8036"),
            "payment_status": "CASE WHEN l_quantity <= 3 THEN 'FAILED' WHEN l_quantity <= 7 THEN 'PENDING' ELSE 'COMPLETED' END",
            "last_updated": LOADED,
        },
    ),
    "fees": (
        "lineitem",
        {
            "fee_id": "l_orderkey * 10 + l_linenumber",
            "fee_number": number("FEE", "l_orderkey * 10 + l_linenumber", 8),
            "account_id": "l_orderkey",
            "fee_type": label(LINE, 'MONTHLY_MAINTENANCE', 'OVERDRAFT', 'ATM_FEE', 'WIRE_TRANSFER', 'FOREIGN_TRANSACTION', 'LATE_PAYMENT'),
            "fee_amount": "CAST(l_tax * 500 AS DECIMAL(10,2))",
            "fee_date": moved("l_shipdate", "8036"),
            "fee_status": "CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' WHEN l_discount = 0 THEN 'WAIVED' ELSE 'CHARGED' END",
            "last_updated": LOADED,
        },
    ),
    "account_balances": (
        "lineitem",
        {
            "balance_id": "l_orderkey * 10 + l_linenumber",
            "account_id": "l_orderkey",
            "balance_amount": "CAST(l_extendedprice - 5000 AS DECIMAL(12,2))",
            "available_balance": "CAST(l_extendedprice - 5100 AS DECIMAL(12,2))",
            "balance_date": moved("l_shipdate", "8036"),
            "last_updated": LOADED,
        },
    ),
    "interest_accruals": (
        "lineitem",
        {
            "accrual_id": "l_orderkey * 10 + l_linenumber",
            "account_id": "l_orderkey",
            "interest_amount": "CAST(l_discount * 100 AS DECIMAL(10,2))",
            "interest_rate": "CAST(l_discount * 50 AS DECIMAL(6,2))",
            "accrual_date": moved("l_shipdate", "8036"),
            "last_updated": LOADED,
        },
    ),
    "account_alerts": (
        "lineitem",
        {
            "alert_id": "l_orderkey * 10 + l_linenumber",
            "account_id": "l_orderkey",
            "alert_type": label(LINE, 'LOW_BALANCE', 'LARGE_DEPOSIT', 'UNUSUAL_ACTIVITY', 'PAYMENT_DUE', 'RATE_CHANGE'),
            "alert_timestamp": moved("l_shipdate", "8036", "l_partkey % 1440"),
            "alert_status": "CASE WHEN l_quantity > 49 AND l_discount = 0 THEN 'PENDING' WHEN l_linestatus = 'F' THEN 'ACTIONED' ELSE 'DISMISSED' END",
            "last_updated": LOADED,
        },
    ),
    "channel_usage": (
        "events",
        {
            "usage_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 11",
            "channel_type": label(EVENT, 'ONLINE', 'MOBILE', 'ATM', 'BRANCH', 'MOBILE', 'PHONE'),
            "usage_count": "CAST(CAST(floor(value) AS BIGINT) % 20 + 1 AS INT)",
            "usage_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "last_updated": LOADED,
        },
    ),
    "product_usage": (
        "events",
        {
            "usage_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 9",
            "product_type": label(EVENT, 'CHECKING', 'SAVINGS', 'CREDIT_CARD', 'MORTGAGE', 'INVESTMENTS', 'INSURANCE', 'LOANS', 'MOBILE_BANKING'),
            "usage_frequency": "CAST(CAST(floor(value) AS BIGINT) % 10 + 1 AS INT)",
            "usage_date": moved("ts", "-(event_id % 200)"),
            "last_updated": LOADED,
        },
    ),
    "customer_segments": (
        "events",
        {
            "segment_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 10",
            "segment_name": label(EVENT, 'PREMIUM', 'MASS_AFFLUENT', 'EMERGING_AFFLUENT', 'MASS_MARKET', 'YOUNG_PROFESSIONAL', 'PREMIUM', 'STUDENT'),
            "segment_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "last_updated": LOADED,
        },
    ),
    "marketing_campaigns": (
        "events",
        {
            "campaign_response_id": "event_id",
            "campaign_id": number("CAMP", "event_id % 50", 6),
            "customer_id": "user_id * 10 + event_id % 8",
            "campaign_type": label(EVENT, 'SAVINGS_PROMOTION', 'LOAN_OFFER', 'INVESTMENT_SEMINAR', 'INSURANCE_QUOTE', 'DIGITAL_BANKING', 'REFERRAL', 'CREDIT_CARD_OFFER'),
            "channel": label(VALUE, 'EMAIL', 'DIRECT_MAIL', 'PHONE', 'DIGITAL_AD'),
            "sent_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "response_type": "CASE event_type WHEN 'purchase' THEN 'CONVERTED' WHEN 'click' THEN 'CLICKED' WHEN 'view' THEN 'OPENED' ELSE 'NO_RESPONSE' END",
            "resulted_in_sale": "event_type IN ('purchase', 'signup')",
            "last_updated": LOADED,
        },
    ),
    "retention_events": (
        "events",
        {
            "event_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 7",
            "event_type": "CASE event_type WHEN 'view' THEN 'RETENTION_OFFER_SENT' WHEN 'purchase' THEN 'CUSTOMER_SAVED' WHEN 'click' THEN 'WIN_BACK_CAMPAIGN' WHEN 'signup' THEN 'LOYALTY_PROGRAM_ENROLLED' ELSE CASE WHEN value > 100 THEN 'ACCOUNT_CLOSED' ELSE 'CHURN_RISK_IDENTIFIED' END END",
            "event_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "event_outcome": label(EVENT, 'FAILED', 'PENDING', 'SUCCESSFUL'),
            "last_updated": LOADED,
        },
    ),
    "risk_assessments": (
        "events",
        {
            "assessment_id": "event_id",
            "assessment_number": number("RISK", "event_id", 8),
            "customer_id": "user_id * 10 + event_id % 11",
            "risk_type": label(EVENT, 'CREDIT_RISK', 'FRAUD_RISK', 'OPERATIONAL_RISK', 'MARKET_RISK'),
            "risk_score": "CAST(400 + event_id * 37 % 450 AS INT)",
            "risk_rating": "CASE WHEN CAST(400 + event_id * 37 % 450 AS INT) >= 750 THEN 'LOW' WHEN CAST(400 + event_id * 37 % 450 AS INT) >= 650 THEN 'MEDIUM' WHEN CAST(400 + event_id * 37 % 450 AS INT) >= 550 THEN 'HIGH' ELSE 'VERY_HIGH' END",
            "assessment_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "requires_review": "event_id % 30 = 1",
            "last_updated": LOADED,
        },
    ),
    "fraud_alerts": (
        "events",
        {
            "alert_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 9",
            "alert_type": label(EVENT, 'UNUSUAL_TRANSACTION', 'LOCATION_ANOMALY', 'VELOCITY_CHECK', 'MERCHANT_RISK', 'BEHAVIORAL_PATTERN'),
            "risk_score": "CAST(event_id * 13 % 100 AS INT)",
            "alert_timestamp": moved("ts", "-(event_id % 60)"),
            "alert_status": "CASE WHEN value > 150 THEN 'CONFIRMED_FRAUD' WHEN value > 120 THEN 'UNDER_REVIEW' ELSE 'FALSE_POSITIVE' END",
            "last_updated": LOADED,
        },
    ),
    "compliance_records": (
        "events",
        {
            "compliance_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 8",
            "compliance_type": label(EVENT, 'AML_SCREENING', 'SANCTIONS_CHECK', 'PEP_SCREENING', 'ADVERSE_MEDIA'),
            "check_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "compliance_status": "CASE WHEN value > 160 THEN 'FLAGGED' ELSE 'CLEAR' END",
            "last_updated": LOADED,
        },
    ),
    "credit_scores": (
        "events",
        {
            "score_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 11",
            "credit_score": "CAST(600 + event_id * 41 % 250 - 3 * (user_id % 40) AS INT)",
            "score_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "bureau": label(EVENT, 'EXPERIAN', 'EQUIFAX', 'TRANSUNION'),
            "last_updated": LOADED,
        },
    ),
    "kyc_records": (
        "events",
        {
            "kyc_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 10",
            "kyc_type": label(EVENT, 'INITIAL', 'PERIODIC_REVIEW', 'ENHANCED_DD'),
            "review_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "status": "CASE WHEN value > 160 THEN 'FAILED' ELSE 'PASSED' END",
            "last_updated": LOADED,
        },
    ),
}

# Where the alternative profile differs.
ALTERNATIVE: dict[str, tuple[str, dict[str, str]]] = BANK | {
    "loans": (
        "part",
        {
            "loan_id": "p_partkey",
            "customer_id": "CAST(floor(p_partkey / 3.0) AS BIGINT)",
            "loan_type": label(BRAND, 'personal', 'auto', 'mortgage', 'student'),
            "loan_date": since("2013-01-01", "p_partkey * 37 % 3900"),
            "loan_amount": "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * (1 + 5 * p_size) AS DECIMAL(14,2))",
            "loan_status": "CASE WHEN p_size <= 4 THEN 'defaulted' WHEN p_size <= 8 THEN 'paid_off' WHEN p_size <= 10 THEN 'INVALID' ELSE 'active' END",
            "last_updated": LOADED,
        },
    ),
    "investments": (
        "lineitem",
        {
            "investment_id": "l_orderkey * 10 + l_linenumber",
            "customer_id": "l_partkey",
            "investment_type": label(LINE, 'STOCKS', 'BONDS', 'MUTUAL_FUNDS', 'ETF', 'REAL_ESTATE'),
            "investment_amount": "CAST(l_extendedprice AS DECIMAL(12,2))",
            "current_price": "CAST(1 + CAST(floor(l_quantity) AS BIGINT) % 20 * 0.05 - 0.3 AS DECIMAL(8,2))",
            "last_updated": LOADED,
        },
    ),
    "customer_phones": (
        "orders",
        {
            "phone_id": "o_orderkey",
            "customer_id": "o_custkey",
            "sms_enabled": "NOT (o_orderpriority = '5-LOW')",
            "is_primary": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
            "phone_type": label(ORDER, 'mobile', 'home', 'work', 'primary', 'emergency'),
            "phone_number": "concat(" + label(ORDER, '555-1', '(212) 555-', '555-0') + ", lpad(CAST(o_orderkey % 9000 + 1000 AS STRING), 4, '0'))",
            "phone_status": "CASE WHEN o_totalprice < 30000 THEN 'INVALID' WHEN o_orderstatus = 'P' THEN 'unverified' ELSE 'verified' END",
            "marketing_consent": "o_totalprice >= 100000",
            "last_updated": LOADED,
        },
    ),
    "product_usage": (
        "events",
        {
            "usage_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 9",
            "product_id": label(EVENT, 'SAVE001', 'LOAN001', 'INVT001', 'CD001', 'CHCK001', 'SAVE001', 'CHCK001'),
            "usage_count": "CAST(CAST(floor(value) AS BIGINT) % 10 + 1 AS INT)",
            "usage_date": moved("ts", "-(event_id % 200)"),
            "last_updated": LOADED,
        },
    ),
    "marketing_campaigns": (
        "events",
        {
            "campaign_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 8",
            "campaign_type": label(EVENT, 'DIRECT_MAIL', 'DIGITAL_ADS', 'SOCIAL_MEDIA', 'PHONE_CALL', 'EVENT', 'EMAIL_PROMOTION'),
            "campaign_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "response_status": "CASE event_type WHEN 'purchase' THEN 'CONVERTED' WHEN 'click' THEN 'ENGAGED' ELSE 'NO_RESPONSE' END",
            "last_updated": LOADED,
        },
    ),
    "risk_assessments": (
        "events",
        {
            "assessment_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 11",
            "risk_score": "CAST(400 + event_id * 37 % 450 AS INT)",
            "assessment_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "risk_type": label(EVENT, 'CREDIT_RISK', 'FRAUD_RISK', 'OPERATIONAL_RISK', 'COMPLIANCE_RISK'),
            "risk_level": label(EVENT, 'HIGH', 'MEDIUM', 'LOW'),
            "last_updated": LOADED,
        },
    ),
    "fraud_alerts": (
        "events",
        {
            "alert_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 9",
            "alert_type": label(EVENT, 'UNUSUAL_TRANSACTION', 'LOCATION_ANOMALY', 'VELOCITY_CHECK', 'MERCHANT_RISK', 'BEHAVIORAL_PATTERN'),
            "alert_timestamp": moved("ts", "-(event_id % 60)"),
            "alert_status": "CASE WHEN value > 150 THEN 'CONFIRMED_FRAUD' WHEN value > 120 THEN 'UNDER_REVIEW' ELSE 'FALSE_POSITIVE' END",
            "risk_level": label(EVENT, 'HIGH', 'MEDIUM', 'LOW'),
            "last_updated": LOADED,
        },
    ),
    "credit_scores": (
        "events",
        {
            "score_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 11",
            "score_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "bureau": label(EVENT, 'EXPERIAN', 'EQUIFAX', 'TRANSUNION'),
            "score_value": "CAST(600 + event_id * 41 % 250 - 3 * (user_id % 40) AS INT)",
            "last_updated": LOADED,
        },
    ),
    "kyc_records": (
        "events",
        {
            "kyc_id": "event_id",
            "customer_id": "user_id * 10 + event_id % 10",
            "kyc_type": label(EVENT, 'INITIAL', 'PERIODIC_REVIEW', 'ENHANCED_DD'),
            "verification_date": "CAST(CAST(" + moved("ts", "-(event_id % 60)") + " AS DATE) AS TIMESTAMP)",
            "verification_status": "CASE WHEN value > 160 THEN 'FAILED' WHEN value > 130 THEN 'PENDING' ELSE 'VERIFIED' END",
            "last_updated": LOADED,
        },
    ),
}

SHOP: dict[str, tuple[str, dict[str, str]]] = {
    "raw_customers": (
        "customer",
        {
            "id": "c_custkey",
            "first_name": label(HOME, 'Bo', 'Cy', None, 'Ann'),
            "last_name": "c_mktsegment",
        },
    ),
    "raw_orders": (
        "orders",
        {
            "id": "o_orderkey",
            "user_id": "o_custkey",
            "order_date": "CAST(o_orderdate AS DATE)",
            "status": "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN " + label(ORDER, 'shipped', 'placed') + " ELSE " + label(ORDER, 'returned', 'return_pending') + " END",
        },
    ),
    "raw_payments": (
        "lineitem",
        {
            "id": "l_orderkey * 10 + l_linenumber",
            "order_id": "CASE WHEN l_partkey % 50 = 0 THEN -1 ELSE l_orderkey END",
            "payment_method": label(COST, 'coupon', 'bank_transfer', 'gift_card', 'credit_card'),
            "amount": "CAST(floor(l_extendedprice * 100) AS BIGINT)",
        },
    ),
    "shop_customers": (
        "customer",
        {
            "customer_id": "c_custkey",
            "first_name": label(HOME, 'Bo', 'Cy', None, 'Ann'),
            "last_name": "c_mktsegment",
            "email": "concat('c', CAST(c_custkey AS STRING), '@example.com')",
        },
    ),
    "shop_orders": (
        "orders",
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "order_date": "CAST(o_orderdate AS TIMESTAMP)",
            "amount": "CAST(CAST(floor(o_totalprice) AS BIGINT) % 500 AS DECIMAL(14,2))",
            "status": "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN " + label(ORDER, 'shipped', 'placed') + " ELSE " + label(ORDER, 'returned', 'return_pending') + " END",
        },
    ),
    "pairs": (
        "lineitem",
        {
            "i": "l_partkey + 1",
            "j": "l_suppkey + 1",
        },
    ),
}

REFERENCES = {
    'age_cohorts': """SELECT * FROM (VALUES ('AC001', 'Gen Z', 'Digital native social conscious'),
        ('AC002', 'Millennial', 'Tech-savvy career-focused'),
        ('AC003', 'Gen X', 'Established families wealth-building'),
        ('AC004', 'Baby Boomer', 'Pre-retirement wealth preservation'),
        ('AC005', 'Silent Generation', 'Conservative fixed-income focused'),
        ('AC006', 'Young Professional', 'Career growth investment-focused'),
        ('AC007', 'Mid-Career', 'Peak earning family-focused'),
        ('AC008', 'Pre-Retirement', 'Wealth preservation planning'),
        ('AC009', 'Retired', 'Income preservation legacy planning'),
        ('AC010', 'Young Adult', 'Student early career')) AS fixed_rows(cohort_id, cohort_name, characteristics)""",
    'credit_score_ranges': """SELECT * FROM (VALUES ('CSR001', 'Exceptional', 'A+', 0.5),
        ('CSR002', 'Very Good', 'A', 1.2),
        ('CSR003', 'Good', 'B+', 2.8),
        ('CSR004', 'Fair', 'B', 8.5),
        ('CSR005', 'Poor', 'C', 18.2),
        ('CSR006', 'Very Poor', 'D', 35.0),
        ('CSR007', 'No Score', 'N/A', 12.0),
        ('CSR008', 'Thin File', 'C-', 15.5),
        ('CSR009', 'New Credit', 'B', 6.2),
        ('CSR010', 'Rebuilt Credit', 'B-', 9.8)) AS fixed_rows(score_range_id, range_name, grade, default_rate)""",
    'geographic_regions': """SELECT * FROM (VALUES ('CA', 'California', 'West Coast', 'Urban', 148.5, 'High'),
        ('TX', 'Texas', 'Southwest', 'Mixed', 95.2, 'Medium'),
        ('NY', 'New York', 'Northeast', 'Urban', 139.8, 'High'),
        ('FL', 'Florida', 'Southeast', 'Mixed', 102.3, 'Medium'),
        ('IL', 'Illinois', 'Midwest', 'Urban', 108.7, 'High'),
        ('MT', 'Montana', 'Mountain West', 'Rural', 98.1, 'Low'),
        ('OH', 'Ohio', 'Midwest', 'Mixed', 92.4, 'Medium'),
        ('WA', 'Washington', 'Pacific Northwest', 'Urban', 118.9, 'Medium'),
        ('GA', 'Georgia', 'Southeast', 'Mixed', 96.7, 'Medium'),
        ('CO', 'Colorado', 'Mountain West', 'Mixed', 104.8, 'Medium')) AS fixed_rows(state_code, state_name, region_name, market_type, cost_of_living_index, population_density)""",
    'income_brackets': """SELECT * FROM (VALUES ('IB001', 'Low Income', 'Medium'),
        ('IB002', 'Lower Middle', 'High'),
        ('IB003', 'Middle Income', 'High'),
        ('IB004', 'Upper Middle', 'Very High'),
        ('IB005', 'High Income', 'Very High'),
        ('IB006', 'Affluent', 'Critical'),
        ('IB007', 'High Net Worth', 'Critical'),
        ('IB008', 'Ultra High Net Worth', 'Critical'),
        ('IB009', 'Very Wealthy', 'Critical'),
        ('IB010', 'Ultra Wealthy', 'Critical')) AS fixed_rows(bracket_id, bracket_name, marketing_priority)""",
    'lifecycle_stages': """SELECT * FROM (VALUES ('LS001', 'Prospect', 'Potential customer showing interest'),
        ('LS002', 'Onboarding', 'Recently opened first account'),
        ('LS003', 'New Customer', 'Learning product features and usage'),
        ('LS004', 'Growing', 'Adding products and increasing usage'),
        ('LS005', 'Established', 'Stable relationship with multiple products'),
        ('LS006', 'Mature', 'Long-term customer with deep relationship'),
        ('LS007', 'Loyal', 'Highly satisfied advocating for bank'),
        ('LS008', 'Champion', 'Top tier customer with referrals'),
        ('LS009', 'At Risk', 'Declining usage or satisfaction'),
        ('LS010', 'Dormant', 'Inactive account minimal activity')) AS fixed_rows(stage_id, stage_name, characteristics)""",
    'product_catalog': """SELECT * FROM (VALUES ('CHCK001', 'Basic Checking', 'account', 'banking', 0, 'Low'),
        ('SAVE001', 'High Yield Savings', 'account', 'banking', 1000, 'Low'),
        ('CRDT001', 'Platinum Credit Card', 'credit_card', 'lending', 0, 'Medium'),
        ('LOAN001', 'Personal Loan', 'loan', 'lending', 0, 'Medium'),
        ('MORT001', '30-Year Fixed Mortgage', 'mortgage', 'lending', 0, 'High'),
        ('INVT001', 'Brokerage Account', 'investment', 'investments', 2500, 'High'),
        ('INSUR001', 'Auto Insurance', 'insurance', 'insurance', 0, 'Low'),
        ('CD001', '12-Month CD', 'certificate', 'banking', 5000, 'Low'),
        ('BUSI001', 'Business Checking', 'account', 'commercial', 2500, 'Medium'),
        ('CRED002', 'Cash Back Credit Card', 'credit_card', 'lending', 0, 'Medium')) AS fixed_rows(product_id, product_name, product_type, category, min_balance, risk_level)""",
    'risk_categories': """SELECT * FROM (VALUES ('RC001', 1, 'Minimal Risk', 'Annual'),
        ('RC002', 2, 'Low Risk', 'Semi-Annual'),
        ('RC003', 3, 'Moderate Risk', 'Quarterly'),
        ('RC004', 4, 'Elevated Risk', 'Monthly'),
        ('RC005', 5, 'High Risk', 'Weekly'),
        ('RC006', 6, 'Severe Risk', 'Daily'),
        ('RC007', 7, 'Critical Risk', 'Real-time'),
        ('RC008', 8, 'Regulatory Watch', 'Daily'),
        ('RC009', 9, 'Sanctions Risk', 'Real-time'),
        ('RC010', 10, 'Fraud Alert', 'Real-time')) AS fixed_rows(risk_category_id, risk_level, risk_name, monitoring_frequency)""",
}
