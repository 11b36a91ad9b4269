"""Check queries of the order demo, the reusable steps and the data checks."""

from __future__ import annotations

from oracles import fixed_checks as contracts
from oracles.fixed_checks import Check
from oracles.fixed_inputs import SHOP
from oracles.fixed_rules import insights as I
from oracles.fixed_rules import orders as O
from oracles.text import Book, case, literal, mean, n, pct, real, rounded, score, select, share, total

# Column kinds of the reference tables, in order; a number tells the decimal places.
TEXT, WHOLE, FLAG, DAY = "text", "whole", "flag", "day"
REFERENCE_COLUMNS = {
    "product_catalog": (TEXT, TEXT, TEXT, TEXT, WHOLE, 2, 2, TEXT),
    "risk_categories": (TEXT, WHOLE, TEXT, WHOLE, WHOLE, TEXT, TEXT, FLAG),
    "credit_score_ranges": (TEXT, TEXT, WHOLE, WHOLE, TEXT, TEXT, TEXT, 2),
    "transaction_types": (TEXT, TEXT, TEXT, TEXT, FLAG, 2, FLAG),
    "channel_definitions": (TEXT, TEXT, TEXT, TEXT, FLAG, 2, TEXT),
    "geographic_regions": (TEXT, TEXT, TEXT, TEXT, TEXT, 1, TEXT),
    "income_brackets": (TEXT, TEXT, WHOLE, WHOLE, TEXT, TEXT, TEXT),
    "age_cohorts": (TEXT, TEXT, WHOLE, WHOLE, TEXT, TEXT, TEXT),
    "occupation_categories": (TEXT, TEXT, TEXT, TEXT, TEXT, 2),
    "regulatory_requirements": (TEXT, TEXT, TEXT, WHOLE, TEXT, TEXT),
    "compliance_rules": (TEXT, TEXT, TEXT, WHOLE, TEXT, TEXT),
    "currency_codes": (TEXT, TEXT, TEXT, WHOLE, 4, FLAG),
    "country_risk_ratings": (TEXT, TEXT, TEXT, TEXT, TEXT, TEXT),
    "fee_structures": (TEXT, TEXT, TEXT, 2, TEXT, TEXT),
    "interest_rate_tiers": (TEXT, TEXT, WHOLE, WHOLE, 2, TEXT),
    "marketing_segments": (TEXT, TEXT, TEXT, TEXT, TEXT, TEXT),
    "lifecycle_stages": (TEXT, TEXT, WHOLE, TEXT, TEXT),
    "service_level_agreements": (TEXT, TEXT, 1, WHOLE, 2, FLAG),
    "holiday_calendars": (TEXT, TEXT, DAY, FLAG, FLAG, TEXT),
    "economic_indicators": (TEXT, TEXT, 2, TEXT, TEXT, TEXT),
}


def reference_totals(table: str, kinds: tuple) -> str:
    """What a reference table made of the parts adds up to, by kind of column."""

    def added(texts: list[str], kind: str) -> str:
        return f"CAST({' + '.join(texts)} AS {kind})" if texts else f"CAST(NULL AS {kind})"

    at = list(enumerate(kinds))
    signs = ["sum(length('K' || p_partkey))", *[f"sum(length(p_type || ' {i}'))" for i, kind in at if i and kind == TEXT]]
    exact = [f"sum(CAST(p_size * 1.25 AS DECIMAL(18,{kind})))" for _, kind in at if isinstance(kind, int)]
    last = "CAST(max(DATE '2024-01-01' + p_size) AS VARCHAR)" if DAY in kinds else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{table}' AS table_name, count(*) AS entries, count(DISTINCT p_partkey) AS keys,"
        f" {added(signs, 'BIGINT')} AS signs,"
        f" {added([f'sum(p_size * {i})' for i, kind in at if kind == WHOLE], 'BIGINT')} AS whole_total,"
        f" {added(exact, 'DOUBLE')} AS exact_total,"
        f" {added([f'count(*) FILTER (p_size % 3 = {i % 3})' for i, kind in at if kind == FLAG], 'BIGINT')} AS flags,"
        f" {last} AS last_day FROM part"
    )



def build(book: Book) -> None:
    for name, (table, columns) in SHOP.items():
        book.add(f"_{name}", columns, table)

    # Order demo
    book.add("shop_stg_customers", {"customer_id": "id", "first_name": "first_name", "last_name": "last_name"}, "_raw_customers", "", ("_raw_customers",))
    book.add(
        "shop_stg_orders",
        {"order_id": "id", "customer_id": "user_id", "order_date": "order_date", "status": "status"},
        "_raw_orders",
        "",
        ("_raw_orders",),
    )
    book.add(
        "shop_stg_payments",
        {"payment_id": "id", "order_id": "order_id", "payment_method": "payment_method", "amount": "amount // 100"},
        "_raw_payments",
        "",
        ("_raw_payments",),
    )
    whole = {name: f"CAST({name} AS BIGINT)" for name in ("number_of_orders", "customer_lifetime_value")}
    book.add_text(
        "order_customers",
        "SELECT c.customer_id, c.first_name, c.last_name, CAST(o.first_order AS VARCHAR) AS first_order,"
        " CAST(o.most_recent_order AS VARCHAR) AS most_recent_order,"
        f" {whole['number_of_orders']} AS number_of_orders, {whole['customer_lifetime_value']} AS customer_lifetime_value"
        " FROM shop_stg_customers c LEFT JOIN (SELECT customer_id, min(order_date) AS first_order,"
        " max(order_date) AS most_recent_order, count(order_id) AS number_of_orders FROM shop_stg_orders"
        " GROUP BY customer_id) o ON o.customer_id = c.customer_id"
        " LEFT JOIN (SELECT so.customer_id, sum(p.amount) AS customer_lifetime_value FROM shop_stg_payments p"
        " LEFT JOIN shop_stg_orders so ON so.order_id = p.order_id GROUP BY so.customer_id) v"
        " ON v.customer_id = c.customer_id",
        "customer_id first_name last_name first_order most_recent_order number_of_orders customer_lifetime_value".split(),
        ("shop_stg_customers", "shop_stg_orders", "shop_stg_payments"),
    )
    paid = select(
        {
            "order_id": "order_id",
            **{
                f"{method}_amount": f"CAST({total('amount', f'payment_method = {literal(method)}')} AS BIGINT)"
                for method in O.PAYMENT_METHODS
            },
            "amount": "CAST(sum(amount) AS BIGINT)",
        },
        "shop_stg_payments",
        "GROUP BY order_id",
    )
    book.add(
        "order_payments_pivot",
        {
            "order_id": "o.order_id",
            "customer_id": "o.customer_id",
            "order_date": "o.order_date",
            "status": "o.status",
            **{f"{method}_amount": f"{method}_amount" for method in O.PAYMENT_METHODS},
            "amount": "amount",
        },
        f"shop_stg_orders o LEFT JOIN ({paid}) p ON p.order_id = o.order_id",
        "",
        ("shop_stg_orders", "shop_stg_payments"),
    )
    book.add(
        "published_customers",
        {
            "customer_id": "customer_id",
            "first_name": "first_name",
            "last_name": "last_name",
            "full_name": "first_name || ' ' || last_name",
            "email": "email",
        },
        "_shop_customers",
        "",
        ("_shop_customers",),
    )
    book.add(
        "published_orders",
        {
            "order_id": "order_id",
            "customer_id": "customer_id",
            "order_date": "CAST(order_date AS DATE)",
            "amount": real("amount"),
            "status": "status",
        },
        "_shop_orders",
        "",
        ("_shop_orders",),
    )
    book.add(
        "customer_orders",
        {
            "customer_id": "c.customer_id",
            "full_name": "c.full_name",
            "email": "c.email",
            "total_orders": "count(o.order_id)",
            "total_spent": real("sum(o.amount)"),
        },
        "published_customers c LEFT JOIN _shop_orders o ON o.customer_id = c.customer_id",
        "WHERE o.status = 'completed' GROUP BY c.customer_id, c.full_name, c.email",
        ("published_customers", "_shop_orders"),
    )
    book.add(
        "customer_summary",
        {
            "customer_id": "customer_id",
            "full_name": "full_name",
            "total_orders": "total_orders",
            "total_spent": "total_spent",
            "customer_tier": case(O.SPEND_TIER),
        },
        "customer_orders",
        "",
        ("customer_orders",),
    )
    for stored, source in {"stored_customer_summary": "customer_summary", "named_customer_summary": "customer_summary", "csv_order_customers": "order_customers"}.items():
        book.add_text(stored, f"SELECT * FROM {source}", book.columns[source], (source,))
    book.add_text(
        "csv_reference_tables",
        " UNION ALL ".join(reference_totals(table, kinds) for table, kinds in REFERENCE_COLUMNS.items()),
        ["table_name", "entries", "keys", "signs", "whole_total", "exact_total", "flags", "last_day"],
    )
    for name, kept in (("numeric_grid_summary", ""), ("numeric_grid_filtered", "WHERE (i + j) % 100 = 0")):
        book.add(
            name,
            {
                "my_number": "CAST(5 AS BIGINT)",
                "total_rows": "count(*)",
                "avg_sum_squares": rounded(f"{real('sum(CAST(pow(i, 2) + pow(j, 2) AS DECIMAL(38,0)))')} / count(*)", 2),
                "total_sqrt_product": real("round(sum(CAST(sqrt(i * j) AS DECIMAL(28,6))), 2)"),
                "max_trig": rounded("max(sin(i) * cos(j))", 4),
                "min_log_product": rounded("min(ln(i + 1) * ln(j + 1))", 4),
                "message": literal(O.GRID_MESSAGE),
            },
            "_pairs",
            kept,
            ("_pairs",),
        )
    for name in ("stg_accounts", "stg_customers_360", "stg_customer_addresses"):
        book.add_text(f"csv_{name}", f"SELECT * FROM {name}", book.columns[name], (name,))
    book.add_text("passthrough", "SELECT * FROM nation", ["n_nationkey", "n_name", "n_regionkey"])

    # Reusable steps
    money = "CAST({} AS DECIMAL(14,2))".format
    book.add(
        "account_band_mix",
        {
            "account_band": "account_band",
            "customers": "count(*)",
            "balance": real(f"sum({money('c_acctbal')})"),
            "customer_share": share("count(*)", "sum(count(*)) OVER ()"),
        },
        f"(SELECT c_acctbal, {case(I.ACCOUNT_BAND)} AS account_band FROM customer)",
        "GROUP BY account_band",
    )
    balance = f"sum({money('c_acctbal')})"
    book.add(
        "market_segment_share",
        {
            "c_mktsegment": "c_mktsegment",
            "balance": real(balance),
            "balance_share": share(balance, f"sum({balance}) OVER ()", 2),
        },
        "customer",
        "GROUP BY c_mktsegment",
    )
    book.add(
        "latest_event_per_user",
        {c: c for c in ("user_id", "event_id")}
        | {"ts": "CAST(ts AS VARCHAR)", "event_type": "event_type", "value": "value"},
        "events",
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    )
    bought_count, error_count = n("event_type = 'purchase'"), n("event_type = 'error'")
    book.add_text(
        "customer_activity_alignment",
        f"SELECT customer_id, orders, {real('spent')} AS spent, CAST(last_order AS VARCHAR) AS last_order, events,"
        f" purchases, errors, CAST(last_event AS VARCHAR) AS last_event, {case(I.CUSTOMER_ACTION)} AS next_action"
        f" FROM (SELECT o_custkey AS customer_id, count(*) AS orders, sum({money('o_totalprice')}) AS spent,"
        " max(CAST(o_orderdate AS DATE)) AS last_order FROM orders GROUP BY o_custkey) o"
        f" FULL JOIN (SELECT user_id * 11 AS customer_id, count(*) AS events, {bought_count} AS purchases,"
        f" {error_count} AS errors, max(CAST(ts AS DATE)) AS last_event FROM events GROUP BY user_id) e"
        " USING (customer_id)",
        "customer_id orders spent last_order events purchases errors last_event next_action".split(),
    )

    book.add_text(
        "customer_versions_alignment",
        "SELECT coalesce(k.customer_id, v.customer_id) AS customer_id, orders, CAST(last_order AS VARCHAR) AS last_order,"
        " events, purchases, segment FROM"
        " (SELECT coalesce(o.customer_id, e.customer_id) AS customer_id, orders, last_order, events, purchases FROM"
        " (SELECT CASE WHEN o_orderstatus <> 'P' OR o_totalprice >= 5000 THEN o_custkey END AS customer_id,"
        " count(*) AS orders, max(CAST(o_orderdate AS DATE)) AS last_order FROM orders GROUP BY 1) o"
        " FULL JOIN (SELECT CASE WHEN event_type <> 'error' OR value <= 100 THEN user_id * 11 END AS customer_id,"
        " count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases FROM events GROUP BY 1) e"
        " ON o.customer_id = e.customer_id) k"
        " FULL JOIN (SELECT CASE WHEN c_acctbal >= -900 THEN c_custkey END AS customer_id, c_mktsegment AS segment FROM customer"
        " UNION ALL SELECT CASE WHEN c_acctbal >= -900 THEN c_custkey END, 'IN DEBT' FROM customer WHERE c_acctbal < 0) v"
        " ON k.customer_id = v.customer_id",
        "customer_id orders last_order events purchases segment".split(),
    )

    def since(days: int, more: str = "TRUE") -> str:
        return n(f"ts >= TIMESTAMP '{I.EVENTS_UNTIL} 00:00:00' - INTERVAL {days} DAY AND {more}")

    bought = "event_type = 'purchase'"
    book.add(
        "recent_event_counts",
        {
            "user_id": "user_id",
            "all_events": "count(*)",
            "last_7_days": since(7),
            "last_14_days": since(14),
            "purchases_last_14_days": since(14, bought),
            "purchase_pct": pct(n(bought), "count(*)", 2),
        },
        "events",
        "GROUP BY user_id",
    )
    book.add_text(
        "order_value_steps",
        "SELECT o_custkey, o_orderkey AS latest_order, o_totalprice AS latest_value, previous_value,"
        f" {rounded('o_totalprice - previous_value', 2)} AS value_change FROM (SELECT *, lag(o_totalprice) OVER"
        " (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS previous_value FROM orders"
        " QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1)",
        "o_custkey latest_order latest_value previous_value value_change".split(),
    )
    book.add(
        "return_flag_pivot",
        {
            "l_suppkey": "l_suppkey",
            "accepted": "sum(l_quantity) FILTER (WHERE l_returnflag = 'A')",
            "none": "sum(l_quantity) FILTER (WHERE l_returnflag = 'N')",
            "returned": "sum(l_quantity) FILTER (WHERE l_returnflag = 'R')",
        },
        "lineitem",
        "GROUP BY l_suppkey",
    )
    returned = "l_returnflag = 'R'"
    lines = select(
        {"s_suppkey": "l_suppkey", "lines": "count(*)", "returned_share": pct(n(returned), "count(*)", 2)},
        "lineitem",
        "GROUP BY l_suppkey",
    )
    book.add(
        "supplier_scores",
        {
            "s_suppkey": "s_suppkey",
            "s_name": "s_name",
            "lines": "lines",
            "returned_share": "returned_share",
            "supplier_score": f"CAST({score(*I.SUPPLIER_PARTS)} AS BIGINT)",
        },
        f"supplier LEFT JOIN ({lines}) AS l USING (s_suppkey)",
    )
    usual = (
        "SELECT o_custkey, o_orderpriority AS usual_priority FROM (SELECT o_custkey, o_orderpriority, count(*) AS times"
        " FROM orders GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY times DESC, o_orderpriority) = 1"
    )
    habits = select(
        {
            "o_custkey": "o_custkey",
            "urgency": mean(f"CAST({case(I.PRIORITY_WEIGHT)} AS DECIMAL(4,2))"),
            "statuses": "count(DISTINCT o_orderstatus)",
            "value_spread": rounded("stddev_samp(o_totalprice)", 2),
        },
        "orders",
        "GROUP BY o_custkey",
    )
    book.add(
        "customer_order_habits",
        {c: c for c in ("o_custkey", "usual_priority", "urgency", "statuses", "value_spread")},
        f"({usual}) AS u JOIN ({habits}) AS h USING (o_custkey)",
    )
    value = money("o_totalprice")
    section = "SELECT '{}' AS section, {} AS label, count(*) AS entries, {} AS amount, {} AS avg_amount FROM {}"
    amount, average = real(f"sum({value})"), mean(value)
    book.add_text(
        "order_sections",
        " UNION ALL ".join(
            [
                section.format("ALL", "CAST(NULL AS VARCHAR)", amount, average, "orders"),
                section.format("STATUS", "o_orderstatus", amount, average, "orders GROUP BY o_orderstatus"),
                section.format("PRIORITY", "o_orderpriority", amount, average, "orders GROUP BY o_orderpriority"),
                section.format("SUPPLIERS", "NULL", real(f"sum({money('s_acctbal')})"), "NULL", "supplier"),
            ]
        ),
        "section label entries amount avg_amount".split(),
    )

    # Data checks
    def failures(table: str, check: Check) -> str:
        column = check.column
        if check.kind == "not_null":
            found = f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
        elif check.kind == "accepted_values":
            listed = ", ".join(literal(v) for v in check.values)
            found = f"SELECT count(*) FROM {table} WHERE NOT {column} IN ({listed})"
        elif check.kind == "unique":
            found = (
                f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL"
                f" GROUP BY {column} HAVING count(*) > 1)"
            )
        else:
            parent = SHOP_NAMES[check.parent]
            found = (
                f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND NOT EXISTS"
                f" (SELECT 1 FROM {parent} AS p WHERE p.{check.parent_column} = {table}.{column})"
            )
        return f"({found})"

    def checks(name: str, tables: dict[str, list[Check]], named: dict[str, str]) -> None:
        rows = [
            f"SELECT {literal(table)} AS table_name, {literal(check.kind)} AS check_name,"
            f" {literal(check.column)} AS column_name, {failures(named[table], check)} AS failures"
            for table, listed in tables.items()
            for check in listed
        ]
        book.add_text(
            name,
            " UNION ALL ".join(rows),
            ["table_name", "check_name", "column_name", "failures"],
            tuple(dict.fromkeys(named[table] for table in tables)),
        )

    checks("checks_staging", contracts.STAGING, {t: f"stg_{t}" for t in contracts.STAGING})
    checks("checks_roll_ups", contracts.ROLL_UPS, {t: f"int_{t}" for t in contracts.ROLL_UPS})
    checks("checks_reports", contracts.REPORTS, {t: t for t in contracts.REPORTS})
    checks("checks_order_demo", contracts.ORDER_DEMO, SHOP_NAMES)
    book.add(
        "check_unique_line_ids",
        {"line_id": "l_orderkey * 10 + l_linenumber", "occurrences": "count(*)"},
        "lineitem",
        "GROUP BY l_orderkey * 10 + l_linenumber HAVING count(*) > 1",
    )
    book.add(
        "check_missing_event_values",
        {"event_id": "event_id", "user_id": "user_id"},
        "(SELECT event_id, user_id, CASE WHEN event_type <> 'signup' THEN value END AS value FROM events)",
        "WHERE value IS NULL",
    )
    book.add(
        "check_event_types",
        {"event_id": "event_id", "event_type": "event_type"},
        "events",
        "WHERE event_type NOT IN ('click', 'view', 'purchase')",
    )
    book.add(
        "check_orphan_events",
        {"event_id": "event_id", "customer_id": "user_id * 11"},
        "events",
        "WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id * 11)",
    )


SHOP_NAMES = {
    "stg_customers": "shop_stg_customers",
    "stg_orders": "shop_stg_orders",
    "stg_payments": "shop_stg_payments",
    "customers": "order_customers",
    "orders": "order_payments_pivot",
    "published_customers": "published_customers",
    "published_orders": "published_orders",
    "customer_orders": "customer_orders",
    "customer_summary": "customer_summary",
}
