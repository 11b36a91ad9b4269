"""The reusable steps applied straight to customers, orders, lines and events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from brightledger.functions.dates import moment
from brightledger.functions.scoring import choice, clamped, mean, n_if, named, rate_pct, spread
from brightledger.operators.keyed import (
    align,
    latest_per_key,
    newest_two,
    outer_join,
    recent_count,
    share_of_total,
    with_most_common,
)
from brightledger.operators.sections import totals_and_groups, union_sections
from brightledger.rules.base import band, lookup, rules

# Cut points and labels of these reports.
ACCOUNT_BAND = band("c_acctbal", [(7500, "HIGH"), (2500, "MEDIUM"), (0, "LOW")], "OVERDRAWN")
SUPPLIER_PARTS = (
    band("s_acctbal", [(7500, 40), (2500, 25), (0, 10)], -20),
    rules(0, ("returned_share < 30", 30), ("returned_share < 35", 15)),
    rules(0, ("lines >= 500", 40), ("lines >= 100", 20)),
)
CUSTOMER_ACTION = rules(
    "KEEP",
    ("orders IS NULL", "FIRST_ORDER_OFFER"),
    ("errors > 10 AND purchases = 0", "SERVICE_CALL"),
    ("purchases > 0 AND spent >= 2000000", "VIP_PROGRAM"),
    ("spent < 500000", "UPSELL"),
)
PRIORITY_WEIGHT = lookup(
    "o_orderpriority", {"1-URGENT": 1.0, "2-HIGH": 0.75, "3-MEDIUM": 0.5, "4-NOT SPECIFIED": 0.25}, 0.0
)
EVENTS_UNTIL = dt.date(2024, 1, 31)


def account_band_mix(customer: DataFrame) -> DataFrame:
    groups = (
        customer.select("c_acctbal", *named(account_band=choice(ACCOUNT_BAND)))
        .groupBy("account_band")
        .agg(*named(customers="count(*)", balance="sum(CAST(c_acctbal AS DECIMAL(14,2)))"))
    )
    return share_of_total(groups, "customers", "customer_share")


def market_segment_share(customer: DataFrame) -> DataFrame:
    groups = customer.groupBy("c_mktsegment").agg(*named(balance="sum(CAST(c_acctbal AS DECIMAL(14,2)))"))
    return share_of_total(groups, "balance", "balance_share", 2)


def latest_event_per_user(events: DataFrame) -> DataFrame:
    return latest_per_key(
        events.select("user_id", "event_id", "ts", "event_type", "value"), "user_id", [F.col("ts"), F.col("event_id")]
    )


def _orders_by_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        *named(
            orders="count(*)",
            spent="sum(CAST(o_totalprice AS DECIMAL(14,2)))",
            last_order="max(to_date(o_orderdate))",
        )
    )


def _events_by_customer(events: DataFrame) -> DataFrame:
    # Every user stands for ten customers' worth of ids, so that some events belong to
    # no customer with orders and some customers have no events.
    return events.groupBy(F.expr("user_id * 11").alias("customer_id")).agg(
        *named(
            events="count(*)",
            purchases=n_if("event_type = 'purchase'"),
            errors=n_if("event_type = 'error'"),
            last_event="max(to_date(ts))",
        )
    )


def customer_activity_alignment(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders and events per customer, whichever of them there are, and what to do next."""
    known = align([_orders_by_customer(orders), _events_by_customer(events)], "customer_id")
    return known.select("*", *named(next_action=choice(CUSTOMER_ACTION)))


def customer_versions_alignment(customer: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders, events and segments per customer where keys are missing and repeated: large
    debtors, small open orders and large errors name no customer, and customers in debt
    have a second version."""
    known = align(
        [
            orders.groupBy(F.expr("CASE WHEN o_orderstatus <> 'P' OR o_totalprice >= 5000 THEN o_custkey END AS customer_id")).agg(
                *named(orders="count(*)", last_order="max(to_date(o_orderdate))")
            ),
            events.groupBy(F.expr("CASE WHEN event_type <> 'error' OR value <= 100 THEN user_id * 11 END AS customer_id")).agg(
                *named(events="count(*)", purchases=n_if("event_type = 'purchase'"))
            ),
        ],
        "customer_id",
    )
    key = F.expr("CASE WHEN c_acctbal >= -900 THEN c_custkey END AS customer_id")
    versions = customer.select(key, F.col("c_mktsegment").alias("segment")).union(
        customer.where("c_acctbal < 0").select(key, F.lit("IN DEBT"))
    )
    return outer_join(known, versions, "customer_id")


def recent_event_counts(events: DataFrame) -> DataFrame:
    def since(days: int) -> str:
        return moment(EVENTS_UNTIL - dt.timedelta(days=days))

    return events.groupBy("user_id").agg(
        *named(
            all_events="count(*)",
            last_7_days=recent_count("ts", since(7)),
            last_14_days=recent_count("ts", since(14)),
            purchases_last_14_days=recent_count("ts", since(14), "event_type = 'purchase'"),
            purchase_pct=rate_pct(n_if("event_type = 'purchase'"), "count(*)", 2),
        )
    )


def order_value_steps(orders: DataFrame) -> DataFrame:
    """Newest order per customer and the change from the one before it."""
    two = newest_two(
        orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"),
        "o_custkey",
        [F.desc_nulls_first("o_orderdate"), F.desc("o_orderkey")],
    )

    def at(rank: int, column: str) -> str:
        return f"max(CASE WHEN age_rank = {rank} THEN {column} END)"

    return two.groupBy("o_custkey").agg(
        *named(
            latest_order=at(1, "o_orderkey"),
            latest_value=at(1, "o_totalprice"),
            previous_value=at(2, "o_totalprice"),
            value_change=f"round({at(1, 'o_totalprice')} - {at(2, 'o_totalprice')}, 2)",
        )
    )


def return_flag_pivot(lineitem: DataFrame) -> DataFrame:
    """Quantity per supplier with a column per return flag."""
    return (
        lineitem.groupBy("l_suppkey")
        .pivot("l_returnflag", ["A", "N", "R"])
        .agg(F.sum("l_quantity"))
        .select("l_suppkey", *named(accepted="A", none="N", returned="R"))
    )


def supplier_scores(supplier: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Lines are reduced to one row per supplier before they meet the suppliers."""
    per_supplier = lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        *named(lines="count(*)", returned_share=rate_pct(n_if("l_returnflag = 'R'"), "count(*)", 2))
    )
    return supplier.join(per_supplier, "s_suppkey", "left").select(
        "s_suppkey", "s_name", "lines", "returned_share", *named(supplier_score=clamped(*SUPPLIER_PARTS))
    )


def customer_order_habits(orders: DataFrame) -> DataFrame:
    """Usual priority (the first in sort order on a tie), its weight, and the spread of values."""
    weight = f"CAST({choice(PRIORITY_WEIGHT)} AS DECIMAL(4,2))"
    return with_most_common(
        orders,
        "o_custkey",
        named(
            urgency=mean(weight),
            statuses="count(DISTINCT o_orderstatus)",
            value_spread=f"round({spread('o_totalprice', 'DECIMAL(14,2)')}, 2)",
        ),
        {"usual_priority": "o_orderpriority"},
    )


def order_sections(orders: DataFrame, supplier: DataFrame) -> DataFrame:
    """Order totals, totals by status and by priority, and a section on suppliers."""
    value = "CAST(o_totalprice AS DECIMAL(14,2))"
    by_order = totals_and_groups(
        orders,
        [[], ["o_orderstatus"], ["o_orderpriority"]],
        ["ALL", "STATUS", "PRIORITY"],
        named(entries="count(*)", amount=f"sum({value})", avg_amount=mean(value)),
    ).select(
        "section", *named(label="coalesce(o_orderstatus, o_orderpriority)"), "entries", "amount", "avg_amount"
    )
    suppliers = supplier.agg(
        *named(entries="count(*)", amount="sum(CAST(s_acctbal AS DECIMAL(14,2)))")
    ).select(F.lit("SUPPLIERS").alias("section"), "entries", "amount")
    return union_sections(by_order, suppliers).orderBy("section", F.desc_nulls_last("amount"))
