"""The order demo: payments, orders and customers, and the published customer summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brightledger.functions.scoring import choice, literal, named, sum_if
from brightledger.operators.keyed import left_align
from brightledger.rules.base import band

# Payment methods in column order, and the spend that earns each tier.
PAYMENT_METHODS = ("credit_card", "coupon", "bank_transfer", "gift_card")
GRID_MESSAGE = "This query should take about 20 seconds"
SPEND_TIER = band("total_spent", [(300, "Gold"), (100, "Silver")], "Bronze")


# --- cleaning ----------------------------------------------------------------
def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("customer_id"), "first_name", "last_name")


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("order_id"), F.col("user_id").alias("customer_id"), "order_date", "status")


def stg_payments(raw: DataFrame) -> DataFrame:
    """Cents become whole units; the remainder is cut off."""
    return raw.select(
        F.col("id").alias("payment_id"), "order_id", "payment_method", F.expr("amount div 100").alias("amount")
    )


# --- results -----------------------------------------------------------------
def payments_per_order(payments: DataFrame, methods: Sequence[str] = PAYMENT_METHODS) -> DataFrame:
    """One row per order: a column per payment method, and the total."""
    return payments.groupBy("order_id").agg(
        *named(
            **{f"{method}_amount": sum_if(f"payment_method = '{method}'", "amount") for method in methods},
            amount="sum(amount)",
        )
    )


def customers(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Order dates, order count and lifetime value per customer.

    Payments are added up per order before they meet the orders, so that join has one
    row per order on both sides; payments without an order belong to no customer.
    """
    ordered = orders.groupBy("customer_id").agg(
        *named(
            first_order="min(order_date)",
            most_recent_order="max(order_date)",
            number_of_orders="count(order_id)",
        )
    )
    per_order = payments.groupBy("order_id").agg(*named(paid="sum(amount)"))
    spent = (
        orders.select("order_id", "customer_id")
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(*named(customer_lifetime_value="sum(paid)"))
    )
    return left_align(customers.select("customer_id", "first_name", "last_name"), [ordered, spent], "customer_id")


def orders(orders: DataFrame, payments: DataFrame, methods: Sequence[str] = PAYMENT_METHODS) -> DataFrame:
    return orders.select("order_id", "customer_id", "order_date", "status").join(
        payments_per_order(payments, methods), "order_id", "left"
    )


# --- published results -------------------------------------------------------
def published_customers(raw: DataFrame) -> DataFrame:
    """The full name is missing where either part is."""
    return raw.select(
        "customer_id", "first_name", "last_name", F.expr("first_name || ' ' || last_name").alias("full_name"), "email"
    )


def published_orders(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", "customer_id", F.to_date("order_date").alias("order_date"), "amount", "status")


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Completed orders per customer; customers without one are left out. Orders are
    added up per customer first (customer ids are unique)."""
    completed = (
        orders.where("status = 'completed'")
        .groupBy("customer_id")
        .agg(*named(total_orders="count(order_id)", total_spent="sum(amount)"))
    )
    return customers.select("customer_id", "full_name", "email").join(completed, "customer_id")


def customer_summary(customer_orders: DataFrame) -> DataFrame:
    return customer_orders.select(
        "customer_id", "full_name", "total_orders", "total_spent", *named(customer_tier=choice(SPEND_TIER))
    )


def numeric_grid_summary(pairs: DataFrame, step: int = 100) -> DataFrame:
    """Power, root, trigonometric and logarithm measures over pairs ``i, j`` whose sum
    divides by ``step``. Logarithms are natural."""
    measured = pairs.where(F.expr(f"(i + j) % {step} = 0")).select(
        *named(
            sum_of_squares="CAST(pow(i, 2) + pow(j, 2) AS DECIMAL(38,0))",
            sqrt_product="CAST(sqrt(i * j) AS DECIMAL(28,6))",
            trig_calc="sin(i) * cos(j)",
            log_product="ln(i + 1) * ln(j + 1)",
        )
    )
    return measured.agg(
        *named(
            my_number="5",
            total_rows="count(*)",
            avg_sum_squares="round(CAST(sum(sum_of_squares) AS DOUBLE) / count(sum_of_squares), 2)",
            total_sqrt_product="round(sum(sqrt_product), 2)",
            max_trig="round(max(trig_calc), 4)",
            min_log_product="round(min(log_product), 4)",
            message=literal(GRID_MESSAGE),
        )
    )
