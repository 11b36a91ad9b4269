"""The order demo and the data checks on rows worked out by hand."""

import datetime as dt
import math
import random

from conftest import rows
from pyspark.sql import functions as F

from brightledger.operators import checks
from brightledger.operators.checks import Check
from brightledger.plans import orders as O
from brightledger.sources.published import number_grid

DAY = dt.date


def demo(spark):
    customers = spark.createDataFrame([(1, "Ann", "A"), (2, "Bo", "B"), (3, "Cy", "C")], "id int, first_name string, last_name string")
    orders = spark.createDataFrame(
        [
            (10, 1, DAY(2024, 1, 2), "completed"),
            (11, 1, DAY(2024, 3, 4), "placed"),
            (12, 2, DAY(2024, 2, 2), "returned"),
        ],
        "id int, user_id int, order_date date, status string",
    )
    payments = spark.createDataFrame(
        [(1, 10, "credit_card", 1050), (2, 10, "coupon", 299), (3, 11, "gift_card", 1999), (4, 99, "coupon", 5000)],
        "id int, order_id int, payment_method string, amount int",
    )
    return O.stg_customers(customers), O.stg_orders(orders), O.stg_payments(payments)


def test_cents_are_cut_to_whole_units(spark):
    _, _, payments = demo(spark)
    assert [r["amount"] for r in rows(payments, "payment_id")] == [10, 2, 19, 50]


def test_customers(spark):
    found = rows(O.customers(*demo(spark)), "customer_id")
    assert found[0] == {
        "customer_id": 1,
        "first_name": "Ann",
        "last_name": "A",
        "first_order": DAY(2024, 1, 2),
        "most_recent_order": DAY(2024, 3, 4),
        "number_of_orders": 2,
        "customer_lifetime_value": 31,
    }
    # An order without payment, and no order at all; the payment of a missing order counts for nobody.
    assert (found[1]["number_of_orders"], found[1]["customer_lifetime_value"]) == (1, None)
    assert (found[2]["number_of_orders"], found[2]["customer_lifetime_value"]) == (None, None)


def test_orders_pivot(spark):
    _, orders, payments = demo(spark)
    found = rows(O.orders(orders, payments), "order_id")
    assert [(r["credit_card_amount"], r["coupon_amount"], r["gift_card_amount"], r["amount"]) for r in found] == [
        (10, 2, 0, 12),
        (0, 0, 19, 19),
        (None, None, None, None),
    ]


def test_published_summary(spark):
    customers = O.published_customers(
        spark.createDataFrame(
            [(1, "Ann", "A", "a@x"), (2, "Bo", None, "b@x"), (3, "Cy", "C", "c@x"), (4, "Di", "D", "d@x")],
            "customer_id int, first_name string, last_name string, email string",
        )
    )
    orders = O.published_orders(
        spark.createDataFrame(
            [(1, 1, "2025-01-15", 120.0, "completed"), (2, 1, "2025-02-01", 200.0, "completed"),
             (3, 2, "2025-01-16", 100.0, "completed"), (4, 3, "2025-01-16", 99.99, "completed"),
             (5, 4, "2025-01-16", 500.0, "returned")],
            "order_id int, customer_id int, order_date string, amount double, status string",
        )
    )
    found = rows(O.customer_summary(O.customer_orders(customers, orders)), "customer_id")
    assert [(r["customer_id"], r["full_name"], r["total_orders"], r["customer_tier"]) for r in found] == [
        (1, "Ann A", 2, "Gold"),
        (2, None, 1, "Silver"),
        (3, "Cy C", 1, "Bronze"),
    ]


def test_numeric_grid_against_plain_arithmetic(spark):
    n, step = 60, 10
    pairs = [(i, j) for i in range(1, n + 1) for j in range(1, n + 1) if (i + j) % step == 0]
    found = O.numeric_grid_summary(number_grid(spark, n), step).first()
    assert found["total_rows"] == len(pairs)
    assert found["avg_sum_squares"] == round(sum(i * i + j * j for i, j in pairs) / len(pairs), 2)
    assert abs(float(found["total_sqrt_product"]) - sum(math.sqrt(i * j) for i, j in pairs)) < 0.01
    assert found["max_trig"] == round(max(math.sin(i) * math.cos(j) for i, j in pairs), 4)
    assert found["min_log_product"] == round(min(math.log(i + 1) * math.log(j + 1) for i, j in pairs), 4)


def test_checks_count_findings(spark):
    df = spark.createDataFrame(
        [(1, "a", "x"), (1, "b", "x"), (2, None, "y"), (None, "c", "z"), (None, "a", None)], "id int, label string, kind string"
    )
    listed = [
        Check("unique", "id"),
        Check("unique", "label"),
        Check("not_null", "id"),
        Check("not_null", "label"),
        Check("accepted_values", "kind", ("x", "y")),
        Check("relationships", "id", parent="p", parent_column="key"),
    ]
    parent = spark.createDataFrame([(1,), (1,)], "key int")
    found = {(r["check_name"], r["column_name"]): r["failures"] for r in rows(checks.run_checks("t", df, listed, {"p": parent}))}
    assert found == {
        ("unique", "id"): 1,  # missing ids do not count as equal
        ("unique", "label"): 1,
        ("not_null", "id"): 2,
        ("not_null", "label"): 1,
        ("accepted_values", "kind"): 1,  # a missing value passes
        ("relationships", "id"): 1,
    }


def test_checks_of_an_empty_table_find_nothing(spark):
    df = spark.createDataFrame([], "id int, label string")
    listed = [Check("unique", "id"), Check("not_null", "label")]
    assert {r["failures"] for r in rows(checks.run_checks("t", df, listed))} == {0}


def test_all_checks_in_one_pass_against_the_single_ones(spark):
    rng = random.Random(8)
    parent = spark.createDataFrame([(k, name) for k, name in [(1, "a"), (2, "b"), (2, "a"), (3, None), (4, "d"), (None, "e"), (9, "f")]], "k long, name string")
    data = [(rng.choice([None, *range(6)]), rng.choice(["a", "b", None, "c"]), rng.choice([1.5, 0.0, -0.0, 7.0, None])) for _ in range(200)]
    child = spark.createDataFrame(data, "ref int, label string, price double").withColumn("id", F.monotonically_increasing_id()).repartition(3)
    listed = {
        "child": [Check("unique", "id"), Check("unique", "price"), Check("unique", "label"), Check("not_null", "label"), Check("not_null", "id"),
                  Check("accepted_values", "label", ("a", "b")), Check("relationships", "ref", parent="parent", parent_column="k"),
                  Check("relationships", "label", parent="parent", parent_column="name")],
        "parent": [Check("unique", "k"), Check("not_null", "k"), Check("relationships", "k", parent="parent", parent_column="k")],
        "empty": [Check("unique", "k"), Check("not_null", "k")],
    }
    tables = {"child": child, "parent": parent, "empty": parent.where("k > 100")}
    expected = []
    for table, held in listed.items():
        df = tables[table]
        for check in held:
            if check.kind == "unique":
                count = checks.unique_values(df, check.column).count()
            elif check.kind == "not_null":
                count = checks.missing(df, check.column).count()
            elif check.kind == "accepted_values":
                count = checks.disallowed(df, check.column, check.values).count()
            else:
                count = checks.orphans(df, check.column, tables[check.parent], check.parent_column).count()
            expected.append({"table_name": table, "check_name": check.kind, "column_name": check.column, "failures": count})
    found = checks.run_all_checks(tables, listed)
    assert rows(found) == sorted(expected, key=lambda r: tuple(repr(r[c]) for c in sorted(r)))
    assert any(r["failures"] for r in expected if r["check_name"] == "relationships")
    assert checks.run_all_checks({"parent": parent}, {"parent": []}).collect() == []


def test_checks_read_each_table_once_and_shuffle_once(spark, sf_dir):
    places = [spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "orders")]
    listed = {
        "customer": [Check("unique", "c_custkey"), Check("unique", "c_name"), Check("not_null", "c_name"), Check("not_null", "c_acctbal")],
        "orders": [Check("unique", "o_orderkey"), Check("relationships", "o_custkey", parent="customer", parent_column="c_custkey")],
    }
    plan = checks.run_all_checks(dict(zip(listed, places)), listed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
