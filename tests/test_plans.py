"""Shape of the physical plans: what is read, what is shuffled, and what must not appear."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from brightledger.plans import silver
from brightledger.plans.bank import Bank


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """Plans as they are when no side is small enough to broadcast, except the
    reference tables, whose handful of rows is known."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4096")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_no_python_and_no_cross_join_anywhere(spark, sf_dir):
    for name, query in entry.queries().items():
        plan = plan_of(query(spark, sf_dir))
        for unwanted in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert unwanted not in plan, (name, unwanted)


def test_one_shuffle_per_source(spark, sf_dir, large_tables):
    bank = Bank.over(spark, sf_dir)
    # Transfers are summarised twice, by sender and by receiver.
    for name, sources in {"transaction_analytics": 7, "customer_financial_summary": 5}.items():
        plan = plan_of(bank[name])
        assert len(re.findall(r" Exchange hashpartitioning\((?:customer|account)_id|to_account_id|from_account_id", plan)) >= sources
        assert plan.count(" Exchange ") == sources, name


def test_profile_joins_reuse_the_partitioning(spark, sf_dir, large_tables):
    plan = plan_of(Bank.over(spark, sf_dir)["customer_profile"])
    assert plan.count(" Exchange hashpartitioning(customer_id") == 6  # the customers and five summaries


def test_reference_tables_are_broadcast(spark, sf_dir, large_tables):
    plan = plan_of(Bank.over(spark, sf_dir)["customers_360"])
    assert plan.count("BroadcastHashJoin") == 5 and " Exchange hash" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    loans = plan_of(Bank.over(spark, sf_dir)["loans"].select("loan_id", "loan_size_category"))
    (read,) = re.findall(r"ReadSchema: struct<([^>]*)>", loans)
    assert {c.split(":")[0] for c in read.split(",")} <= {"p_partkey", "p_size", "p_retailprice"}
    shop = plan_of(entry.queries()["customer_orders"](spark, sf_dir))
    assert "email" not in re.findall(r"ReadSchema: struct<([^>]*)>", shop)[0]
    events = plan_of(entry.queries()["check_event_types"](spark, sf_dir))
    assert "PushedFilters: [Not(" in events or "PushedFilters: [IsNotNull(event_type)" in events
    (read,) = re.findall(r"ReadSchema: struct<([^>]*)>", events)
    assert "props" not in read


def test_reports_read_their_join_once(spark, sf_dir, large_tables):
    """Totals and groups come out of one aggregation over the customers."""
    plan = plan_of(Bank.over(spark, sf_dir)["risk_management_dashboard"])
    assert plan.count("Expand") == 1


def test_versions_of_one_customer_are_dealt_by_all_columns(spark, sf_dir):
    base = Bank.over(spark, sf_dir)["customers_360"]
    one = base.limit(1).withColumn("customer_id", F.lit(None).cast(base.schema["customer_id"].dataType))
    versions = one.crossJoin(spark.range(60)).withColumn("credit_score", F.col("id").cast(base.schema["credit_score"].dataType)).drop("id")
    made = silver.customer_base(versions.union(versions).repartition(4))
    assert "collect_set" not in plan_of(made)
    assert made.columns == silver.PROFILE_COLUMNS and made.count() == 60
    assert made.where("customer_id IS NULL").select("credit_score").distinct().count() == 60
