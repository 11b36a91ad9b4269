"""Cleaning rules and roll-ups on rows worked out by hand."""

import datetime as dt
import re
import shutil
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from compare import differences
from conftest import rows
from oracles import catalogue
from pyspark.sql import functions as F

from brightledger.params import RunParams
from brightledger.plans import gold, silver, staging
from brightledger.plans.bank import Bank
from brightledger.registry import all_queries, portable, reporting_bank
from brightledger.sources.reference import builtin_reference

P = RunParams(dt.date(2024, 2, 1))


def ts(text):
    return dt.datetime.fromisoformat(text)


def frame(spark, schema, *data):
    """A frame from plain values; whole numbers are taken for money where the schema has decimals."""
    money = [" decimal" in column for column in re.split(r", (?=\w+ )", schema)]
    made = [
        tuple(Decimal(v) if is_money and isinstance(v, int) else v for v, is_money in zip(row, money)) for row in data
    ]
    return spark.createDataFrame(made, schema)


# --- cleaning ----------------------------------------------------------------
def test_account_bands_at_their_edges(spark):
    raw = frame(
        spark,
        "account_id long, customer_id long, product_id string, current_balance decimal(14,2), average_balance decimal(14,2),"
        " account_status string, opened_date timestamp, closed_date timestamp, interest_rate decimal(6,2),"
        " monthly_fee decimal(8,2), online_banking_enabled boolean, mobile_banking_enabled boolean",
        *[
            (i, 1, product, balance, 1200, status, ts(opened), closed, rate, fee, True, i % 2 == 0)
            for i, (product, balance, status, opened, closed, rate, fee) in enumerate(
                [
                    ("SAVE001", 100000, "active", "2014-02-01", None, 1, 5),
                    ("SAVE001", 99999, "dormant", "2014-02-02", None, 1, 0),
                    ("SAVE001", 999, "active", "2023-06-01", None, 1, 5),
                    ("NONE", 0, "restricted", "2023-06-01", ts("2023-07-01"), 1, 5),
                    ("CHCK001", 250000, "INVALID", "2023-06-01", None, 1, 5),
                    ("CHCK001", 250000, None, "2023-06-01", None, 1, 5),
                ]
            )
        ],
    )
    found = rows(staging.accounts(raw, P, builtin_reference(spark, "product_catalog")), "account_id")
    assert len(found) == 4  # INVALID and unknown status are left out
    top, below, small, closed = found
    assert (top["balance_tier"], top["service_tier"], top["account_age_years"]) == ("High Balance", "Premium", 10)
    assert (top["relationship_tenure"], top["cross_sell_score"], top["fee_waiver_eligible"]) == ("Long Term", 90, True)
    assert top["annual_interest_rate"] == Decimal("0.01")
    assert top["monthly_interest_expense"] == 1.0 and top["monthly_net_revenue"] == 4.0
    assert (below["balance_tier"], below["account_age_years"], below["risk_status"]) == ("Medium Balance", 9, "Dormant")
    assert (below["digital_adoption_level"], top["digital_adoption_level"]) == ("Partial Digital", "Full Digital")
    assert (small["below_minimum_balance"], small["risk_status"], small["cross_sell_score"]) == (True, "Below Minimum", 45)
    # An unknown product: nothing to compare the balance with.
    assert (closed["product_type"], closed["below_minimum_balance"], closed["risk_status"]) == (None, False, "Negative Balance")
    assert (closed["is_active"], closed["account_age_years"], closed["cross_sell_score"]) == (False, 0, 20)


def test_transactions_keep_monday_as_weekend(spark):
    raw = frame(
        spark,
        "transaction_id int, account_id int, transaction_type string, transaction_status string, channel string,"
        " transaction_amount decimal(12,2), transaction_datetime timestamp, is_high_risk boolean",
        (1, 1, "fee", "completed", "atm", 10000, ts("2024-01-07T23:00:00"), False),  # Sunday night
        (2, 1, "deposit", "completed", "online", 9999, ts("2024-01-08T09:00:00"), False),  # Monday
        (3, 1, "other", "completed", "phone", 99, ts("2024-01-06T06:00:00"), True),  # Saturday
    )
    a, b, c = rows(staging.transactions(raw, P), "transaction_id")
    assert (a["day_category"], b["day_category"], c["day_category"]) == ("WEEKDAY", "WEEKEND", "WEEKDAY")
    assert (a["amount_category"], b["amount_category"], c["amount_category"]) == ("LARGE", "MEDIUM", "MICRO")
    assert (a["time_category"], b["time_category"], c["time_category"]) == ("OFF_HOURS", "BUSINESS_HOURS", "MORNING")
    assert (a["flow_direction"], b["flow_direction"], c["flow_direction"]) == ("OUTFLOW", "INFLOW", "NEUTRAL")
    assert (a["risk_score"], b["risk_score"], c["risk_score"]) == (75, 20, 90)
    assert (a["channel_category"], b["is_digital_transaction"], c["channel_category"]) == ("SELF_SERVICE", True, "ASSISTED")


def test_cards_guard_their_denominator(spark):
    raw = frame(
        spark,
        "card_id int, customer_id int, card_type string, card_brand string, card_status string, credit_limit int,"
        " current_balance decimal(12,2), issue_date timestamp, expiry_date timestamp, contactless_enabled boolean, online_enabled boolean",
        (1, 1, "credit", "visa", "active", 10000, 9001, ts("2023-02-01"), ts("2027-02-01"), True, True),
        (2, 1, "credit", "visa", "active", 0, 50, ts("2019-02-01"), ts("2024-01-31"), False, True),
        (3, 1, "debit", "visa", "blocked", None, 0, ts("2022-02-02"), ts("2026-02-02"), False, False),
    )
    a, b, c = rows(staging.cards(raw, P), "card_id")
    assert (a["utilization_rate"], a["utilization_category"], a["risk_score"]) == (90.01, "HIGH_UTILIZATION", 90)
    assert (a["available_credit"], a["is_usable"], a["tenure_category"]) == (999, True, "MATURE")
    assert (b["utilization_rate"], b["available_credit"], b["card_tier"], b["is_expired"]) == (0, None, "N/A", True)
    assert (c["risk_score"], c["card_tier"], c["card_age_years"]) == (95, "N/A", 1)


def test_customer_stage_uses_the_month_part(spark):
    raw = frame(
        spark,
        "customer_id int, customer_number string, first_name string, last_name string, date_of_birth timestamp, gender string,"
        " email_address string, annual_income int, credit_score int, customer_status string, customer_since_date timestamp",
        (1, "C1", "mary-ann", "o'neil", ts("2004-02-29"), "f", "A@B.C", 250000, 740, "active", ts("2014-01-15")),
        (2, "C2", "bo", "x", ts("1974-02-01"), "m", "b@b.c", 49999, 499, "closed", ts("2019-08-01")),
    )
    refs = [
        builtin_reference(spark, name)
        for name in ("age_cohorts", "income_brackets", "credit_score_ranges", "risk_categories", "lifecycle_stages")
    ]
    a, b = rows(staging.customers_360(raw, P, *refs), "customer_id")
    # Ten years with the bank, but in the first months of the year of the relationship.
    assert (a["relationship_years"], a["lifecycle_stage_name"]) == (10, "New Customer")
    assert (a["full_name"], a["age"], a["age_cohort_name"]) == ("Mary-Ann O'Neil", 19, "Young Adult")
    assert (a["customer_value_segment"], a["income_bracket_name"], a["risk_name"]) == ("High Value", "Affluent", "Low Risk")
    assert (b["age"], b["age_cohort_name"], b["lifecycle_stage_name"]) == (50, "Pre-Retirement", "Mature")
    assert (b["risk_name"], b["marketing_eligible"], b["lending_eligible"]) == ("Severe Risk", False, False)


# --- roll-ups ----------------------------------------------------------------
def test_balance_movement_takes_the_two_newest(spark):
    balances = frame(
        spark,
        "account_id int, balance_id int, balance_amount decimal(12,2), available_balance decimal(12,2), balance_date timestamp",
        (1, 1, 100, 90, ts("2024-01-01")),
        (1, 2, 150, 140, ts("2024-01-02")),
        (1, 3, 130, 120, ts("2024-01-02")),
        (2, 4, 10, 9, ts("2024-01-01")),
    )
    a, b = rows(silver.balance_movement(balances), "account_id")
    assert (a["latest_balance"], a["previous_balance"], a["balance_change"]) == (130, 150, -20)
    assert (b["latest_balance"], b["previous_balance"], b["balance_change"]) == (10, None, None)


def test_alert_counts_keep_customers_without_alerts(spark):
    accounts = frame(spark, "account_id int, customer_id int", (1, 7), (2, 7), (3, 8))
    alerts = frame(
        spark,
        "alert_id int, account_id int, alert_type string, alert_status string, alert_timestamp timestamp",
        (1, 1, "UNUSUAL_ACTIVITY", "PENDING", ts("2024-01-05T10:00:00")),
        (2, 2, "LOW_BALANCE", "PENDING", ts("2024-01-06T10:00:00")),
        (None, 2, "LOW_BALANCE", "ACTIONED", ts("2024-01-07T10:00:00")),
    )
    a, b = rows(silver.account_alert_summary(accounts, alerts), "customer_id")
    assert (a["total_account_alerts"], a["unusual_activity_alerts"], a["pending_account_alerts"]) == (2, 1, 2)
    assert a["last_account_alert_date"] == dt.date(2024, 1, 7)
    assert (b["total_account_alerts"], b["last_account_alert_date"]) == (0, None)


def test_newest_assessment_per_type_feeds_the_pivot(spark):
    assessments = frame(
        spark,
        "assessment_id int, customer_id int, risk_type string, risk_score int, risk_rating string, assessment_date timestamp, requires_review boolean",
        (1, 1, "CREDIT_RISK", 900, "LOW", ts("2024-01-01"), True),
        (2, 1, "CREDIT_RISK", 500, "HIGH", ts("2024-01-02"), False),
        (3, 1, "FRAUD_RISK", 600, "MEDIUM", ts("2024-01-01"), True),
    )
    (found,) = rows(silver.assessment_summary(assessments))
    assert (found["current_credit_risk_score"], found["credit_risk_rating"]) == (500, "HIGH")
    assert (found["current_fraud_risk_score"], found["current_market_risk_score"]) == (600, None)
    assert found["assessments_requiring_review"] == 1


def test_usual_label_is_the_first_on_a_tie(spark):
    accounts = frame(spark, "account_id int, customer_id int", (1, 1), (2, 1), (3, 2))
    analytics = frame(
        spark,
        "account_id int, total_transactions long, total_transaction_volume decimal(12,2), net_cash_flow decimal(12,2),"
        " total_deposit_amount decimal(12,2), total_payment_amount decimal(12,2), total_fee_amount decimal(12,2),"
        " digital_transaction_percentage double, last_transaction_date date, spending_category string, activity_level string, last_updated timestamp",
        (1, 3, 10, 1, 1, 1, 1, 50.0, dt.date(2024, 1, 1), "LOW_SPENDER", "MINIMAL", None),
        (2, 4, 10, 1, 1, 1, 1, 25.0, dt.date(2024, 1, 3), "HIGH_SPENDER", "MINIMAL", None),
    )
    a, b = rows(silver.owner_transactions(accounts, analytics), "customer_id")
    assert (a["primary_spending_category"], a["digital_transaction_percentage"]) == ("HIGH_SPENDER", 37.5)
    assert (b["total_transactions"], b["primary_activity_level"]) == (None, None)


# --- over the given tables ---------------------------------------------------
@pytest.fixture(scope="module")
def bank(spark, sf_dir, tmp_path_factory):
    return Bank.over(spark, sf_dir, store=str(tmp_path_factory.mktemp("store")))


def test_stored_roll_ups_start_at_files_and_equal_the_lazy_ones(spark, sf_dir, bank):
    lazy = Bank.over(spark, sf_dir)["customer_retention_analytics"]
    stored = bank["customer_retention_analytics"]
    assert "FileScan parquet" in stored._jdf.queryExecution().executedPlan().toString()
    assert rows(stored, "customer_id") == rows(lazy, "customer_id")


def test_scores_stay_inside_their_limits(bank):
    scores = {
        "channel_effectiveness": ("digital_adoption_score", "channel_diversity_score"),
        "product_penetration_analysis": (
            "product_penetration_score",
            "cross_sell_opportunity_score",
            "product_stickiness_score",
        ),
        "customer_retention_analytics": ("churn_risk_score", "retention_opportunity_score"),
        "account_performance_dashboard": ("account_profitability_score", "account_health_score"),
        "customer_360_master": ("customer_lifetime_value_score", "churn_risk_score"),
    }
    for table, columns in scores.items():
        for column in columns:
            low, high = bank[table].agg(F.min(column), F.max(column)).first()
            assert 0 <= low <= high <= 100, (table, column)


def test_one_row_per_key(bank):
    for table in silver.MODELS:
        key = "account_id" if table in ("transaction_analytics", "account_performance_dashboard") else "customer_id"
        total, distinct = bank[table].agg(F.count("*"), F.count_distinct(key)).first()
        assert total == distinct, table


def test_product_weights_equal_the_repeated_rows(spark, bank):
    """The weighted report against the join that repeats a customer per account."""
    names = (
        "product_penetration_analysis",
        "profile_core",
        "customer_financial_summary",
        "account_activity",
    )
    weighted = gold.product_customers(*[bank[name] for name in names])
    repeated = (
        bank[names[0]]
        .select("customer_id", "next_best_product", "cross_sell_opportunity_score")
        .join(bank[names[2]].select("customer_id", "total_relationship_value", "total_loans"), "customer_id", "left")
        .join(bank[names[3]].select("customer_id", "account_profitability_score"), "customer_id", "left")
    )
    expected = repeated.groupBy("next_best_product").agg(
        F.count("*").alias("n"),
        F.sum("total_relationship_value").alias("v"),
        F.expr("count_if(total_loans > 0)").alias("loans"),
        F.expr("round(avg(account_profitability_score), 6)").alias("p"),
    )
    found = weighted.groupBy("next_best_product").agg(
        F.sum("weight").alias("n"),
        F.expr("sum(total_relationship_value * weight)").alias("v"),
        F.expr("sum(CASE WHEN total_loans > 0 THEN weight ELSE 0 END)").alias("loans"),
        F.expr("round(sum(profitability_sum) / sum(profitability_count), 6)").alias("p"),
    )
    assert rows(found, "next_best_product") == rows(expected, "next_best_product")


def test_segment_shares_add_up(bank):
    report = bank["customer_segmentation_analysis"].where("analysis_section = 'SEGMENT_OVERVIEW'")
    shares = report.agg(F.sum("segment_share_percentage"), F.sum("segment_value_share_pct")).first()
    assert all(abs(share - 100) < 0.5 for share in shares)


def test_reports_are_sorted(bank):
    found = [
        (r["dashboard_section"], -(r["high_value_percentage"] if r["high_value_percentage"] is not None else -1e9))
        for r in bank["executive_customer_dashboard"].collect()
    ]
    assert found == sorted(found)


def test_another_day_moves_ages_and_windows(spark, sf_dir):
    later = Bank.over(spark, sf_dir, RunParams(dt.date(2034, 2, 1)))
    sooner = Bank.over(spark, sf_dir)
    a = later["customers_360"].agg(F.avg("age")).first()[0]
    b = sooner["customers_360"].agg(F.avg("age")).first()[0]
    assert a - b == 10
    recent = later["customer_retention_analytics"].agg(F.sum("interactions_last_90_days")).first()[0]
    assert recent == 0


@pytest.fixture
def large_owner(spark, sf_dir, tmp_path):
    """The given tables with half of all orders placed by one customer, and a tenth by none."""
    for table in ("customer", "part", "lineitem", "events"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{sf_dir}/{table}.parquet")
    owner = F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 1 WHEN o_orderkey % 10 = 1 THEN NULL ELSE o_custkey END")
    spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("o_custkey", owner).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_a_large_owner_is_dealt_over_tasks_in_the_registered_query(spark, large_owner):
    """Without any help of the runtime, no task of the owner join has many more rows than the
    others, and the rows are those of a plain join."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = all_queries()["int_account_performance_dashboard"](spark, large_owner)
        sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and len(sizes) == 16, sizes
        # Accounts are given in one order, so that 1500 of them had one owner in one task.
        assert df.count() == df.select("account_id").distinct().count() == sum(sizes)
        assert df.where("customer_id = 1").count() > sum(sizes) * 0.49
        known = df.where("customer_id = 1").select("customer_name", "customer_total_balances").distinct()
        assert known.count() == 1 and known.first()["customer_name"] is not None
        assert df.where("customer_id IS NULL AND customer_name IS NOT NULL").count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_large_owner_query_equals_its_check_query(spark, large_owner):
    name = "int_account_performance_dashboard"
    df = all_queries()[name](spark, large_owner)
    con = duckdb.connect()
    for table in ("customer", "part", "lineitem", "events", "orders"):
        place = f"{large_owner}/{table}.parquet" + ("/*.parquet" if table == "orders" else "")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{place}'")
    result = con.execute(catalogue.statements()[name])
    assert differences(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in result.description], result.fetchall()) == []


# --- stored roll-ups ---------------------------------------------------------
def test_reports_follow_changed_tables_and_nothing_else_is_rebuilt(spark, sf_dir, tmp_path):
    tables = ("customer", "orders", "part", "lineitem", "events")
    for table in tables:
        shutil.copy(f"{sf_dir}/{table}.parquet", tmp_path / f"{table}.parquet")
    report, folder = all_queries()["executive_customer_dashboard"], str(tmp_path)
    before = rows(report(spark, folder))
    store = reporting_bank(spark, folder).store
    versions = {p.name: sorted(v.name for v in p.glob("v-*")) for p in Path(store).iterdir()}
    # Unchanged tables: the same bank, and another bank over the same store builds nothing.
    assert reporting_bank(spark, folder) is reporting_bank(spark, folder)
    assert rows(Bank.over(spark, folder, store=store)["executive_customer_dashboard"].drop("last_updated")) is not None
    assert {p.name: sorted(v.name for v in p.glob("v-*")) for p in Path(store).iterdir()} == versions
    # Half of the events are gone.
    spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 2 = 0").write.parquet(str(tmp_path / "half"))
    (tmp_path / "events.parquet").unlink()
    (tmp_path / "half").rename(tmp_path / "events.parquet")
    after = rows(report(spark, folder))
    assert after != before and after == rows(all_queries()["executive_customer_dashboard"](spark, folder))
    lazy = Bank.over(spark, folder)["executive_customer_dashboard"]
    assert after == rows(portable(lazy))
    now = {p.name: sorted(v.name for v in p.glob("v-*")) for p in Path(store).iterdir()}
    bank = Bank.over(spark, folder)
    for name in versions:
        from_events = any(bank.raw.source(i).endswith("events.parquet") for i in bank.inputs_of(name))
        assert (now[name] != versions[name]) == from_events, name
    assert any(now[name] == versions[name] for name in versions)


def test_marks_tell_inputs_parameters_and_profiles_apart(spark, sf_dir):
    bank, later = Bank.over(spark, sf_dir), Bank.over(spark, sf_dir, RunParams(dt.date(2034, 2, 1)))
    assert bank.mark("customer_health") == Bank.over(spark, sf_dir).mark("customer_health")
    marks = {bank.mark("customer_health"), bank.mark("profile_core"), later.mark("customer_health"), Bank.over(spark, sf_dir, profile="alt").mark("customer_health")}
    assert len(marks) == 4
    assert bank.inputs_of("customer_financial_summary") == {"accounts", "cards", "loans", "investments", "insurance_policies"}
    # Rows that lie in no file cannot be told to be the same, so they are built anew.
    held = {name: spark.createDataFrame([], bank.raw[name].schema) for name in bank.raw}
    memory = [Bank(held, bank.references, store="unused").mark("customer_financial_summary") for _ in range(2)]
    assert memory[0] != memory[1]
