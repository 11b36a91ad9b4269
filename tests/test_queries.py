"""Every registered query against its check query, and the driver contract."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from brightledger.rules import staging as staging_rules
from brightledger.rules.base import band
from compare import check_rows, differences

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


def test_every_query_has_a_check_or_a_reason():
    assert set(CHECKS) <= set(QUERIES)
    without = set(QUERIES) - set(CHECKS)
    assert all(re.match(r"op\d+_|pipeline$", name) for name in without), "only operators tested on their own have none"


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "customer_lifetime_value" in df.columns


def test_the_comparison_notices_differences():
    assert not differences(["a", "b"], [(1, 2.0)], ["b", "a"], [(2.0, 1)])
    assert differences(["a"], [(1,)], ["a"], [(2,)])
    assert differences(["a"], [(1,)], ["a"], [(1.0,)])
    assert differences(["a"], [(None,)], ["a"], [(0,)])
    assert differences(["a"], [(1,), (1,)], ["a"], [(1,)])
    assert differences(["a"], [(1,)], ["b"], [(1,)])


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns, expected = check_rows(CHECKS[name], sf_dir)
    assert differences(df.columns, [tuple(r) for r in df.collect()], columns, expected) == []


def test_a_changed_threshold_turns_its_query_red(spark, sf_dir, monkeypatch):
    changed = band("current_balance", [(100000, "High Balance"), (26000, "Medium Balance"), (5000, "Standard Balance")], "Low Balance")
    monkeypatch.setattr(staging_rules, "BALANCE_TIER", changed)
    df = QUERIES["stg_accounts"](spark, sf_dir)
    columns, expected = check_rows(CHECKS["stg_accounts"], sf_dir)
    assert any("balance_tier" in d for d in differences(df.columns, [tuple(r) for r in df.collect()], columns, expected))


def test_check_queries_import_nothing_from_the_library():
    sources = (Path(__file__).parent.parent / "oracles").glob("*.py")
    assert not [p.name for p in sources if re.search(r"^\s*(from|import) brightledger", p.read_text(), re.M)]
