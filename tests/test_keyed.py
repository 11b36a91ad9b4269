"""Alignment, newest rows and grouped sections against brute force."""

import random
import re
import statistics
from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from brightledger.functions.scoring import spread
from brightledger.operators.keyed import (
    align,
    latest_per_key,
    newest,
    newest_two,
    nulls_first,
    outer_join,
    share_of_total,
    spread_join,
    with_most_common,
)
from brightledger.operators.sections import one_row, totals_and_groups, union_sections


def test_align_keeps_every_key_and_marks_what_is_missing(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, a int")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "k int, b string")
    c = spark.createDataFrame([(4, True)], "k int, c boolean")
    assert rows(align([a, b, c], "k"), "k") == [
        {"k": 1, "a": 10, "b": None, "c": None},
        {"k": 2, "a": 20, "b": "x", "c": None},
        {"k": 3, "a": None, "b": "y", "c": None},
        {"k": 4, "a": None, "b": None, "c": True},
    ]


def test_align_and_outer_join_match_a_chain_of_full_joins(spark):
    a = spark.createDataFrame([(1, "n"), (None, "m")], "k int, a string")
    b = spark.createDataFrame([(1, 5), (None, 6), (3, 7)], "k int, b int")
    c = spark.createDataFrame([(1, "Anna"), (1, "Bob"), (None, "Cy"), (4, "Di")], "k int, c string")
    chained = a.join(b, "k", "full").join(c, "k", "full")
    assert rows(outer_join(align([a, b], "k"), c, "k")) == rows(chained)
    assert chained.count() == 7


def test_align_of_aggregates_does_not_shuffle_again(spark):
    facts = [
        spark.range(1000).selectExpr("id % 50 AS k", f"id AS v{i}").groupBy("k").agg(F.sum(f"v{i}").alias(f"s{i}"))
        for i in range(4)
    ]
    plan = align(facts, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4


def test_newest_takes_missing_dates_first_and_breaks_ties_by_id(spark):
    df = spark.createDataFrame(
        [(1, 1, "2024-01-01", "a"), (1, 2, "2024-01-01", "b"), (2, 3, None, "c"), (2, 4, "2024-05-05", "d")],
        "k int, id int, at string, label string",
    )
    found = newest(df, "k", [*nulls_first("at"), F.col("id")], {"chosen": "label"})
    assert rows(found, "k") == [{"k": 1, "chosen": "b"}, {"k": 2, "chosen": "c"}]
    whole = latest_per_key(df, "k", [F.col("at"), F.col("id")])
    assert rows(whole, "k")[1] == {"k": 2, "id": 4, "at": "2024-05-05", "label": "d"}


def test_newest_two_against_brute_force_with_one_hot_key(spark):
    rng = random.Random(3)
    data = [(0 if rng.random() < 0.4 else rng.randrange(1, 40), i, rng.randrange(30)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, id int, at int").repartition(8)
    found = newest_two(df, "k", [F.col("at").desc(), F.col("id").desc()]).collect()
    expected = {}
    for k, i, at in data:
        expected.setdefault(k, []).append((at, i))
    expected = {k: sorted(v, reverse=True)[:2] for k, v in expected.items()}
    got = {}
    for row in sorted(found, key=lambda r: r["age_rank"]):
        got.setdefault(row["k"], []).append((row["at"], row["id"]))
    assert got == expected


def test_rank_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    plan = newest_two(df, "k", [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2


def test_shares_add_up(spark):
    groups = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "g string, n int")
    assert rows(share_of_total(groups, "n", "pct"), "g") == [
        {"g": "a", "n": 1, "pct": 25.0},
        {"g": "b", "n": 1, "pct": 25.0},
        {"g": "c", "n": 2, "pct": 50.0},
    ]


def test_totals_and_groups_in_one_pass(spark):
    df = spark.createDataFrame(
        [("x", "p", 1), ("x", None, 2), ("y", "p", 4), (None, "q", 8)], "g string, h string, n int"
    )
    found = totals_and_groups(
        df, [[], ["g"], ["h"]], ["ALL", "G", "H"], [F.sum("n").alias("n"), F.expr("count_if(g = 'x') AS xs")]
    )
    assert rows(found.select("section", "g", "h", "n", "xs"), "section", "g", "h") == [
        {"section": "ALL", "g": None, "h": None, "n": 15, "xs": 2},
        {"section": "G", "g": "x", "h": None, "n": 3, "xs": 2},
        {"section": "G", "g": "y", "h": None, "n": 4, "xs": 0},
        {"section": "H", "g": None, "h": "p", "n": 5, "xs": 1},
        {"section": "H", "g": None, "h": "q", "n": 8, "xs": 0},
    ]


def test_sections_and_single_rows(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3,)], "c int")
    assert rows(one_row(a, b)) == [{"a": 1, "b": 2, "c": 3}]
    assert rows(union_sections(a, b.withColumnRenamed("c", "b")), "b") == [{"a": 1, "b": 2}, {"a": None, "b": 3}]
    assert "Cartesian" not in one_row(a, b)._jdf.queryExecution().executedPlan().toString()


def test_shares_of_many_labels_use_no_single_task(spark):
    groups = spark.range(100_000).selectExpr("id AS g", "CAST(id % 4 AS DECIMAL(9,2)) AS n").repartition(8)
    shares = share_of_total(groups, "n", "pct", 6)
    plan = shares._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange SinglePartition" not in main and "Window" not in plan and "Join" not in plan
    total = sum(i % 4 for i in range(100_000))
    found = shares.groupBy("n").agg(F.min("pct").alias("low"), F.max("pct").alias("high"), F.count("*").alias("labels")).collect()
    assert all(r["low"] == r["high"] == round(float(r["n"]) * 100 / total, 6) and r["labels"] == 25_000 for r in found)
    empty = share_of_total(groups.where("g < 0"), "n", "pct")
    nothing = share_of_total(groups.where("n = 0").limit(2), "n", "pct")
    assert empty.collect() == [] and [r["pct"] for r in nothing.collect()] == [None, None]


def test_spread_join_equals_a_left_join(spark):
    rng = random.Random(9)
    keys = [rng.choice([1, 1, 1, 2, None, rng.randrange(3, 60)]) for _ in range(4000)]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k int").repartition(5)
    versions = [(k, f"v{k}") for k in [None, 1, 1, 2, *range(4, 70)]]
    right = spark.createDataFrame(versions, "k int, v string")
    joined = spread_join(left, right, "k", left.select("k"), "id")
    assert joined.columns == ["k", "id", "v"]
    assert rows(joined) == rows(left.join(right, "k", "left"))
    for empty_left, empty_right in ((left.where("id < 0"), right), (left, right.where("k < 0"))):
        made = spread_join(empty_left, empty_right, "k", empty_left.select("k"), "id")
        assert rows(made) == rows(empty_left.join(empty_right, "k", "left"))


def test_heavy_keys_are_dealt_over_tasks_and_few(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "20")
        left = spark.range(40_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS k")
        right = spark.range(40_000).selectExpr("id AS k", "id * 2 AS v")
        joined = spread_join(left, right, "k", left.select("k"), "id")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 1.6 * sizes[len(sizes) // 2] and sum(sizes) == 40_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_most_common_value_against_counters(spark):
    rng = random.Random(4)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["b", "a", None]), rng.choice("xyz"), rng.randrange(9)) for _ in range(500)]
    data += [(9, None, "x", 1), (10, "b", "y", 2), (10, "a", "y", 2)]
    df = spark.createDataFrame(data, "k int, s string, t string, n int").repartition(4)
    made = with_most_common(df, "k", [F.sum("n").alias("n"), F.count_distinct("t").alias("ts")], {"usual_s": "s", "usual_t": "t", "again": "s"})
    expected = []
    for k in {row[0] for row in data}:
        held = [row for row in data if row[0] == k]
        best = lambda at: min(((-c, v) for v, c in Counter(r[at] for r in held if r[at] is not None).items()), default=(0, None))[1]
        expected.append({"k": k, "n": sum(r[3] for r in held), "ts": len({r[2] for r in held}), "usual_s": best(1), "usual_t": best(2), "again": best(1)})
    assert rows(made, "k") == sorted(expected, key=lambda r: repr(r["k"]))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "mode(" not in plan and "collect" not in plan


def test_spread_does_not_depend_on_the_order_of_rows(spark):
    values = [300 + (i * 7919) % 551 for i in range(2000)] + [None] * 5
    seen = set()
    for parts in (1, 3, 8):
        df = spark.createDataFrame([(v,) for v in values], "x int").repartition(parts)
        seen.add(df.agg(F.expr(spread("x"))).first()[0])
    (found,) = seen
    assert abs(found - statistics.stdev(v for v in values if v is not None)) < 1e-9
    one = spark.createDataFrame([(5,), (None,)], "x int")
    assert one.agg(F.expr(spread("x"))).first()[0] is None
    assert not re.search("stddev", df.agg(F.expr(spread("x")))._jdf.queryExecution().executedPlan().toString())
