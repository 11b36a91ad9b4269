"""Calendar, text and scoring helpers against values worked out by hand."""

import datetime as dt
import random

from pyspark.sql import functions as F

from brightledger.functions import dates, scoring, text
from brightledger.rules.base import band, lookup, rules


def value(spark, expr, **columns):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()], F.lit(1).alias("one"))
    return df.select(F.expr(expr).alias("v")).first()["v"]


def ts(year, month, day, hour=0, minute=0, second=0):
    return dt.datetime(year, month, day, hour, minute, second)


def test_age_counts_completed_years(spark):
    def age(a, b):
        return value(spark, dates.age_years("a", "b"), a=a, b=b)

    assert age(ts(2020, 2, 29), ts(2021, 2, 28)) == 0
    assert age(ts(2020, 2, 29), ts(2021, 3, 1)) == 1
    assert age(ts(1990, 6, 15), ts(2024, 6, 14)) == 33
    assert age(ts(1990, 6, 15), ts(2024, 6, 15)) == 34
    assert age(ts(1990, 6, 15, 10), ts(2024, 6, 15)) == 33  # later in the day
    assert age(ts(2025, 3, 1), ts(2024, 2, 1)) == -1  # thirteen months ahead
    assert value(spark, dates.age_years("CAST(NULL AS TIMESTAMP)", "a"), a=ts(2024, 1, 1)) is None


def test_month_part_stays_below_twelve(spark):
    def months(a, b):
        return value(spark, dates.age_month_part("a", "b"), a=a, b=b)

    assert months(ts(2020, 1, 31), ts(2024, 2, 1)) == 0
    assert months(ts(2020, 1, 1), ts(2024, 12, 1)) == 11
    assert months(ts(2020, 1, 1), ts(2024, 1, 1)) == 0
    assert months(ts(2025, 3, 15), ts(2024, 2, 1)) == -1


def test_age_on_random_pairs(spark):
    def by_fields(a, b):
        """Total months between a and a later b, on calendar fields."""
        total = (b.year - a.year) * 12 + b.month - a.month
        return total - ((b.day, b.time()) < (a.day, a.time()))

    rng = random.Random(7)
    base = ts(1950, 1, 1)
    pairs = [
        tuple(sorted(base + dt.timedelta(seconds=rng.randrange(80 * 365 * 86400)) for _ in range(2)))
        for _ in range(300)
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a timestamp, b timestamp")
    found = df.selectExpr("i", f"{dates.age_years('a', 'b')} AS y", f"{dates.age_month_part('a', 'b')} AS m").collect()
    for row in found:
        a, b = pairs[row["i"]]
        assert (row["y"], row["m"]) == divmod(by_fields(a, b), 12)


def test_week_day_and_day_spans(spark):
    assert value(spark, dates.day_of_week("a"), a=ts(2024, 2, 4)) == 0  # Sunday
    assert value(spark, dates.day_of_week("a"), a=ts(2024, 2, 5)) == 1
    assert value(spark, dates.day_of_week("a"), a=ts(2024, 2, 10)) == 6
    assert value(spark, dates.whole_days("a", "b"), a=ts(2024, 1, 5, 10), b=ts(2024, 2, 1)) == 26
    assert value(spark, dates.clock_hours("a", "b"), a="09:30:00", b="18:00:00") == 8
    assert value(spark, dates.clock_hours("a", "b"), a="08:00:00", b="20:00:00") == 12


def test_title_case_breaks_at_any_sign(spark):
    assert value(spark, text.title_case("a"), a="mary-ann o'neil") == "Mary-Ann O'Neil"
    assert value(spark, text.title_case("a"), a="12B main STREET") == "12b Main Street"
    assert value(spark, text.title_case("a"), a="élan vital") == "Élan Vital"
    assert value(spark, text.title_case("CAST(NULL AS STRING)")) is None


def test_joined_skips_missing_pieces(spark):
    assert value(spark, text.joined("a", "'-'", "CAST(NULL AS STRING)"), a="x") == "x-"


def test_rules_first_match_wins_and_unknown_falls_through(spark):
    size = band("x", [(100, "BIG"), (10, "MID")], "SMALL")
    df = spark.createDataFrame([(1, 100), (2, 99), (3, 10), (4, 9), (5, None)], "i int, x int")
    found = [r["v"] for r in df.select("i", scoring.decide(size).alias("v")).orderBy("i").collect()]
    assert found == ["BIG", "MID", "MID", "SMALL", "SMALL"]
    assert value(spark, scoring.choice(lookup("a", {"K": 3}, 0)), a="K") == 3
    assert value(spark, scoring.choice(rules(None, ("a = 'K'", 1))), a="Z") is None
    assert value(spark, scoring.truth("a > 1 OR CAST(NULL AS BOOLEAN)"), a=2) is True
    assert value(spark, scoring.truth("a > 1"), a=None) is False


def test_scores_are_held_inside_their_limits(spark):
    assert value(spark, scoring.clamped("a", "60"), a=70) == 100
    assert value(spark, scoring.clamped("a", "-60"), a=10) == 0
    # A part that is unknown makes the sum unknown, which counts as the lower limit.
    assert value(spark, scoring.clamped("a", "CAST(NULL AS INT)"), a=10) == 0


def test_rates(spark):
    assert value(spark, scoring.rate_pct("a", "b", 2), a=1, b=3) == 33.33
    assert value(spark, scoring.rate_pct("a", "b", 2), a=1, b=0) == 0
    assert value(spark, scoring.rate_pct("a", "b", 1), a=1, b=800) == 0.1  # 0.125 rounds to 0.1
    assert value(spark, scoring.rate_pct("a", "b", 2), a=6667, b=20000) == 33.34  # 33.335 rounds up
    assert value(spark, scoring.share_pct("a", "b"), a=1, b=0) is None
    assert value(spark, scoring.truncated_pct("a", "b"), a=7, b=8) == 0
    assert value(spark, scoring.truncated_pct("a", "b"), a=8, b=8) == 100
    assert value(spark, scoring.truncated_pct("a", "b"), a=1, b=0) is None


def test_means_of_exact_numbers(spark):
    df = spark.createDataFrame([("1.10",), ("2.20",), (None,)], "x string").selectExpr("CAST(x AS DECIMAL(10,2)) AS x")
    assert df.select(F.expr(scoring.mean("x")).alias("m")).first()["m"] == 1.65
    assert df.where("x > 5").select(F.expr(scoring.mean("x")).alias("m")).first()["m"] is None
    assert df.select(F.expr(scoring.n_if("x > 2")).alias("n")).first()["n"] == 1
    assert float(df.select(F.expr(scoring.sum_if("x > 5", "x")).alias("s")).first()["s"]) == 0
