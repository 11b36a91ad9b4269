"""Rule tables turned into columns, and the arithmetic of scores and rates.

Each helper hands the JVM one piece of expression text instead of building the
expression call by call; a report has several hundred of them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brightledger.rules.base import Rules


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def choice(rules: Rules) -> str:
    """A rule table as expression text: the first rule whose condition holds, else the default."""
    arms = " ".join(f"WHEN {condition} THEN {literal(value)}" for condition, value in rules.pairs)
    return f"(CASE {arms} ELSE {literal(rules.default)} END)"


def named(**texts: str | Column) -> list[Column]:
    """Columns by name, from expression text or columns."""
    return [
        F.expr(f"{text} AS {name}") if isinstance(text, str) else text.alias(name) for name, text in texts.items()
    ]


def decide(rules: Rules) -> Column:
    return F.expr(choice(rules))


def decide_all(**rules: Rules) -> dict[str, Column]:
    return {name: decide(table) for name, table in rules.items()}


def truth(condition: str) -> str:
    """True where the condition holds; false where it is false or unknown."""
    return f"coalesce(({condition}), false)"


def flag(condition: str) -> Column:
    return F.expr(truth(condition))


def flags(conditions: dict[str, str]) -> dict[str, Column]:
    return {name: flag(text) for name, text in conditions.items()}


def points(*parts: Rules | str) -> str:
    return " + ".join(choice(part) if isinstance(part, Rules) else f"({part})" for part in parts)


def clamped(*parts: Rules | str, low: int = 0, high: int = 100) -> str:
    """Sum of the parts, held inside ``low..high``."""
    return f"least({high}, greatest({low}, {points(*parts)}))"


def weighted(weights: dict[str, int]) -> str:
    return " + ".join(f"coalesce({name}, 0) * {weight}" for name, weight in weights.items())


def or_else(default, *names: str) -> list[Column]:
    return [F.expr(f"coalesce({name}, {literal(default)}) AS {name}") for name in names]


def or_zero(*names: str) -> list[Column]:
    return or_else(0, *names)


def ratio(part: str, whole: str) -> str:
    """``part / whole`` as a double, NULL for a zero denominator."""
    return f"(CAST(({part}) AS DOUBLE) / nullif(CAST(({whole}) AS DOUBLE), 0D))"


def share_pct(part: str, whole: str, digits: int = 1) -> str:
    """``part`` as a rounded percentage of ``whole``, NULL for a zero ``whole``."""
    return f"round({ratio(f'({part}) * 100', whole)}, {digits})"


def rate_pct(part: str, whole: str, digits: int) -> str:
    """Same, but 0 where ``whole`` is not positive."""
    share = f"CAST(({part}) AS DOUBLE) * 100 / CAST(({whole}) AS DOUBLE)"
    return f"(CASE WHEN ({whole}) > 0 THEN round({share}, {digits}) ELSE 0D END)"


def truncated_pct(part: str, whole: str) -> str:
    """A rate computed in whole numbers: 0 below the whole, else 100."""
    return f"(({part}) div nullif(({whole}), 0)) * 100"


def mean(expr: str) -> str:
    """Average of an exact number: the sum stays exact, so the result does not depend
    on the order in which tasks finish."""
    return f"(CAST(sum({expr}) AS DOUBLE) / count({expr}))"


def mean_of_means(expr: str) -> str:
    """Same for a double, held to nine places before it is summed."""
    return mean(f"CAST({expr} AS DECIMAL(24,9))")


def spread(expr: str, kind: str = "DECIMAL(10,0)") -> str:
    """Sample standard deviation of an exact number, NULL for fewer than two.

    From its count, sum and sum of squares, which are merged without rounding, so the result
    does not depend on which task has which rows; only the last quotient and root are doubles.
    """
    x, n = f"CAST({expr} AS {kind})", f"count({expr})"
    apart = f"{n} * sum({x} * {x}) - sum({x}) * sum({x})"
    return f"CASE WHEN {n} > 1 THEN sqrt(CAST({apart} AS DOUBLE) / (CAST({n} AS DOUBLE) * ({n} - 1))) END"


def n_if(condition: str) -> str:
    return f"count_if({condition})"


def sum_if(condition: str, column: str) -> str:
    """Sum over the rows that meet the condition, 0 where none does."""
    return f"sum(CASE WHEN {condition} THEN {column} ELSE 0 END)"


def choices(**rules: Rules) -> dict[str, str]:
    return {name: choice(table) for name, table in rules.items()}
