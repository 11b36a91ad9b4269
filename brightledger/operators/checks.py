"""Data checks as Spark jobs.

Checks report how many findings there are and keep none of the rows. All checks of all
tables are counted in one pass over each table and one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from brightledger.functions.scoring import literal

@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""


def unique_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; missing values do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
    )


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _outside(column: str, values: Iterable[str]) -> str:
    return f"{column} NOT IN ({', '.join(literal(value) for value in values)})"


def disallowed(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the list; a missing value passes."""
    return df.where(_outside(column, values))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key the parent lacks; a missing key passes."""
    keys = parent.select(F.col(parent_column).alias("_parent_key")).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def _comparable(df: DataFrame, column: str, kinds: set[T.DataType]) -> tuple[Column, Column]:
    """A column as a whole number, or else as text, equal where the values are equal. ``kinds``
    are the types of all columns it is compared with, its own among them."""
    none, value, own = F.lit(None), F.col(column), df.schema[column].dataType
    if all(isinstance(kind, T.IntegralType) for kind in kinds):
        return value.cast("bigint"), none.cast("string")
    if len(kinds) > 1 and isinstance(own, T.NumericType):
        value = value.cast("decimal(38,10)")
    elif isinstance(own, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)  # one zero
    return none.cast("bigint"), value.cast("string")


def _fails(check: Check) -> str:
    return f"{check.column} IS NULL" if check.kind == "not_null" else _outside(check.column, check.values)


def _entry(number: int, whole: Column, text: Column, role: int) -> Column:
    return F.struct(F.lit(number).alias("number"), whole.alias("whole"), text.alias("text"), F.lit(role).alias("role"))


def run_all_checks(tables: Mapping[str, DataFrame], listed: Mapping[str, Sequence[Check]]) -> DataFrame:
    """One result row per check on any of the tables: table_name, check_name, column_name and
    failures. Tables that are only parents of others are given without checks of their own.

    Each table is read once. A row gives one entry per key column, of the column's number and
    the value (a whole number or text), and one per failed row check; entries of all tables are
    counted by number and value in one shuffle, after partial counts where they are read. A key
    column and the columns that refer to it share a number, so the counts also tell which
    references have no parent. From there one row of sums is left.
    """
    numbers: dict[tuple[str, str], int] = {}
    referring: list[tuple[str, Check]] = []
    kinds: dict[tuple[str, str], set[T.DataType]] = {}
    for table, checks in listed.items():
        for check in checks:
            if check.kind not in ("unique", "relationships"):
                continue
            key = (table, check.column) if check.kind == "unique" else (check.parent, check.parent_column)
            numbers.setdefault(key, len(numbers))
            for held, column in (key, (table, check.column)):
                kinds.setdefault(key, set()).add(tables[held].schema[column].dataType)
            if check.kind == "relationships":
                referring.append((table, check))
    failing = [(table, check) for table, checks in listed.items() for check in checks if check.kind in ("not_null", "accepted_values")]

    stacked = []
    for table, df in tables.items():
        keys = [(key, key[1], 0) for key in numbers if key[0] == table]
        keys += [
            ((check.parent, check.parent_column), check.column, role)
            for role, (child, check) in enumerate(referring, 1)
            if child == table
        ]
        failed = [(len(numbers) + at, check) for at, (owner, check) in enumerate(failing) if owner == table]
        if len(keys) == 1 and all(check.kind == "not_null" and check.column == keys[0][1] for _, check in failed):
            # A row has its key or lacks it, so it gives one entry.
            (key, column, role), absent = keys[0], F.lit(failed[0][0] if failed else None).cast("int")
            whole, text = _comparable(df, column, kinds[key])
            number = F.when(F.col(column).isNull(), absent).otherwise(numbers[key])
            entry = df.select(number.alias("number"), whole.alias("whole"), text.alias("text"), F.lit(role).alias("role"))
            stacked.append(entry if len(failed) == 1 else entry.where("number IS NOT NULL"))
        elif keys or failed:
            entries = []
            for key, column, role in keys:
                whole, text = _comparable(df, column, kinds[key])
                entries.append(F.when(F.col(column).isNotNull(), _entry(numbers[key], whole, text, role)))
            for number, check in failed:
                entries.append(F.when(F.expr(_fails(check)), _entry(number, F.lit(None).cast("bigint"), F.lit(None).cast("string"), 0)))
            stacked.append(df.select(F.explode(F.array_compact(F.array(*entries))).alias("entry")).select("entry.*"))

    if not stacked:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table_name string, check_name string, column_name string, failures long")
    roles = [F.count_if(F.col("role") == role).alias(f"role_{role}") for role in range(len(referring) + 1)]
    counted = reduce(DataFrame.unionAll, stacked).groupBy("number", "whole", "text").agg(*roles)
    results = []
    for table, checks in listed.items():
        for check in checks:
            if check.kind == "unique":
                found = f"count_if(number = {numbers[table, check.column]} AND role_0 > 1)"
            elif check.kind == "relationships":
                role = next(at for at, (child, other) in enumerate(referring, 1) if child == table and other is check)
                number = numbers[check.parent, check.parent_column]
                found = f"coalesce(sum(CASE WHEN number = {number} AND role_0 = 0 THEN role_{role} END), 0)"
            else:
                number = len(numbers) + next(at for at, (owner, other) in enumerate(failing) if owner == table and other is check)
                found = f"coalesce(sum(CASE WHEN number = {number} THEN role_0 END), 0)"
            results.append((table, check, found))
    sums = counted.agg(*[F.expr(found).alias(f"c{at}") for at, (_, _, found) in enumerate(results)])
    lines = ", ".join(f"{literal(t)}, {literal(c.kind)}, {literal(c.column)}, c{at}" for at, (t, c, _) in enumerate(results))
    return sums.selectExpr(f"stack({len(results)}, {lines}) AS (table_name, check_name, column_name, failures)")


def run_checks(table: str, df: DataFrame, checks: Sequence[Check], parents: Mapping[str, DataFrame] = {}) -> DataFrame:
    """The checks of one table; ``parents`` has the tables that it refers to."""
    needed = {check.parent: parents[check.parent] for check in checks if check.kind == "relationships" and check.parent != table}
    return run_all_checks({table: df, **needed}, {table: checks})
