"""Report sections: rows of different summaries under one list of columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brightledger.operators.keyed import align


def union_sections(*sections: DataFrame) -> DataFrame:
    """Stacks sections by column name; a column a section lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sections)


def one_row(*summaries: DataFrame) -> DataFrame:
    """One-row summaries side by side, without a cross join."""
    keyed = [summary.withColumn("_all", F.lit(1)) for summary in summaries]
    return align(keyed, "_all").drop("_all")


def totals_and_groups(
    df: DataFrame, sets: Sequence[Sequence[str]], labels: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """Aggregates under several groupings in one pass over the rows.

    ``sets`` lists the grouping columns of each section (empty for the total) and
    ``labels`` its name, which comes out in ``section``. The report needs the input,
    a join of many summaries, only once.
    """
    keys = list(dict.fromkeys(key for group in sets for key in group))
    grouped = df.groupingSets([list(group) for group in sets], *keys).agg(
        *measures, F.grouping_id(*keys).alias("_grouping")
    )
    # Bit i from the left of the grouping id is set where key i was rolled up.
    codes = [sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in group) for group in sets]
    section = reduce(
        lambda column, pair: column.when(F.col("_grouping") == pair[0], F.lit(pair[1])),
        zip(codes[1:], labels[1:]),
        F.when(F.col("_grouping") == codes[0], F.lit(labels[0])),
    )
    present = reduce(
        lambda a, b: a | b,
        [
            (F.col("_grouping") == code) & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in group], F.lit(True))
            for code, group in zip(codes, sets)
        ],
    )
    return grouped.withColumn("section", section).where(present).drop("_grouping")
