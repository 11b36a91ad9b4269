"""Steps that bring several frames together on one key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


# Parts into which a heavy key's rows are dealt, for each task's even share of all rows.
PARTS_A_TASK = 16


def align(summaries: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of summaries that were each aggregated by ``key``, so that they hold at
    most one row per key; others go through ``outer_join``.

    The summaries are stacked and merged by one ``groupBy``. Each of them is already
    hash-partitioned on the key by its own aggregation, the union keeps that
    partitioning, and so the merge needs no further shuffle; a chain of full joins on
    a running ``coalesce`` key would reshuffle everything once per join. Measures a
    key lacks come out NULL. Column names must differ between summaries. As in a join, a
    missing key matches nothing: such a row of each summary stays a row of its own.
    """
    marked = [
        summary.withColumn("_unmatched", F.expr(f"CASE WHEN {key} IS NULL THEN {number} END"))
        for number, summary in enumerate(summaries)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    measures = [name for name in stacked.columns if name not in (key, "_unmatched")]
    return stacked.groupBy(key, "_unmatched").agg(*[F.expr(f"max({name}) AS {name}") for name in measures]).drop("_unmatched")


def outer_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on ``key``, for frames in which a key may be repeated or missing."""
    return left.join(right, key, "full")


def left_align(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Left joins of one-row-per-key frames onto a base."""
    return reduce(lambda left, right: left.join(right, key, "left"), others, base)


def nulls_first(column: str) -> list[Column]:
    """Ordering terms under which a missing value counts as the newest."""
    return [F.col(column).isNull(), F.col(column)]


def newest(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], take: Mapping[str, str | Column]) -> DataFrame:
    """The row with the greatest ``order`` per key, as the columns in ``take``.

    Written as a maximum over a struct, so map tasks send one row per key and a key
    that owns a third of the table costs no more than any other. Equal ranks are
    settled by the taken columns themselves, so give a row id as the last term.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranks = [term.alias(f"rank_{i}") for i, term in enumerate(order)]
    taken = [(F.col(source) if isinstance(source, str) else source).alias(name) for name, source in take.items()]
    top = df.groupBy(*keys).agg(F.max(F.struct(*ranks, *taken)).alias("top"))
    return top.select(*keys, *[F.col(f"top.{name}").alias(name) for name in take])


def newest_two(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The newest and second newest row per key, numbered 1 and 2 in ``age_rank``.

    The rank limit is applied before the shuffle as well, so at most two rows per
    key and map task travel.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("age_rank", F.row_number().over(window)).where("age_rank <= 2")


def latest_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Whole newest row per key."""
    columns = [c for c in df.columns if c != key]
    return newest(df, key, order, {c: c for c in columns}).select(*df.columns)


def total_of(groups: DataFrame, measure: str | Column) -> Column:
    """The sum of a measure over a whole frame, as a value for expressions over other rows.

    Summed in two phases into one row, which the plan reads as a scalar; the frame itself is
    neither moved nor repeated, however many rows it has.
    """
    return groups.agg(F.sum(measure)).scalar()


def share_of_total(groups: DataFrame, measure: str, share: str, digits: int = 1) -> DataFrame:
    """Adds each group's percentage of the sum over all groups, of which there may be any
    number. NULL where the sum is zero or missing."""
    total = F.nullif(total_of(groups, measure).cast("double"), F.lit(0.0))
    return groups.withColumn(share, F.round(F.col(measure).cast("double") * 100 / total, digits))


def spread_join(left: DataFrame, right: DataFrame, key: str, keys: DataFrame, by: str) -> DataFrame:
    """Left join on a key that may own any share of the left rows.

    ``keys`` has the key column of the left rows, from wherever it is cheapest to read. A key
    with more than a quarter of one task's even share of them is heavy: its left rows are dealt
    into parts of a sixteenth of that share by a hash of the column ``by``, and the rows of the
    right side are copied once per part. All other keys have one part, so there is one join on
    (key, part) with tasks of a like size. Left rows without a key match nothing and are dealt
    out as well.

    Fewer than four keys a task can be heavy and together they have at most twenty parts a
    task, so the list of them is broadcast and the copies are few.
    """
    finest = PARTS_A_TASK * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = keys.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    parts = F.col("_rows") * finest / total_of(counts, "_rows")
    heavy = F.broadcast(counts.where(parts > PARTS_A_TASK / 4).select(key, F.ceil(parts).cast("int").alias("_parts")))
    dealt = F.pmod(F.xxhash64(by), F.when(F.col(key).isNull(), finest).otherwise(F.coalesce("_parts", F.lit(1)))).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    spread = left.join(heavy, key, "left").withColumn("_part", dealt).drop("_parts")
    repeated = right.join(heavy, key, "left").withColumn("_part", copies).drop("_parts")
    return spread.join(repeated, [key, "_part"], "left").drop("_part")


def with_most_common(df: DataFrame, key: str, measures: Sequence[Column], labels: Mapping[str, str]) -> DataFrame:
    """One row per key: aggregates, and the most common value of each of the label columns (the
    first in sort order on a tie; missing values do not count).

    Rows are counted by (key, value) first, beside the aggregates by key, in one pass and with
    partial sums before the shuffle; then the best value of a key is a minimum over a struct. So
    no table of all values of a key is ever held, and a key with many rows is reduced where
    they are read.
    """
    columns = list(dict.fromkeys(labels.values()))
    counted = df.groupingSets([[key], *[[key, c] for c in columns]], key, *columns).agg(
        *measures, F.count("*").alias("_times"), F.grouping_id(key, *columns).alias("_level")
    )
    # The bits of the level tell which columns were rolled up; the key never is.
    whole = (1 << len(columns)) - 1
    names = [c for c in counted.columns if c not in (key, *columns, "_times", "_level")]
    at_key = [F.max(F.when(F.col("_level") == whole, F.col(name))).alias(name) for name in names]
    best = []
    for name, column in labels.items():
        level = whole - (1 << (len(columns) - 1 - columns.index(column)))
        here = (F.col("_level") == level) & F.col(column).isNotNull()
        best.append(F.min(F.when(here, F.struct((-F.col("_times")).alias("rank"), F.col(column).alias("value"))))["value"].alias(name))
    return counted.groupBy(key).agg(*at_key, *best)


def recent_count(moment: str, since: str, condition: str = "TRUE") -> str:
    """Rows at or after ``since`` that meet the condition."""
    return f"count_if({moment} >= {since} AND {condition})"
