"""Two-pass external shuffle into shards.

Pass one scatters the records by a seeded hash into buckets that fit in memory; Spark's
shuffle is the external step. Pass two orders each bucket, shuffles it with Fisher-Yates
from a seed of its own and writes it to the folder of its shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from brightledger.llm.common import fresh_folder

SEED = 20
BUCKET_BYTES = 4 << 20


@dataclass(frozen=True)
class Shards:
    """``folder`` holds ``shard=<n>/`` with the records of each shard; the columns ``bucket``
    and ``place`` give their order. ``buckets`` has the rows and the first slot of each."""

    spark: SparkSession
    folder: str
    schema: T.StructType

    def records(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def buckets(self) -> DataFrame:
        """One row per bucket; the running sum is over buckets of a shard, not over rows."""
        counted = self.records().groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
        before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        return counted.select("shard", "bucket", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_slot"))

    def slotted(self) -> DataFrame:
        """The records with ``slot``, their gapless position in the shard."""
        placed = self.records().join(self.buckets().drop("rows"), ["shard", "bucket"])
        return placed.withColumn("slot", F.col("first_slot") + F.col("place")).drop("first_slot")


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose seeded hash of the key is largest (the lowest of equal ones). Only the
    key and the number of shards decide; with one more shard a key stays or moves to it."""
    draws = [F.struct(F.xxhash64(F.lit(seed), F.lit(n), key).alias("draw"), F.lit(-n).alias("low")) for n in range(shards)]
    return (-F.greatest(*draws, draws[0])["low"]).cast("int")


def _fisher_yates(rows: int, seed: tuple[int, int]) -> np.ndarray:
    order, draw = np.arange(rows), np.random.default_rng(seed)
    picks = draw.integers(0, np.arange(rows, 0, -1)) if rows else []
    for back, pick in enumerate(picks):
        last = rows - 1 - back
        order[last], order[pick] = order[pick], order[last]
    return order


def write_shards(
    records: DataFrame, key: str, text: str, shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> Shards:
    """Shuffles whole ``records`` into ``shards`` shards by ``key`` and writes them.

    A stored row is ``record`` (a struct of all input columns, so no name can clash) with
    ``size`` (UTF-8 bytes of ``text``, none for null, plus 1), ``shard``, ``bucket`` and
    ``place``.

    The shard follows from the key alone; a null key counts as a key like any other. The
    bucket within it comes from a seeded hash of key, text and the record's number in the
    input, so a key or a text that fills a third of the table still spreads over all buckets
    of its shard. The number of buckets follows from the bytes of the whole input. A bucket
    is sorted by key and text before it is shuffled, so a task that runs again writes the
    same order; equal records are interchangeable. Empty texts have size 1; a very long text
    makes its bucket as much larger; an empty table gives shards without records.
    """
    spark = records.sparkSession
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    total = records.agg(F.sum(size)).first()[0] or 0
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    number = F.monotonically_increasing_id()
    keyed = records.select(
        F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record"),
        size.alias("size"),
        shard_of(F.col(key), shards, seed).alias("shard"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("first"),
        number.alias("number"),
    )
    scattered = keyed.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "first", "number"), F.lit(per_shard)))
    schema = T.StructType(
        [*scattered.select("record", "size", "shard", "bucket").schema.fields, T.StructField("place", T.LongType())]
    )

    def shuffled(bucket: pa.Table) -> pa.Table:
        ids = [bucket.column(name)[0].as_py() for name in ("shard", "bucket")]
        # Of records with equal key and text, the input number says only which comes first.
        ordered = bucket.sort_by([("first", "ascending"), ("number", "ascending")])
        moved = ordered.take(pa.array(_fisher_yates(bucket.num_rows, (seed, ids[0] << 40 | ids[1]))))
        return moved.drop_columns(["first", "number"]).append_column("place", pa.array(np.arange(bucket.num_rows)))

    folder = fresh_folder(spark, "shards")
    (
        scattered.groupBy("shard", "bucket")
        .applyInArrow(shuffled, schema)
        .write.partitionBy("shard")
        .parquet(folder)
    )
    return Shards(spark, folder, schema)
