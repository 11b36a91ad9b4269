from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from brightledger.llm import sharding
from brightledger.llm.queries import QUERIES

from .cases import documents, none


def test_every_record_has_one_slot_and_is_unchanged(spark):
    df = documents(spark).withColumn("shard", F.lit("clash")).withColumn("Bucket", F.lit(7))
    made = sharding.write_shards(df, "doc_id", "text", 4, bucket_bytes=2_000)
    rows = made.slotted().select("record.*", F.col("shard").alias("to"), "slot", "size").collect()
    given = Counter((r["doc_id"], r["text"], r["shard"], r["Bucket"]) for r in df.collect())
    assert Counter((r["doc_id"], r["text"], r["shard"], r["Bucket"]) for r in rows) == given
    for shard in range(4):
        slots = sorted(r["slot"] for r in rows if r["to"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["size"] == len((r["text"] or "").encode()) + 1 for r in rows)
    assert made.buckets().groupBy("shard").count().agg(F.max("count")).first()[0] > 1


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(4000).select("id", *[sharding.shard_of(F.col("id"), n).alias(f"n{n}") for n in (1, 7, 8, 9)])
    rows = ids.collect()
    assert all(r["n1"] == 0 for r in rows)
    assert all(r["n8"] in (r["n7"], 7) and r["n9"] in (r["n8"], 8) for r in rows)
    assert min(Counter(r["n8"] for r in rows).values()) > 400


def test_hot_key_spreads_over_the_buckets_of_its_shard(spark):
    df = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same text of all rows").alias("text"))
    made = sharding.write_shards(df, "doc_id", "text", 2, bucket_bytes=4_000)
    counts = [r["rows"] for r in made.buckets().collect()]
    assert len(counts) > 5 and sum(counts) == 3000 and max(counts) < 3 * min(counts)


def test_fisher_yates_is_a_uniform_seeded_permutation():
    assert sharding._fisher_yates(0, (1, 2)).tolist() == [] and sharding._fisher_yates(1, (1, 2)).tolist() == [0]
    a = sharding._fisher_yates(50, (1, 2))
    assert sorted(a) == list(range(50)) and (a == sharding._fisher_yates(50, (1, 2))).all()
    seen = Counter(tuple(sharding._fisher_yates(3, (9, n))) for n in range(3000))
    assert len(seen) == 6 and min(seen.values()) > 400


def test_empty_table(spark):
    assert sharding.write_shards(none(spark), "doc_id", "text", 3).slotted().count() == 0


def test_query(spark, sf_dir):
    rows = QUERIES["op1_two_pass_shuffle"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert r["text_crc32"] == crc32(texts[r["doc_id"]].encode()) and r["size"] == len(texts[r["doc_id"]].encode()) + 1
        assert r["grown_shard"] in (r["shard"], 8)
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert np.corrcoef(range(len(order)), order)[0, 1] < 0.3
