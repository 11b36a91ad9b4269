import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brightledger.llm.queries import vocabulary

from .cases import documents, none, prose
from .test_decontaminate import brute
from .test_near_duplicates import true_classes


def staged(spark, docs, sf_dir, places):
    """The result of each stage, each reread from Parquet."""
    for name, stage in corpus_pipeline.STAGES:
        place = str(places / name)
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
        yield name, docs


def test_every_stage_against_its_plain_version(spark, sf_dir, tmp_path):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = {r["doc_id"]: r["text"] for r in given.collect()}
    hits = brute(spark, sf_dir)
    for name, docs in staged(spark, given, sf_dir, tmp_path):
        if name == "packing":
            break
        assert docs.columns == given.columns
        if name == "language":
            left = {d: t for d, t in left.items() if t is not None and any(c.isalpha() for c in t)}
        elif name == "near_duplicates":
            left = {d: left[d] for d in set(true_classes(list(left.items())).values())}
        elif name == "benchmark_passages":
            left = {d: t for d, t in left.items() if d not in hits}
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == left, name
    tokenizer = Tokenizer.from_file(vocabulary())
    rows = docs.collect()
    assert {r["doc_id"] for r in rows} == set(left)
    for doc, text in left.items():
        parts = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"])
        held = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in parts])
        assert held.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1]
    run = corpus_pipeline.run(spark, sf_dir)
    assert run.columns == docs.columns and run.agg(F.sum("length")).first()[0] == sum(r["length"] for r in rows)


def test_awkward_and_clashing_documents(spark, sf_dir, tmp_path):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    extra = [(60, prose(5, 30) + " " + item, "aa", "s", 1), (61, "12 -- 34", None, None, None), (62, item, None, None, None)]
    docs = documents(spark, extra)
    for clash in ("language", "row", "class_id", "kept", "sequence_id", "node", "Bucket"):
        docs = docs.withColumn(clash, F.lit("clash"))
    ids = {}
    for name, made in staged(spark, docs, sf_dir, tmp_path):
        if name != "packing":
            assert made.columns == docs.columns
        ids[name] = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in made.select("doc_id").collect())
    assert not {21, 22, 23, 61} & set(ids["language"]) and ids["language"].count(25) == 2
    assert ids["near_duplicates"].count(25) == 1 and 20 not in ids["near_duplicates"] and -1 in ids["near_duplicates"]
    assert not {60, 62} & set(ids["benchmark_passages"]) and set(range(12)) <= set(ids["benchmark_passages"])
    assert set(ids["packing"]) == set(ids["benchmark_passages"])


def test_no_documents(spark, sf_dir, tmp_path):
    assert [made.count() for _, made in staged(spark, none(spark), sf_dir, tmp_path)] == [0] * 4


def test_a_corpus_without_labels_is_kept(spark, sf_dir):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    lettered = docs.where("text IS NOT NULL").rdd.filter(lambda r: any(c.isalpha() for c in r["text"])).count()
    assert kept.count() == lettered > 12 and kept.columns == docs.columns
    assert kept.where("lang IS NOT NULL").count() == 0


def test_missing_labels_are_filled_in_and_given_ones_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("lang", F.expr("CASE WHEN doc_id % 3 <> 0 THEN lang END"))
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.STAGES[0][1](spark, docs, sf_dir).collect()}
    given = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(kept[d] == given[d] for d in kept if d % 3)
    told = [kept[d] == given[d] for d in kept if d % 3 == 0]
    assert len(told) > 50 and np.mean(told) > 0.97 and None not in kept.values()


@pytest.mark.parametrize("name", ["pipeline", *[f"op{n}" for n in range(1, 14)]])
def test_registered(name):
    import __spark_entry__

    found = [q for q in __spark_entry__.queries() if q == name or q.startswith(name + "_")]
    assert len(found) == 1
