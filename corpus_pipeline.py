"""From raw documents to packed training sequences.

Each stage takes the documents that the one before kept; all but the last return the columns
of documents. Rows are handled as the operators' docstrings say: a null, empty or letterless
text has no language and goes in the first stage; a null doc_id is kept, and rows that repeat
a doc_id are documents of their own as long as their texts differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightledger.llm import decontaminate, langid, minhash, packing
from brightledger.llm.common import given, stored
from brightledger.llm.queries import vocabulary
from brightledger.session import prepared


# A text goes if no language has this share of it.
LEAST_SHARE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language, which their ``lang`` names where it was null; the model
    is learned from the labels there are.

    A null, empty or letterless text goes, and one in which every language has less than
    ``LEAST_SHARE``. If no document has a label there is nothing to tell languages by: then all
    documents with a letter stay as they are.
    """
    model = langid.learn_from_folds(docs)
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    told = langid.identify(docs.select(record, "text"), model)
    if not model.languages:
        return told.where(F.col("text").rlike(r"[\p{L}\p{Nl}\p{No}]")).select("record.*")
    named = F.coalesce("record.lang", "language.pred").alias("lang")
    columns = [named if c == "lang" else F.col(f"record.`{c}`") for c in docs.columns]
    return told.where((F.col("language.pred") != langid.UNKNOWN) & (F.col("language.score") >= LEAST_SHARE)).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, given(spark, sf_dir, "benchmark").select("item_id", "text"), one_to_one=False)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their training sequences."""
    return packing.pack(docs, vocabulary())


def _with_settings(stage):
    return lambda spark, docs, sf_dir: stage(prepared(spark), docs, sf_dir)


STAGES = [
    ("language", _with_settings(language)),
    ("near_duplicates", _with_settings(near_duplicates)),
    ("benchmark_passages", _with_settings(benchmark_passages)),
    ("packing", _with_settings(packed)),
]

# Signatures, expectation-maximisation and a tokenizer are not SQL; the tests hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
