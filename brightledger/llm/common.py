"""Small helpers of the operators in this folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightledger.session import shared_folder


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the one that all executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read again, which cuts the lineage
    and survives the loss of executors."""
    spark = df.sparkSession
    place = fresh_folder(spark, label)
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used: the
    optimizer puts a column's expression in place of its name, but not a lambda's argument."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a row without id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
