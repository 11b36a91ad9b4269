"""Stored tables, views by name, and one-row parameters.

A stored table is a folder of versions. Each version is written whole beside the others, and
then made current by one marker file, whose creation is a single step on any file system; so
readers see the old rows or the new ones, a failed write changes nothing, and a table may be
rebuilt from itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

MARKERS = "_current"
# Versions that stay: the current one, and the one before it for those that still read it.
KEPT = 2
PUBLIC_SPACE = "global_temp"


class PrivateTable(LookupError):
    """A table that exists but is not public."""


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(number, version, mark) of every version that was finished, oldest first."""
    files, place = _file_system(spark, f"{path}/{MARKERS}")
    if not files.exists(place):
        return []
    return sorted(tuple(status.getPath().getName().split("-")) for status in files.listStatus(place))


def write_table(df: DataFrame, path: str, mark: str = "") -> DataFrame:
    """Materialise a result with full replacement and hand back the stored table, whose plan
    starts at the files.

    Readers that began before go on with the version they had, which stays until the second
    replacement after it. If two writers replace a table at once, one of them is current in
    the end, whole. ``mark`` (letters and digits) is kept with the version for ``stored_mark``.
    """
    spark = df.sparkSession
    version = uuid4().hex
    files, place = _file_system(spark, f"{path}/v-{version}")
    try:
        df.write.parquet(f"{path}/v-{version}")
    except BaseException:
        files.delete(place, True)
        raise
    before = _versions(spark, path)
    number = int(before[-1][0]) + 1 if before else 1
    _, marker = _file_system(spark, f"{path}/{MARKERS}/{number:012d}-{version}-{mark}")
    files.create(marker, False).close()
    for old in before[: -(KEPT - 1)]:
        # The marker goes first: a version without one is never read.
        files.delete(_file_system(spark, f"{path}/{MARKERS}/{'-'.join(old)}")[1], False)
        files.delete(_file_system(spark, f"{path}/v-{old[1]}")[1], True)
    return spark.read.schema(df.schema).parquet(f"{path}/v-{version}")


def stored_mark(spark: SparkSession, path: str) -> str | None:
    """The mark of the current version of a stored table; None if there is no such table."""
    versions = _versions(spark, path)
    return versions[-1][2] if versions else None


def stored_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a stored table, or the Parquet files of another folder."""
    versions = _versions(spark, path)
    return spark.read.parquet(f"{path}/v-{versions[-1][1]}" if versions else path)


def content_mark(spark: SparkSession, paths: Iterable[str]) -> str:
    """A mark of files, and of all files in folders, which changes if one is added, taken away
    or written anew: a hash of their paths, sizes and times. Hidden files do not count."""
    lines = []
    for path in sorted(set(paths)):
        files, place = _file_system(spark, path)
        listed = files.listFiles(place, True)
        while listed.hasNext():
            status = listed.next()
            if not status.getPath().getName().startswith((".", "_")):
                lines.append(f"{status.getPath().toString()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()[:32]


def as_view(df: DataFrame, name: str, public: Collection[str] = ()) -> DataFrame:
    """Publish a lazy result under a name: for this session, and if the name is on the list
    ``public`` also for every other reader of the application (``read_published``)."""
    df.createOrReplaceTempView(name)
    if name in public:
        df.createOrReplaceGlobalTempView(name)
    return df


def public_names(spark: SparkSession) -> list[str]:
    """The names that other readers may use."""
    return sorted(table.name for table in spark.catalog.listTables(PUBLIC_SPACE) if table.namespace == [PUBLIC_SPACE])


def read_published(spark: SparkSession, name: str) -> DataFrame:
    """Another project's public result: a path (it has a slash) or a public name.

    A name that was published for its own session alone, or a table of the catalog that was
    never published, is refused, and an unknown one is not found.
    """
    if "/" in name:
        return stored_table(spark, name)
    if name in public_names(spark):
        return spark.table(f"{PUBLIC_SPACE}.{name}")
    try:
        known = spark.catalog.tableExists(name)
    except AnalysisException:
        known = False
    raise PrivateTable(f"{name} is not public") if known else LookupError(f"no published table {name}")


def param_row(spark: SparkSession, value, name: str = "my_number") -> DataFrame:
    """A run parameter as a one-row frame."""
    return spark.range(1).select(F.lit(value).alias(name))


def number_grid(spark: SparkSession, n: int) -> DataFrame:
    """All pairs ``i, j`` in ``1..n``, counted out of one distributed range."""
    return spark.range(n * n).select(
        (F.floor(F.col("id") / n) + 1).cast("bigint").alias("i"), (F.col("id") % n + 1).alias("j")
    )


def passthrough(df: DataFrame) -> DataFrame:
    return df.select("*")
