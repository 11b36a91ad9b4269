"""Session settings the plans rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning does the skew splitting and the partition sizing; the time
# zone is pinned because dates are cut out of timestamps. Methods above 8000 bytes
# are never compiled by the JVM, and the wide projections here reach that: below the
# limit Spark splits them into methods that are (three to four times as fast).
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Batches that go to Python tasks are bounded by bytes, whatever the length of the rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "brightledger") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # A report has more stages than the 100 compiled plans kept by default.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepared(spark: SparkSession) -> SparkSession:
    """Gives a session the settings the plans rely on, where it does not set them itself."""
    own = spark.conf.getAll
    for key, value in SETTINGS.items():
        if key not in own:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in
    ``spark.checkpoint.dir``. Only a local master without that setting gets a folder
    made here.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="brightledger-"))
    return spark.sparkContext.getCheckpointDir()
