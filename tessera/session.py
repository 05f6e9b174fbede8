"""Spark session settings shared by tests, the bench and the driver entry.

Cluster jobs get their session from the platform; only the settings that
the library relies on for correctness (UTC, ANSI, NTZ timestamps) are
asserted there. ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library's semantics depend on. Timestamps in the warehouse
# are TIMESTAMP_NTZ and written "as UTC"; the zone matters only where an NTZ
# value is turned into an instant (slice maths in operators.windows).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Scale settings: AQE re-plans joins from runtime sizes (its broadcast
# threshold is the size check for joins we do not hint), coalesces small
# shuffle partitions and splits skewed sort-merge join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tessera-wh-"))
    )
    for k, v in {**REQUIRED_CONF, **SCALE_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings the library needs on an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
    location and is used as is. Only in local mode (tests, one machine) an
    unset folder is replaced by a scratch folder; on a cluster that would be
    a different disk per executor, so it raises there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def size_shuffle_partitions(spark: SparkSession, paths: list[str],
                            bytes_per_partition: int = 128 * 1024 * 1024,
                            minimum: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the input size so each
    shuffle partition holds about ``bytes_per_partition`` (AQE then merges
    small ones; it never splits large ones except in skewed joins). At
    100 TB of input this gives ~800k partitions instead of the default 200.
    Sizes come from the file system's content summaries (no data read)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    floor = minimum if minimum is not None else spark.sparkContext.defaultParallelism
    n = max(floor, -(-total // bytes_per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
