"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
LIBRARY_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "shiftlens",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("SHIFTLENS_DRIVER_MEMORY", "16g"))
         # rank tables are checkpointed; drop their files once no plan references them
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**LIBRARY_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_library_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_library_conf(spark: SparkSession) -> None:
    for k, v in LIBRARY_CONF.items():
        spark.conf.set(k, v)


def is_local(master: str) -> bool:
    """One JVM that holds driver and executor (``local-cluster`` starts executors of their own)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    ``spark.checkpoint.dir`` from the session when the cluster names one;
    otherwise a local session (tests, ad-hoc use) gives its SparkContext a folder
    (``spark.checkpoint.dir`` itself cannot be changed once the context runs).
    On a cluster a folder of the driver's machine would lose data, so there the
    setting is required."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server owns the setting
        sc = None
    known = d or (sc.getCheckpointDir() if sc is not None else None)
    if known is None and (sc is None or not is_local(sc.master)):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc is None:
        return known
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d or tempfile.mkdtemp(prefix="shiftlens-ckpt-"))
    return d or sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (visible to every executor)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/shiftlens-work/{name}-{uuid.uuid4().hex[:12]}"


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths``, from file-system metadata only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def size_shuffle_partitions(spark: SparkSession, paths: list[str],
                            target_bytes: int = TARGET_PARTITION_BYTES, minimum: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` to about input size / ``target_bytes``
    (at least the cluster's default parallelism), so a shuffle of the whole
    input still gives partitions that fit in task memory; AQE coalesces the
    partitions a smaller intermediate does not need."""
    floor = minimum if minimum is not None else spark.sparkContext.defaultParallelism
    n = max(floor, -(-input_bytes(spark, paths) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_bytes, 256 * 1024 * 1024)))
    return n
