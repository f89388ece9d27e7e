"""SparkSession helpers: session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "keepwise",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every operator here assumes.

    UTC is pinned because ``timestamp_ntz`` columns meet zone-aware functions
    in a few places; AQE is on so joins and partition counts re-plan from
    runtime sizes. On a cluster pass ``master=None`` and let spark-submit
    decide; ``shuffle_partitions`` should then be sized to the data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # checkpoint files (report ranking) are deleted once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` from filesystem metadata (no
    data is read; works for any Hadoop-compatible store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return int(total)


def size_shuffle_partitions(spark: SparkSession, paths, target_mb: int = 200,
                            expansion: float = 1.0) -> int:
    """Set ``spark.sql.shuffle.partitions`` so each shuffle partition holds
    about ``target_mb`` of data (``expansion`` scales compressed input to
    shuffled bytes), never fewer than the cluster's cores. AQE then coalesces
    small partitions and splits skewed ones around the same advisory size.
    Returns the partition count."""
    total = input_bytes(spark, paths) * expansion
    cores = spark.sparkContext.defaultParallelism
    n = max(cores, int(total // (target_mb * 1024 * 1024)) + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{target_mb}m")
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a
    private folder is made if driver and executors are one process (a
    ``local`` master, as in tests); on a cluster that is an error, since each
    executor would write to a disk the others cannot see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="keepwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
