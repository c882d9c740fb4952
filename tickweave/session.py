"""Session settings shared by every job.

All candle times are naive UTC (``TIMESTAMP_NTZ``); the session zone is pinned to
UTC so that the few functions that pass through zoned timestamps give the same
wall-clock values everywhere.  AQE is on so that shuffle partition counts,
broadcast conversion (by measured size) and skew splits are decided at run time.
"""
from __future__ import annotations

import re
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings a running session may change at any time (SQL confs).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Sizing for a large cluster (hundreds of executors, 100 TB inputs): start with
# many shuffle partitions and let AQE merge them to ~256 MB each, read files in
# 256 MB splits, and split skewed join partitions above 1 GB / 5x the median.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app: str = "tickweave",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Create (or reuse) a session with the library's settings (``cluster`` adds
    the large-cluster sizing)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            **RUNTIME_CONF}
    if cluster:
        conf.update(CLUSTER_CONF)
    else:
        conf["spark.driver.memory"] = "8g"  # local mode: the driver is the executor
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder of this session: the shared folder named by
    ``spark.checkpoint.dir``.  A folder is only made here when the session names none and
    runs on this machine alone; on a cluster that raises, since executors would not see it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tickweave-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables, inside the shared checkpoint folder; ``release``
    deletes what was written there."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    _SCRATCH.append((spark, path))
    return path


_TABLES: list[tuple[SparkSession, str]] = []


def scratch_table(spark: SparkSession, name: str) -> str:
    """A catalogue name that ``release`` drops."""
    _TABLES.append((spark, name))
    return name


_KEPT: list[DataFrame] = []


def reuse(df: DataFrame) -> DataFrame:
    """Keep a derived frame that a job reads more than once (candles, an aligned
    pair: far smaller than the trades behind them) so that the raw scan and
    aggregation run once.  MEMORY_AND_DISK; lost blocks are recomputed from
    lineage.  Kept frames live until ``release()``."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(kept)
    return kept


def release() -> int:
    """Drop every frame kept by ``reuse`` and delete the scratch tables (call between jobs
    of a long-lived session once their results are written).  Returns how many were dropped."""
    n = len(_KEPT) + len(_SCRATCH)
    while _KEPT:
        _KEPT.pop().unpersist()
    while _TABLES:
        spark, name = _TABLES.pop()
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        if spark.sparkContext._jsc is None:
            continue  # the session has ended
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return n
