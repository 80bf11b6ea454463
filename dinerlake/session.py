"""Session settings and the shared folder used to cut long lineages."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# The first two decide results.  The third lets the adaptive planner replace a
# sort-merge join by a hash join once every partition of one side is known to be
# small; larger sides keep the sort-merge join.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings this library relies on; sizing is left to the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def keep_clusters(spark: SparkSession) -> None:
    """Let joins on several keys use the layout by one of them, instead of dealing both sides out anew.

    A skewed join may still be split, though that costs what the layout saved.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def start_with_partitions(spark: SparkSession, n: int) -> None:
    """Shuffle into ``n`` partitions or more, which the adaptive planner then merges.

    A sort of a partition that does not fit into memory is spilled.
    """
    most = max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(most))


def scan_in_parts(spark: SparkSession, size: str) -> None:
    """Read files in parts of ``size`` unless the session names one; sums sort what a part holds."""
    key = "spark.sql.files.maxPartitionBytes"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def local_session(app: str = "dinerlake", cores: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="dinerlake-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from that copy."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
