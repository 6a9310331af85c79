"""Session construction and shared-folder helpers.

Scratch output (Bronze copies, stream sinks and checkpoints, cut lineage)
always goes under the folder the cluster names in ``spark.checkpoint.dir``.
Only when a session has none (a local test run) do we pick one ourselves.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold at any scale: AQE re-plans joins and partition counts
# from runtime sizes, splits skewed shuffle partitions, and broadcasts a join
# side only when its measured size is under the threshold.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "kerbside", extra: dict | None = None) -> SparkSession:
    """``shuffle_partitions`` is left at the cluster's setting unless given
    (small local runs): AQE merges partitions, but never adds any."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # A machine-local folder is not visible to executors on a cluster.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="kerbside-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint dir."""
    return f"{shared_dir(spark)}/kerbside/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this session wrote under its scratch folder. Call it when
    the DataFrames that read from there are no longer needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/kerbside")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
