"""Session helpers: the settings every plan relies on, and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the semantics depend on (timestamps are wall-clock UTC text) or that
# keep the plans adaptive (AQE coalesces tiny shuffles, splits skewed joins and
# turns joins into broadcasts only after measuring the real build side).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the operators assume (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def workers_find_package(spark: SparkSession) -> SparkSession:
    """Python workers look for this package where the driver found it (a path that they lack does no harm)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "sensorlake") -> SparkSession:
    """Build (or reuse) a session for local runs and tests; clusters pass their own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SENSORLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.compress", "true")
        # small local inputs: keep enough post-shuffle tasks for the CPU-heavy per-row work
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage; a
    folder given to ``SparkContext.setCheckpointDir`` counts as well, and having neither
    is an error. Only in local mode, where the driver is the one executor, a
    fresh local folder is made and recorded, so that every later caller agrees on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sensorlake-ckpt-"))    # the setting itself cannot be changed at run time
        root = spark.sparkContext.getCheckpointDir()
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once for several consumers and cut its lineage.

    A Parquet table in the shared folder: every consumer reads only the columns
    it needs, and a lost executor costs a re-read, not a recomputation of the
    upstream plan.
    """
    path = scratch_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared root (through the Hadoop file system that holds it)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001
