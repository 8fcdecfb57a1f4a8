"""Session helpers: local sessions for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on. They are applied only where the session has none of its own.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join side is split even when that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", app: str = "pagemark") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    shuffle = str(os.cpu_count() or 8) if cores == "*" else str(cores)
    return (
        builder.config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no call-site capture per column expression: plans are built faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else built, keeping what was set explicitly."""
    explicit = dict(spark.sparkContext.getConf().getAll())
    for key, value in RUNTIME_CONF.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without one gets a
    temporary folder; on a cluster a missing setting is an error, as executors share no local disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="pagemark-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` computed once: written below the checkpoint folder, which all executors share, and reread."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
