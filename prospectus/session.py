"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators assume. Timestamps are rendered in UTC; AQE re-plans
# joins and coalesces small shuffles at runtime; skew-join splits hot keys.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "prospectus", driver_memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (HDFS/S3/...) folder and is used
    as is; a cluster session without it is an error, because a folder of the
    driver's machine is not seen by executors.  A local session gets a
    temporary folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="prospectus-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written tables/state."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts)


def handed_over(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint folder and read it back."""
    path = work_path(df.sparkSession, "steps", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: rows (of some 100 bytes) up to which the smaller side of a join is sent to every executor
FEW_ROWS = 500_000


def few(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast where it is counted to be small, else as it is."""
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df
