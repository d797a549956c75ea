"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "interlog") -> SparkSession:
    """Session with the settings the library is tuned for.

    Master and shuffle partitions are only set when given, so that spark-submit decides on a cluster; there
    ``spark.sql.shuffle.partitions`` is best about input bytes / 128 MB (AQE coalesces the small ones and
    splits skewed join partitions at run time).
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master).config("spark.driver.memory", "16g")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # long sessions run many queries with large plans: keep little status history on the driver
        .config("spark.sql.ui.retainedExecutions", "50")
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "100")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A private folder is only created in local mode (tests), never on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="interlog-ckpt-")
        sc.setCheckpointDir(folder)
        return folder
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def cut_lineage(df: DataFrame, name: str = "t") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Like a reliable checkpoint it drops the lineage and survives executor loss (unlike cached or
    locally checkpointed data); unlike an RDD checkpoint, later scans prune columns and push filters
    down into the files.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "interlog-tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def sized_broadcast(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only after the row count is checked; larger inputs stay shuffled."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= max_rows else df
