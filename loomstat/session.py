"""Session building and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "loomstat") -> SparkSession:
    """A session for one machine; a cluster brings its own through spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")  # small test data on all cores
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("LOOMSTAT_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="loomstat-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is used, but only in local
    mode: on a cluster a folder of one machine would be lost to the others.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or sc.getCheckpointDir()
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="loomstat-")
    sc.setCheckpointDir(made)
    return made


def cut_lineage(df):
    """Write ``df`` to the shared folder and go on from the written rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder, for a table written in passing."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df):
    """``df`` as a table of the shared folder, read back.

    For loops of joins: a checkpoint keeps the estimated size of its plan, and estimates
    of joins are products, which grow without bound from round to round; a table has the
    size of its files.
    """
    path = new_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
