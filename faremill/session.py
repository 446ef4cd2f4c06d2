"""Spark session defaults and fault-tolerant materialisation."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(
    app_name: str = "faremill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build (or reuse) a session with the settings the reports rely on.

    Calendar functions read the session time zone, so it is pinned to UTC. With
    ``master`` unset, the cluster's own submit settings decide where to run.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # recording a Python call site for every column doubles the time to build a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
        )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, honouring the one the cluster names.

    Only a local session without ``spark.checkpoint.dir`` gets a scratch folder; on a
    cluster a machine-local folder would be lost with its executor, so that is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = os.path.join(tempfile.mkdtemp(prefix="faremill-"), "checkpoints")
    context.setCheckpointDir(shared)
    return context.getCheckpointDir() or shared


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder once and cut its lineage.

    For data that many later jobs read (iterative training): a lost executor then costs a
    re-read of a few blocks instead of a re-run of the whole cleaning and join.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as a table of the shared checkpoint folder and read it back.

    Like ``materialise``, but later reads prune columns and, with ``partition_by``, folders.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
