"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One machine is its own cluster; anywhere else the folder must be named.
LOCAL_FOLDER = "/tmp/checkpoints"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (UTC) and the adaptive ones."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("roadpulse")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    ``LOCAL_FOLDER`` stands in for it in local mode with the setting unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(LOCAL_FOLDER)
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that its lineage ends in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


MAX_BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring: above either limit the plan stays a shuffle join.

    Rows and bytes (of the rows as text) are summed in one aggregation, partition by partition.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    held = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if held["n"] <= max_rows and held["bytes"] <= max_bytes else df
