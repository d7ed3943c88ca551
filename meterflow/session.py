"""Session helpers: local sessions for tests, and the shared staging folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "meterflow", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use the one it gives you."""
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def staging_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage: ``spark.checkpoint.dir`` where it is set.

    Only a local session may fall back to a folder of its own, because a
    machine-local path is not visible to the other executors of a cluster.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    import tempfile

    folder = tempfile.mkdtemp(prefix="meterflow-")
    context.setCheckpointDir(folder)
    return folder


def stage_folder(spark: SparkSession) -> str:
    """A new, unused folder below the staging root."""
    return f"{staging_root(spark)}/meterflow-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so later plans start from the table.

    A stored table survives lost executors and keeps column pruning and filter
    pushdown for everything built on it, unlike a cached or checkpointed plan.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
