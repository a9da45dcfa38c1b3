"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold at any size; sizing (shuffle partitions, memory) stays with
# whoever launches the session.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A longer method is left to the JVM's interpreter; a stage with one is run by parts instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keys and texts of a compressed file take many times its size in memory; whether a join's side is small enough to be
    # sent through the driver is told from files of a few hundred kB only, and measured once it is shuffled otherwise.
    "spark.sql.sources.fileCompressionFactor": "50",
}


def compiled(spark: SparkSession) -> None:
    """The last two settings above, in sessions that others made."""
    for name in ("spark.sql.codegen.hugeMethodLimit", "spark.sql.sources.fileCompressionFactor"):
        spark.conf.set(name, ENGINE_CONF[name])


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "dealweave"):
    """Single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DEALWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.dealweave.spread", str(spark.sparkContext.defaultParallelism))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def settled(df: DataFrame, part: str) -> DataFrame:
    """The rows as a table written once to the shared folder, for steps that read them several times."""
    folder = f"{shared_folder(df.sparkSession)}/dealweave-{part}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else a test-only one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local["):  # one machine; not local-cluster
        import tempfile

        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
