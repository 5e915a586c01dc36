"""Session helpers shared by tests, bench and the driver entry points."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "shoprank") -> SparkSession:
    """A local session for tests and the bench (no UI, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a folder that the driver and
    all executors share, and is used as is; without it a cluster session is
    refused, since a folder of the driver's machine would not be seen by the
    executors. Only a local session (tests, bench) may get a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = private_folder(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def private_folder(master: str) -> str:
    """A new private folder for a local master; any other master is an error."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="shoprank-ckpt-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder (any Hadoop file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_back(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` and read it: ends the lineage and tells the optimiser the size."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
