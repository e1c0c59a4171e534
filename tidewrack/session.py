"""Session helpers: table loading and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set the checkpoint folder from ``spark.checkpoint.dir``; only where that is unset use an own one.

    A cluster names a folder shared by all executors in that setting. The fallback is for local tests, where
    driver and executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if spark.sparkContext.getCheckpointDir():
            return spark.sparkContext.getCheckpointDir()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tidewrack-ckpt-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared)
    return shared


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder, for a written table; removed when the session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path
