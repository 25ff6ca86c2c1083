"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "seriesmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides anything."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point checkpoints at the folder the cluster names.

    ``spark.checkpoint.dir`` wins. Only a session whose executors are threads of this
    process may fall back to a temporary folder, which goes when the process ends: on
    a cluster a lost executor would take it along.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        folder = tempfile.mkdtemp(prefix="seriesmart-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The frame written to the shared folder once and read back, for the length
    of a ``with`` block.

    Cuts the lineage where one plan feeds several actions, or where a table is
    rewritten from a plan that reads it. Unlike a recomputed plan the files have
    a known size, and a count of one column reads only that column.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged/{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of a shared file system, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
