"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "tidemark", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that change results (time zone) on a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder all executors share, below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tidemark-", dir=os.environ.get("TMPDIR"))
        sc.setCheckpointDir(folder)
    return f"{sc.getCheckpointDir()}/{name}"


_written: list[str] = []
#: Spark's own setting: shuffle files go at the end of the execution that wrote them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def release(spark: SparkSession) -> None:
    """Delete the tables that ``durable`` wrote in this process; nothing may read them any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    while _written:
        path = hadoop(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and go on from the table.

    Cuts lineage, so a result that feeds several branches is computed once and stays the same in
    all of them, also when an executor is lost. Reading back keeps column pruning and known sizes.
    The shuffle files of the write go with its end: nothing reads them once the table is whole.
    """
    spark = df.sparkSession
    path = shared_folder(spark, f"durable-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)
