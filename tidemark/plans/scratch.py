"""Cutting lineage with files that every executor shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DIR_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only where none is set and the master is local."""
    sc = spark.sparkContext
    found = spark.conf.get(DIR_KEY, None) or sc.getConf().get(DIR_KEY)
    if not found and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError(f"set {DIR_KEY} to a folder that all executors share")
    if not found:
        found = tempfile.mkdtemp(prefix="tidemark-checkpoints-")
        spark.conf.set(DIR_KEY, found)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def cut(frame: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder and read it back without its lineage."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def written(frame: DataFrame, what: str) -> DataFrame:
    """Like `cut`, as compressed columnar files: for large intermediate tables."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(file)  # what nothing dropped before the application ends
    return spark.read.schema(frame.schema).parquet(path)


def dropped(frame: DataFrame) -> None:
    """Delete the files behind a frame made by `written` once nothing reads it any more."""
    spark = frame.sparkSession
    base = shared_dir(spark)
    jvm = spark.sparkContext._jvm
    roots = {f.rsplit("/", 1)[0] for f in frame.inputFiles()}
    for root in roots:
        if root.replace("file:///", "/").replace("file:/", "/").startswith(base.replace("file://", "").replace("file:", "")):
            path = jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
