"""Files in and out: strict CSV, optional tables, provenance, write-once and staged results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def strict_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file with header and quoted line breaks; a malformed line fails the read."""
    return spark.read.options(header=True, multiLine=True, mode="FAILFAST", enforceSchema=False).schema(schema).csv(path)


def optional_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, or an empty frame of the schema where there is none; any other error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def partitioned(spark: SparkSession, path: str, *partitions: str) -> DataFrame:
    """One or more partition folders of a table, their partition columns kept."""
    base = path.split(f"/{partitions[0].split('=')[0]}=")[0] if partitions else path
    return spark.read.option("basePath", base).parquet(*[f"{base}/{p}" for p in partitions] or [base])


def united(spark: SparkSession, paths: Sequence[str], source: str = "source_path") -> DataFrame:
    """Several tables by name, missing columns null, each row with its path."""
    frames = [spark.read.parquet(p).withColumn(source, F.lit(p)) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_once(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modified ms) of a folder's entries."""
    p, fs = _hadoop_path(spark, path)
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)) if fs.exists(p) else []


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """A hash of what lies in the paths, to see that an input changed."""
    import hashlib

    return hashlib.sha256(repr([(p, listed(spark, p)) for p in sorted(paths)]).encode()).hexdigest()


def staged(df: DataFrame, path: str, force: bool = False, partitions: int | None = None) -> DataFrame:
    """The frame as written under `path`; an earlier complete result there is used again."""
    spark = df.sparkSession
    if force or not exists(spark, f"{path}/_SUCCESS"):
        (df.repartition(partitions) if partitions else df).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_count(rows: int, row_bytes: int, target_bytes: int = 128 << 20) -> int:
    return max(1, -(-rows * row_bytes // target_bytes))


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace only the partitions that the frame has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def manifest(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
