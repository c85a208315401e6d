"""Watermark windows for batches, and the same publishing step for a stream's micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import new_rows


def in_window(df: DataFrame, at: str, after: str | None, upto: str) -> DataFrame:
    """Rows in (after, upto]; all up to there without `after`."""
    moment = lambda x: F.lit(x).cast("timestamp_ntz")
    out = df.where(F.col(at).cast("timestamp_ntz") <= moment(upto))
    return out if after is None else out.where(F.col(at).cast("timestamp_ntz") > moment(after))


def lag_seconds(event: Column, ingested: Column) -> Column:
    return F.timestamp_diff("SECOND", event, ingested)


def publish_stream(stream: DataFrame, path: str, key: str, checkpoint: str):
    """Append each micro-batch's unseen ids to a Parquet table; a repeated batch adds nothing."""

    def each(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        once = batch.dropDuplicates([key])
        try:
            target = spark.read.parquet(path)
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            once.write.mode("append").parquet(path)
            return
        new_rows(once, target, key).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
