"""Incremental staging of raw record files with Structured Streaming.

The file source remembers which files it has read, so an interval staged once is not
staged again and an interrupted run resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from topictide.operators.staging import stage
from topictide.sources.readers import CSV_OPTIONS, RAW_SCHEMA


def raw_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_SCHEMA).options(**CSV_OPTIONS)
    reader = reader.option("multiLine", "true").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def stage_new_files(
    spark: SparkSession, raw_path: str, staged_path: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Stage the raw files not seen before, then stop; rows append to their year partition."""
    return (
        stage(raw_stream(spark, raw_path, files_per_batch))
        .writeStream.format("parquet")
        .option("path", staged_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("year")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
