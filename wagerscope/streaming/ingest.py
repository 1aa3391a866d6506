"""Append new bet files to the bronze table (S2), each file once.

The batch load reads every file again after a truncate.  Here the file source
remembers which files it has seen, and a run handles what arrived since and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wagerscope.sources import files


def new_files(
    spark: SparkSession, path: str, prefix: str = "transactions", max_files: int = 1000
) -> DataFrame:
    """The paths of unseen files as a stream; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", f"{prefix}*")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select("path")
    )


def append_new_files(
    spark: SparkSession, path: str, target: str, checkpoint: str, prefix: str = "transactions"
) -> None:
    """Write rows of unseen files to the parquet folder ``target`` and return when done.

    Files go through the batch load's header check: one with another header adds
    no rows and is named, with the reason, in ``<target>_skipped``.  Each batch has
    a folder of its own, so a batch that runs again replaces itself.
    """

    def append(batch: DataFrame, number: int) -> None:
        # At most the stream's maxFilesPerTrigger paths.
        paths = [r.path for r in batch.collect()]
        if paths:
            own = batch.sparkSession
            skipped = files.skipped_files(own, paths, prefix)
            skipped.write.mode("overwrite").parquet(f"{target}_skipped/batch={number}")
            bronze = files.read_bronze(own, paths, prefix)
            bronze.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = (
        new_files(spark, path, prefix)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
