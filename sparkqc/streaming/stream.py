"""Structured Streaming entry points.

New delivery files are picked up incrementally by the file source; the
streaming checkpoint replaces "move the file to an archive". Each micro-batch
gives its files to the batch validators (V1-V5, S5) through ``foreachBatch`` and
appends to the table; scoring is stateless and runs unchanged on a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqc.sources import history, ingest
from sparkqc.sources.contract import Contract

#: Files of one micro-batch at most: what bounds the list of paths on the driver.
MAX_FILES = 1000


def read_stream(spark: SparkSession, path: str, contract: Contract, max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """CSV file stream with the raw (text) contract schema and ``file_name``."""
    r = (spark.readStream.schema(ingest.raw_schema(contract)).option("header", True).option("enforceSchema", True)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", ingest.CORRUPT))
    r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path).select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"))


def read_files(spark: SparkSession, path: str, max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """``(file_path)`` of every line of newly delivered files, headers too, so that a file without rows is seen."""
    return spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path).select(F.col("_metadata.file_path").alias("file_path"))


def ingest_stream(spark: SparkSession, path: str, contract: Contract, table_path: str, quarantine_path: str,
                  checkpoint: str, available_now: bool = True, max_files_per_trigger: int = MAX_FILES, incremental: bool = False):
    """Append newly delivered files to the table; quarantine bad files and rows.

    ``trigger(availableNow=True)`` processes everything present and stops, which
    makes the stream a restartable incremental batch job; ``checkpoint`` is a
    folder that outlives the session, as it knows the files read. The appends are
    at-least-once: a micro-batch replayed after a failure writes its rows again
    under the same ``_epoch``; ``compile_table`` (DISTINCT without the
    bookkeeping columns) removes them. With ``incremental`` the table is a
    ``sources.history`` table, where a replay adds nothing in the first place.
    """
    def handle(batch: DataFrame, epoch_id: int) -> None:
        paths = [r[0] for r in batch.distinct().collect()]  # at most maxFilesPerTrigger
        if not paths:
            return
        parts = ingest.validate_batches(spark, paths, contract, write_verdicts=True)
        if incremental:
            history.append_new(spark, parts["good"], table_path)
        else:
            parts["good"].withColumn("_epoch", F.lit(epoch_id)).write.mode("append").parquet(table_path)
        parts["bad_files"].withColumn("_epoch", F.lit(epoch_id)).write.mode("append").parquet(quarantine_path + "/files")
        parts["rejected_rows"].withColumn("_epoch", F.lit(epoch_id)).write.mode("append").parquet(quarantine_path + "/rows")

    w = read_files(spark, path, max_files_per_trigger).writeStream.foreachBatch(handle).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
                 available_now: bool = True):
    """R2: the fitted chain is a stateless projection, so it runs as-is on a stream."""
    w = scorer(stream).writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def dedup_stream(stream: DataFrame, cols: list[str], event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """With an event-time column, bounded-state dedup inside the watermark;
    without one the default is distinct at read (``ingest.compile_table``)."""
    if event_time is None:
        raise ValueError("streaming dedup without event time keeps unbounded state; use compile_table")
    if stream.schema[event_time].dataType.typeName() == "timestamp_ntz":  # watermarks need a zoned timestamp
        stream = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(cols)
