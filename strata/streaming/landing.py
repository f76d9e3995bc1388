"""Incremental bronze landing with Structured Streaming.

The batch landing re-reads a whole folder each run. As a stream, each CSV file
that appears in the folder is landed exactly once: the file source remembers
the files it has read and the Parquet sink commits each micro-batch atomically,
both through the checkpoint folder (which must be on shared storage).
``availableNow`` lands everything present now, in bounded batches, then stops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.sinks.files import DEFAULT_CODEC
from strata.sources.files import read_csv_strings, string_schema

# Files per micro-batch: bounds the size of one batch when a backlog is landed.
MAX_FILES_PER_TRIGGER = 1000


def start_landing(
    spark: SparkSession,
    source_dir: str,
    bronze_path: str,
    checkpoint: str,
    columns: Sequence[str] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start landing ``source_dir``'s CSV files (header, all strings) as Parquet.

    The columns are those of the files' header, extra ones included; ``columns`` names the least that
    must be there. A file whose header differs stops the stream with an error, as its columns would
    be taken by position.
    """
    found = read_csv_strings(spark, source_dir).columns
    missing = [c for c in columns or () if c not in found]
    if missing:
        raise ValueError(f"columns missing from {source_dir}: {missing}")
    stream = (
        spark.readStream.schema(string_schema(found))
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
        .csv(source_dir)
    )
    writer = (
        stream.writeStream.format("parquet")
        .option("path", bronze_path)
        .option("checkpointLocation", checkpoint)
        .option("compression", DEFAULT_CODEC)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def land_available(
    spark: SparkSession, source_dir: str, bronze_path: str, checkpoint: str, columns: Sequence[str] | None = None
) -> str:
    """Land every file present now and return ``bronze_path`` (blocks until done)."""
    query = start_landing(spark, source_dir, bronze_path, checkpoint, columns, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"landing stream failed: {query.exception()}")
    return bronze_path
