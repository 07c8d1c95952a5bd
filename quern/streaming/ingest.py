"""Structured Streaming: incremental ingest that is safe to repeat, and windowed counts of events.

A build fetches again and again; what it already has is skipped. Here new files are taken once each, by the checkpoint
of the stream, and rows that arrive again are dropped by key within a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quern.functions import text as T


def read_new_files(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int = 1_000) -> DataFrame:
    """A stream of the Parquet files of a folder, each once."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def ingest(rows: DataFrame, time: str, keys: list[str], late: str = "7 days") -> DataFrame:
    """Rows with normalised text; of those that arrive again within `late` only the first is kept."""
    stamped = rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return stamped.dropDuplicatesWithinWatermark(keys).withColumn("text", T.normalize_text(F.col("text")))


def append_available(stream: DataFrame, path: str, checkpoint: str, partition: str | None = None) -> StreamingQuery:
    """Writes all that is there now and stops; the next call goes on from the checkpoint, so nothing is written twice."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(partition) if partition else writer).start()


def windowed_counts(events: DataFrame, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events and their summed value by window and type, in append mode once a window is closed."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    grouped = stamped.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("value"))
    return grouped.select(F.col("w.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user: start, end and number of events."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    grouped = stamped.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return grouped.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
