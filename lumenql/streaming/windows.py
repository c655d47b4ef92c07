"""Structured Streaming over event tables: windows with late data, sessions, and change of state.

Each function takes a streaming or a static DataFrame, so a batch twin checks a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_of(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    """A stream of the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def marked(events: DataFrame, late: str) -> DataFrame:
    """Event times as instants, with a watermark where the events are a stream."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", late) if timed.isStreaming else timed


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by event type and window; money as decimals, so that sums do not depend on order."""
    out = marked(events, late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "1 hour", slide: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    out = marked(events, late).groupBy(F.window("ts", width, slide), "event_type").agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a user: events that follow each other within the gap."""
    out = marked(events, late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def run_once(frame: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Drain a stream into a memory table and return it; for tests and small results."""
    query = frame.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return frame.sparkSession.table(name)
