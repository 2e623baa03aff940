"""Captured pages as a stream: deduplicated captures, and windowed fetch counters for late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfspark.schema import PAGE_CAPTURES


def read_captures(spark: SparkSession, path: str, files_a_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(PAGE_CAPTURES).option("maxFilesPerTrigger", files_a_trigger).parquet(path)


def once_per_url(captures: DataFrame, late: str = "2 days") -> DataFrame:
    """The first capture of each URL; the state of a URL is dropped after the watermark."""
    return captures.withWatermark("fetched_at", late).dropDuplicatesWithinWatermark(["url"])


def fetch_counters(captures: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Captures, blocks and mean seconds for each window of capture times."""
    return captures.withWatermark("fetched_at", late).groupBy(F.window("fetched_at", window)).agg(
        F.count("*").alias("fetches"), F.count(F.when(F.col("block"), 1)).alias("blocked"), (F.avg("timing_ms") / 1000).alias("mean_seconds")
    ).select(F.col("window.start").alias("window_start"), "fetches", "blocked", "mean_seconds")


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that is there and stop; a restart goes on where the last one ended."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
