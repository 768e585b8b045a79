"""The stateless operators over streams of reads, and counts of arrivals by event time.

Barcode calls, gates and motif extraction work on one read at a time, so they run
unchanged on a stream; counts by plate and window close with the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import demux


def read_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 10) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def demultiplexed_stream(reads: DataFrame, plates: list[tuple[str, str]], settings: demux.CallSettings, gates: demux.Gates) -> DataFrame:
    """Reads (sequence, quality and what else) with their plate calls."""
    return demux.demultiplex(reads, plates, None, settings, settings, gates)


def arrivals(calls: DataFrame, time: str = "ts", lateness: str = "10 minutes", window: str = "5 minutes", key: str = "event_type") -> DataFrame:
    """Arrivals of each key in tumbling windows of event time; late ones beyond the watermark are left out."""
    told = calls.withWatermark(time, lateness).groupBy(F.window(time, window).alias("w"), F.col(key))
    return told.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n", "total")
