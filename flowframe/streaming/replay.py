"""An extra beside the batch operators: windowed activity of a stream of frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events and mean value by window and type; works on batch and streaming input with the same plan."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("mean_value", 6).alias("mean_value"))
