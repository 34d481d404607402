"""Running metrics of a prediction log."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelwise.operators.skew import col


def _metrics(latency: str) -> list[Column]:
    timed = F.when(col(latency) != 0, col(latency))
    return [
        F.count(F.lit(1)).alias("predictions"),
        F.round(F.coalesce(F.avg(timed), F.lit(0.0)), 2).alias("average_processing_time_ms"),
    ]


def level_metrics(log: DataFrame, ts: str, level: str, latency: str, window: str) -> DataFrame:
    """Count and mean latency per tumbling window and risk level, of a batch or of a stream with a watermark."""
    grouped = log.groupBy(F.window(col(ts), window).alias("w"), col(level)).agg(*_metrics(latency))
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), col(level), "predictions", "average_processing_time_ms")


def monitor_stream(
    log: DataFrame, ts: str, level: str, latency: str, out: str, checkpoint: str, window: str = "1 day", late: str = "1 hour"
) -> StreamingQuery:
    """Append each window once the watermark has passed its end; later rows are dropped.

    State is one row per open (window, level).
    """
    timed = log.withColumn(ts, col(ts).cast("timestamp")).withWatermark(ts, late)
    metrics = level_metrics(timed, ts, level, latency, window)
    writer = metrics.writeStream.outputMode("append").format("parquet").option("path", out)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
