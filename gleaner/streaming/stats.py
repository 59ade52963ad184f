"""Running capture statistics per event-time window.

The capture log (``events``) is read as a stream; per 1-hour window:
captures, failures (event_type 'error') and successes.  State is one row per
window, kept for good (24 rows a day), so an event counts however late it
arrives; in update mode each micro-batch's updated windows are appended with
their batch id through ``foreachBatch``, and readers take the
latest version of each window (an upsert without a table format).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import scratch_path
from gleaner.sources.tables import stream_table

WINDOW = "1 hour"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_table(spark, sf_dir, "events")


def utc_instant(ntz: Column) -> Column:
    """The instant whose UTC wall clock is the given TIMESTAMP_NTZ value,
    independent of the session time zone (windows are taken on it)."""
    text = F.concat(F.date_format(ntz, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX")


def window_counts(events: DataFrame) -> DataFrame:
    """Per-window counters (works on a batch or a streaming DataFrame).

    Windows are taken on the UTC instant of the capture time, so they align
    with the wall-clock hours of the log whatever the session time zone; the
    reported window start is that hour as TIMESTAMP_NTZ (one per window).
    """
    e = events.select(utc_instant(F.col("ts")).alias("event_time"),
                      # the hour of the wall clock, kept TIMESTAMP_NTZ (date_trunc
                      # would go through the session zone)
                      F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:00:00")).alias("window_start"),
                      "event_type")
    err = F.col("event_type") == "error"
    return (e.groupBy(F.window("event_time", WINDOW).alias("w"), "window_start")
            .agg(F.count(F.lit(1)).alias("captures"), F.count_if(err).alias("failures"),
                 F.count_if(~err).alias("successes"))
            .select("window_start", (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
                    "captures", "failures", "successes"))


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run T2 (availableNow) and return the latest counters of every window."""
    out, ckpt = scratch_path(spark, "t2-out"), scratch_path(spark, "t2-ckpt")

    def append(batch: DataFrame, batch_id: int) -> None:
        # A retried batch appends the same rows again with the same id;
        # readers keep one version per window, so the result is unchanged.
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    q = (window_counts(event_stream(spark, sf_dir)).writeStream.outputMode("update")
         .foreachBatch(append).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    versions = spark.read.parquet(out)
    latest = versions.groupBy("window_start", "window_end").agg(
        F.max_by(F.struct("captures", "failures", "successes"), "batch_id").alias("v"))
    return latest.select("window_start", "window_end", "v.captures", "v.failures", "v.successes")
