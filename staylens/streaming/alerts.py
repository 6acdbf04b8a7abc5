"""Dead-letter alerts over the landing stream.

Event-time windows on ``ingestion_time`` that end every 5 minutes and look back 10, with a
watermark: one stateful aggregation counts the 5 minutes and the 10, so every window that
the stream writes carries both alerts: more than 100 dead letters in the 5 minutes, an error rate
above 1 % in the 10. The watermark bounds the state. What arrives behind it is not in those
counts; a second output counts every row by window and micro-batch, without state,
and ``latest_windows`` reports the difference as late rows, so nothing goes uncounted.

Both outputs are written into ``batch_id`` folders that a repeated micro-batch overwrites.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from staylens import reference_data as R
from staylens.operators.landing import land

RATE_WINDOW = "10 minutes"


@dataclass(frozen=True)
class Thresholds:
    error_rate: float = R.ALERT_ERROR_RATE
    dead_letters: int = R.ALERT_DEAD_LETTERS


def window_counts(labelled: DataFrame, window: str = R.ALERT_WINDOW, watermark: str = "10 minutes") -> DataFrame:
    """Per window end: requests and dead letters of the last ``window`` and of the last ``RATE_WINDOW``."""
    w = F.window("ingestion_time", RATE_WINDOW, window)
    own, dead = F.col("_end") == F.col("w.end"), F.col("reason").isNotNull()
    return (labelled.withWatermark("ingestion_time", watermark)
            .select("ingestion_time", "reason", w.alias("w")).select("*", _end(window).alias("_end"))
            .groupBy("w")
            .agg(F.count_if(own).alias("requests"), F.count_if(own & dead).alias("dead_letters"),
                 F.count(F.lit(1)).alias("rate_requests"), F.count_if(dead).alias("rate_dead")))


def _seconds(window: str) -> int:
    n, unit = window.split()
    return int(n) * {"s": 1, "m": 60, "h": 3600}[unit[0]]


def _end(window: str) -> Column:
    """End of the tumbling window that a row falls in."""
    s = _seconds(window)
    return F.timestamp_seconds((F.floor(F.unix_seconds("ingestion_time") / s) + 1) * s)


def with_flags(counts: DataFrame, limits: Thresholds = Thresholds(), window: str = R.ALERT_WINDOW) -> DataFrame:
    """The windows that hold a request, with both alerts."""
    rate = F.col("rate_dead").cast("double") / F.col("rate_requests").cast("double")
    return counts.where("requests > 0").select(
        (F.col("w.end") - F.expr(f"INTERVAL {window}")).alias("window_start"), F.col("w.end").alias("window_end"),
        "requests", "dead_letters", F.round(rate * 100.0, 2).alias("error_pct"),
        (rate > limits.error_rate).alias("error_rate_alert"),
        (F.col("dead_letters") > limits.dead_letters).alias("dead_letter_alert"))


def start_alerts(spark: SparkSession, messages: DataFrame, out_path: str, checkpoint: str,
                 gate: str = "light", available_now: bool = False, processing_time: str = "1 minute",
                 limits: Thresholds = Thresholds()):
    """Both outputs as streams over ``messages``; returns the two queries (windows, all rows)."""
    labelled = land(messages, gate).select("ingestion_time", "reason")
    # landing keeps every message, with its time as it came: counting them needs no body to be read
    came = messages.select(F.col("received_at").cast("timestamp").alias("ingestion_time")) if "received_at" in messages.columns else labelled

    def flagged(batch: DataFrame, batch_id: int) -> None:
        with_flags(batch, limits).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/windows/batch_id={batch_id}")

    def every(batch: DataFrame, batch_id: int) -> None:
        rows = batch.groupBy(_end(R.ALERT_WINDOW).alias("window_end")).agg(F.count(F.lit(1)).alias("arrived"))
        rows.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/arrivals/batch_id={batch_id}")

    out = []
    for frame, mode, sink, name in ((window_counts(labelled), "update", flagged, "windows"),
                                    (came, "append", every, "arrivals")):
        w = (frame.writeStream.outputMode(mode).foreachBatch(sink)
             .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}"))
        out.append((w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start())
    return out


def latest_windows(spark: SparkSession, out_path: str) -> DataFrame:
    """Final value of every window (its version from the latest micro-batch), its alerts, and the late rows of its 5 minutes."""
    root = out_path.rstrip("/")
    w = Window.partitionBy("window_end").orderBy(F.col("batch_id").desc())
    windows = (spark.read.parquet(f"{root}/windows").withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
               .drop("_rn", "batch_id"))
    arrived = spark.read.parquet(f"{root}/arrivals").groupBy("window_end").agg(F.sum("arrived").alias("arrived"))
    start = F.col("window_end") - F.expr(f"INTERVAL {R.ALERT_WINDOW}")
    return (arrived.join(windows, "window_end", "left")
            .select(start.alias("window_start"), "window_end", F.coalesce("requests", F.lit(0)).alias("requests"),
                    F.coalesce("dead_letters", F.lit(0)).alias("dead_letters"), "error_pct", "error_rate_alert", "dead_letter_alert",
                    (F.col("arrived") - F.coalesce("requests", F.lit(0))).alias("late_requests")))
