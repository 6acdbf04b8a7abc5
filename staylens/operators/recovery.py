"""Recovery flows over the dead letters.

Replay re-validates quarantined events under the current contract (e.g. after
an allow list was extended) and re-lands those that now pass, unless an event
with the same dedup key is already in bronze. Each replay counts an attempt; a
dead letter that has used up its attempts is abandoned.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens.operators.landing import (BRONZE_COLUMNS, REASON_BAD_TIMESTAMP, REASON_MISSING, REASON_TOO_LARGE, REASON_VALIDATION,
                                       REASON_VERSION, land)
from staylens.session import work_dir
from staylens.sources import sinks

# FIXED VALUES: replay outcomes.
RELANDED = "relanded"
ALREADY_LANDED = "already_landed"
STILL_FAILING = "still_failing"
ABANDONED = "abandoned"
MAX_ATTEMPTS = 5
# Reasons that a changed contract, limit or version list may lift; text that is no JSON stays what it is.
REPLAYABLE = [REASON_VALIDATION, REASON_MISSING, REASON_BAD_TIMESTAMP, REASON_TOO_LARGE, REASON_VERSION]


def replay(quarantine: DataFrame, bronze: DataFrame, known_countries=None, currencies=None,
           max_bytes: int | None = None) -> DataFrame:
    """Outcome per replayed dead letter (every reason but text that is no JSON), with its bronze record.

    The dedup keys already landed are reduced with a distinct (partial
    aggregation collapses a hot key before the shuffle) and matched with a
    left join, so no key is ever gathered whole into one task.
    """
    retry = (quarantine.filter(F.col("reason").isin(*REPLAYABLE))
             .select(F.col("event_id").alias("request_id"), F.col("ingestion_time").alias("received_at"),
                     F.col("raw").alias("value"), "schema_version", "attempts"))
    relabelled = land(retry, "full", known_countries=known_countries, currencies=currencies, max_bytes=max_bytes)
    attempts = retry.select(F.col("request_id").alias("event_id"), "attempts")
    spent = F.col("attempts") + 1 >= MAX_ATTEMPTS
    landed_keys = bronze.select("dedup_key").distinct().withColumn("_landed", F.lit(True))
    return (relabelled.join(attempts, "event_id")
            .join(landed_keys, "dedup_key", "left")
            .select(*BRONZE_COLUMNS,
                    F.when(F.col("reason").isNotNull(), F.when(spent, ABANDONED).otherwise(STILL_FAILING))
                    .when(F.col("_landed"), ALREADY_LANDED).otherwise(RELANDED).alias("outcome"),
                    (F.col("attempts") + 1).alias("attempts")))


def replay_and_land(spark: SparkSession, quarantine: DataFrame, bronze_path: str, known_countries=None,
                    currencies=None, max_bytes: int | None = None, batch: str | None = None) -> DataFrame:
    """Replay dead letters against a stored bronze table and append the re-landed ones to it.

    The outcomes are written first, so the append and the caller see the same ones;
    the append skips event ids filed by other batches and overwrites its own ``batch``.
    """
    path = work_dir(spark, "replay")
    replay(quarantine, sinks.read_bronze(spark, bronze_path), known_countries, currencies, max_bytes).write.parquet(path)
    outcomes = spark.read.parquet(path)
    sinks.append_bronze_idempotent(spark, outcomes.filter(F.col("outcome") == RELANDED), bronze_path,
                                   batch or f"replay-{uuid.uuid4().hex}")
    return outcomes
