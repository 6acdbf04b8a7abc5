"""Streaming landing: message log -> bronze + quarantine + archive.

The source is a folder of message-log files ``(request_id, received_at, value,
client)`` (the same shape a Kafka source gives as key / timestamp / value);
with a Kafka connector on the classpath the reader is swapped, the rest is the
same. Each micro-batch is labelled once and persisted, then written to three
sinks. Every sink is idempotent per micro-batch: it overwrites the partitions
(or the folder) of its ``batch_id``, so a batch replayed after a failure (the
checkpoint re-runs the last batch) leaves exactly one copy of each event, and
a micro-batch never reads what earlier ones stored.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from staylens.operators.landing import bronze_rows, land, quarantine_rows
from staylens.schemas import RAW_MESSAGE
from staylens.sources import sinks

MESSAGE_SCHEMA = StructType([*RAW_MESSAGE.fields, StructField("client", StringType())])


def read_messages(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source_dir)


def with_source_ids(messages: DataFrame) -> DataFrame:
    """Id and time of messages that carry none, from where they stand in the source.

    The id is a UUID made of the file's name and the row's place in it, the time that of the file,
    so a batch that is read again (or a block that is computed again) gives the same ones.
    """
    h = F.md5(F.concat_ws("#", "_metadata.file_name", F.col("_metadata.row_index").cast("string")))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    return messages.select("*", F.struct(uuid.alias("id"), F.col("_metadata.file_modification_time").alias("at")).alias("_source")) \
        .withColumn("request_id", F.coalesce("request_id", "_source.id")) \
        .withColumn("received_at", F.coalesce("received_at", "_source.at")).drop("_source")


def landing_batch(gate: str, bronze_path: str, quarantine_path: str, archive_path: str | None, times: int = 1):
    """What a micro-batch writes: its own partitions of each table, overwritten when it is run again.

    No stored row is read for that, however much was landed before.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        for _ in range(times):
            once(batch, batch_id)

    def once(batch: DataFrame, batch_id: int) -> None:
        labelled = land(batch, gate).dropDuplicates(["event_id"]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sinks.write_bronze(bronze_rows(labelled), bronze_path, str(batch_id), cluster=False)
            sinks.write_quarantine(quarantine_rows(labelled), quarantine_path, str(batch_id))
            if archive_path:
                (sinks.archive_lines(bronze_rows(labelled)).write.mode("overwrite")
                 .text(f"{archive_path.rstrip('/')}/batch_id={batch_id}"))
        finally:
            labelled.unpersist()
    return run


def start_landing(spark: SparkSession, source_dir: str, bronze_path: str, quarantine_path: str,
                  checkpoint: str, archive_path: str | None = None, gate: str = "light",
                  available_now: bool = False, processing_time: str = "30 seconds",
                  max_files_per_trigger: int | None = None, times: int = 1):
    """Start the landing stream; ``available_now`` drains what is there and stops.

    ``times`` above 1 writes every micro-batch so often, as retries after a failure do.

    A6: the bronze table must exist (``sinks.create_bronze``); it is not made by the way.
    """
    if not sinks.folder_exists(spark, bronze_path):
        raise FileNotFoundError(f"no bronze table at {bronze_path}")
    w = (with_source_ids(read_messages(spark, source_dir, max_files_per_trigger)).writeStream
         .foreachBatch(landing_batch(gate, bronze_path, quarantine_path, archive_path, times))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
