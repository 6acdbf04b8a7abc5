"""Raw request sources (A1, A2, B1).

* ``read_request_bodies``: a batch of files with one JSON body per line
  (``spark.read.text``), the batch form of the ingestion endpoint.
* ``from_bus_records``: records of a message bus (key, timestamp, value bytes,
  headers) as the message-log shape landing expects. Bytes that are not valid
  UTF-8 become a NULL body, which landing routes to ``invalid_json``.
* ``read_kafka_stream``: the streaming source when the Kafka connector is on
  the classpath (it is optional; the folder source in ``streaming.landing``
  serves tests and file drops).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_request_bodies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def decode_utf8(value) -> F.Column:
    """STRING of a BINARY body, NULL when the bytes are not valid UTF-8."""
    return F.when(F.is_valid_utf8(value.cast("string")), value.cast("string"))


def from_bus_records(records: DataFrame) -> DataFrame:
    """(key, timestamp, value[, headers, topic, partition, offset]) -> (request_id, received_at, value, schema_version).

    A record without a key is named by its place on the bus (topic, partition, offset), so it
    gets the same id whenever it is read again (S4).
    """
    cols = records.columns
    version = (F.try_element_at(F.map_from_entries("headers"), F.lit("schema_version")).cast("string")
               if "headers" in cols else F.lit(None).cast("string"))
    place = [c for c in ("topic", "partition", "offset") if c in cols]
    key = F.col("key").cast("string")
    if {"partition", "offset"} <= set(place):
        key = F.coalesce(key, F.concat_ws("-", *[F.col(c).cast("string") for c in place]))
    return records.select(
        key.alias("request_id"),
        F.col("timestamp").alias("received_at"),
        decode_utf8(F.col("value")).alias("value"),
        version.alias("schema_version"))


def read_kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Streaming records from Kafka (needs the spark-sql-kafka connector)."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("includeHeaders", "true").load())
    return from_bus_records(raw)
