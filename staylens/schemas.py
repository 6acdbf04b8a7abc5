"""Explicit schemas of every stored table (no inference on read)."""

from pyspark.sql import types as T

# Raw message log: one inbound request body per row. ``request_id`` and
# ``received_at`` are what a message bus / request log carries with each body;
# when absent, landing assigns uuid() and current_timestamp().
RAW_MESSAGE = T.StructType([
    T.StructField("request_id", T.StringType(), True),
    T.StructField("received_at", T.TimestampType(), True),
    T.StructField("value", T.StringType(), True),
])

BRONZE = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("dedup_key", T.StringType(), False),
    T.StructField("ingestion_time", T.TimestampType(), False),
    T.StructField("partner_id", T.StringType(), False),
    T.StructField("schema_version", T.StringType(), False),
    T.StructField("payload", T.StringType(), False),
    T.StructField("hotel_id", T.IntegerType(), True),
    T.StructField("search_timestamp", T.TimestampType(), True),
    T.StructField("ingest_date", T.DateType(), True),
])

QUARANTINE = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("ingestion_time", T.TimestampType(), False),
    T.StructField("schema_version", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
    T.StructField("errors", T.ArrayType(T.StructType([
        T.StructField("path", T.StringType()), T.StructField("code", T.StringType()), T.StructField("message", T.StringType())])), True),
    T.StructField("raw", T.StringType(), True),
    T.StructField("attempts", T.IntegerType(), False),
    T.StructField("ingest_date", T.DateType(), True),
])

DIM_HOTELS = T.StructType([
    T.StructField("hotel_id", T.IntegerType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("country_iso", T.StringType(), True),
])

SILVER_COLUMNS = [
    "event_id", "dedup_key", "ingestion_time", "partner_id", "schema_version", "payload",
    "hotel_id", "search_timestamp", "arrival_date", "departure_date", "length_of_stay",
    "user_country", "hotel_name", "city", "hotel_latitude", "hotel_longitude",
    "hotel_country_iso", "user_country_iso", "search_date", "los_bucket",
]
