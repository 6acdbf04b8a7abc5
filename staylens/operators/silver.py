"""Silver: typed, enriched, deduplicated searches.

Plan shape: bronze scan -> one VARIANT parse per row -> broadcast joins with
the two tiny dimensions (fixed-size seed data) -> filters -> latest row per
``dedup_key``. The ``row_number() = 1`` filter lets Spark insert a partial
WindowGroupLimit before the shuffle, so a key re-sent many times (a retry
storm holding a large share of rows) is reduced to one row per map task
before it is exchanged; the shuffle is on a sha256 hash, hence uniform.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from staylens import reference_data as Ref
from staylens.functions import json as J
from staylens.functions.buckets import los_bucket
from staylens.functions.dates import strict_date
from staylens.functions.joins import broadcast_if_small
from staylens.schemas import SILVER_COLUMNS


def stage(bronze: DataFrame) -> DataFrame:
    """T1/T2/A15 staging: payload fields extracted once (typed, never aborting).

    The payload is parsed once, and the typed fields come out of a one-row
    ``inline``: later filters on them (T10/T11) then read plain columns instead
    of having the JSON extraction substituted into every predicate branch.
    """
    v = F.col("_v")
    fields = {
        "arrival_date": J.text(v, "arrival_date"),
        "departure_date": J.text(v, "departure_date"),
        "length_of_stay": J.integer(v, "length_of_stay"),
        "user_country": J.text(v, "user_country"),
        "hotel_name": J.text(v, "hotel_name"),
        "hotel_latitude": J.number(v, "hotel_latitude"),
        "hotel_longitude": J.number(v, "hotel_longitude")}
    return J.evaluated(J.with_parsed(bronze, "payload"), fields) \
        .select(*[c for c in bronze.columns if c != "ingest_date"], *fields)


# FIXED VALUES: payload fields that a contract version adds, with their types (FIXTURES.md 6).
VERSION_FIELDS = {"v1": {}, "v2": {"guests": J.integer, "trip_purpose": J.text}}


def stage_versions(bronze: DataFrame) -> DataFrame:
    """Staging by contract version, each version's own fields beside the common ones (NULL where a version lacks them)."""
    out = None
    for version, fields in VERSION_FIELDS.items():
        rows = stage(bronze.where(F.col("schema_version") == version))
        if fields:
            own = F.struct(*[read(F.col("_v"), f).alias(f) for f, read in fields.items()])
            rows = J.with_parsed(rows, "payload").select(*rows.columns, F.inline(F.array(own)))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def enrich(staged: DataFrame, dim_hotels: DataFrame, country_map: DataFrame) -> DataFrame:
    """Hotel city (left join), user country ISO (left join on trimmed lower name),
    search_date, LOS bucket and the stay computed from the dates.

    The dimensions are broadcast only when their estimated size is small (the
    seed data is a few rows); a large hotel dimension is joined by shuffle.
    """
    hotels = broadcast_if_small(dim_hotels.select("hotel_id", "city",
                                                  F.col("country_iso").alias("hotel_country_iso")))
    countries = broadcast_if_small(country_map.select(F.lower("name").alias("_country_key"),
                                                      F.col("iso").alias("_iso")))
    return (staged.join(hotels, "hotel_id", "left")
            .join(countries, F.lower(F.trim("user_country")) == F.col("_country_key"), "left")
            .withColumn("user_country_iso", F.coalesce("_iso", F.upper(F.left("user_country", F.lit(2)))))
            .withColumn("search_date", F.to_date("search_timestamp"))
            .withColumn("los_bucket", los_bucket(F.col("length_of_stay")))
            .withColumn("computed_los", F.datediff(strict_date(F.col("departure_date")),
                                                   strict_date(F.col("arrival_date"))))
            .drop("_country_key", "_iso"))


def keep_consistent(enriched: DataFrame) -> DataFrame:
    """Complete, date-consistent stays of at most 14 nights."""
    return enriched.filter(
        F.col("arrival_date").isNotNull() & F.col("departure_date").isNotNull()
        & F.col("length_of_stay").isNotNull()
        & (F.col("computed_los") == F.col("length_of_stay"))
        & (F.col("los_bucket") != Ref.LOS_OTHER))


def latest_per_key(df: DataFrame, key: str = "dedup_key") -> DataFrame:
    """The most recently ingested row per key (event_id breaks ties)."""
    w = Window.partitionBy(key).orderBy(F.col("ingestion_time").desc(), F.col("event_id").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def silver(bronze: DataFrame, dim_hotels: DataFrame | None = None,
           country_map: DataFrame | None = None) -> DataFrame:
    """Full silver build from bronze (T1-T13): filter first, then latest wins."""
    spark = bronze.sparkSession
    dim_hotels = dim_hotels if dim_hotels is not None else Ref.dim_hotels(spark)
    country_map = country_map if country_map is not None else Ref.country_map(spark)
    enriched = enrich(stage(bronze), dim_hotels, country_map)
    return latest_per_key(keep_consistent(enriched)).select(*SILVER_COLUMNS)


# FIXED VALUES: silver reject reasons (T14), checked in this order.
REJECT_NULL_FIELD = "null_field"
REJECT_LOS_MISMATCH = "los_mismatch"
REJECT_LOS_RANGE = "los_out_of_range"
REJECT_DUPLICATE = "duplicate"


# Parts that the copies of one key are ranked in first.
KEY_PARTS = 16


def silver_rejects(bronze: DataFrame, dim_hotels: DataFrame | None = None,
                   country_map: DataFrame | None = None) -> DataFrame:
    """Bronze rows that did not become silver rows, with the reason.

    One pass: a row's own reason is a column, and the loser of a key is marked by a window over
    the consistent rows of the key. The others stand in windows of their own (by event id).
    Copies of a key are ranked in ``KEY_PARTS`` parts and then the parts' winners, so a key that
    holds a large share of the rows is not sorted by one task. Nothing is joined back.
    """
    spark = bronze.sparkSession
    dim_hotels = dim_hotels if dim_hotels is not None else Ref.dim_hotels(spark)
    country_map = country_map if country_map is not None else Ref.country_map(spark)
    e = enrich(stage(bronze), dim_hotels, country_map)
    complete = (F.col("arrival_date").isNotNull() & F.col("departure_date").isNotNull()
                & F.col("length_of_stay").isNotNull())
    own = (F.when(~complete, REJECT_NULL_FIELD)
           .when(F.coalesce(F.col("computed_los") != F.col("length_of_stay"), F.lit(True)), REJECT_LOS_MISMATCH)
           .when(F.col("los_bucket") == Ref.LOS_OTHER, REJECT_LOS_RANGE))
    rows = e.select("event_id", "dedup_key", "ingestion_time", "hotel_id", "search_date", own.alias("reason"))
    newest = [F.col("ingestion_time").desc(), F.col("event_id").desc()]

    def beaten(df: DataFrame, *parts) -> DataFrame:
        alone = F.when(F.col("reason").isNull(), F.col("dedup_key")).otherwise(F.col("event_id"))
        w = Window.partitionBy(F.col("reason").isNull(), alone, *parts).orderBy(*newest)
        lost = F.col("reason").isNull() & (F.row_number().over(w) > 1)
        return df.withColumn("reason", F.when(lost, REJECT_DUPLICATE).otherwise(F.col("reason")))

    part = F.pmod(F.xxhash64("event_id"), F.lit(KEY_PARTS))
    return beaten(beaten(rows, part)).filter(F.col("reason").isNotNull())


def read_dim_hotels(spark: SparkSession, path: str) -> DataFrame:
    """A4: the hotel dimension from a CSV with a header (explicit schema, no inference).

    T4: a hotel listed twice would double its searches in the join, so it ends the job.
    """
    from staylens.schemas import DIM_HOTELS
    rows = spark.read.schema(DIM_HOTELS).option("header", True).csv(path)
    one = rows.groupBy("hotel_id").agg(F.count(F.lit(1)).alias("n"), F.max("city").alias("city"),
                                       F.max("country_iso").alias("country_iso"))
    twice = F.raise_error(F.concat(F.lit("hotel listed twice: "), F.col("hotel_id").cast("string"))).cast("int")
    return one.select(F.when(F.col("n") == 1, F.col("hotel_id")).otherwise(twice).alias("hotel_id"), "city", "country_iso")
