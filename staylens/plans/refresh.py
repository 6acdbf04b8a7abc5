"""Refresh plans over stored tables: full rebuild, incremental merge, stream of bronze files, backfill.

Silver and the marts are partitioned by ``search_date`` and published together
(``sources.versions.Tables``). All copies of a ``dedup_key`` share one
search_date (the key hashes the timestamp text), and every mart share is
computed within (city, search_date), so a refresh is exact per day: the
touched days are rebuilt from the union of stored and new rows, written once,
and one version switch shows them in silver and all marts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens import reference_data as Ref
from staylens.operators import gold, quality
from staylens.operators.silver import enrich, keep_consistent, latest_per_key, stage
from staylens.schemas import BRONZE, SILVER_COLUMNS
from staylens.sources.versions import Tables, Written

SILVER = "silver"
MARTS = {
    "gold_arrival_date_popularity": gold.arrival_popularity,
    "gold_country_trends": gold.country_trends,
    "gold_los_distribution": gold.los_distribution,
}


def silver_candidates(bronze: DataFrame, dim_hotels: DataFrame | None = None) -> DataFrame:
    """Consistent, enriched rows of a bronze slice (before the latest-wins step).

    ``dim_hotels`` is the hotel dimension to use (``silver.read_dim_hotels``), the seed rows by default.
    """
    spark = bronze.sparkSession
    hotels = Ref.dim_hotels(spark) if dim_hotels is None else dim_hotels
    return keep_consistent(enrich(stage(bronze), hotels, Ref.country_map(spark))) \
        .select(*SILVER_COLUMNS)


def _write_marts(tables: Tables, run: str, silver: DataFrame) -> dict[str, Written]:
    return {name: tables.write(name, run, build(silver)) for name, build in MARTS.items()}


def merge(spark: SparkSession, new_bronze: DataFrame, root: str, dim_hotels: DataFrame | None = None,
          at: dt.datetime | None = None) -> list[dt.date]:
    """Merge a bronze batch into silver and refresh the marts of its days; returns those days.

    Stored rows of the touched days are re-ranked together with the batch
    (latest ingestion wins), so the result equals a full rebuild whatever the
    order in which batches arrive, and a batch that is merged again changes
    nothing. The days are read off the timestamp column, before any parsing.
    """
    tables = Tables(spark, root)
    day = F.to_date("search_timestamp")
    touched = [r.d for r in new_bronze.select(day.alias("d")).where("d is not null").distinct().collect()]
    union = silver_candidates(new_bronze, dim_hotels)
    stored = tables.read(SILVER)
    if stored is not None:
        union = union.unionByName(stored.where(F.col("search_date").isin(touched)).select(*SILVER_COLUMNS))
    run = tables.new_run()
    silver = tables.write(SILVER, run, latest_per_key(union), tiebreak="dedup_key")
    marts = _write_marts(tables, run, tables.written(SILVER, run, silver.schema))
    tables.publish(run, {SILVER: silver, **marts}, touched, at)
    return touched


def follow_bronze(spark: SparkSession, bronze_path: str, root: str, checkpoint: str, available_now: bool = True,
                  max_files_per_trigger: int | None = None, processing_time: str = "15 minutes",
                  dim_hotels: DataFrame | None = None):
    """Silver and marts follow bronze file by file, without a time mark.

    The file source's checkpoint remembers which bronze files were merged, so a
    row is merged whenever its file appears, however late its times are. A
    micro-batch that is run again after a failure merges to the same rows.
    """
    source = spark.readStream.schema(BRONZE)
    if max_files_per_trigger:
        source = source.option("maxFilesPerTrigger", max_files_per_trigger)

    def run(batch: DataFrame, _batch_id: int) -> None:
        merge(batch.sparkSession, batch.select(*BRONZE.names), root, dim_hotels)

    w = source.parquet(bronze_path).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def publish_marts(spark: SparkSession, silver: DataFrame, root: str, names=None, at: dt.datetime | None = None) -> Tables:
    """The named marts (default: all) of a silver frame, published."""
    tables = Tables(spark, root)
    run = tables.new_run()
    tables.publish(run, {name: tables.write(name, run, MARTS[name](silver)) for name in names or MARTS}, at=at)
    return tables


def full_refresh(spark: SparkSession, bronze: DataFrame, root: str, enforce_gate: bool = True,
                 dim_hotels: DataFrame | None = None, at: dt.datetime | None = None) -> dict[str, int]:
    """Rebuild silver and the marts, check them, then publish them by one switch.

    The quality gate runs on what was written and before it is published: an
    error-severity failure, or a crash at any point, leaves the tables as they
    were. Whole tables are replaced, so days that bronze no longer holds go.
    """
    tables = Tables(spark, root)
    run = tables.new_run()
    new = {SILVER: tables.write(SILVER, run, latest_per_key(silver_candidates(bronze, dim_hotels)), tiebreak="dedup_key")}
    new.update(_write_marts(tables, run, tables.written(SILVER, run, new[SILVER].schema)))
    now = {name: tables.written(name, run, w.schema) for name, w in new.items()}
    if enforce_gate:
        quality.enforce(quality.scan(now[SILVER], now["gold_country_trends"], now["gold_los_distribution"]))
    tables.publish(run, new, at=at)
    return {"silver_rows" if name == SILVER else name: df.count() for name, df in now.items()}


def backfill(spark: SparkSession, bronze: DataFrame, from_date: str, to_date: str,
             dim_hotels: DataFrame | None = None) -> dict[str, DataFrame]:
    """Silver and marts rebuilt from bronze for search dates in [from, to].

    The search-date range is pushed to Parquet as a timestamp range, before
    the dedup shuffle. The ingest day says nothing about it: the search date
    comes from the payload, whose clock or offset may run ahead of ours.
    """
    lo = F.lit(from_date).cast("date")
    ts_lo = lo.cast("timestamp")
    ts_hi = F.date_add(F.lit(to_date).cast("date"), 1).cast("timestamp")
    # A range on the raw timestamp column (not on to_date of it) reaches the Parquet reader.
    sliced = bronze.filter((F.col("search_timestamp") >= ts_lo) & (F.col("search_timestamp") < ts_hi))
    silver = latest_per_key(silver_candidates(sliced, dim_hotels))
    return {"silver": silver, **{name: build(silver) for name, build in MARTS.items()}}
