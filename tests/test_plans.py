"""Physical-plan properties the scale design relies on."""

import pytest

import __spark_entry__ as E
from staylens.operators import gold, serving
from staylens.operators.silver import silver
from staylens.plans.derived import Flow
from staylens.session import work_dir
from staylens.sources import sinks

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    """The text of ``df.explain("formatted")``."""
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def test_latest_wins_is_limited_before_the_shuffle(spark):
    path = work_dir(spark, "p-bronze")
    sinks.write_bronze(Flow(spark, SF).bronze, path)
    text = silver(sinks.read_bronze(spark, path))._jdf.queryExecution().sparkPlan().toString()
    # Partial runs map-side, before the exchange on dedup_key; Final after it.
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text, text


def test_served_read_prunes_partitions_and_pushes_city(spark):
    f = Flow(spark, SF)
    path = work_dir(spark, "p-los")
    sinks.write_partitions(gold.los_distribution(f.silver), path)
    q = serving.los_trends(spark.read.parquet(path), "Paris", "2024-01-08", "2024-01-14")
    text = q._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(search_date" in text
    assert "EqualTo(city,Paris)" in text


def test_landing_has_no_shuffle(spark):
    from staylens.operators.landing import land
    from staylens.sources.tables import table
    raw = table(spark, SF, "events", "event_id", "ts", "user_id", "value")
    from staylens.sources.search_feed import search_feed
    text = land(search_feed(raw), "full")._jdf.queryExecution().sparkPlan().toString()
    assert "Exchange" not in text


@pytest.mark.parametrize("name", ["silver_enriched", "gold_country_trends", "silver_rejects", "rate_limit_audit",
                                  "nearest_city_fallback", "quarantine_replay", "dq_freshness", "bronze_dedup_key"])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    text = plan_of(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dimension_broadcast_is_size_checked(spark):
    from staylens.functions.joins import broadcast_if_small, estimated_bytes
    from staylens import reference_data as R
    small = R.dim_hotels(spark)
    assert estimated_bytes(small) < 1024
    assert "broadcast" in broadcast_if_small(small)._jdf.queryExecution().analyzed().toString().lower()
    big = spark.range(10_000_000).selectExpr("id as k", "cast(id as string) as v")
    assert "ResolvedHint (strategy=broadcast)" not in broadcast_if_small(big, limit=1024)._jdf.queryExecution() \
        .analyzed().toString()


def test_backfill_pushes_timestamp_filters_only(spark):
    from staylens.plans.refresh import backfill
    path = work_dir(spark, "p-bf")
    sinks.write_bronze(Flow(spark, SF).bronze, path)
    text = formatted(backfill(spark, sinks.read_bronze(spark, path), "2024-01-08", "2024-01-14")["silver"])
    assert "PartitionFilters: [isnotnull(ingest_date" not in text  # searches may be dated after their ingest day
    assert "GreaterThanOrEqual(search_timestamp" in text and "LessThan(search_timestamp" in text


def test_landing_runs_in_compiled_code(spark):
    # Generated methods over 8000 bytes are never compiled by the JVM: no stage of such a size may run whole.
    from staylens.session import prepare
    assert int(prepare(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_spread_follows_the_input_size(spark, monkeypatch):
    from staylens.sources import tables
    df = spark.range(1000, numPartitions=1)
    monkeypatch.setattr(tables, "SPREAD_BYTES", 400)  # 8000 bytes by estimate
    assert tables.spread(df, "id").rdd.getNumPartitions() == 20
    monkeypatch.setattr(tables, "SPREAD_BYTES", 1 << 30)
    assert tables.spread(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_incremental_queries_land_once(spark, monkeypatch):
    # Every batch used to derive and land the whole log again.
    from staylens import queries
    calls = []
    monkeypatch.setattr(queries.Flow, "_store", lambda self, df, name, col, real=queries.Flow._store: (
        calls.append(name) if name in self.stored else None, real(self, df, name, col))[1])
    bronze = queries._bronze_batches(queries.Flow(spark, SF, stored=("landed",)), 0, 1, 2)
    assert calls == ["landed"] and len(bronze) == 3
    assert sum(b.count() for b in bronze) == E.queries()["bronze_count"](spark, SF).first()[0]


def test_spread_bounds_the_rows_of_a_task(spark, monkeypatch, tmp_path):
    from staylens.sources import tables
    monkeypatch.setattr(tables, "SPREAD_ROWS", 50)
    assert tables.spread(spark.range(1000, numPartitions=1), "id").rdd.getNumPartitions() == 20
    # Splits enough, but the file is one row group: all rows would go to one of them.
    spark.range(1000).selectExpr("id", "sha2(cast(id as string), 256) as text").coalesce(1).write.parquet(str(tmp_path / "one"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        df = spark.read.parquet(str(tmp_path / "one"))
        assert df.rdd.getNumPartitions() >= 20
        out = tables.spread(df, "id")
        rows = [n for n in out.rdd.glom().map(len).collect()]
        assert sum(rows) == 1000 and max(rows) <= 100
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quarantine_folders_hold_few_files(spark, tmp_path):
    # Every task used to add a file to every folder.
    from staylens.schemas import QUARANTINE
    rows = (spark.range(400, numPartitions=40).selectExpr(
        "cast(id as string) event_id", "timestamp'2024-01-01' ingestion_time", "'v1' schema_version", "concat('r', id % 2) reason",
        "cast(array() as array<struct<path:string,code:string,message:string>>) errors", "'x' raw", "1 attempts",
        "date_add(date'2024-01-01', cast(id div 2 % 2 as int)) ingest_date").select(*QUARANTINE.names))
    path = str(tmp_path / "q")
    sinks.write_quarantine(rows, path, "b")
    stored = spark.read.parquet(path)
    assert stored.count() == 400
    assert len(stored.inputFiles()) == 4


def test_streamed_bronze_days_hold_few_files(spark, tmp_path):
    # Every task of an unclustered write used to add a file to every day.
    bronze = spark.range(400, numPartitions=40).selectExpr(
        "cast(id as string) event_id", "'k' dedup_key", "timestamp'2024-01-01' ingestion_time", "'p' partner_id", "'v1' schema_version",
        "'{}' payload", "1 hotel_id", "timestamp'2024-01-01' search_timestamp", "date_add(date'2024-01-01', cast(id % 4 as int)) ingest_date")
    path = str(tmp_path / "b")
    sinks.write_bronze(bronze, path, "0", cluster=False)
    assert sinks.read_bronze(spark, path).count() == 400
    assert len(spark.read.parquet(path).inputFiles()) == 4
