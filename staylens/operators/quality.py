"""Data-quality checks over silver and the marts.

Each check is one aggregate (or one filter for failing-row checks); the scan
computes all metrics of a table in a single pass and unpivots them with
``stack``, so adding checks does not add scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staylens import reference_data as Ref
from staylens.functions.dates import strict_date

# FIXED VALUES: check severities.
SEVERITY_ERROR = "error"
SEVERITY_WARN = "warn"


def duplicate_keys(silver: DataFrame, key: str = "dedup_key") -> DataFrame:
    """Keys present more than once (partial aggregation, no row collection)."""
    return (silver.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def null_violations(silver: DataFrame) -> DataFrame:
    """Failing rows of the not-null tests with their severity."""
    checks = F.array(
        F.when(F.col("dedup_key").isNull(), F.struct(F.lit("not_null_dedup_key").alias("check"),
                                                      F.lit(SEVERITY_ERROR).alias("severity"))),
        F.when(F.col("hotel_id").isNotNull() & F.col("city").isNull(),
               F.struct(F.lit("not_null_city").alias("check"), F.lit(SEVERITY_WARN).alias("severity"))),
        F.when(F.col("length_of_stay").isNull(), F.struct(F.lit("not_null_length_of_stay").alias("check"),
                                                           F.lit(SEVERITY_ERROR).alias("severity"))),
    )
    return (silver.select("event_id", "dedup_key", "hotel_id", F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("c"))
            .select("event_id", "dedup_key", "hotel_id", "c.check", "c.severity"))


def unaccepted_los_buckets(df: DataFrame) -> DataFrame:
    """Rows whose los_bucket is not an accepted value (anti join on the 5-row value list)."""
    accepted = F.broadcast(Ref.accepted_los_buckets(df.sparkSession))
    return df.join(accepted, "los_bucket", "left_anti")


def _unaccepted_bucket() -> Column:
    return ~F.coalesce(F.col("los_bucket").isin(*Ref.ACCEPTED_LOS_BUCKETS), F.lit(False))


def _inconsistent_stay() -> Column:
    nights = F.datediff(strict_date(F.col("departure_date")), strict_date(F.col("arrival_date")))
    return ~F.coalesce(nights == F.col("length_of_stay"), F.lit(False))


def los_inconsistent(silver: DataFrame) -> DataFrame:
    """Rows whose stay differs from departure minus arrival."""
    return (silver.filter(_inconsistent_stay())
            .select("dedup_key", "length_of_stay", "arrival_date", "departure_date"))


def _metric_rows(table: str, df: DataFrame, metrics: list[tuple[str, Column, str, str, str]]) -> DataFrame:
    """One aggregate pass over ``df``; metrics are (check, value, op, threshold, severity)."""
    agg = df.agg(*[m[1].cast("double").alias(f"m{i}") for i, m in enumerate(metrics)])
    stacked = ", ".join(f"'{m[0]}', m{i}, '{m[2]}', cast({m[3]} as double), '{m[4]}'"
                        for i, m in enumerate(metrics))
    rows = agg.selectExpr(f"stack({len(metrics)}, {stacked}) as (check, metric, op, threshold, severity)")
    ok = (F.when(F.col("op") == ">", F.col("metric") > F.col("threshold"))
          .when(F.col("op") == "<", F.col("metric") < F.col("threshold"))
          .otherwise(F.col("metric") == F.col("threshold")))
    return rows.select(F.lit(table).alias("table_name"), "check", "metric", "op", "threshold",
                       F.when(ok, "pass").otherwise("fail").alias("outcome"), "severity")


def scan(silver: DataFrame, country: DataFrame, los: DataFrame) -> DataFrame:
    """Every monitoring check as a row (table, check, metric, threshold, outcome, severity)."""
    n = F.count(F.lit(1))
    s = _metric_rows("searches_enriched", silver, [
        ("row_count", n, ">", "0", SEVERITY_ERROR),
        ("missing_count_city", F.count_if(F.col("city").isNull()), "<", "1", SEVERITY_WARN),
        ("missing_pct_city", F.coalesce(F.try_divide(F.count_if(F.col("city").isNull()) * 100.0, n), F.lit(0.0)), "<", "1",
         SEVERITY_WARN),
        ("duplicate_count_dedup_key", n - F.count_distinct("dedup_key"), "=", "0", SEVERITY_ERROR),
        ("missing_count_dedup_key", F.count_if(F.col("dedup_key").isNull()), "=", "0", SEVERITY_ERROR),
        ("missing_count_length_of_stay", F.count_if(F.col("length_of_stay").isNull()), "=", "0", SEVERITY_ERROR),
        ("failed_rows_los_bucket", F.count_if(_unaccepted_bucket()), "=", "0", SEVERITY_ERROR),
        ("failed_rows_los_consistency", F.count_if(_inconsistent_stay()), "=", "0", SEVERITY_ERROR),
    ])
    c = _metric_rows("gold_country_trends", country, [
        ("row_count", n, ">", "0", SEVERITY_ERROR),
        ("invalid_count_pct_of_total",
         F.count_if(F.col("pct_of_total").isNull() | ~F.col("pct_of_total").between(0, 100)), "=", "0",
         SEVERITY_ERROR),
    ])
    d = _metric_rows("gold_los_distribution", los, [
        ("row_count", n, ">", "0", SEVERITY_ERROR),
        ("failed_rows_los_bucket", F.count_if(_unaccepted_bucket()), "=", "0", SEVERITY_ERROR),
    ])
    return s.unionByName(c).unionByName(d)


def gate(scan_rows: DataFrame) -> DataFrame:
    """One row saying whether the refresh may publish (no failing error-severity check)."""
    failing = (F.col("outcome") == "fail") & (F.col("severity") == SEVERITY_ERROR)
    return scan_rows.agg(
        (F.count_if(failing) == 0).alias("passed"),
        F.count_if(failing).alias("failed_errors"),
        F.count_if((F.col("outcome") == "fail") & (F.col("severity") == SEVERITY_WARN)).alias("failed_warnings"),
        F.coalesce(F.array_join(F.array_sort(F.collect_list(F.when(failing, F.concat_ws(".", "table_name", "check")))),
                                ","), F.lit("")).alias("failed_checks"))


class QualityGateError(RuntimeError):
    pass


def enforce(scan_rows: DataFrame) -> None:
    """D11 in a refresh plan: raise before publishing when an error-severity check fails."""
    row = gate(scan_rows).first()
    if not row["passed"]:
        raise QualityGateError(f"quality gate failed: {row['failed_checks']}")


def freshness(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, refreshed: DataFrame, as_of: Column) -> DataFrame:
    """One row a published table: when it was refreshed, whether that is too long ago, and the pipeline's lag and rates.

    ``refreshed`` holds (table_name, refreshed_at) of the published tables
    (``Tables.refreshed``): a refresh job that has stopped shows there, however
    fresh the ingestion is. One aggregate over bronze; the silver and dead-letter
    counts are scalar subqueries (each a single partial-aggregated count).
    """
    silver_rows = silver.select(F.count(F.lit(1))).scalar()
    null_city = silver.select(F.count_if(F.col("city").isNull())).scalar()
    dead = quarantine.select(F.count(F.lit(1))).scalar()
    landed = bronze.agg(F.max("ingestion_time").alias("newest_ingestion"), F.count(F.lit(1)).alias("bronze_rows"),
                        F.count_distinct("dedup_key").alias("bronze_keys")).select(F.struct("*")).scalar()
    rows = refreshed.select("table_name", "refreshed_at", landed.alias("_b")).select("table_name", "refreshed_at", "_b.*")

    def minutes(since: str) -> Column:
        return (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col(since))) / 6.0e7

    return rows.select(
        "table_name", "refreshed_at", F.round(minutes("refreshed_at"), 2).alias("refresh_lag_minutes"),
        (minutes("refreshed_at") > Ref.GOLD_STALE_MINUTES).alias("stale"),
        "newest_ingestion",
        F.round(minutes("newest_ingestion"), 2).alias("ingest_lag_minutes"),
        F.round(F.try_divide(null_city * 100.0, silver_rows), 2).cast("double").alias("null_city_pct"),
        F.round(F.try_divide((F.col("bronze_rows") - F.col("bronze_keys")) * 100.0, F.col("bronze_rows")), 2)
        .cast("double").alias("duplicate_pct"),
        F.round(F.try_divide(dead * 100.0, dead + F.col("bronze_rows")), 2).cast("double").alias("dead_letter_pct"),
        "bronze_rows", silver_rows.alias("silver_rows"), dead.alias("dead_letters"))
