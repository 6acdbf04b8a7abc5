"""Per-city reads of the marts (Q1-Q7).

Marts are stored partitioned by ``search_date``, so the optional date range
prunes partitions and the city equality is pushed to the Parquet scan as a
row-group filter. ``city=None`` gives the all-cities (bulk) form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from staylens.sources.versions import Tables


def _window(df: DataFrame, city: str | None, from_date=None, to_date=None) -> DataFrame:
    if city is not None:
        df = df.filter(F.col("city") == F.lit(city))
    if from_date is not None:
        df = df.filter(F.col("search_date") >= F.lit(from_date).cast("date"))
    if to_date is not None:
        df = df.filter(F.col("search_date") <= F.lit(to_date).cast("date"))
    return df


def cities(country_trends: DataFrame) -> DataFrame:
    """Q1: cities with data, in order."""
    return country_trends.select("city").distinct().orderBy("city")


def arrival_trends(arrival: DataFrame, city: str | None = None, from_date=None, to_date=None) -> DataFrame:
    """Q2 / Q6: arrival-date popularity ordered by search date, arrival date."""
    return (_window(arrival, city, from_date, to_date)
            .select("city", "arrival_date", "search_date", "search_count")
            .orderBy("city", "search_date", "arrival_date"))


def country_trends(country: DataFrame, city: str | None = None, from_date=None, to_date=None) -> DataFrame:
    """Q3 / Q6: country panel, most searches first (ties by country, then day)."""
    return (_window(country, city, from_date, to_date)
            .select("city", "search_date", "user_country", "user_country_iso", "search_count",
                    "pct_of_total", "avg_los")
            .orderBy("city", F.col("search_count").desc(), "user_country", "search_date"))


def los_trends(los: DataFrame, city: str | None = None, from_date=None, to_date=None) -> DataFrame:
    """Q4 / Q6: LOS distribution ordered by bucket (label order is the logical order)."""
    return (_window(los, city, from_date, to_date)
            .select("city", "search_date", "los_bucket", "search_count", "pct_of_total")
            .orderBy("city", "los_bucket", "search_date"))


def _nest(df: DataFrame, key_cols: list[Column], value_cols: list[str], name: str) -> DataFrame:
    """Per-city array of structs ordered by ``key_cols`` (the key is dropped after sorting).

    Each array holds mart rows (bounded by distinct dates x buckets of one
    city), never raw events.
    """
    entry = F.struct(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key_cols)]).alias("key"),
                     F.struct(*value_cols).alias("value"))
    return (df.groupBy("city").agg(F.sort_array(F.collect_list(entry)).alias("_l"))
            .select("city", F.transform("_l", lambda x: x["value"]).alias(name)))


def city_trends(arrival: DataFrame, country: DataFrame, los: DataFrame, city: str | None = None,
                from_date=None, to_date=None) -> DataFrame:
    """Q5: one nested record per city with the three panels (all cities when ``city`` is None)."""
    a = _nest(_window(arrival, city, from_date, to_date),
              [F.col("search_date"), F.col("arrival_date")],
              ["arrival_date", "search_date", "search_count"], "arrival_date_popularity")
    c = _nest(_window(country, city, from_date, to_date),
              [-F.col("search_count"), F.col("user_country"), F.col("search_date")],
              ["search_date", "user_country", "user_country_iso", "search_count", "pct_of_total", "avg_los"],
              "country_trends")
    d = _nest(_window(los, city, from_date, to_date),
              [F.col("los_bucket"), F.col("search_date")],
              ["search_date", "los_bucket", "search_count", "pct_of_total"], "los_distribution")
    return (a.join(c, "city", "full").join(d, "city", "full")
            .select("city",
                    F.lit(from_date).cast("date").alias("from_date"),
                    F.lit(to_date).cast("date").alias("to_date"),
                    F.coalesce("arrival_date_popularity", F.array()).alias("arrival_date_popularity"),
                    F.coalesce("country_trends", F.array()).alias("country_trends"),
                    F.coalesce("los_distribution", F.array()).alias("los_distribution")))


def panel_entries(nested: DataFrame) -> DataFrame:
    """Q5 as rows: one per panel entry of ``city_trends``, with its position in the panel."""
    def rows(panel, name, entry, value=lambda x, c: F.lit(None)):
        return F.transform(name, lambda x, i: F.struct(
            F.lit(panel).alias("panel"), i.alias("position"), x["search_date"].alias("search_date"),
            x[entry].cast("string").alias("entry"), value(x, "user_country_iso").cast("string").alias("user_country_iso"),
            x["search_count"].alias("search_count"), value(x, "pct_of_total").cast("double").alias("pct_of_total"),
            value(x, "avg_los").cast("double").alias("avg_los")))

    entries = F.concat(
        rows("arrival", "arrival_date_popularity", "arrival_date"),
        rows("country", "country_trends", "user_country", lambda x, c: x[c]),
        rows("stay", "los_distribution", "los_bucket", lambda x, c: x[c] if c == "pct_of_total" else F.lit(None)))
    return nested.select("city", F.inline(entries))


# FIXED VALUES: read outcomes (HTTP 200 / 404 / 503 in the service form).
STATUS_OK = "ok"
STATUS_NO_DATA = "not_found"
STATUS_NOT_READY = "not_ready"


@dataclass
class Marts:
    arrival: DataFrame | None
    country: DataFrame | None
    los: DataFrame | None

    @property
    def ready(self) -> bool:
        return all(x is not None for x in (self.arrival, self.country, self.los))


def load_marts(spark: SparkSession, root: str) -> Marts:
    """The marts of the newest published version; a missing one is None (the 'not ready' outcome)."""
    tables = Tables(spark, root)
    return Marts(*map(tables.read, ("gold_arrival_date_popularity", "gold_country_trends", "gold_los_distribution")))


def panel_rows(marts: Marts) -> DataFrame:
    """The three marts as rows of one shape: panel, city, search_date, entry and its measures."""
    def rows(df, panel, entry, *own):
        extra = {"user_country_iso": "string", "pct_of_total": "double", "avg_los": "double"}
        return df.select(F.lit(panel).alias("panel"), "city", "search_date", F.col(entry).cast("string").alias("entry"),
                         "search_count", *[(F.col(c) if c in own else F.lit(None)).cast(t).alias(c) for c, t in extra.items()])

    return (rows(marts.arrival, "arrival", "arrival_date")
            .unionByName(rows(marts.country, "country", "user_country", "user_country_iso", "pct_of_total", "avg_los"))
            .unionByName(rows(marts.los, "stay", "los_bucket", "pct_of_total")))


def trends_status(marts: Marts, requested: DataFrame) -> DataFrame:
    """Q7: outcome per requested city: ok, not_found (no rows in any panel), not_ready."""
    if not marts.ready:
        return requested.select("city", F.lit(STATUS_NOT_READY).alias("status"))
    present = (marts.arrival.select("city").unionByName(marts.country.select("city"))
               .unionByName(marts.los.select("city")).distinct().withColumn("_has", F.lit(True)))
    return (requested.select("city").distinct().join(present, "city", "left")
            .select("city", F.when(F.col("_has"), STATUS_OK).otherwise(STATUS_NO_DATA).alias("status")))

