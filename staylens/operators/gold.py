"""Gold marts (G1-G3, G5, G6): per-city aggregates of silver.

All three marts group by (city, search_date, ...), so partial aggregation
absorbs the skew of a dominant city before the shuffle. The share of total
is a window over the already aggregated rows (one scan of silver instead of
two aggregates and a join); NULL search_date never reaches silver (landing
quarantines unparseable timestamps), so this equals the join form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staylens import reference_data as Ref


def _share(count: Column, total: Column) -> Column:
    # DOUBLE arithmetic (100.0 * bigint / bigint would be DECIMAL in Spark).
    return F.round(count.cast("double") * 100.0 / total.cast("double"), 1)


def _mean_stay() -> Column:
    return F.round(F.col("total_nights").cast("double") / F.col("search_count").cast("double"), 1)


def _with_city(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("city").isNotNull())


def arrival_popularity(silver: DataFrame) -> DataFrame:
    """G1: searches per city, arrival date and search date."""
    return (_with_city(silver)
            .groupBy("city", "arrival_date", "search_date")
            .agg(F.count(F.lit(1)).alias("search_count"))
            .select("city", F.to_date("arrival_date").alias("arrival_date"), "search_date", "search_count"))


def country_trends(silver: DataFrame) -> DataFrame:
    """Searches and average stay per user country, with the share of the city-day.

    ``total_nights`` is kept beside the average, so that several days can be averaged from the mart.
    """
    counts = (_with_city(silver)
              .groupBy("city", "search_date", "user_country", "user_country_iso")
              .agg(F.count(F.lit(1)).alias("search_count"), F.sum("length_of_stay").alias("total_nights")))
    day = Window.partitionBy("city", "search_date")
    return counts.select(
        "city", "search_date", "user_country", "user_country_iso", "search_count",
        _share(F.col("search_count"), F.sum("search_count").over(day)).alias("pct_of_total"),
        _mean_stay().alias("avg_los"), "total_nights")


def los_distribution(silver: DataFrame) -> DataFrame:
    """Searches per LOS bucket with the share of the city-day."""
    counts = (_with_city(silver).groupBy("city", "search_date", "los_bucket")
              .agg(F.count(F.lit(1)).alias("search_count")))
    day = Window.partitionBy("city", "search_date")
    return counts.select("city", "search_date", "los_bucket", "search_count",
                         _share(F.col("search_count"), F.sum("search_count").over(day)).alias("pct_of_total"))


def _trailing(mart: DataFrame, as_of: Column, days: int) -> DataFrame:
    return mart.filter(F.col("search_date").between(F.date_sub(as_of, days - 1), as_of))


def _panel(counts: DataFrame, as_of: Column, days: int, *columns) -> DataFrame:
    city = Window.partitionBy("city")
    return counts.select(
        "city", F.date_sub(as_of, days - 1).alias("from_date"), as_of.alias("to_date"),
        *[_share(F.col("search_count"), F.sum("search_count").over(city)).alias(c) if c == "pct_of_total" else c for c in columns])


def trailing_days(country: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """The dashboard's trailing-window country panel per city, from the stored country mart.

    The mart's rows of the last ``days`` search dates up to ``as_of`` are summed per
    city and user country: share of the city's searches in the window and the
    average stay (nights over searches). No silver row is read.
    """
    counts = (_trailing(country, as_of, days).groupBy("city", "user_country", "user_country_iso")
              .agg(F.sum("search_count").alias("search_count"), F.sum("total_nights").alias("total_nights"))
              .withColumn("avg_los", _mean_stay()))
    return _panel(counts, as_of, days, "user_country", "user_country_iso", "search_count", "pct_of_total", "avg_los")


def trailing_arrivals(arrival: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Searches per city and arrival date over the last ``days`` search dates, from the stored arrival mart."""
    counts = _trailing(arrival, as_of, days).groupBy("city", "arrival_date").agg(F.sum("search_count").alias("search_count"))
    return _panel(counts, as_of, days, "arrival_date", "search_count")


def trailing_los(los: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Searches per city and LOS bucket over the last ``days`` search dates, with the city's share, from the stored mart."""
    counts = _trailing(los, as_of, days).groupBy("city", "los_bucket").agg(F.sum("search_count").alias("search_count"))
    return _panel(counts, as_of, days, "los_bucket", "search_count", "pct_of_total")


def weekly_arrivals(silver: DataFrame, threshold: int = Ref.WEEKLY_HIGHLIGHT_THRESHOLD) -> DataFrame:
    """Searches per city and 7-day arrival window (epoch-aligned tumbling), flagged at a threshold."""
    with_city = _with_city(silver).withColumn("_arr", F.to_date("arrival_date").cast("timestamp"))
    return (with_city.groupBy("city", F.window("_arr", "7 days").alias("w"))
            .agg(F.count(F.lit(1)).alias("search_count"))
            .select("city", F.to_date(F.col("w.start")).alias("week_start"), "search_count",
                    (F.col("search_count") >= threshold).alias("highlight")))
