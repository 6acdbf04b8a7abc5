"""The end-to-end flow over the driver datasets, built lazily.

``Flow(spark, sf_dir)`` derives the raw message log from ``events`` and
exposes every stage as a DataFrame (nothing is computed until an action):
raw -> landed (labelled) -> bronze / quarantine -> silver -> marts.

With ``stored=True`` (or a subset such as ``("silver",)``) the landed batch
and/or silver are written once as tables
in the shared checkpoint folder (as the production pipeline stores them) and
read back, so plans that fan out into several marts or checks scan stored
tables instead of re-deriving silver in every branch.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from staylens import reference_data as Ref
from staylens.operators import gold, landing, silver as silver_ops
from staylens.session import prepare, work_dir
from staylens.sources.search_feed import search_feed
from staylens.sources.tables import spread, table


class Flow:
    def __init__(self, spark: SparkSession, sf_dir: str, gate: str = "light", stored=False):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.gate = gate
        self.stored = {"landed", "silver"} if stored is True else set(stored or ())

    def _store(self, df: DataFrame, name: str, partition_col: str | None) -> DataFrame:
        if name not in self.stored:
            return df
        path = work_dir(self.spark, name)
        (df.write.partitionBy(partition_col) if partition_col else df.write).parquet(path)
        return self.spark.read.parquet(path).select(*df.columns)

    @cached_property
    def events(self) -> DataFrame:
        return spread(table(self.spark, self.sf_dir, "events", "event_id", "ts", "user_id", "value"), "event_id")

    @cached_property
    def raw(self) -> DataFrame:
        return search_feed(self.events)

    @cached_property
    def landed(self) -> DataFrame:
        # no folder a day: every landing task holds rows of every day, tasks x days files would be tiny ones
        return self._store(landing.land(self.raw, self.gate), "landed", None)

    @cached_property
    def bronze(self) -> DataFrame:
        return landing.bronze_rows(self.landed)

    @cached_property
    def quarantine(self) -> DataFrame:
        return landing.quarantine_rows(self.landed)

    @cached_property
    def dim_hotels(self) -> DataFrame:
        return Ref.dim_hotels(self.spark)

    @cached_property
    def country_map(self) -> DataFrame:
        return Ref.country_map(self.spark)

    @cached_property
    def silver(self) -> DataFrame:
        return self._store(silver_ops.silver(self.bronze, self.dim_hotels, self.country_map), "silver", "search_date")

    @cached_property
    def arrival(self) -> DataFrame:
        return gold.arrival_popularity(self.silver)

    @cached_property
    def country(self) -> DataFrame:
        return gold.country_trends(self.silver)

    @cached_property
    def los(self) -> DataFrame:
        return gold.los_distribution(self.silver)
