"""Tables published together: silver and the marts under one version.

Partitions are written once, into the folder of the run that made them; a version is a small
table that lists the folders that make up every table. Writing that list is the publish: it
counts from the moment Spark commits it, and readers open the newest one, so they see silver
and all marts of one refresh or of the one before, never a mix. A run that dies in between
leaves folders that no version lists. Unchanged days are listed again, not written again.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from staylens.sources import sinks

LISTING = StructType([
    StructField("table_name", StringType(), False),
    StructField("search_date", DateType(), True),
    StructField("run", StringType(), True),
    StructField("refreshed_at", TimestampType(), False),
    StructField("version", LongType(), False),
    StructField("schema", StringType(), True),
])


@dataclass(frozen=True)
class Written:
    """What a run wrote of a table."""

    schema: StructType
    days: list[dt.date]


class Tables:
    """The published tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _children(self, path: str) -> list[str]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def version(self) -> int:
        """The newest published version (0: nothing is published)."""
        numbers = (int(m[1]) for m in (re.fullmatch(r"v(\d+)", n) for n in self._children(f"{self.root}/versions")) if m)
        return max((n for n in numbers if "_SUCCESS" in self._children(f"{self.root}/versions/v{n}")), default=0)

    def listing(self) -> DataFrame:
        """The newest version: a row for each table (its schema, no run) and for each day of it (its run)."""
        n = self.version()
        if n == 0:
            return self.spark.createDataFrame([], LISTING)
        return self.spark.read.schema(LISTING).parquet(f"{self.root}/versions/v{n}")

    def folder(self, name: str, run: str) -> str:
        return f"{self.root}/data/{name}/run={run}"

    def new_run(self) -> str:
        return uuid.uuid4().hex[:12]

    def write(self, name: str, run: str, df: DataFrame, tiebreak: str | None = None) -> Written:
        """Write the days present in ``df``, once, into the run's folder."""
        path = self.folder(name, run)
        sinks.write_partitions(df, path, tiebreak=tiebreak)
        return Written(df.schema, sinks.partition_dates(self.spark, path, "search_date"))

    def written(self, name: str, run: str, schema: StructType) -> DataFrame:
        """What a run wrote, published or not."""
        return self.spark.read.schema(schema).parquet(self.folder(name, run))

    def publish(self, run: str, tables: dict[str, Written], touched: list[dt.date] | None = None,
                at: dt.datetime | None = None) -> int:
        """Switch to a version in which the run's days replace the ``touched`` days (None: all) of its tables."""
        old = self.listing().collect()  # one row a table and day
        version = self.version() + 1
        at = at or dt.datetime.now(dt.timezone.utc)
        gone = None if touched is None else set(touched)
        rows = []
        for r in old:
            fresh = r.table_name in tables
            if fresh and (r.run is None or gone is None or r.search_date in gone):
                continue  # replaced
            rows.append((r.table_name, r.search_date, r.run, at if fresh else r.refreshed_at, version, r.schema))
        for name, new in tables.items():
            rows.append((name, None, None, at, version, new.schema.json()))  # the table itself, also when it has no day
            rows += [(name, d, run, at, version, None) for d in new.days]
        # fails when another refresh has published this number meanwhile
        self.spark.createDataFrame(rows, LISTING).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/versions/v{version}")
        return version

    def read(self, name: str) -> DataFrame | None:
        """The table in the newest version, partitioned by search date; None when no version has it."""
        rows = [r for r in self.listing().collect() if r.table_name == name]
        if not rows:
            return None
        schema = StructType.fromJson(json.loads(next(r.schema for r in rows if r.run is None)))
        parts = [f"{self.folder(name, r.run)}/search_date={r.search_date}" for r in rows if r.run is not None]
        if not parts:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema).option("basePath", f"{self.root}/data/{name}").parquet(*parts)
        return stored.select(*schema.names)

    def refreshed(self) -> DataFrame:
        """When each table was refreshed last: table_name, refreshed_at."""
        return self.listing().groupBy("table_name").agg(F.max("refreshed_at").alias("refreshed_at"))

    def drop_unlisted(self, keep_versions: int = 2) -> int:
        """Remove run folders that none of the newest ``keep_versions`` versions lists (while no refresh runs); returns how many."""
        n = self.version()
        kept = set()
        for v in range(max(1, n - keep_versions + 1), n + 1):
            kept |= {(r.table_name, r.run) for r in self.spark.read.schema(LISTING).parquet(f"{self.root}/versions/v{v}").collect()}
        dropped = 0
        for name in self._children(f"{self.root}/data"):
            for child in self._children(f"{self.root}/data/{name}"):
                if child.startswith("run=") and (name, child[4:]) not in kept:
                    dropped += sinks.drop_folder(self.spark, f"{self.root}/data/{name}/{child}")
        return dropped
