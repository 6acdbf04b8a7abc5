"""Table writers (bronze, quarantine, marts, archive) and partition maintenance.

Layout: bronze and quarantine are partitioned by ``ingest_date`` (day of
ingestion), silver and the marts by ``search_date``. Writes that replace data
use dynamic partition overwrite, so only the partitions present in the new
data are replaced.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens import reference_data as R
from staylens.functions.joins import estimated_bytes
from staylens.operators.landing import BRONZE_COLUMNS
from staylens.session import work_dir

# Upper bound of rows per output file (keeps files a few hundred MB at scale).
MAX_RECORDS_PER_FILE = 5_000_000
# Estimated bytes a writing task: what a table is range-partitioned for.
TASK_BYTES = 256 * 1024 * 1024
# Parts that event ids are filed in.
ID_BUCKETS = 64
# Archive lines keep microseconds (the default format stops at milliseconds).
ARCHIVE_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def range_partitions(df: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """Range partitions that give each writing task about ``task_bytes`` by Catalyst's estimate."""
    return max(1, min(100_000, -(-estimated_bytes(df) // task_bytes)))


def clustered(df: DataFrame, partition_col: str, cluster_col: str, tiebreak: str,
              num_partitions: int | None = None) -> DataFrame:
    """Range-partition on (partition, cluster, tiebreak) and sort within tasks.

    Each task writes a contiguous slice of one day sorted by the cluster key,
    so files carry tight min/max statistics on it (row-group skipping). The
    unique tie-break column lets the range partitioner split a hot day or a hot
    hotel across tasks instead of sending it to one. Without ``num_partitions``
    the session's shuffle partitions are the start and AQE joins small ones.
    """
    keys = (partition_col, cluster_col, tiebreak)
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(partition_col, cluster_col)


def write_bronze(bronze: DataFrame, path: str, batch: str | None = None, cluster: bool = True) -> None:
    """Add a batch of bronze rows, by ingest day and batch, clustered by hotel_id.

    A batch is written by overwriting its own partitions: written again after a failure, whole
    or in part, it stands once, and nothing stored has to be read for that. The number of
    tasks follows the size of the batch (a narrow projection, whose size Catalyst estimates well). Without
    clustering a day's rows are only brought together (a large day in several parts): else every
    task would add a file to every day.
    """
    out = bronze.select(*BRONZE_COLUMNS)
    if cluster:
        n = max(range_partitions(out), int(bronze.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        out = clustered(out, "ingest_date", "hotel_id", "event_id", n)
    else:
        out = out.hint("rebalance", "ingest_date")
    (out.withColumn("batch_id", F.lit(batch or uuid.uuid4().hex)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("ingest_date", "batch_id").parquet(path))


def create_bronze(spark: SparkSession, path: str) -> None:
    """The empty bronze table that a landing stream appends to."""
    _fs_path(spark, path)[1].mkdirs(_fs_path(spark, path)[0])


def _fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs_path(spark, path)
    return fs.exists(p)


def drop_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _fs_path(spark, path)
    return fs.delete(p, True)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    from staylens.schemas import BRONZE
    return spark.read.schema(BRONZE).parquet(path).select(*BRONZE.names)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds table data (files or partition folders, not only metadata).

    A dynamic partition overwrite does not leave a ``_SUCCESS`` marker at the
    root, so the marker cannot be used; hidden (``_``/``.``) entries are ignored.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def _id_bucket(column: str = "event_id"):
    return F.pmod(F.xxhash64(column), F.lit(ID_BUCKETS)).cast("int")


def stored_ids(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """Filed event ids (event_id, batch_id, id_bucket) of the given buckets: those partitions alone are read."""
    filed = spark.read.schema("event_id string, id_bucket int, batch_id string").parquet(ids_path(path))
    return filed if buckets is None else filed.where(F.col("id_bucket").isin(buckets))


def ids_path(path: str) -> str:
    return f"{path.rstrip('/')}_ids"


def new_events(spark: SparkSession, batch: DataFrame, path: str, batch_id: str) -> DataFrame:
    """One row per event id of ``batch`` that no other batch has filed; ids are looked up in their own buckets only.

    Copies go and ids are looked up under the same keys, so that rows are dealt out once for both.
    """
    keys = ["id_bucket", "event_id"]
    rows = batch.withColumn("id_bucket", _id_bucket()).dropDuplicates(keys)
    if table_exists(spark, ids_path(path)):
        buckets = [r.b for r in batch.select(_id_bucket().alias("b")).distinct().collect()]  # at most ID_BUCKETS numbers
        filed = stored_ids(spark, path, buckets).where(F.col("batch_id") != batch_id).select(*keys)
        rows = rows.join(filed, keys, "left_anti")
    return rows.drop("id_bucket")


def append_bronze_idempotent(spark: SparkSession, new: DataFrame, path: str, batch: str) -> DataFrame:
    """Append only events whose ``event_id`` no other batch has stored (re-runs add nothing).

    Ids are filed beside the table by hash bucket and batch, so a look-up reads ids of the batch's
    buckets and no event. Rows and ids are both written by overwriting the batch's own
    partitions: a batch that failed half-way is simply run again. ``new`` is read for its ids and for
    its rows; what is appended is written once before. Returns the rows appended.
    """
    work = work_dir(spark, "append")
    new_events(spark, new.select(*BRONZE_COLUMNS), path, batch).write.parquet(work)
    rows = spark.read.parquet(work)
    write_bronze(rows, path, batch)
    file_ids(rows, path, batch)
    return rows


def file_ids(rows: DataFrame, path: str, batch: str) -> None:
    """File the event ids of a stored batch (or of a day that a stream has landed) for later look-ups."""
    (rows.select("event_id", _id_bucket().alias("id_bucket"), F.lit(batch).alias("batch_id"))
     .repartition("id_bucket").sortWithinPartitions("id_bucket", "event_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("id_bucket", "batch_id").parquet(ids_path(path)))


def write_quarantine(quarantine: DataFrame, path: str, batch: str | None = None) -> None:
    """A batch of dead letters by ingest day, reason and batch (a batch written again stands once).

    Rows of a folder are brought together first, a large folder in several parts: else every landing
    task would add a file to every folder.
    """
    (quarantine.hint("rebalance", "ingest_date", "reason").withColumn("batch_id", F.lit(batch or uuid.uuid4().hex)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("ingest_date", "reason", "batch_id").parquet(path))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    from staylens.schemas import QUARANTINE
    return spark.read.schema(QUARANTINE).parquet(path).select(*QUARANTINE.names)


def write_partitions(df: DataFrame, path: str, partition_col: str = "search_date", tiebreak: str | None = None) -> None:
    """Write a table by day, clustered by city; days that are there already are replaced."""
    (clustered(df, partition_col, "city", tiebreak or partition_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(partition_col).parquet(path))


def archive_lines(bronze: DataFrame) -> DataFrame:
    """One JSON line per landed event: the record and its original payload."""
    record = F.struct(*[c for c in BRONZE_COLUMNS if c not in ("payload",)])
    return bronze.select(F.to_json(F.struct(F.col("payload"), record.alias("record")), ARCHIVE_FORMAT).alias("value"))


def write_archive(bronze: DataFrame, path: str) -> None:
    """JSON-lines archive (as many files as tasks; no forced single shard)."""
    archive_lines(bronze).write.mode("append").option("compression", "gzip").text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The landed events of an archive, columns as in bronze."""
    from staylens.schemas import BRONZE
    record = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in BRONZE if f.name != "payload")
    lines = spark.read.options(**ARCHIVE_FORMAT).schema(f"payload string, record struct<{record}>").json(path)
    return lines.select("record.*", "payload").select(*BRONZE_COLUMNS)


def publish_envelope(bronze: DataFrame) -> DataFrame:
    """Message-bus form (key, value, headers) of each landed event."""
    headers = F.array(
        F.struct(F.lit("ingestion_time").alias("key"),
                 F.date_format("ingestion_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").cast("binary").alias("value")),
        F.struct(F.lit("partner_id").alias("key"), F.col("partner_id").cast("binary").alias("value")),
        F.struct(F.lit("schema_version").alias("key"), F.col("schema_version").cast("binary").alias("value")),
    )
    return bronze.select(F.col("event_id").alias("key"), F.col("payload").alias("value"), headers.alias("headers"))


def partition_dates(spark: SparkSession, path: str, column: str = "ingest_date") -> list[dt.date]:
    """Dates of the ``column=...`` partition directories (a metadata listing, no data read).

    The folder of rows without a date (``__HIVE_DEFAULT_PARTITION__``) has no age and is left out.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    if not fs.exists(p):
        return out
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(column + "=") and not name.endswith("=__HIVE_DEFAULT_PARTITION__"):
            out.append(dt.date.fromisoformat(name.split("=", 1)[1]))
    return sorted(out)


def expired_dates(dates: list[dt.date], as_of: dt.date, days: int = R.RETENTION_DAYS) -> list[dt.date]:
    """Partitions older than the retention period (ingest_date < as_of - days)."""
    cutoff = as_of - dt.timedelta(days=days)
    return [d for d in dates if d < cutoff]


def drop_partitions(spark: SparkSession, path: str, dates: list[dt.date], column: str = "ingest_date") -> int:
    """Delete expired partition directories (metadata operation on the file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for d in dates:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={d.isoformat()}")
        if p.getFileSystem(conf).delete(p, True):
            n += 1
    return n


def apply_retention(spark: SparkSession, path: str, as_of: dt.date, days: int = R.RETENTION_DAYS,
                    column: str = "ingest_date") -> list[dt.date]:
    expired = expired_dates(partition_dates(spark, path, column), as_of, days)
    drop_partitions(spark, path, expired, column)
    return expired
