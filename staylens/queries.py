"""Registry of the queries run by the driver (name -> callable(spark, sf_dir))."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens.operators import serving
from staylens.operators.validation import error_texts
from staylens.plans.derived import Flow

# Read parameters of the serving queries (fixed request values).
CITY = "Paris"
FROM_DATE = "2024-01-08"
TO_DATE = "2024-01-14"
CITY_WITHOUT_DATA = "Atlantis"
MONTH = ("2024-01-01", "2024-01-31")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 for all cities over a month: a date range bounds the arrays of a city."""
    f = Flow(spark, sf_dir, stored=("silver",))
    return serving.city_trends(f.arrival, f.country, f.los, None, *MONTH)


# --- landing / bronze ------------------------------------------------------

def _draw(column, n):
    """A number below n from the number in an event's id (a re-sent copy draws as its original)."""
    return F.expr(f"cast(rtrim('r', {column}) as bigint) div 7 % {n}")


@query
def bronze_landing(spark, sf_dir):
    return Flow(spark, sf_dir).bronze


@query
def bronze_dedup_key(spark, sf_dir):
    """Keys landed more than once (re-sent requests), with first and last ingestion."""
    b = Flow(spark, sf_dir).bronze
    return (b.groupBy("dedup_key")
            .agg(F.count(F.lit(1)).alias("copies"), F.min("ingestion_time").alias("first_ingestion"),
                 F.max("ingestion_time").alias("last_ingestion"))
            .filter(F.col("copies") > 1))


@query
def bronze_count(spark, sf_dir):
    return Flow(spark, sf_dir).bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))


# --- silver ----------------------------------------------------------------

@query
def staged_events(spark, sf_dir):
    from staylens.operators.silver import stage
    return stage(Flow(spark, sf_dir).bronze).drop("payload", "partner_id", "schema_version")


@query
def silver_enriched(spark, sf_dir):
    return Flow(spark, sf_dir).silver.drop("payload")


@query
def silver_rejects(spark, sf_dir):
    from staylens.operators.silver import silver_rejects as rejects
    f = Flow(spark, sf_dir, stored=True)
    return rejects(f.bronze, f.dim_hotels, f.country_map)


# --- gold ------------------------------------------------------------------

@query
def gold_arrival_popularity(spark, sf_dir):
    return Flow(spark, sf_dir).arrival


@query
def gold_country_trends(spark, sf_dir):
    return Flow(spark, sf_dir).country


@query
def gold_los_distribution(spark, sf_dir):
    return Flow(spark, sf_dir).los


@query
def pipeline_counts(spark, sf_dir):
    f = Flow(spark, sf_dir, stored=("silver",))
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    return f.silver.agg(F.count(F.lit(1)).alias("silver_rows")).select(
        "silver_rows",
        n(f.arrival).alias("gold_arrival_date_popularity"),
        n(f.country).alias("gold_country_trends"),
        n(f.los).alias("gold_los_distribution"))


# --- serving (from stored marts) ---------------------------------------------

def _stored_marts(spark, sf_dir, *names):
    """The named marts (default: all) published by search date, as a refresh leaves them, and opened for reading."""
    from staylens.plans.refresh import publish_marts
    from staylens.session import work_dir
    root = work_dir(spark, "marts")
    publish_marts(spark, Flow(spark, sf_dir, stored=("silver",)).silver, root, names or None)
    return serving.load_marts(spark, root)


@query
def cities(spark, sf_dir):
    return serving.cities(_stored_marts(spark, sf_dir, "gold_country_trends").country)


@query
def arrival_trends(spark, sf_dir):
    return serving.arrival_trends(_stored_marts(spark, sf_dir, "gold_arrival_date_popularity").arrival, CITY, FROM_DATE, TO_DATE)


@query
def country_trends(spark, sf_dir):
    return serving.country_trends(_stored_marts(spark, sf_dir, "gold_country_trends").country, CITY, FROM_DATE, TO_DATE)


@query
def los_trends(spark, sf_dir):
    return serving.los_trends(_stored_marts(spark, sf_dir, "gold_los_distribution").los, CITY, FROM_DATE, TO_DATE)


@query
def city_trends(spark, sf_dir):
    m = _stored_marts(spark, sf_dir)
    return serving.panel_entries(serving.city_trends(m.arrival, m.country, m.los, CITY, FROM_DATE, TO_DATE))


@query
def city_trends_undated(spark, sf_dir):
    m = _stored_marts(spark, sf_dir)
    return serving.panel_entries(serving.city_trends(m.arrival, m.country, m.los, CITY))


@query
def trends_missing_city(spark, sf_dir):
    """Outcome per city: with all marts, and while the arrival mart is not built."""
    m = _stored_marts(spark, sf_dir)
    requested = Flow(spark, sf_dir).dim_hotels.select("city").unionByName(
        spark.range(1).select(F.lit(CITY_WITHOUT_DATA).alias("city")))
    return (serving.trends_status(m, requested).withColumn("marts", F.lit("all"))
            .unionByName(serving.trends_status(serving.Marts(None, m.country, m.los), requested)
                         .withColumn("marts", F.lit("no_arrival"))))


# --- validation / dead letters --------------------------------------------

def _validated(spark, sf_dir):
    from staylens.operators.validation import validate
    return validate(Flow(spark, sf_dir).raw).withColumnRenamed("request_id", "event_id")


def _error_rows(df, stage):
    return (df.filter(F.col("failed_stage") == stage)
            .select("event_id", F.size("errors").alias("error_count"),
                    F.array_join(error_texts("errors"), " | ").alias("error_text"),
                    F.array_join("errors.code", ",").alias("error_codes")))


@query
def validate_schema_errors(spark, sf_dir):
    return _error_rows(_validated(spark, sf_dir), "contract")


@query
def validate_business_errors(spark, sf_dir):
    return _error_rows(_validated(spark, sf_dir), "business")


@query
def validate_split(spark, sf_dir):
    landed = Flow(spark, sf_dir, gate="full").landed
    return (landed.groupBy(F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("outcome"),
                           F.coalesce("reason", F.lit("none")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("events")))


@query
def rejections_by_code(spark, sf_dir):
    from staylens.operators.validation import rejections_by_code as by_code
    return by_code(_validated(spark, sf_dir))


@query
def quarantine_full(spark, sf_dir):
    q = Flow(spark, sf_dir, gate="full").quarantine
    return q.withColumns({"error_text": F.array_join(error_texts("errors"), " | "),
                          "error_codes": F.array_join("errors.code", ",")}).drop("errors")


# --- data quality ------------------------------------------------------------

AS_OF = "2024-01-31 00:00:00"


def _damaged(silver):
    """Silver with faults that its own build never leaves: what the failing-row checks are for.

    Of 100 draws: 0 stands twice, 1 has a wrong stay, 2 no stay, 3 an unknown bucket, 4 no key.
    """
    c = _draw("event_id", 100)
    return (silver.withColumn("_copies", F.explode(F.when(c == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
            .drop("_copies")
            .withColumns({"length_of_stay": F.when(c == 1, F.col("length_of_stay") + 1).when(c == 2, F.lit(None)).otherwise(F.col("length_of_stay")),
                          "los_bucket": F.when(c == 3, F.lit("a while")).otherwise(F.col("los_bucket")),
                          "dedup_key": F.when(c == 4, F.lit(None)).otherwise(F.col("dedup_key"))}))


@query
def dq_unique(spark, sf_dir):
    from staylens.operators.quality import duplicate_keys
    return duplicate_keys(_damaged(Flow(spark, sf_dir).silver))


@query
def dq_not_null(spark, sf_dir):
    from staylens.operators.quality import null_violations
    return null_violations(_damaged(Flow(spark, sf_dir).silver))


@query
def dq_accepted_values(spark, sf_dir):
    from staylens.operators.quality import unaccepted_los_buckets
    return unaccepted_los_buckets(_damaged(Flow(spark, sf_dir).silver)).select("event_id", "search_date", "los_bucket")


@query
def dq_los_consistency(spark, sf_dir):
    from staylens.operators.quality import los_inconsistent
    return los_inconsistent(_damaged(Flow(spark, sf_dir).silver))


@query
def dq_scan(spark, sf_dir):
    from staylens.operators.quality import scan
    f = Flow(spark, sf_dir, stored=("silver",))
    return scan(f.silver, f.country, f.los)


@query
def dq_gate(spark, sf_dir):
    """The gate on silver as it is built, and on a damaged candidate."""
    from staylens.operators.quality import gate, scan
    f = Flow(spark, sf_dir, stored=("silver",))
    return (gate(scan(f.silver, f.country, f.los)).withColumn("candidate", F.lit("built"))
            .unionByName(gate(scan(_damaged(f.silver), f.country, f.los)).withColumn("candidate", F.lit("damaged"))))


# The refresh of the marts: silver goes on after the arrival mart's last run.
REFRESHED_AT = {"gold_arrival_date_popularity": "2024-01-20 06:00:00", "gold_los_distribution": "2024-01-30 23:45:00"}


@query
def dq_freshness(spark, sf_dir):
    """The arrival mart's job has stopped on the 20th, the stay mart is 15 minutes old."""
    import datetime as dt
    from staylens.operators.quality import freshness
    from staylens.plans.refresh import publish_marts
    from staylens.session import work_dir
    f = Flow(spark, sf_dir, stored=True)
    root = work_dir(spark, "fresh-marts")
    for name, at in REFRESHED_AT.items():
        tables = publish_marts(spark, f.silver, root, [name], dt.datetime.fromisoformat(at).replace(tzinfo=dt.timezone.utc))
    return freshness(f.bronze, f.silver, f.quarantine, tables.refreshed(), F.lit(AS_OF).cast("timestamp"))


# --- edge checks -------------------------------------------------------------

@query
def oversize_quarantine(spark, sf_dir):
    q = Flow(spark, sf_dir, gate="full").quarantine
    return (q.filter(F.col("reason") == "payload_too_large")
            .select("event_id", "ingestion_time", F.octet_length("raw").alias("kept_bytes"), "raw"))


# The feed's clients send about one request an hour: a limit that bites there.
RATE_LIMIT = {"limit": 2, "window_us": 3_600_000_000}


@query
def rate_limit_audit(spark, sf_dir):
    from staylens.operators.rate_limit import rate_limit_audit as audit
    return audit(Flow(spark, sf_dir).raw.select("client", "request_id", "received_at"), **RATE_LIMIT)


@query
def rate_limit_exact(spark, sf_dir):
    """The accepted-only rule over the whole log; one client sends a third of it."""
    from staylens.operators.rate_limit import limit_exact
    log = Flow(spark, sf_dir).raw.select(
        F.when(_draw("request_id", 3) == 0, "client-hot").otherwise(F.col("client")).alias("client"),
        "request_id", "received_at")
    return limit_exact(log, **RATE_LIMIT)


# --- marts over several days -------------------------------------------------

def _newest(mart):
    return mart.select(F.max("search_date")).scalar()


@query
def gold_last_7_days(spark, sf_dir):
    from staylens.operators.gold import trailing_days
    mart = _stored_marts(spark, sf_dir, "gold_country_trends").country
    return trailing_days(mart, _newest(mart))


@query
def gold_last_7_days_arrivals(spark, sf_dir):
    from staylens.operators.gold import trailing_arrivals
    mart = _stored_marts(spark, sf_dir, "gold_arrival_date_popularity").arrival
    return trailing_arrivals(mart, _newest(mart))


@query
def gold_last_7_days_los(spark, sf_dir):
    from staylens.operators.gold import trailing_los
    mart = _stored_marts(spark, sf_dir, "gold_los_distribution").los
    return trailing_los(mart, _newest(mart))


@query
def gold_weekly_arrivals(spark, sf_dir):
    from staylens.operators.gold import weekly_arrivals
    return weekly_arrivals(Flow(spark, sf_dir).silver)


# --- storage: layout, retention, idempotent append, incremental merge --------

def _stored_bronze(spark, sf_dir, name):
    from staylens.session import work_dir
    from staylens.sources import sinks
    path = work_dir(spark, name)
    # landed once: the range partitioner of the table reads its input twice
    sinks.write_bronze(Flow(spark, sf_dir, stored=("landed",)).bronze, path)
    return path


@query
def bronze_layout(spark, sf_dir):
    """Rows and hotels by day, and how many files of the day reach back into the hotels of the file before."""
    from pyspark.sql import Window
    from staylens.sources import sinks
    path = _stored_bronze(spark, sf_dir, "bronze-layout")
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"))
    files = rows.groupBy("ingest_date", "file").agg(F.min("hotel_id").alias("lo"), F.max("hotel_id").alias("hi"))
    before = F.lag("hi").over(Window.partitionBy("ingest_date").orderBy("lo", "hi"))
    overlaps = (files.withColumn("before", before).groupBy("ingest_date")
                .agg(F.count_if(F.col("before") > F.col("lo")).alias("overlapping_files")))
    return (sinks.read_bronze(spark, path).groupBy("ingest_date")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("hotel_id").alias("hotels"),
                 F.min("hotel_id").alias("min_hotel_id"), F.max("hotel_id").alias("max_hotel_id"))
            .join(overlaps, "ingest_date"))


RETENTION_AS_OF = "2024-04-15"


@query
def bronze_retention(spark, sf_dir):
    import datetime as dt
    from staylens.sources import sinks
    path = _stored_bronze(spark, sf_dir, "bronze-retention")
    sinks.apply_retention(spark, path, dt.date.fromisoformat(RETENTION_AS_OF))
    return sinks.read_bronze(spark, path).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("rows"))


SPLIT_DAY = "2024-01-16"


@query
def bronze_idempotent_insert(spark, sf_dir):
    """The table holds the days before SPLIT_DAY; the whole log then comes as one batch, and the batch a second time."""
    from staylens.session import work_dir
    from staylens.sources import sinks
    f = Flow(spark, sf_dir, stored=("landed",))  # landed once, for four batches
    path = work_dir(spark, "bronze-idempotent")
    sinks.append_bronze_idempotent(spark, f.bronze.filter(F.col("ingest_date") < F.lit(SPLIT_DAY).cast("date")), path, "history")
    sinks.append_bronze_idempotent(spark, f.bronze, path, "resent")
    sinks.append_bronze_idempotent(spark, f.bronze, path, "resent")  # the batch is run again
    sinks.append_bronze_idempotent(spark, f.bronze, path, "resent-again")  # and sent again under another name
    return sinks.read_bronze(spark, path).select("event_id", "dedup_key", "ingestion_time", "ingest_date")


BATCH_BOUNDS = ["2024-01-11", "2024-01-21"]


def _bronze_batches(f, *order):
    d = F.col("ingest_date")
    lo, hi = (F.lit(x).cast("date") for x in BATCH_BOUNDS)
    parts = [d < lo, (d >= lo) & (d < hi), d >= hi]
    return [f.bronze.filter(parts[k]) for k in order]


@query
def silver_incremental(spark, sf_dir):
    """Bronze arrives in three ingest-day batches (newest first); silver is merged after each."""
    from staylens.plans.refresh import SILVER, Tables, merge
    from staylens.session import work_dir
    root = work_dir(spark, "silver-incremental")
    for batch in _bronze_batches(Flow(spark, sf_dir, stored=("landed",)), 2, 0, 1):
        merge(spark, batch, root)
    return Tables(spark, root).read(SILVER).drop("payload")


@query
def gold_incremental(spark, sf_dir):
    """Marts refreshed per touched day with each merged batch equal the full marts (all three, as panel rows)."""
    from staylens.plans.refresh import merge
    from staylens.session import work_dir
    root = work_dir(spark, "gold-inc")
    for batch in _bronze_batches(Flow(spark, sf_dir, stored=("landed",)), 0, 1, 2):
        merge(spark, batch, root)
    return serving.panel_rows(serving.load_marts(spark, root))


@query
def silver_watermark(spark, sf_dir):
    """Bronze grows in three steps and silver follows its files; a fifth of every step's rows come five days late or more."""
    from staylens.plans.refresh import SILVER, Tables, follow_bronze
    from staylens.session import work_dir
    from staylens.sources import sinks
    bronze = sinks.read_bronze(spark, _stored_bronze(spark, sf_dir, "bronze-whole"))
    path, root, ckpt = (work_dir(spark, n) for n in ("bronze-growing", "silver-following", "follow-ckpt"))
    day = F.col("ingest_date")
    lo, hi = (F.lit(x).cast("date") for x in BATCH_BOUNDS)
    span = F.when(day >= hi, 2).when(day >= lo, 1).otherwise(0)
    waits = F.when(span == 0, day < F.date_sub(lo, 5)).when(span == 1, day < F.date_sub(hi, 5)).otherwise(False)
    step = span + F.when(waits & (_draw("event_id", 5) == 0), 1).otherwise(0)
    for k in range(len(BATCH_BOUNDS) + 1):
        sinks.write_bronze(bronze.where(step == k), path, f"step-{k}")
        follow_bronze(spark, path, root, ckpt).awaitTermination()
    return Tables(spark, root).read(SILVER).drop("payload")


REBUILD_BEFORE = "2024-01-20"


@query
def full_refresh_counts(spark, sf_dir):
    """Silver and marts rebuilt twice, the second time from fewer days and with the hotels read from a CSV file."""
    from staylens.operators.silver import read_dim_hotels
    from staylens.plans.refresh import MARTS, SILVER, Tables, full_refresh
    from staylens.session import work_dir
    from staylens.sources import sinks
    f = Flow(spark, sf_dir)
    bronze = sinks.read_bronze(spark, _stored_bronze(spark, sf_dir, "bronze-full"))
    root, csv = work_dir(spark, "full-tables"), work_dir(spark, "dim-csv")
    f.dim_hotels.write.option("header", True).csv(csv)
    full_refresh(spark, bronze, root)
    full_refresh(spark, bronze.filter(F.col("search_timestamp") < F.lit(REBUILD_BEFORE).cast("timestamp")), root,
                 dim_hotels=read_dim_hotels(spark, csv))
    tables, counts = Tables(spark, root), None
    for name in (SILVER, *MARTS):
        one = tables.read(name).agg(F.count("*").alias("rows"), F.max("search_date").alias("last_day")) \
            .select(F.lit(name).alias("table_name"), "rows", "last_day")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query
def quarantine_retention(spark, sf_dir):
    """Dead letters stored by day and reason, days past the retention period dropped."""
    import datetime as dt
    from staylens.session import work_dir
    from staylens.sources import sinks
    path = work_dir(spark, "quarantine")
    sinks.write_quarantine(Flow(spark, sf_dir, gate="full").quarantine, path)
    sinks.apply_retention(spark, path, dt.date.fromisoformat(RETENTION_AS_OF))
    return spark.read.parquet(path).groupBy("ingest_date", "reason").agg(F.count("*").alias("rows"))


@query
def request_bodies(spark, sf_dir):
    """Files of one request body a line, read and landed by the request path's gate."""
    from staylens.operators.landing import land
    from staylens.session import work_dir
    from staylens.sources.requests import read_request_bodies
    path = work_dir(spark, "bodies")
    Flow(spark, sf_dir).raw.select("value").write.text(path)
    return (land(read_request_bodies(spark, path), "full")
            .groupBy(F.coalesce("reason", F.lit("none")).alias("reason"))
            .agg(F.count("*").alias("events"), F.count_distinct("dedup_key").alias("keys")))


BACKFILL = ("2024-01-08", "2024-01-14")


@query
def backfill_range(spark, sf_dir):
    from staylens.plans.refresh import backfill
    from staylens.sources import sinks
    path = _stored_bronze(spark, sf_dir, "bronze-backfill")
    return backfill(spark, sinks.read_bronze(spark, path), *BACKFILL)["gold_country_trends"]


@query
def archive_jsonl(spark, sf_dir):
    from staylens.session import work_dir
    from staylens.sources import sinks
    path = work_dir(spark, "archive")
    sinks.write_archive(Flow(spark, sf_dir).bronze, path)
    return sinks.read_archive(spark, path)


@query
def publish_envelope(spark, sf_dir):
    from staylens.sources import sinks
    sent = sinks.publish_envelope(Flow(spark, sf_dir).bronze)
    return (sent.select("key", "value", F.explode("headers").alias("h"))
            .select("key", "value", F.col("h.key").alias("header"), F.col("h.value").cast("string").alias("header_value")))


# --- streaming ---------------------------------------------------------------

def _drain(spark, sf_dir, start, late=None, columns=("request_id", "received_at", "value", "client")):
    """Feed the derived message log to a stream as it would arrive: a span of days lands, the stream drains it.

    ``start(source)`` starts the streams on the landing zone (``availableNow``, same checkpoint every
    time). The log is derived once and stored by span; each span is then moved in by its own write.
    Rows for which ``late`` holds come one span later.
    """
    from staylens.session import work_dir
    log, zone = work_dir(spark, "message-log"), work_dir(spark, "landing-zone")
    lo, hi = (F.lit(x).cast("date") for x in BATCH_BOUNDS)
    day = F.to_date("received_at")
    span = F.when(day >= hi, 2).when(day >= lo, 1).otherwise(0)
    if late is not None:
        span = F.least(F.lit(2), span + F.when(late, 1).otherwise(0))
    Flow(spark, sf_dir).raw.withColumn("span", span).write.partitionBy("span").parquet(log)
    for k in range(len(BATCH_BOUNDS) + 1):
        spark.read.parquet(log).filter(F.col("span") == k).select(*columns).write.mode("append").parquet(zone)
        started = start(zone)
        for q in started if isinstance(started, list) else [started]:
            q.awaitTermination()


@query
def stream_landing(spark, sf_dir):
    """The log landed span by span, and every micro-batch written twice, as after a failure."""
    from staylens.session import work_dir
    from staylens.sources import sinks
    from staylens.streaming import landing
    bronze, quarantine, archive, ckpt = (work_dir(spark, n) for n in ("s-bronze", "s-quarantine", "s-archive", "s-ckpt"))
    sinks.create_bronze(spark, bronze)
    _drain(spark, sf_dir, lambda src: landing.start_landing(spark, src, bronze, quarantine, ckpt, archive, available_now=True,
                                                            times=2))
    return sinks.read_bronze(spark, bronze)


@query
def stream_stable_ids(spark, sf_dir):
    """Messages without id and time, landed by two independent streams: events by reason, and how many got the same id and time."""
    from staylens.session import work_dir
    from staylens.sources import sinks
    from staylens.streaming import landing
    runs = [{n: work_dir(spark, f"ids-{n}-{k}") for n in ("bronze", "quarantine", "ckpt")} for k in range(2)]

    def start(source):
        out = []
        for r in runs:
            sinks.create_bronze(spark, r["bronze"])
            out.append(landing.start_landing(spark, source, r["bronze"], r["quarantine"], r["ckpt"], available_now=True))
        return out

    _drain(spark, sf_dir, start, columns=("value",))
    first, second = (sinks.read_bronze(spark, r["bronze"]).select("event_id", "ingestion_time", F.lit("none").alias("reason"))
                     .unionByName(sinks.read_quarantine(spark, r["quarantine"]).select("event_id", "ingestion_time", "reason")) for r in runs)
    same = second.withColumnRenamed("reason", "again")
    return (first.join(same, ["event_id", "ingestion_time"], "left").groupBy("reason")
            .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"),
                 F.count_if(F.col("again") == F.col("reason")).alias("same_again")))


# Limits that bite in the feed, which sends about one request in five minutes.
ALERT_LIMITS = {"error_rate": 0.3, "dead_letters": 0}
# Part of the last day before a bound that comes with the span after it.
LATE_FROM = "2024-01-10 12:00:00"


@query
def stream_alerts(spark, sf_dir):
    """A fifth of the first span's last twelve hours comes behind the watermark."""
    from staylens.session import work_dir
    from staylens.streaming.alerts import Thresholds, latest_windows, start_alerts
    from staylens.streaming.landing import read_messages
    out, ckpt = work_dir(spark, "s-alerts"), work_dir(spark, "a-ckpt")
    behind = (_draw("request_id", 5) == 0) & (F.col("received_at") >= F.lit(LATE_FROM).cast("timestamp")) \
        & (F.col("received_at") < F.lit(BATCH_BOUNDS[0]).cast("timestamp"))
    _drain(spark, sf_dir, lambda src: start_alerts(spark, read_messages(spark, src), out, ckpt, available_now=True,
                                                   limits=Thresholds(**ALERT_LIMITS)), late=behind)
    return latest_windows(spark, out)


@query
def contract_versions(spark, sf_dir):
    """Two contract versions and an unknown one through one gate, staged by version."""
    from staylens.operators.landing import bronze_rows, land
    from staylens.operators.silver import stage_versions
    from staylens.sources.search_feed import versioned_feed
    landed = land(versioned_feed(Flow(spark, sf_dir).events), "full")
    none = F.lit(None)
    staged = stage_versions(bronze_rows(landed)).select("schema_version", none.cast("string").alias("reason"), "guests", "trip_purpose")
    rejected = landed.where(F.col("reason").isNotNull()).select("schema_version", "reason", none.cast("int").alias("guests"),
                                                                none.cast("string").alias("trip_purpose"))
    return (staged.unionByName(rejected).groupBy("schema_version", F.coalesce("reason", F.lit("none")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("events"), F.count("guests").alias("with_guests"), F.sum("guests").alias("guests"),
                 F.count("trip_purpose").alias("with_purpose")))


# --- recovery and fallbacks ---------------------------------------------------

# Allow lists after two contract updates: one more currency, then one more country.
REPLAY_CURRENCIES = ["XYZ"]
REPLAY_COUNTRIES = ["norway"]


# The size limit after the second update: bodies that were too large pass.
REPLAY_MAX_BYTES = 4096


@query
def quarantine_replay(spark, sf_dir):
    """Two replays into stored bronze; outcomes of the second, and whether the event is in bronze after it.

    Every reason but text that is no JSON is replayed. A third of the dead letters had used up three attempts before.
    """
    from staylens import reference_data as Ref
    from staylens.operators.recovery import replay_and_land
    from staylens.session import work_dir
    from staylens.sources import sinks
    f = Flow(spark, sf_dir, gate="full", stored=("landed",))
    path = work_dir(spark, "bronze-replay")
    sinks.append_bronze_idempotent(spark, f.bronze, path, "landed")
    currencies = Ref.VALID_CURRENCIES + REPLAY_CURRENCIES
    spent = F.when(_draw("event_id", 3) == 0, 3).otherwise(1).cast("int")
    dead = f.quarantine.withColumn("attempts", spent)
    first = replay_and_land(spark, dead, path, currencies=currencies, batch="replay-1")
    again = dead.drop("attempts").join(first.select("event_id", "attempts"), "event_id")
    second = replay_and_land(spark, again, path, Ref.KNOWN_COUNTRIES + REPLAY_COUNTRIES, currencies, REPLAY_MAX_BYTES, batch="replay-2")
    stored = sinks.stored_ids(spark, path).select("event_id", F.lit(True).alias("in_bronze"))
    return second.join(stored, "event_id", "left").select(
        "event_id", "dedup_key", "outcome", "attempts", F.coalesce("in_bronze", F.lit(False)).alias("in_bronze"))


@query
def nearest_city_fallback(spark, sf_dir):
    from staylens.operators.geo_fallback import city_centroids, nearest_city, unknown_hotels
    s = Flow(spark, sf_dir, stored=("silver",)).silver
    return nearest_city(unknown_hotels(s), city_centroids(s))
