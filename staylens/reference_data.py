"""Reference data of the search-event contract and the marts.

Everything in the FIXED VALUES block must equal the upstream contract for
results to match; it is kept as data (small DataFrames / literals), not logic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the upstream contract and seed data)
# ---------------------------------------------------------------------------

PARTNER_ID = "ota-partner-1"
SCHEMA_VERSION = "v1"
MAX_REQUEST_BYTES = 2048
RATE_LIMIT_PER_SECOND = 100
RETENTION_DAYS = 90
DLQ_RAW_CHARS = 500

# Hotel dimension seed: hotel_id, city, country_iso.
DIM_HOTELS = [
    (1235, "New York", "US"),
    (1236, "Brussels", "BE"),
    (1237, "Paris", "FR"),
    (1238, "Berlin", "DE"),
    (1239, "Zurich", "CH"),
]

# Country name -> ISO code used for silver enrichment (matched on lower(trim(name))).
COUNTRY_MAP = [
    ("Belgium", "BE"),
    ("Brazil", "BR"),
    ("France", "FR"),
    ("Germany", "DE"),
    ("Netherlands", "NL"),
    ("Spain", "ES"),
    ("Switzerland", "CH"),
    ("United Kingdom", "GB"),
    ("United States", "US"),
    ("USA", "US"),
]

# Edge allow lists: lower(strip(user_country)) and currency codes.
KNOWN_COUNTRIES = [
    "belgium", "brazil", "france", "germany", "netherlands",
    "spain", "switzerland", "united kingdom", "united states", "usa",
]
VALID_CURRENCIES = ["EUR", "USD", "GBP", "CHF", "BRL"]

# Length-of-stay buckets: (label, min nights, max nights); anything else is 'other'.
LOS_BUCKETS = [("1", 1, 1), ("2", 2, 2), ("3", 3, 3), ("4-7", 4, 7), ("8-14", 8, 14)]
LOS_OTHER = "other"
ACCEPTED_LOS_BUCKETS = [b[0] for b in LOS_BUCKETS]

# Contract v1: required fields in declaration order, and their JSON types.
REQUIRED_FIELDS = [
    "arrival_date", "departure_date", "length_of_stay", "user_country", "hotel_id",
    "hotel_name", "hotel_latitude", "hotel_longitude", "timestamp", "search_results",
]
STRING_FIELDS = ["arrival_date", "departure_date", "user_country", "hotel_name", "timestamp"]
INTEGER_FIELDS = ["length_of_stay", "hotel_id"]
NUMBER_FIELDS = ["hotel_latitude", "hotel_longitude"]
# (field, minimum, maximum) inclusive numeric bounds; None = unbounded.
NUMERIC_BOUNDS = [
    ("length_of_stay", 1, 365),
    ("hotel_id", 1, None),
    ("hotel_latitude", -90, 90),
    ("hotel_longitude", -180, 180),
]
# (field, min length, max length) string length bounds.
LENGTH_BOUNDS = [("user_country", 1, 100), ("hotel_name", 1, 500)]
RESULT_ITEM_FIELDS = ["room_name", "price", "currency"]
CURRENCY_PATTERN = "^[A-Z]{3}$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# Contract v2 (FIXTURES.md 6): v1 with the party size, and optionally why they travel.
V2_REQUIRED_FIELDS = ["guests"]
V2_STRING_FIELDS = ["trip_purpose"]
V2_INTEGER_FIELDS = ["guests"]
V2_NUMERIC_BOUNDS = [("guests", 1, 20)]
V2_LENGTH_BOUNDS = [("trip_purpose", 1, 50)]

# Data-quality thresholds of the marts' monitoring checks.
GOLD_STALE_MINUTES = 30
ALERT_ERROR_RATE = 0.01          # > 1 % rejected within the window
ALERT_DEAD_LETTERS = 100         # > 100 dead letters within 5 minutes
ALERT_WINDOW = "5 minutes"
WEEKLY_HIGHLIGHT_THRESHOLD = 170

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Contract:
    """The field rules of one contract version, as data (item and business rules hold for every version)."""

    required: tuple[str, ...]
    strings: tuple[str, ...]
    integers: tuple[str, ...]
    numbers: tuple[str, ...]
    bounds: tuple[tuple, ...]
    lengths: tuple[tuple, ...]


CONTRACTS = {
    "v1": Contract(tuple(REQUIRED_FIELDS), tuple(STRING_FIELDS), tuple(INTEGER_FIELDS), tuple(NUMBER_FIELDS),
                   tuple(NUMERIC_BOUNDS), tuple(LENGTH_BOUNDS)),
    "v2": Contract(tuple(REQUIRED_FIELDS + V2_REQUIRED_FIELDS), tuple(STRING_FIELDS + V2_STRING_FIELDS),
                   tuple(INTEGER_FIELDS + V2_INTEGER_FIELDS), tuple(NUMBER_FIELDS),
                   tuple(NUMERIC_BOUNDS + V2_NUMERIC_BOUNDS), tuple(LENGTH_BOUNDS + V2_LENGTH_BOUNDS)),
}
# Contract versions landing accepts.
ACCEPTED_SCHEMA_VERSIONS = list(CONTRACTS)


def _sql_literal(x) -> str:
    return str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"


def relation(spark: SparkSession, rows, columns: list[tuple[str, str]]) -> DataFrame:
    """A5: inline relation (``VALUES``): a local relation with exact size statistics."""
    body = ", ".join("(" + ", ".join(_sql_literal(x) for x in r) + ")" for r in rows)
    names = ", ".join(c for c, _ in columns)
    casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in columns)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")


def dim_hotels(spark: SparkSession) -> DataFrame:
    return relation(spark, DIM_HOTELS, [("hotel_id", "INT"), ("city", "STRING"), ("country_iso", "STRING")])


def country_map(spark: SparkSession) -> DataFrame:
    return relation(spark, COUNTRY_MAP, [("name", "STRING"), ("iso", "STRING")])


def accepted_los_buckets(spark: SparkSession) -> DataFrame:
    return relation(spark, [(b,) for b in ACCEPTED_LOS_BUCKETS], [("los_bucket", "STRING")])

